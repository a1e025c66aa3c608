import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridspark.operators import settlement

SALES = "credito_id bigint, data_transacao timestamp_ntz, seq int, tie bigint, tie2 bigint, quantidade_kwh double, valor_rs double"


def walk(credits, requests):
    """The rule one request at a time."""
    left = {k: Decimal(str(v)) for k, v in credits.items()}
    outcome = {}
    for r in sorted(requests, key=lambda r: (r[0], r[1], r[2], r[3], r[4])):
        q = None if r[5] is None else Decimal(str(r[5]))
        if q is None:
            outcome[r[3]] = settlement.INVALID
        elif r[0] not in left:
            outcome[r[3]] = settlement.UNKNOWN_CREDIT
        elif left[r[0]] < q:
            outcome[r[3]] = settlement.TOO_LITTLE
        else:
            left[r[0]] -= q
            outcome[r[3]] = settlement.SOLD
    return outcome, {k: float(v) for k, v in left.items()}


def check(spark, credits, requests, **options):
    table = spark.createDataFrame(
        [(k, 1, float(v)) for k, v in credits.items()], "id bigint, cliente_id bigint, saldo_kwh double"
    )
    asked = spark.createDataFrame(requests, SALES)
    settled = settlement.settle(table, asked, **options)
    want, left = walk(credits, requests)
    rows = settled.collect()
    assert len(rows) == len(requests)
    assert {r["tie"]: r["status"] for r in rows} == want
    after = {r["id"]: r["saldo_kwh"] for r in settlement.balances(table, settled).collect()}
    assert after == pytest.approx(left, abs=1e-9)


def some_requests(rng, credits, n, quantity):
    import datetime

    day = datetime.datetime(2024, 1, 1)
    return [
        (rng.choice(credits), day + datetime.timedelta(days=rng.randrange(5)), rng.randrange(3), i, 0, quantity(rng), 1.0)
        for i in range(n)
    ]


@pytest.mark.parametrize("options", [{}, {"fold_limit": 3, "slice_rows": 6, "block_rows": 3}, {"fold_limit": 3}])
@pytest.mark.parametrize("seed", range(2))
def test_against_walk(spark, seed, options):
    rng = random.Random(seed)
    credits = {1: 100.0, 2: 0.0, 3: 57.25, 4: 1e6, 5: 12.5}
    quantity = [lambda r: round(r.expovariate(1 / 8), 2), lambda r: round(r.gauss(2, 8), 6)][seed]
    check(spark, credits, some_requests(rng, [1, 1, 1, 2, 3, 4, 5, 99], 200, quantity), **options)


@pytest.mark.parametrize("fold_limit", [1000, 3])
def test_odd_quantities(spark, fold_limit):
    rng = random.Random(7)
    credits = {1: 20.0, 2: -5.0, 3: 0.0}
    choices = [0.0, -1.0, 4.0, 9.5, None, -6.0, 0.000001, 30.0]
    requests = some_requests(rng, [1, 2, 3], 60, lambda r: r.choice(choices))
    check(spark, credits, requests, fold_limit=fold_limit)


@pytest.fixture
def passes(monkeypatch):
    """Folds of slices made, the last one for the outcomes left out."""
    made = []
    real = settlement._fold_slices

    def counted(blocks, starts, fold, schema):
        if fold is settlement._fold_bounds:
            made.append(starts.count())
        return real(blocks, starts, fold, schema)

    monkeypatch.setattr(settlement, "_fold_slices", counted)
    return made


@pytest.mark.parametrize("quantity", [
    lambda r: float(r.randrange(1, 50)),
    lambda r: r.randrange(1, 50) * (-1.0 if r.random() < 0.2 else 1.0),
    lambda r: r.choice([-3.0, 3.0, 2.0]),
])
def test_one_hot_credit_needs_few_passes(spark, passes, quantity):
    requests = some_requests(random.Random(3), [1], 20_000, quantity)
    check(spark, {1: 3000.0}, requests, fold_limit=100, slice_rows=1000, block_rows=250)
    assert passes[0] == 20 and len(passes) < 10 and sum(passes) < 60


def test_two_million_refunded_requests(spark, passes):
    """Outcomes are folded again here from the sorted requests."""
    table = spark.createDataFrame([(1, 5000.0)], "id bigint, saldo_kwh double")
    q = F.pmod(F.xxhash64("id"), F.lit(50)) + 1
    asked = spark.range(2_000_000).select(
        "id", F.lit(1).cast("bigint").alias("credito_id"), F.lit(1.0).alias("valor_rs"),
        F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)) == 0, -q).otherwise(q).cast("double").alias("quantidade_kwh"),
    )
    settled = settlement.settle(table, asked, ["id"], slice_rows=50_000)
    rows = settled.select("id", "quantidade_kwh", "status").orderBy("id").toPandas()
    assert passes[0] == 34 and len(passes) < 10  # slices of whole blocks
    left, want = 5000.0, []
    for q in rows["quantidade_kwh"]:
        want.append(left >= q)
        left -= q if left >= q else 0
    assert ((rows["status"] == settlement.SOLD) == want).all()


def test_amounts_beyond_64_bits(spark):
    wide = [9e18, -9e18, 3e18, 5.0, 1e20, -2e19, 1.5e19]
    requests = some_requests(random.Random(9), [1, 2], 40, lambda r: r.choice(wide))
    check(spark, {1: 2e19, 2: -1e19}, requests, fold_limit=3, slice_rows=4, block_rows=2)


def test_long_fold_crosses_blocks(spark):
    requests = some_requests(random.Random(6), [1, 2], 700, lambda r: r.choice([-2.0, 1.5, 4.0, None]))
    check(spark, {1: 3.0, 2: 100.0}, requests)


def test_only_unknown_hot_credits(spark):
    requests = some_requests(random.Random(1), [8], 20, lambda r: 1.0)
    check(spark, {1: 5.0}, requests, fold_limit=5)


def test_token_value_and_flag(spark):
    table = spark.createDataFrame([(1, 1, 10.0)], "id bigint, cliente_id bigint, saldo_kwh double")
    asked = spark.createDataFrame(
        [(1, None, 1, 1, 1, -2.0, 8.0, None), (1, None, 2, 1, 1, 3.0, 8.0, 5.0)],
        SALES + ", valor_token double",
    )
    rows = {r["seq"]: r for r in settlement.settle(table, asked).collect()}
    assert (rows[1]["valor_token"], rows[1]["sinal_suspeito"]) == (2.0, 1)
    assert (rows[2]["valor_token"], rows[2]["sinal_suspeito"]) == (5.0, 0)
    assert {r["status"] for r in rows.values()} == {settlement.SOLD}


def test_requests_without_a_known_credit_join_no_group(spark):
    credits = spark.createDataFrame([(1, 5e12)], "id bigint, saldo_kwh double")
    rows = [(k, None if k % 2 else 99, 1.0, 1.0) for k in range(50)] + [(100, 1, 2e12, 1.0)]
    requests = spark.createDataFrame(rows, "id bigint, credito_id bigint, quantidade_kwh double, valor_rs double")
    got = settlement.settle(credits, requests, ["id"], fold_limit=5).collect()
    assert len(got) == 51
    assert {r["status"] for r in got if r["id"] < 100} == {settlement.UNKNOWN_CREDIT}
    assert [r["status"] for r in got if r["id"] == 100] == [settlement.SOLD]


def test_hot_requests_are_dealt_once(spark, monkeypatch):
    """Into blocks; a pass moves quantities, and outcomes are told where the blocks lie."""
    whole, real = [], settlement.materialise

    def kept(df, label, **options):
        if "valor_rs" in df.columns:
            whole.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, label, **options)

    monkeypatch.setattr(settlement, "materialise", kept)
    requests = some_requests(random.Random(5), [1, 2], 4000, lambda r: float(r.randrange(-5, 30)))
    table = spark.createDataFrame([(1, 900.0), (2, 300.0)], "id bigint, saldo_kwh double")
    asked = spark.createDataFrame(requests, SALES)
    settled = settlement.settle(table, asked, fold_limit=100, slice_rows=500, block_rows=100)
    assert [label for label, _ in whole] == ["settlement-blocks"]
    assert whole[0][1].count("rangepartitioning") == 1
    assert settled.count() == 4000


def test_hot_credit_without_a_balance(spark):
    table = spark.createDataFrame([(1, None), (2, 5.0)], "id bigint, saldo_kwh double")
    requests = some_requests(random.Random(2), [1, 2], 60, lambda r: 1.0)
    rows = settlement.settle(table, spark.createDataFrame(requests, SALES), fold_limit=5).collect()
    assert len(rows) == 60
    assert {r["status"] for r in rows if r["credito_id"] == 1} == {settlement.UNKNOWN_CREDIT}
    assert sum(r["status"] == settlement.SOLD for r in rows) == 5
