import datetime
import re

from gridspark.llm import mixing, url_filters
from tests.llm import helpers


def test_mix_of_awkward_rows(spark):
    docs = helpers.documents(spark)
    rows = mixing.decided(docs).select("row.doc_id", "row.text", "row.source", "size", "source_size", "target", "copies").collect()
    assert len(rows) == len(helpers.ROWS)
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) and 0 <= r["copies"] <= 3
        assert r["target"] <= 3 * r["source_size"]
        assert r["size"] or not r["copies"]
    taken = mixing.mix(docs)
    assert taken.columns == docs.columns and taken.count() == sum(r["copies"] for r in rows)
    assert mixing.mix(docs.limit(0)).count() == 0
    again = mixing.decided(docs.repartition(5)).select("row.doc_id", "copies").collect()
    assert sorted(map(tuple, again), key=str) == sorted(((r["doc_id"], r["copies"]) for r in rows), key=str)


def test_repeated_rows_stay_within_the_target(spark):
    import random

    rng = random.Random(4)
    rows = [(7, "w " * 10, "en", "a")] * 301 + [(100 + k, "w " * rng.randrange(1, 30), "en", rng.choice("ab")) for k in range(300)]
    rows += [(None, "w " * 3, "en", "b")] * 50
    got = mixing.decided(helpers.documents(spark, rows)).select("row.doc_id", "row.source", "size", "target", "copies").collect()
    assert len({r["copies"] for r in got if r["doc_id"] == 7}) == 1
    for source in "ab":
        mine = [r for r in got if r["source"] == source]
        taken, target = sum(r["copies"] * r["size"] for r in mine), mine[0]["target"]
        # A group of repeats is taken whole or not: the gap is smaller than such a group.
        assert target - 3010 <= taken <= target + 1e-6


def test_targets_are_shared_up_to_their_limits(spark):
    sized = spark.createDataFrame([("=a", "a", 10), ("=b", "b", 1000), ("=c", "c", 1000), ("", None, 0)], "key string, source string, size long")
    got = {r["key"]: r["target"] for r in mixing.source_targets(sized).collect()}
    # a stops at 30; b and c share the rest 2 to 3; the empty source gets nothing.
    assert got == {"=a": 30.0, "=b": 1980 * 2 / 5, "=c": 1980 * 3 / 5, "": 0.0}


def test_as_of_join_equals_intervals(spark):
    """Against every pair of a question and an interval, on dense random dates."""
    import random

    rng = random.Random(8)
    day = lambda: datetime.date(2024, 1, 1) + datetime.timedelta(days=rng.randrange(25))
    names = ["k1", "k2", "k3", "k4"]
    log = [(rng.choice(names), day(), rng.choice(["add", "remove", "add"]), rng.choice("xy")) for _ in range(60)]
    entries = spark.createDataFrame(log, "key string, listed_on date, action string, category string")
    asked = [(rng.choice([*names, "other", None]), rng.choice([day(), day(), None])) for _ in range(300)]
    got = url_filters.as_of(spark.createDataFrame(asked, "key string, fetched_on date"), url_filters.intervals(entries))
    spans = [tuple(r) for r in url_filters.intervals(entries).select("key", "valid_from", "valid_to", "category").collect()]
    want = {(k, d, c, a) for k, d in asked for key, a, z, c in spans if k == key and d and a <= d < z}
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_url_list_over_time(spark):
    day = datetime.date
    entries = spark.createDataFrame(
        [
            ("bad.example", day(2024, 1, 10), "add", "spam"), ("bad.example", day(2024, 2, 1), "remove", "spam"),
            ("ok.bad.example", day(2024, 1, 15), "add", "allow"), ("bad.example/x", day(2024, 1, 20), "add", "adult"),
            ("bad.example/x", day(2024, 1, 20), "add", "adult"), (None, day(2024, 1, 1), "add", "spam"), ("bad.example", None, "add", "spam"),
            ("[2001:db8::7]", day(2024, 1, 1), "add", "spam"), ("0.7", day(2024, 1, 1), "add", "spam"), ("10.0.0.8", day(2024, 1, 2), "add", "spam"),
        ],
        "key string, listed_on date, action string, category string",
    )
    captures = [
        (1, "http://www.BAD.example:80/", day(2024, 1, 9), False), (2, "http://www.bad.example./", day(2024, 1, 10), True),
        (3, "http://ok.bad.example/", day(2024, 1, 12), True), (4, "http://ok.bad.example/", day(2024, 1, 15), False),
        (5, "http://bad.example/x/y?q#f", day(2024, 2, 5), True), (6, "http://bad.example/xy", day(2024, 2, 5), False),
        (7, None, day(2024, 1, 11), False), (8, "no url", day(2024, 1, 11), False), (9, "http://bad.example/", None, False),
        (2, "http://www.bad.example./", day(2024, 1, 10), True), (None, "http://bad.example", day(2024, 1, 31), True),
        (10, "http://[2001:db8::7]:8080/a", day(2024, 1, 2), True), (11, "http://u@10.0.0.7/", day(2024, 1, 2), False),
        (12, "http://10.0.0.8:80/", day(2024, 1, 2), True), (13, "http://bad.example/" + "x/" * 2_000, day(2024, 2, 5), True),
    ]
    frame = spark.createDataFrame([(*c, "x") for c in captures], "page_id long, url string, fetched_on date, want boolean, key string")
    got = url_filters.evaluate(frame, entries).select("page_id", "blocked").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((c[0], c[3]) for c in captures), key=str)
    assert url_filters.evaluate(frame, entries.limit(0)).filter("blocked OR active_entries > 0").count() == 0
    assert url_filters.evaluate(frame.limit(0), entries).count() == 0
