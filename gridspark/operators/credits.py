"""Energy credits: clients, issuance, surplus crediting, balances, statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.operators.measurements import surplus_by_client
from gridspark.operators.rowsets import dense_ids, keep_first, keep_last
from gridspark.session import materialise

# Credit terms.
LIFETIME_DAYS = 1825
TOKEN_SHARE = 0.25
CAPACITY_FACTOR = 0.15
MONTH_DAYS = 30
OPENING_PRICE_RS = 0.80
OPENING_PRICE_TOKEN = 0.20


def _day(as_of: str) -> Column:
    return F.lit(as_of).cast("date")


def _token_id(kind: str, owner: Column, as_of: str) -> Column:
    """Differs by the kind of owner, the owner, the credit's own id and the day."""
    parts = [F.lit(kind), owner.cast("string"), F.col("id").cast("string"), F.lit(as_of)]
    return F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, 16)


def register_clients(people: DataFrame) -> DataFrame:
    """Client rows with the tax id replaced by its SHA-256.

    ``people`` has id, cpf_cnpj, tipo and optionally carteira and did.
    """
    optional = [
        (F.col(c) if c in people.columns else F.lit(None).cast("string")).alias(c)
        for c in ["carteira", "did"]
    ]
    return people.select("id", F.sha2("cpf_cnpj", 256).alias("cpf_cnpj_hash"), "tipo", *optional)


def estimated_kwh(
    kw: Column, factor: float = CAPACITY_FACTOR, days: int = MONTH_DAYS
) -> Column:
    """Energy a unit yields over ``days`` at a capacity factor."""
    return kw * 24 * days * factor


def issue_credits(
    units: DataFrame, price_rs: float, as_of: str, contract: str | None = None, start_id: int = 1
) -> DataFrame:
    """A credit per unit (mmgd_fato_id, cliente_id, potencia_kw), ids in unit order."""
    drafted = units.select(
        "mmgd_fato_id",
        "cliente_id",
        estimated_kwh(F.col("potencia_kw")).alias("saldo_kwh"),
        F.lit(float(price_rs)).alias("valor_unitario_rs"),
        F.lit(price_rs * TOKEN_SHARE).alias("valor_unitario_token"),
        F.date_add(_day(as_of), LIFETIME_DAYS).alias("data_vencimento"),
        F.lit(contract).cast("string").alias("token_contrato"),
    )
    numbered = dense_ids(drafted, "mmgd_fato_id", "id", start_id)
    return numbered.withColumn("token_id", _token_id("unidade", F.col("mmgd_fato_id"), as_of))


def live(credits: DataFrame, as_of: str) -> DataFrame:
    """Credits that expire after ``as_of``, spent ones included."""
    return credits.filter(F.col("data_vencimento") > _day(as_of))


def earliest_live(credits: DataFrame, as_of: str) -> DataFrame:
    """Per client the live credit that expires first."""
    return keep_first(live(credits, as_of), "cliente_id", ["data_vencimento", "id"])


def available(credits: DataFrame, as_of: str, client: int | None = None) -> DataFrame:
    """Live credits with a balance; one client's come by expiry."""
    rows = live(credits, as_of).filter(F.col("saldo_kwh") > 0)
    if client is None:
        return rows
    return rows.filter(F.col("cliente_id") == client).orderBy("data_vencimento", "id")


def credit_surplus(credits: DataFrame, fresh: DataFrame, as_of: str) -> DataFrame:
    """The credit table after crediting the surplus of fresh measurements."""
    return apply_surplus(credits, surplus_by_client(fresh), as_of)


def apply_surplus(credits: DataFrame, surplus: DataFrame, as_of: str) -> DataFrame:
    """The credit table after crediting a sum per client (cliente_id, excedente_kwh).

    A client's surplus goes to the live credit that expires first, or opens a
    new one. The sums are written to the scratch area first (eager): they serve
    both cases, and the measurements behind them are read once.
    """
    targets = earliest_live(credits, as_of).select("cliente_id", F.col("id").alias("credito_id"))
    earned = materialise(surplus.join(targets, "cliente_id", "left"), "surplus")
    additions = earned.filter(F.col("credito_id").isNotNull()).select(
        F.col("credito_id").alias("id"), "excedente_kwh"
    )
    topped = (
        credits.join(additions, "id", "left")
        .withColumn("saldo_kwh", F.col("saldo_kwh") + F.coalesce("excedente_kwh", F.lit(0.0)))
        .select(credits.columns)
    )
    drafted = earned.filter(F.col("credito_id").isNull()).select(
        "cliente_id",
        F.col("excedente_kwh").alias("saldo_kwh"),
        F.lit(OPENING_PRICE_RS).alias("valor_unitario_rs"),
        F.lit(OPENING_PRICE_TOKEN).alias("valor_unitario_token"),
        F.date_add(_day(as_of), LIFETIME_DAYS).alias("data_vencimento"),
    )
    top_id = credits.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    opened = dense_ids(drafted, "cliente_id", "__n").withColumn("id", F.col("__n") + top_id)
    opened = opened.withColumn("token_id", _token_id("cliente", F.col("cliente_id"), as_of))
    columns = [c for c in opened.columns if c in credits.columns]
    return topped.unionByName(opened.select(columns), allowMissingColumns=True)


def client_balance(
    credits: DataFrame, measurements: DataFrame, as_of: str, client: int | None = None
) -> DataFrame:
    """Balance of the earliest live credit and the last measurement per client, with the battery's charge."""
    if "bateria_soc" not in measurements.columns:
        measurements = measurements.withColumn("bateria_soc", F.lit(None).cast("double"))
    if client is not None:
        credits = credits.filter(F.col("cliente_id") == client)
        measurements = measurements.filter(F.col("cliente_id") == client)
    first = earliest_live(credits, as_of).select(
        "cliente_id", F.col("saldo_kwh").alias("saldo"), "valor_unitario_rs", "data_vencimento"
    )
    tie = [c for c in ["dispositivo", "geracao_kw", "consumo_kw"] if c in measurements.columns]
    last = keep_last(measurements, ["cliente_id"], ["ts", *tie]).select(
        "cliente_id", F.col("ts").alias("ultima_medicao"), "geracao_kw", "consumo_kw", "bateria_soc"
    )
    return first.join(last, "cliente_id", "full").select(
        "cliente_id",
        F.coalesce("saldo", F.lit(0.0)).alias("saldo_kwh"),
        "valor_unitario_rs",
        "data_vencimento",
        "ultima_medicao",
        "geracao_kw",
        "consumo_kw",
        "bateria_soc",
    )


def statement(transactions: DataFrame, credits: DataFrame, client: int | None = None) -> DataFrame:
    """Transactions of the clients owning the credits; one client's newest first."""
    owners = credits.select(F.col("id").alias("credito_id"), "cliente_id")
    if client is not None:
        owners = owners.filter(F.col("cliente_id") == client)
    rows = transactions.join(owners, "credito_id")
    return rows if client is None else rows.orderBy(F.desc("data_transacao"))
