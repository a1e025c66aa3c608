"""URL filters by a temporal list join.

A list is a log of dated entries: on a date a key (a host, a parent domain, or a
host with a path prefix) is added with a category, or removed. Entries become
validity intervals, and each capture is evaluated against the entries that were
active when it was fetched. The most specific active key decides: its category
``allow`` lets the capture pass, any other category blocks it. An IP address has
no parent domains.

Defined results: a capture without URL, host or fetch date matches nothing and
passes; entries without key or date are ignored; of several entries for one key
on one date the one with the greatest (category, action) counts; a repeated
``add`` starts a new interval; empty tables give no rows or no matches. Repeated
captures are repeated in the result, URLs of any length are taken whole, and other
columns are never looked at.

The as-of join is linear: the dates asked for of a key and the starts of its
intervals stand in one order, and each date takes the last start before it. A key has
at most as many rows there as the calendar has days, however many captures name it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALLOW = "allow"
FOREVER = "9999-12-31"


def host(url: Column) -> Column:
    """Lower-case host without user, port or closing dot; null where there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)", 1)
    return F.nullif(F.lower(F.rtrim(found, F.lit("."))), F.lit(""))


def path(url: Column) -> Column:
    """Path from the slash on, without query and fragment."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    return F.when(F.length(found) > 0, found).otherwise("/")


def keys(url: Column) -> Column:
    """Keys that could name a URL, the most specific last: parent domains, the host, path prefixes."""
    labels = F.split(host(url), r"\.")
    count = F.size(labels)
    address = host(url).rlike(r"^(\[.*|[0-9]+(\.[0-9]+){3})$")
    parents = F.transform(
        F.sequence(F.when(address, count).otherwise(F.least(F.lit(2), count)), count),
        lambda n: F.array_join(F.slice(labels, count - n + 1, n), "."),
    )
    segments = F.filter(F.split(path(url), "/"), lambda s: s != "")
    prefixes = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(segments)), lambda n: n > 0),
        lambda n: F.concat(host(url), F.lit("/"), F.array_join(F.slice(segments, 1, n), "/")),
    )
    return F.when(host(url).isNotNull(), F.concat(parents, prefixes))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals [valid_from, valid_to) of ``entries`` (key, listed_on, action, category)."""
    clean = (
        entries.filter("key IS NOT NULL AND listed_on IS NOT NULL")
        .groupBy(F.lower("key").alias("key"), F.col("listed_on").cast("date").alias("valid_from"))
        .agg(
            F.max(
                F.struct(
                    F.coalesce("category", F.lit("")).alias("category"),
                    F.coalesce("action", F.lit("")).alias("action"),
                )
            ).alias("entry")
        )
    )
    following = F.lead("valid_from").over(Window.partitionBy("key").orderBy("valid_from"))
    return (
        clean.withColumn("valid_to", F.coalesce(following, F.to_date(F.lit(FOREVER))))
        .filter(F.col("entry.action") == "add")
        .select("key", "valid_from", "valid_to", F.col("entry.category").alias("category"))
    )


def as_of(asked: DataFrame, active: DataFrame) -> DataFrame:
    """The interval of each (key, fetched_on) of ``asked`` that holds on that date: with category, valid_from.

    Both sides come once for each key and date; a start sorts before a question of its date.
    """
    start = F.struct("valid_from", "valid_to", "category").alias("start")
    starts = active.select("key", F.col("valid_from").alias("day"), F.lit(False).alias("asks"), start)
    none = F.lit(None).cast("struct<valid_from:date,valid_to:date,category:string>").alias("start")
    questions = asked.filter("key IS NOT NULL AND fetched_on IS NOT NULL").select(
        "key", F.col("fetched_on").alias("day"), F.lit(True).alias("asks"), none
    )
    upto = Window.partitionBy("key").orderBy("day", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    latest = starts.unionByName(questions.distinct()).withColumn("found", F.last("start", ignorenulls=True).over(upto))
    return latest.filter(F.col("asks") & (F.col("day") < F.col("found.valid_to"))).select(
        "key", F.col("day").alias("fetched_on"), F.col("found.category").alias("category"), F.col("found.valid_from").alias("valid_from")
    )


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per capture (page_id, url, fetched_on): its host, active keys and verdict.

    Columns: page_id, host, fetched_on, active_entries, rule, category,
    listed_since, blocked.
    """
    asked = captures.select(
        "page_id",
        "url",
        F.col("fetched_on").cast("date").alias("fetched_on"),
    )
    # A URL's answer depends on its keys and date only: equal ones are looked up once.
    partitions = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The distinct URLs are few bytes but many keys: keep them spread.
    urls = asked.select("url", "fetched_on").distinct().repartition(partitions, "url", "fetched_on")
    wanted = urls.select("url", "fetched_on", F.posexplode(keys(F.col("url"))).alias("depth", "key"))
    hits = wanted.join(as_of(wanted, intervals(entries)), ["key", "fetched_on"])
    answers = hits.groupBy("url", "fetched_on").agg(
        F.count(F.lit(1)).alias("active_entries"),
        F.max(F.struct("depth", "key", "category", "valid_from")).alias("best"),
    )
    return (
        asked.alias("c")
        .join(
            answers.alias("h"),
            F.col("c.url").eqNullSafe(F.col("h.url"))
            & F.col("c.fetched_on").eqNullSafe(F.col("h.fetched_on")),
            "left",
        )
        .select(
            "page_id",
            host(F.col("c.url")).alias("host"),
            F.col("c.fetched_on").alias("fetched_on"),
            F.coalesce("active_entries", F.lit(0)).cast("bigint").alias("active_entries"),
            F.col("best.key").alias("rule"),
            F.col("best.category").alias("category"),
            F.col("best.valid_from").alias("listed_since"),
            F.coalesce(F.col("best.category") != ALLOW, F.lit(False)).alias("blocked"),
        )
    )
