"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm import centroids, chat, exact_dedup, fingerprints, mixing, near_dedup, packing, phrases, quality, sanitise, token_files, url_filters, warc
from gridspark.session import scratch_path

PACK_END, FILE_END = 1, 2

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _draw(key):
    """A number from a key's digest, to date the entries of the test lists."""
    return F.conv(F.substring(F.md5(key), 1, 6), 16, 10).cast("bigint")


def url_captures(pages: DataFrame) -> DataFrame:
    """Pages as captures: the table has no fetch date, so one is spread over 2024 by id."""
    day = F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), day).alias("fetched_on"))


def url_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the pages' own hosts, their domains and first path segments."""
    url = F.col("url")
    named = pages.select(url_filters.host(url).alias("host"), url_filters.keys(url).alias("keys"))
    hosts = named.filter("host IS NOT NULL").select("host", "keys").distinct()
    domains = hosts.select(F.col("keys")[0].alias("key"), F.lit("domain").alias("kind"))
    plain = hosts.select(F.col("host").alias("key"), F.lit("host").alias("kind"))
    first = F.filter("keys", lambda k: k.contains("/"))
    prefixes = hosts.filter(F.size(first) > 0).select(first[0].alias("key"), F.lit("path").alias("kind"))
    drawn = domains.union(plain).union(prefixes).distinct().withColumn("n", _draw(F.concat_ws(":", "kind", "key")))

    def entry(kind, modulus, offset, action, category):
        day = (F.col("n") % 200 + offset).cast("int")
        return drawn.filter((F.col("kind") == kind) & (F.col("n") % modulus == 0)).select(
            "key",
            F.date_add(F.lit("2024-01-01").cast("date"), day).alias("listed_on"),
            F.lit(action).alias("action"),
            F.lit(category).alias("category"),
        )

    return (
        entry("host", 3, 0, "add", "gambling")
        .union(entry("host", 3, 60, "remove", "gambling"))
        .union(entry("host", 6, 150, "add", "adult"))
        .union(entry("domain", 5, 10, "add", "spam"))
        .union(entry("path", 4, 20, "add", "allow"))
        .union(entry("path", 8, 90, "remove", "allow"))
    )


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.evaluate(url_captures(pages), url_entries(pages))


def op2_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], SCHEMAS["conversations"]
    )
    turns = table(spark, sf_dir, "conversations").unionByName(planted)
    return chat.read_back(chat.windows(turns, tokenizer=tokenizer_file()))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.scored(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_file(), PACK_END)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(table(spark, sf_dir, "documents"))


def op7_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-planes")
    token_files.write(table(spark, sf_dir, "documents"), folder, tokenizer_file(), FILE_END)
    return token_files.read_documents(spark, folder)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.decided(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder, compress=True)
    return warc.read(spark, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.spans(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_chat_windows": op2_chat_windows,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality": op4_quality,
    "op5_packing": op5_packing,
    "op6_fingerprints": op6_fingerprints,
    "op7_token_planes": op7_token_planes,
    "op8_source_mix": op8_source_mix,
    "op9_near_dedup": op9_near_dedup,
    "op10_warc": op10_warc,
    "op11_phrases": op11_phrases,
    "op12_centroids": op12_centroids,
    "op13_sanitise": op13_sanitise,
}
