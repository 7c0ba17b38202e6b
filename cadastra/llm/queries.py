"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import (
    alignment,
    ann,
    decontaminate,
    hardneg,
    htmltext,
    licenses,
    linededup,
    mixing,
    quality,
    secrets,
    sharding,
    simhash,
    sql,
    urls,
)
from cadastra.llm.common import scratch_folder, stored

URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
QUERY_EVERY = 20
ANCHOR_EVERY = 50
MOVED_EVERY = 7


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"), licenses.catalogue(spark))
    return found.select("doc_id", "digest", "license", F.array_join("notices", ",").alias("notices"))


def quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels"))
    scored = quality.scored(docs, model)
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = linededup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge_urls(table(spark, folder, "pages").select("page_id", "url"), urls.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def benchmark_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored(mixing.sized(table(spark, folder, "documents"), "doc_id"), scratch_folder(spark, "mix-sizes"))
    drawn = mixing.mix(rows, mixing.draws(rows))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"])
    return drawn.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    versions = table(spark, folder, "documents").select("doc_id", "text")
    ledger = secrets.SecretLedger(spark)
    ledger.scan(versions)
    found = ledger.findings_of(versions)

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("findings", lambda f: f["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id",
        *map(count, ("assign", "access", "hex")),
        F.sha2(secrets.listing(base), 256).alias("base_sha256"),
        secrets.listing(F.col("findings")).alias("spans"),
    )


def table_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "slot", "shard")


def graph_search(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


def simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.groups(table(spark, folder, "documents"))
    digits = F.lower(F.lpad(F.hex(F.col("fps")[0]), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def main_text(spark: SparkSession, folder: str) -> DataFrame:
    return htmltext.extract(table(spark, folder, "pages"))


def hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % MOVED_EVERY == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, folder, "embeddings").withColumn("label", moved), F.col("vec_id") % ANCHOR_EVERY == 0)


def token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    documents, _ = alignment.align(table(spark, folder, "documents").select("doc_id", "text"), digest=True)
    return documents.withColumnRenamed("groups", "groups_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": license_scan,
        "op2_quality_votes": quality_votes,
        "op3_line_dedup": line_dedup,
        "op4_url_filter": url_filter,
        "op5_benchmark_scan": benchmark_scan,
        "op6_source_mix": source_mix,
        "op7_secret_scan": secret_scan,
        "op8_table_sharding": table_sharding,
        "op9_graph_search": graph_search,
        "op10_simhash_groups": simhash_groups,
        "op11_main_text": main_text,
        "op12_hard_negatives": hard_negatives,
        "op13_token_alignment": token_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": sql.license_scan(),
        "op3_line_dedup": sql.LINE_DEDUP,
        "op4_url_filter": sql.url_filter(URL_RULES),
        "op5_benchmark_scan": sql.benchmark_scan(),
        "op6_source_mix": sql.source_mix(),
        "op7_secret_scan": sql.SECRET_SCAN,
        "op12_hard_negatives": sql.HARD_NEGATIVES,
    }
