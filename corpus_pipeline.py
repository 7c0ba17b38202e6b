"""A training corpus from ``documents``: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import decontaminate, mixing, quality, sharding, simhash
from cadastra.llm.common import scratch_folder

#: Near copies that share four in five of their five-word shingles differ in eleven bits of a fingerprint of these on average,
#: beyond any table's reach. Fingerprints of the distinct words differ in four or five; two of them, of different hashes,
#: with candidates up to eight bits, find nearly all of these pairs.
FEATURES = tuple(simhash.Feature(width=1, distinct=True, seed=seed) for seed in (42, 43))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose neighbours vote for quality."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return quality.scored(docs, model).where(F.col("score") >= quality.THRESHOLD).select(*columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return simhash.one_of_each(docs, FEATURES)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every draw of the mix as a row, so a document may appear up to four times, or in part."""
    return mixing.materialised(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``slot`` and ``shard``."""
    return sharding.place(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing sources to target weights", mix_sources),
    ("sharding", assign_shards),
]

#: SQL can express neither the classifier nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
