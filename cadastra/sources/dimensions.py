"""Code/description tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadastra.schemas import DOMAIN, DOMAIN_TABLES
from cadastra.sources import bronze, silver


def build(spark: SparkSession, bronze_root: str, gold_root: str, overwrite: bool = False) -> None:
    """One Parquet table per domain folder; existing ones are kept."""
    for folder, table in DOMAIN_TABLES.items():
        raw = bronze.read_raw(spark, f"{bronze_root}/{folder}", DOMAIN)
        silver.write(silver.cast_schema(raw, DOMAIN), f"{gold_root}/{table}", overwrite)


def load(spark: SparkSession, gold_root: str, table: str) -> DataFrame:
    return silver.read(spark, f"{gold_root}/{table}", DOMAIN)


def load_all(spark: SparkSession, gold_root: str) -> dict[str, DataFrame]:
    """Every dimension by its domain name, in lower case."""
    return {folder.lower(): load(spark, gold_root, table) for folder, table in DOMAIN_TABLES.items()}
