"""Typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cadastra.functions.cleansing import typed_columns
from cadastra.sources.bronze import OK
from cadastra.sources.committed import CODEC, write_once


def cast_schema(raw: DataFrame, schema: StructType) -> DataFrame:
    """Text columns to their declared types; unreadable or out-of-range numbers become null."""
    return raw.select(*typed_columns(schema))


def write(df: DataFrame, path: str, overwrite: bool = False, max_records_per_file: int = 0) -> bool:
    """Parquet; a committed table is left alone (and False returned) unless ``overwrite`` is set."""
    return write_once(df, path, overwrite, maxRecordsPerFile=max_records_per_file)


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table, whether written as one or in batches; without its quarantine, if it has one."""
    table = spark.read.schema(schema).parquet(path)
    if "reason" in table.columns:
        table = table.where(F.col("reason") == OK)
    return table.select(*schema.names)


QUARANTINE = StructType([StructField("file", StringType()), StructField("block", LongType()), StructField("line", StringType())])


def write_judged(judged: DataFrame, path: str, schema: StructType, overwrite: bool = False) -> bool:
    """The table and its quarantine, from ``bronze.read_judged``: one pass, and one commit for both. Rows that do not fit lie in
    partitions of their own, one per reason."""
    place = [f.name for f in QUARANTINE.fields]
    typed_rows = judged.select(*typed_columns(schema), *place, "reason")
    return write_once(typed_rows, path, overwrite, parts=["reason"])


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """(reason, file, block, line) of the records that did not fit; ``block`` is where the part of the file begins that holds it."""
    table = spark.read.schema(QUARANTINE).parquet(path)
    return table.where(F.col("reason") != OK).select("reason", *QUARANTINE.names)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Catalog table laid out by ``key``: joins of equally bucketed tables need no exchange.

    Meant for tables without hot keys; rows of one key always share a bucket. With ``path`` the files lie there, and a session
    whose catalog does not know the table can name it anew (``open_bucketed``).
    """
    writer = df.write.mode("overwrite").format("parquet").option("compression", CODEC).bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def open_bucketed(spark: SparkSession, table: str, path: str, schema: StructType, key: str, buckets: int) -> None:
    """Names the files of a bucketed table in this session's catalog."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    layout = f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {layout} LOCATION '{path}'")
