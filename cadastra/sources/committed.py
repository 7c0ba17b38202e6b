"""Tables that count as present only once the job that wrote them has committed."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

MARK = "_SUCCESS"
# a quarter smaller than Spark's default, in the same time
CODEC = "zstd"


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a file is there, on any file system Spark can read; other errors than its absence are raised."""
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def is_committed(spark: SparkSession, path: str) -> bool:
    """True if the folder has the mark that Spark's writers leave last; a job that was cut short leaves none."""
    return _exists(spark, f"{path.rstrip('/')}/{MARK}")


def write_once(df: DataFrame, path: str, overwrite: bool = False, parts: list[str] | None = None, **options) -> bool:
    """Write Parquet unless a committed table is there already; the leftovers of a failed job are replaced."""
    if not overwrite and is_committed(df.sparkSession, path):
        return False
    options = {"partitionOverwriteMode": "static", "compression": CODEC, **options}
    df.write.mode("overwrite").options(**options).partitionBy(*parts or []).parquet(path)
    return True


def write_note(spark: SparkSession, path: str, values: dict) -> None:
    """A one-row table of settings beside the data they describe."""
    rows = [(str(k), str(v)) for k, v in values.items()]
    spark.createDataFrame(rows, "name string, value string").coalesce(1).write.mode("overwrite").parquet(path)


def read_note(spark: SparkSession, path: str) -> dict[str, str]:
    return {row["name"]: row["value"] for row in spark.read.parquet(path).collect()}
