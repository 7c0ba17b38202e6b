"""Dated snapshots of the fact table, one partition per snapshot and load.

A load writes into a folder of its own and leaves a mark last. Only marked loads count: the remains of a job that was cut short are
not listed, not read, and do not keep a snapshot from being written. A snapshot that is written anew gets a new load; reads that
began before keep theirs.
"""

from __future__ import annotations

import re
import uuid
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cadastra.operators.clustering import clustered
from cadastra.schemas import FACT
from cadastra.sources.committed import CODEC

LOAD = "load"
SNAPSHOTS = StructType([*FACT.fields, StructField("snapshot", StringType(), True), StructField(LOAD, StringType(), True)])
LATEST, ALL = "latest", "all"
MARKS = "_marks"
CLUSTERED = ["data_inicio_atividade", "uf", "cnae_fiscal_principal"]


def _marked(spark: SparkSession, path: str) -> dict[str, tuple[int, str]]:
    """(number, load) of the last complete load of each snapshot. A mark is one file, put in place by a rename."""
    try:
        files = spark.read.format("binaryFile").load(f"{path}/{MARKS}/*/*/part-*").inputFiles()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    found: dict[str, tuple[int, str]] = {}
    for file in files:
        name, number, load = re.search(rf"/{MARKS}/([^/]+)/(\d+)-(\w+)/", file).groups()
        # the path in a file's name is encoded once more
        name = unquote(unquote(name))
        found[name] = max(found.get(name, (-1, "")), (int(number), load))
    return found


def snapshots(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete snapshots, in order. No data is read."""
    return sorted(_marked(spark, path))


def write_snapshot(
    fact: DataFrame,
    path: str,
    snapshot: str,
    overwrite: bool = False,
    max_records_per_file: int = 0,
    cluster: bool = False,
    files: int | None = None,
) -> bool:
    """Add one snapshot. An existing one is kept (and False returned) unless ``overwrite`` is set.

    Rows are ordered by opening date inside each file, which makes the row-group statistics selective
    for the activity window. With ``cluster`` they are dealt by opening date, state and activity together (into
    ``files``, if given), at the price of a shuffle, so filters on each of these leave most files unread.
    """
    spark = fact.sparkSession
    number, _ = _marked(spark, path).get(snapshot, (-1, ""))
    if number >= 0 and not overwrite:
        return False
    load = uuid.uuid4().hex
    ordered = clustered(fact, CLUSTERED, FACT.names[0], files) if cluster else fact.sortWithinPartitions(CLUSTERED[0])
    (
        ordered.withColumns({"snapshot": F.lit(snapshot), LOAD: F.lit(load)})
        .write.mode("append")
        .options(maxRecordsPerFile=max_records_per_file, compression=CODEC)
        .partitionBy("snapshot", LOAD)
        .parquet(path)
    )
    mark = spark.createDataFrame([(snapshot,)], "snapshot string").coalesce(1)
    mark.write.parquet(f"{path}/{MARKS}/{quote(snapshot, safe='')}/{number + 1}-{load}")
    return True


def _is(marked: dict[str, tuple[int, str]], name: str) -> Column:
    return (F.col("snapshot") == name) & (F.col(LOAD) == marked[name][1])


def read(spark: SparkSession, path: str, snapshot: str = LATEST) -> DataFrame:
    """The latest snapshot, a named one, or every one; partition pruning keeps the others unread."""
    marked = _marked(spark, path)
    if not marked:
        raise FileNotFoundError(f"{path} holds no complete snapshot")
    if snapshot == ALL:
        chosen = F.lit(False)
        for name in marked:
            chosen = chosen | _is(marked, name)
    else:
        name = max(marked) if snapshot == LATEST else snapshot
        chosen = _is(marked, name) if name in marked else F.lit(False)
    return spark.read.schema(SNAPSHOTS).parquet(path).where(chosen).drop(LOAD)
