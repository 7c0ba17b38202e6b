"""Joins that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_TASK = 4_000_000
# some 300 MB
WIDE_ROWS_PER_TASK = 500_000


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> dict:
    """Keys too heavy for one task, each with the number of slices it should be cut into.

    One exact counting pass over the key column, with partial aggregation before the shuffle. At most one key per
    ``rows_per_task`` rows is returned. The answer only steers the layout of a join: results are the same for
    any answer.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count("*").alias("rows"))
    return {row["key"]: -(-row["rows"] // rows_per_task) for row in counts.where(F.col("rows") > rows_per_task).collect()}


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int = WIDE_ROWS_PER_TASK) -> int | None:
    """Tasks that so many wide rows need to be sorted in memory, or None where the session's shuffles have as many."""
    needed = -(-rows // rows_per_task)
    return needed if needed > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def dealt(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    return df.repartition(tasks, *keys) if tasks else df


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    hot: dict | None = None,
    hot_right: dict | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Equi-join in which hot keys are cut into slices that different tasks join.

    The rows of a key in ``hot`` are sliced on the left and its right rows repeated once per slice, which
    suits every join that keeps or drops left rows one by one (inner, left, left_semi, left_anti).
    ``hot_right`` slices the right side the same way and is only valid for inner joins.
    Slices follow the content of a row and its input partition, both of which a re-run task reproduces, so keys are
    split even where the input is laid out by key. ``tasks`` deals the right side to so many, where the session's number is too
    small for the rows; Spark deals the left likewise, but for one that lies so already or meets a broadcast. Slices are dealt on both sides.
    """
    if not hot and not hot_right:
        # the left follows, unless it is laid out by the key already or the right is broadcast
        return left.join(dealt(right, tasks, key), key, how)
    if hot_right and how != "inner":
        raise ValueError("the right side can only be sliced in an inner join")
    hot, hot_right = hot or {}, hot_right or {}
    cuts = [(k, hot.get(k, 1), hot_right.get(k, 1)) for k in {**hot, **hot_right}]
    kind = left.schema[key].dataType.simpleString()
    # at most one key per four million rows of the tables
    table = left.sparkSession.createDataFrame(cuts, f"{key} {kind}, _cuts int, _right_cuts int")

    def own(df: DataFrame, count: str):
        content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        slot = F.pmod(F.pmod(content, F.col(count)) + F.spark_partition_id(), F.col(count))
        return F.coalesce(slot.cast("int"), F.lit(0))

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(count), F.lit(1)) - 1))

    sliced_left = left.join(table, key, "left").withColumn("_i", own(left, "_cuts")).withColumn("_j", every("_right_cuts"))
    sliced_right = (
        right.join(table, key, "left").withColumn("_j", own(right, "_right_cuts")).withColumn("_i", every("_cuts"))
    )
    slices = [key, "_i", "_j"]
    joined = dealt(sliced_left.drop("_cuts", "_right_cuts"), tasks, *slices).join(
        dealt(sliced_right.drop("_cuts", "_right_cuts"), tasks, *slices), slices, how
    )
    return joined.drop("_i", "_j")


def sliced_left_join(left: DataFrame, right: DataFrame, key: str, hot_right: dict | None, hot: dict | None = None) -> DataFrame:
    """Left join whose right side may have hot keys: an inner join from the right plus the unmatched left rows."""
    if not hot_right:
        return salted_join(left, right, key, "left", hot)
    matched = salted_join(right, left, key, "inner", hot_right, hot)
    unmatched = salted_join(left, right.select(key).distinct(), key, "left_anti", hot)
    return matched.unionByName(unmatched, allowMissingColumns=True)
