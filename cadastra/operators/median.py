"""Exact median without gathering the values in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_median(df: DataFrame, column: str, ranges: int | None = None) -> DataFrame:
    """One row, one column ``median``: the interpolated median of the non-null values.

    Values become (value, rows) pairs, with a partial aggregation before the shuffle. The pairs are dealt into
    ``ranges`` of neighbouring values (as many as shuffle partitions by default), whose row counts tell in which one or two
    ranges the middle rows lie; only these are put in order. The plan is lazy and has the same
    stages for any input. The second look at the pairs goes by the bounds found, not by partition, so it holds even if
    ranges are cut anew. NaN counts as the largest value, after infinity.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("rows"))
        .repartitionByRange(ranges, "value")
    )
    parts = pairs.groupBy(F.spark_partition_id().alias("range")).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.sum("rows").alias("rows")
    )
    # one row per range from here on
    upto = F.sum("rows").over(Window.orderBy("low").rowsBetween(Window.unboundedPreceding, 0))
    placed = parts.withColumns({"upto": upto, "total": F.sum("rows").over(Window.partitionBy())})
    lower, upper = F.expr("(total - 1) div 2"), F.expr("total div 2")
    middle = placed.where((F.col("upto") > lower) & (F.col("upto") - F.col("rows") <= upper)).agg(
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min(F.col("upto") - F.col("rows")).alias("below"),
        F.max("total").alias("total"),
    )
    bounds = middle.select(F.struct("low", "high", "below", "total")).scalar()
    band = pairs.withColumn("bounds", bounds).where("value BETWEEN bounds.low AND bounds.high").select("*", "bounds.*")
    running = F.col("below") + F.sum("rows").over(Window.orderBy("value"))
    reached = band.withColumn("reached", running)
    first = F.min(F.when(F.col("reached") > lower, F.col("value")))
    second = F.min(F.when(F.col("reached") > upper, F.col("value")))
    # halved before they are added, so that large values do not overflow, unless they are equal
    return reached.agg(F.when(first == second, first).otherwise(first / 2 + second / 2).alias("median"))
