"""Top-N with ties broken by the key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def by_total(df: DataFrame, key: str, total: str = "total") -> DataFrame:
    return df.orderBy(F.desc(total), F.asc_nulls_first(key))


def ascending(df: DataFrame, key: str, total: str = "total") -> DataFrame:
    """Smallest first, as horizontal bars are drawn from below."""
    return df.orderBy(F.asc(total), F.asc_nulls_first(key))


#: Rows of a top list that may be broadcast by hint.
BROADCAST_ROWS = 100_000


def small(df: DataFrame, n: int) -> DataFrame:
    """Broadcast hint for a list of at most ``n`` rows if ``n`` is small; else the join is left to Spark."""
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def top_n(df: DataFrame, n: int, key: str, total: str = "total") -> DataFrame:
    """Planned as TakeOrderedAndProject: each task keeps ``n`` rows."""
    return by_total(df, key, total).limit(n)


def top_n_per_group(df: DataFrame, n: int, group: str, key: str, total: str = "total") -> DataFrame:
    """Planned as WindowGroupLimit: each task keeps ``n`` rows per group before the shuffle."""
    order = Window.partitionBy(group).orderBy(F.desc(total), F.asc_nulls_first(key))
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")
