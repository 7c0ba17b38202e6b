"""Shares, pivots, long form and hierarchical totals of small aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.functions.formats import share


def with_share(df: DataFrame, value: str, into: str) -> DataFrame:
    """Percentage of the column total. The total is a distributed sum, not a one-task window."""
    whole = df.agg(F.sum(value)).scalar()
    return df.withColumn(into, share(F.col(value), whole))


def to_long(df: DataFrame, keys: Sequence[str], values: Mapping[str, str], name: str, value: str) -> DataFrame:
    """Unpivot ``values`` (column -> label)."""
    long = df.unpivot(list(keys), list(values), name, value)
    return long.replace(dict(values), subset=[name])


def mean_pivot(df: DataFrame, rows: str, columns: str, value: str, headers: Sequence) -> DataFrame:
    """Mean of ``value`` per row and column; empty cells are 0. Headers are given, so no extra scan."""
    return df.groupBy(rows).pivot(columns, list(headers)).agg(F.avg(value)).na.fill(0)


def path_totals(df: DataFrame, path: Sequence[str], value: str) -> DataFrame:
    """Totals of every prefix of ``path``; ``nivel`` is 0 for the leaf and grows towards the root."""
    return df.rollup(*path).agg(
        F.sum(value).alias(value),
        F.grouping_id().alias("_mask"),
    ).withColumn("nivel", F.bit_count("_mask")).drop("_mask")
