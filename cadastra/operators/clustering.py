"""Multi-column clustering: rows ordered by interleaved bits of several columns' ranks.

Each column is cut into ranges of about as many rows; a row's range numbers are interleaved bit by bit. Rows that lie near
each other in all columns then lie near each other in the table, so files and row groups cover small ranges of every column, and a
filter on any of them leaves most unread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

BITS = 6


def cuts_of(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Upper bounds of the ranges of each column but the last, at most ``2 ** bits - 1`` per column.

    Numbers are cut at approximate percentiles, from sketches. Other columns are cut between their distinct values, which are counted
    first; only the bounds leave the cluster. Bounds steer the layout only, so approximate ones do."""
    ranges = 1 << bits
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, NumericType)]
    found: dict[str, list] = {}
    if numeric:
        shares = [i / ranges for i in range(1, ranges)]
        row = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in numeric]).first()
        found = {c: sorted(set(row[c] or [])) for c in numeric}
    for column in columns:
        if column not in found:
            counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
            # one row per distinct value from here on
            upto = F.sum("rows").over(Window.orderBy(column).rowsBetween(Window.unboundedPreceding, 0))
            placed = counts.withColumns({"upto": upto, "total": F.sum("rows").over(Window.partitionBy())})
            number = F.least(F.ceil(F.col("upto") * ranges / F.col("total")), F.lit(ranges))
            bounds = placed.groupBy(number.alias("range")).agg(F.max(column).alias("high")).where(F.col("range") < ranges)
            found[column] = sorted(row["high"] for row in bounds.collect())
    return {c: found[c] for c in columns}


def interleaved(cuts: dict[str, list], bits: int = BITS) -> Column:
    """The number whose bits are those of the columns' range numbers, in turns; nulls come first."""
    z = F.lit(0).cast("long")
    for place, (column, bounds) in enumerate(cuts.items()):
        if not bounds:
            continue
        number = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda bound: bound < F.col(column)))
        number = F.coalesce(F.when(F.col(column).isNotNull(), number), F.lit(0))
        # few ranges are spread over all bits, else columns with many would take the leading ones
        number = F.floor(number * (1 << bits) / (len(bounds) + 1))
        for bit in range(bits):
            at = bit * len(cuts) + (len(cuts) - 1 - place)
            z = z.bitwiseOR(F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1)), at))
    return z


def clustered(df: DataFrame, columns: Sequence[str], tie: str, files: int | None = None, bits: int = BITS) -> DataFrame:
    """``df`` dealt into ranges (``files``, if given) of the interleaved order, sorted. Rows of equal order are told apart by ``tie``, so
    that a combination that many rows share is cut as well."""
    name = "_interleaved"
    placed = df.withColumn(name, interleaved(cuts_of(df, columns, bits), bits))
    dealt = placed.repartitionByRange(files, name, tie) if files else placed.repartitionByRange(name, tie)
    return dealt.sortWithinPartitions(name, *columns).drop(name)
