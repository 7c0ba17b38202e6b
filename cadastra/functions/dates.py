"""Arithmetic on dates stored as YYYYMMDD integers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadastra.schemas import FIRST_YEAR, LAST_YEAR


@dataclass(frozen=True)
class Period:
    """Closed range of years."""

    first: int = FIRST_YEAR
    last: int = LAST_YEAR

    def holds(self, ymd: Column) -> Column:
        """Range test on the raw integer, so that it reaches the Parquet row-group filter."""
        return (ymd >= self.first * 10_000) & (ymd < (self.last + 1) * 10_000)

    def holds_year(self, year: Column) -> Column:
        return year.between(self.first, self.last)


def div(value: Column, divisor: int) -> Column:
    return F.call_function("div", value, F.lit(divisor))


def year_of(ymd: Column) -> Column:
    return div(ymd, 10_000).cast("int")


def month_of(ymd: Column) -> Column:
    return div(ymd % 10_000, 100).cast("int")


def month_start(year: Column, month: Column) -> Column:
    """First day of the month; null when the digits are no real month."""
    return F.when(month.between(1, 12) & year.between(1, 9999), F.make_date(year, month, F.lit(1)))


def to_ymd(moment: Column) -> Column:
    return (F.year(moment) * 10_000 + F.month(moment) * 100 + F.dayofmonth(moment)).cast("bigint")


def activity_division(code: Column, divisor: int = 100_000) -> Column:
    """Leading two digits of a seven-digit activity code."""
    return div(code, divisor).cast("int")
