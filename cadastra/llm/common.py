"""Text expressions and scratch tables shared by the operators of this package."""

from __future__ import annotations

import uuid
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.session import shared_dir

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def text_of(column: Column | str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character kept. Plain ``lower`` is exact, and faster, on ASCII text."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def count_words(text: Column) -> Column:
    """Number of maximal runs of characters other than space and U+0009 to U+000D."""
    inner = stripped(text)
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, SPACE_RUN, -1))).cast("long")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the one all executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str) -> DataFrame:
    """The table written to the shared folder and read again: computed once, of known size, without lineage."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def pick(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column of a caller's table is called so."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name
