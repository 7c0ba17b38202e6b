"""Trimming, sentinel clean-up and lenient typing of text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from cadastra.schemas import UNSIGNED_MAX

# The Unicode White_Space characters.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Texts that stand for a missing name.
MISSING_NAMES = ("NONE", "NULL", "")
# Plain decimal notation; Spark alone would also read "1d", "1f" and hexadecimal floats.
DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(text: Column) -> Column:
    """Trim any Unicode white space (``trim`` alone only knows U+0020).

    Trimming a set of characters costs many times a look at both ends, so only texts that need it are trimmed."""
    space = F.lit(WHITE_SPACE)
    padded = F.contains(space, F.substring(text, 1, 1)) | F.contains(space, F.substring(text, -1, 1))
    return F.when(padded & (text != ""), F.btrim(text, space)).otherwise(text)


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def unsigned(text: Column, kind: DataType) -> Column:
    """Lenient cast: anything that is not an integer within the unsigned range becomes null."""
    # plain digits need no trimming; trimming turns no number into another
    trimmed = F.btrim(text, F.lit(WHITE_SPACE))
    number = F.coalesce(text.try_cast("bigint"), F.when(text.rlike("[^0-9]"), trimmed.try_cast("bigint")))
    return F.when(number.between(0, UNSIGNED_MAX[kind]), number).cast(kind)


def typed(text: Column, kind: DataType) -> Column:
    return strip(text) if isinstance(kind, StringType) else unsigned(text, kind)


def typed_columns(schema: StructType) -> list[Column]:
    """All columns of a table of texts, typed.

    Texts are trimmed as one list: one expression per text makes the code of a wide table so long that the JVM never compiles it."""
    texts = [f.name for f in schema.fields if isinstance(f.dataType, StringType)]
    trimmed = F.transform(F.array(*[F.col(n) for n in texts]), strip)
    return [
        (trimmed[texts.index(f.name)] if f.name in texts else typed(F.col(f.name), f.dataType)).alias(f.name) for f in schema.fields
    ]


def money(text: Column) -> Column:
    """Decimal-comma amount; unreadable or missing amounts count as 0.0."""
    dotted = F.replace(text, F.lit(","), F.lit("."))
    return F.coalesce(F.when(dotted.rlike(DECIMAL_TEXT), dotted.try_cast("double")), F.lit(0.0))


def clean_name(text: Column, default: str = "") -> Column:
    name = strip(text)
    return F.when(name.isNull() | F.upper(name).isin(*MISSING_NAMES), F.lit(default)).otherwise(name)


def integer_list(text: Column) -> Column:
    """Comma list to array; one unreadable token empties the whole list."""
    tokens = F.filter(F.transform(F.split(text, ","), strip), lambda t: t != "")
    numbers = F.transform(tokens, lambda t: t.try_cast("bigint"))
    none = F.array().cast("array<bigint>")
    # a list of the one list, so that it is made once for its test and its use
    whole = F.transform(F.array(numbers), lambda found: F.when(~F.exists(found, lambda n: n.isNull()), found))
    return F.coalesce(whole[0], none)


def ellipsize(text: Column, limit: int, keep: int | None = None) -> Column:
    """Cut texts longer than ``limit`` to ``keep`` characters (``limit - 3`` by default) plus dots."""
    kept = limit - 3 if keep is None else keep
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, kept), F.lit("..."))).otherwise(text)
