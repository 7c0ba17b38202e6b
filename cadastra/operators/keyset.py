"""Sets of keys as flags, small enough for every task however many keys there are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# at most a million rows of 64 flags; 16 million keys set a flag in five
SLOTS = 1 << 26


def maybe_among(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``df`` without rows whose key is surely not among ``keys``. Keys that share a flag with one that is there stay, so an exact
    join has to follow; the rows it would drop are gone before they are shuffled, and below joins ``df`` is derived from."""
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS))
    word, bit = F.shiftright(slot, 6), slot.bitwiseAND(63).cast("int")
    same = keys.select(F.col(key).try_cast(df.schema[key].dataType).alias(key)).where(F.col(key).isNotNull())
    flag = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    flags = same.groupBy(word.alias("_word")).agg(F.bit_or(flag).alias("_flags"))
    is_set = F.call_function("shiftright", F.col("_flags"), bit).bitwiseAND(1) == 1
    return df.join(F.broadcast(flags), (word == F.col("_word")) & is_set, "left_semi")
