"""Sharding by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table (a start and a stride from digests of its
name). Shards take turns; each claims the next free slot of its preference. A document's slot is a hash of its id and text, so its
shard is one lookup in the broadcast table; adding or removing a shard moves few other slots. The table
has ``slots`` entries whatever the data, so broadcasting it is safe.

Defined results: null ids and texts hash like any other value, so rows without id are spread by their text;
repeated rows share a slot; empty tables give no rows; columns called ``slot`` or ``shard`` are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARDS = tuple(f"shard-{i:02d}" for i in range(16))
SLOTS = 65_537


def preference(name: str, slots: int) -> tuple[int, int]:
    """Start and stride of the order in which a shard asks for slots."""
    digest = hashlib.sha256(name.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1


def fill(shards: tuple[str, ...], slots: int = SLOTS) -> list[int]:
    """Index of the shard that holds each slot; ``slots`` must be a prime larger than the number of shards."""
    if not shards or len(set(shards)) != len(shards) or slots <= len(shards):
        raise ValueError("shards must be named, distinct and fewer than the slots")
    if any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"{slots} is not a prime")
    held = [-1] * slots
    wishes = [preference(name, slots) for name in shards]
    asked = [0] * len(shards)
    claimed = 0
    while claimed < slots:
        for shard, (start, stride) in enumerate(wishes):
            if claimed == slots:
                break
            slot = (start + asked[shard] * stride) % slots
            while held[slot] >= 0:
                asked[shard] += 1
                slot = (start + asked[shard] * stride) % slots
            held[slot] = shard
            asked[shard] += 1
            claimed += 1
    return held


def place(docs: DataFrame, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``docs`` with ``slot`` and ``shard`` (a name)."""
    spark = docs.sparkSession
    held = fill(shards, slots)
    table = spark.createDataFrame(
        [(slot, shards[shard]) for slot, shard in enumerate(held)], "slot int, shard string"
    )
    kept = [c for c in docs.columns if c.lower() not in ("slot", "shard")]
    slot = F.pmod(F.xxhash64("doc_id", "text"), F.lit(slots)).cast("int")
    return docs.select(*[F.col(f"`{c}`") for c in kept], slot.alias("slot")).join(F.broadcast(table), "slot").select(
        *[F.col(f"`{c}`") for c in kept], "slot", "shard"
    )


def write_shards(docs: DataFrame, path: str, files: int = 8, **options) -> None:
    """Write one folder per shard, each dealt over ``files`` tasks so that no shard is one task."""
    placed = place(docs, **options)
    part = F.pmod(F.xxhash64("text", "doc_id", F.lit(1)), F.lit(files))
    placed.withColumn("_part", part).repartition("shard", "_part").drop("_part").write.partitionBy("shard").parquet(path)
