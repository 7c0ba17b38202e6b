"""SimHash near-deduplication by multi-index hashing.

A fingerprint has 64 bits; bit b is set if it is set in more than half of the XXH64 values of the text's word shingles.
Fingerprints are distinct before anything is compared. Two of them at ``DISTANCE`` (4) or fewer bits differ in two bits or
fewer in one half, so the balls of radius one around their halves meet: each fingerprint is put into a table under the
33 codes of each half's ball. The codes are shuffled once, sorted, and read as a stream of table entries; an entry's members are
compared in all 64 bits.

Each member is linked to the smallest one that near members of the entry connect it to, one link less than members at most. An entry with more than
``SMALL_ENTRY`` members (a large group of near copies) is not compared pair by pair: its members take the balls of radius two
in all 64 bits, 2,081 codes each, and every member is linked to the smallest with the same code. Two fingerprints share
a code exactly if they differ in four bits or fewer. So just what is near is joined, though by links through other members.

``one_of_each`` takes groups of near fingerprints as candidates only. There members of an entry are linked up to ``CANDIDATE_DISTANCE`` (8)
bits, which finds all pairs at five bits and most at eight, and all members of an entry of more than ``SMALL_ENTRY`` are one group. All
pairs of distinct texts of a group are compared by the Jaccard similarity of their sets of five-word shingles, and components of
pairs at ``SIMILAR`` (4/5) or more are what one document is kept of. A group's texts are dealt into blocks of up to ``BLOCK_TEXTS``, and a
text gets a row for every block it meets; no pair is left out.

Defined results: a null or empty text has fingerprint zero, linked like any other; fewer words than a shingle has are one shingle; a
component's id is its smallest doc_id, null if it has none; repeated rows are copies of each other; an empty table gives no
rows; clashing columns are not read, or are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import scratch_folder, stored
from cadastra.llm.components import components

WIDTH = 4
DISTANCE = 4
CANDIDATE_DISTANCE = 8
SMALL_ENTRY = 256
SEED = 42
CHUNK = 1 << 16
SHINGLE = 5
SIMILAR = (4, 5)
BLOCK_TEXTS = 2_048
BLOCK_BYTES = 1 << 23
#: An entry's key is ``kind << KIND_BITS | code``.
KIND_BITS = 33


@dataclass(frozen=True)
class Feature:
    """What one fingerprint is taken of: shingles of ``width`` words, each counted as often as it occurs or, with
    ``distinct``, once; ``seed`` is that of the hash."""

    width: int = WIDTH
    distinct: bool = False
    seed: int = SEED


def majority(values: list[int], totals: np.ndarray) -> None:
    """Add the bits of 64-bit values to the counts of bits set."""
    bits = np.unpackbits(np.array(values, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    np.add(totals, bits.sum(axis=0, dtype=np.int64), out=totals)


def fingerprint(text: str | None, feature: Feature = Feature()) -> int:
    """The fingerprint as a signed 64-bit number."""
    # bytes.lower and bytes.split know A-Z and the six ASCII blanks only, as wanted here
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    size = min(feature.width, len(words))
    shingles = (line[start : end - 1] for start, end in zip([0, *ends[:-1]], ends[size - 1 :]))
    if feature.distinct:
        shingles = iter(dict.fromkeys(shingles))
    totals, count = np.zeros(64, np.int64), 0
    while chunk := [xxhash.xxh64_intdigest(x, feature.seed) for x in islice(shingles, CHUNK)]:
        majority(chunk, totals)
        count += len(chunk)
    packed = np.packbits((2 * totals > count).astype(np.uint8), bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprints(docs: DataFrame, features: tuple[Feature, ...] = (Feature(),)) -> DataFrame:
    """(doc_id, part, fps), one row per row of ``docs``; ``part`` is a hash of the text, ``fps`` has a fingerprint per
    feature."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("part"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [[fingerprint(t.as_py(), feature) for feature in features] for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.int64()))], ["doc_id", "part", "fps"]
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, part bigint, fps array<bigint>")


def flips(bits: int, radius: int) -> list[int]:
    """Masks with at most ``radius`` of ``bits`` bits set, as signed 64-bit numbers."""
    masks = [0]
    for _ in range(radius):
        masks += [m | 1 << b for m in masks for b in range(bits) if not m >> b & 1]
        masks = list(dict.fromkeys(masks))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def half_codes(fp: Column) -> Column:
    """Table codes of a fingerprint: its halves' balls of radius one; the upper half is marked by bit 32."""
    masks = F.array(*[F.lit(m).cast("long") for m in flips(32, 1)])
    low = fp.bitwiseAND(F.lit((1 << 32) - 1))
    high = F.shiftrightunsigned(fp, 32)
    return F.concat(
        F.transform(masks, lambda m: low.bitwiseXOR(m)),
        F.transform(masks, lambda m: high.bitwiseXOR(m).bitwiseOR(F.lit(1 << 32))),
    )


def full_codes(fp: Column) -> Column:
    """The ball of radius two in all bits."""
    singles = F.array(*[F.lit(m).cast("long") for m in flips(64, 1)[1:]])
    pairs = F.flatten(
        F.transform(singles, lambda m, i: F.transform(F.slice(singles, i + 1, 64), lambda n: fp.bitwiseXOR(m).bitwiseXOR(n)))
    )
    # the inner slice starts at m itself, which gives the centre back; the distinct codes are the ball
    return F.array_distinct(F.concat(F.array(fp), F.transform(singles, lambda m: fp.bitwiseXOR(m)), pairs))


def spanning(fps: list[int], distance: int) -> list[tuple[int, int]]:
    """Links that join the members of an entry just as all links at ``distance`` or fewer bits would: each member with the
    smallest it is connected to, so that entries of one group of near copies name the same few fingerprints."""
    fps = sorted(fps)
    values = np.array(fps, np.int64).view(np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
    links, left = [], np.ones(len(fps), bool)
    for start in range(len(fps)):
        stack = [start] if left[start] else []
        left[start] = False
        while stack:
            fresh = np.flatnonzero(near[stack.pop()] & left)
            left[fresh] = False
            stack += fresh.tolist()
            links += [(fps[start], fps[other]) for other in fresh]
    return links


def entry_links(distance: int, compared: bool):
    """Reads (key, fp) in order, as batches of Arrow columns, and gives (kind, a, b): links within each table entry.

    Of an entry with more than ``SMALL_ENTRY`` members each is given with no partner if such entries are to be ``compared`` elsewhere,
    and else linked to the smallest. Such entries pass through without being held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)
        crowd: tuple[int, int] | None = None

        def crowded(key: int, first: int, members: np.ndarray) -> pa.RecordBatch:
            if not compared:
                members = members[members != first]
            least = np.full(len(members), first)
            partner = pa.nulls(len(members), pa.int64()) if compared else pa.array(members)
            firsts = pa.array(members if compared else least)
            kinds = pa.array(np.full(len(members), key >> KIND_BITS, np.int32))
            return pa.RecordBatch.from_arrays([kinds, firsts, partner], ["kind", "a", "b"])

        def made(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            kinds, firsts, seconds = map(np.concatenate, zip(*rows))
            arrays = [pa.array(kinds.astype(np.int32)), pa.array(firsts), pa.array(seconds)]
            return pa.RecordBatch.from_arrays(arrays, ["kind", "a", "b"])

        for batch in _with_end(batches):
            last = batch is None
            if not last:
                new_keys, new_fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                if crowd and len(new_keys):
                    more = int(np.searchsorted(new_keys, crowd[0], side="right"))
                    if more:
                        yield crowded(*crowd, new_fps[:more])
                        new_keys, new_fps = new_keys[more:], new_fps[more:]
                    if len(new_keys):
                        crowd = None
                keys, fps = np.concatenate([keys, new_keys]), np.concatenate([fps, new_fps])
            if not len(keys):
                continue
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(starts, len(keys)))
            if not last:
                # the last entry may go on in the next batch
                held = starts[-1]
                if sizes[-1] > SMALL_ENTRY:
                    crowd = (int(keys[held]), int(fps[held]))
                    yield crowded(*crowd, fps[held:])
                    held = len(keys)
                starts, sizes = starts[:-1], sizes[:-1]
            two = starts[sizes == 2]
            near = two[np.bitwise_count((fps[two] ^ fps[two + 1]).view(np.uint64)) <= distance]
            rows = [(keys[near] >> KIND_BITS, fps[near], fps[near + 1])]
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                if size > SMALL_ENTRY:
                    yield crowded(int(keys[start]), int(fps[start]), fps[start : start + size])
                elif links := spanning(fps[start : start + size].tolist(), distance):
                    firsts, seconds = np.array(links, np.int64).T
                    rows.append((np.full(len(links), keys[start] >> KIND_BITS), firsts, seconds))
            yield made(rows)
            if not last:
                keys, fps = keys[held:], fps[held:]

    return run


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def links_of(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(kind, a, b): links between the distinct (kind, fp) of ``prints``; only fingerprints of one kind are compared.

    At distance 4 they connect just what this relation connects. At larger distances, for candidates, they connect at least
    whatever five bits connect, and the members of an entry of more than ``SMALL_ENTRY``."""
    if distance < 4:
        raise ValueError("two tables with balls of radius one answer distance 4 or more")
    spark = prints.sparkSession
    folder = scratch_folder(spark, "simhash-links")
    # Spark takes an exploded table to be as small as what it is made from: deal it out
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    codes = prints.repartition(tasks, "kind", "fp").select("kind", "fp", F.explode(half_codes(F.col("fp"))).alias("code"))
    key = F.shiftleft(F.col("kind").cast("long"), KIND_BITS).bitwiseOR(F.col("code")).alias("key")
    entries = codes.select(key, "fp").repartition("key").sortWithinPartitions("key", "fp")
    found = entries.mapInArrow(entry_links(distance, distance == DISTANCE), "kind int, a bigint, b bigint")
    found = stored(found, f"{folder}/found")
    small = found.where("b IS NOT NULL")
    if distance != DISTANCE:
        return small.distinct()
    crowded = found.where("b IS NULL").select("kind", F.col("a").alias("fp")).distinct()
    balls = crowded.select("kind", "fp", F.explode(full_codes(F.col("fp"))).alias("code"))
    centres = stored(
        balls.groupBy("kind", "code").agg(F.min("fp").alias("least"), F.count("*").alias("members")).where("members > 1"),
        f"{folder}/centres",
    )
    starred = balls.hint("merge").join(centres, ["kind", "code"]).where("fp <> least")
    return small.unionByName(starred.select("kind", F.col("least").alias("a"), F.col("fp").alias("b"))).distinct()


def groups(docs: DataFrame, features: tuple[Feature, ...] = (Feature(),), distance: int = DISTANCE) -> DataFrame:
    """(doc_id, part, fps, root, component_id), one row per row of ``docs``; documents are linked if they are within the
    distance in any feature's fingerprint."""
    folder = scratch_folder(docs.sparkSession, "simhash")
    # with one feature the fingerprint itself is the node; else a hash of all
    node = F.col("fps")[0] if len(features) == 1 else F.xxhash64("fps")
    rows = stored(fingerprints(docs, features).withColumn("node", node), f"{folder}/fingerprints")
    nodes = stored(
        rows.groupBy("node").agg(F.first("fps").alias("fps"), F.min("doc_id").alias("first_id")), f"{folder}/nodes"
    )
    by_kind = nodes.select("node", F.posexplode("fps").alias("kind", "fp"))
    prints = stored(by_kind.groupBy("kind", "fp").agg(F.min("node").alias("least")), f"{folder}/prints")
    found = links_of(prints.select("kind", "fp"), distance)
    if len(features) > 1:
        same = by_kind.join(prints, ["kind", "fp"]).where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
        first = prints.select("kind", F.col("fp").alias("a"), F.col("least").alias("from"))
        second = prints.select("kind", F.col("fp").alias("b"), F.col("least").alias("to"))
        across = found.join(first, ["kind", "a"]).join(second, ["kind", "b"])
        found = across.select(F.col("from").alias("a"), F.col("to").alias("b")).unionByName(same)
    rooted = nodes.join(components(found).withColumnRenamed("node", "linked"), F.col("node") == F.col("linked"), "left")
    rooted = rooted.select("node", "first_id", F.coalesce("root", "node").alias("root"))
    # stored apart, so that the join with it is a broadcast if it is small, and else a hot root is split
    smallest = stored(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), f"{folder}/smallest")
    named = stored(rooted.join(smallest, "root").select("node", "root", "component_id"), f"{folder}/named")
    return rows.join(named, "node").select("doc_id", "part", "fps", "root", "component_id")


def shingle_set(text: str | None) -> set[int]:
    """64-bit hashes of the distinct shingles of five words; fewer words are one shingle, no words are none."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    return {
        xxhash.xxh64_intdigest(line[start : end - 1], SEED)
        for start, end in zip([0, *ends[:-1]], ends[min(SHINGLE, len(words)) - 1 :] if words else [])
    }


def similar_links(parts: list[int], texts: list[str | None], sides: list[int]) -> list[tuple[int, int]]:
    """Links that join the texts just as all pairs that are similar enough would. Members of one side are compared with
    those of the other; if there is one side only, with each other."""
    sets = [shingle_set(t) for t in texts]
    across = len(set(sides)) > 1
    above, below = SIMILAR
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), parts[i]))
    links = []
    for n, a in enumerate(order):
        for b in order[n + 1 :]:
            if below * len(sets[a]) < above * len(sets[b]):
                break
            if (across and sides[a] == sides[b]) or find(a) == find(b):
                continue
            common = len(sets[a] & sets[b])
            if below * common >= above * (len(sets[a]) + len(sets[b]) - common):
                root[find(b)] = find(a)
                links.append((parts[a], parts[b]))
    return links


def similar_pairs(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b): links by ``part`` that join what the texts of one candidate group (part, root) that are similar join."""
    folder = scratch_folder(docs.sparkSession, "simhash-similar")
    parts = found.select("part", "root").distinct()
    several = stored(parts.groupBy("root").agg(F.count("*").alias("texts")).where("texts > 1"), f"{folder}/several")
    # one row holds each text: the others stay where they are
    holder = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id")).alias("holder")
    holders = found.groupBy("part", "root").agg(holder).join(several, "root")
    members = stored(holders.select("part", "root", F.col("holder.doc_id").alias("holder")), f"{folder}/members")
    bare = docs.select("doc_id", "text")
    same = (F.xxhash64("text") == F.col("part")) & F.col("doc_id").eqNullSafe(F.col("holder"))
    # one plan at every size: at scale neither table of keys can be broadcast
    texts = bare.join(members.hint("merge"), same).select("part", "root", "text").dropDuplicates(["part"])
    texts = stored(texts.withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0))), f"{folder}/texts")
    needed = F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("bytes") / BLOCK_BYTES), F.lit(1))
    blocks = stored(texts.groupBy("root").agg(needed.cast("int").alias("blocks")), f"{folder}/blocks")
    dealt = texts.join(blocks, "root").withColumn("own", F.pmod(F.xxhash64("part", F.lit(1)), "blocks").cast("int"))
    met = dealt.select(
        "root", "own", "part", "text", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )

    def run(table: pa.Table) -> pa.Table:
        made = similar_links(*(table[name].to_pylist() for name in ("part", "text", "own")))
        first, second = zip(*made) if made else ((), ())
        return pa.table({"a": pa.array(first, pa.int64()), "b": pa.array(second, pa.int64())})

    keyed = met.select("root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "part", "text")
    return keyed.groupBy("root", "low", "high").applyInArrow(run, "a bigint, b bigint")


def one_of_each(
    docs: DataFrame, features: tuple[Feature, ...] = (Feature(),), distance: int = CANDIDATE_DISTANCE
) -> DataFrame:
    """``docs`` with one document of every component of similar texts: the one with the smallest doc_id (none at all comes
    last)."""
    folder = scratch_folder(docs.sparkSession, "simhash-kept")
    found = stored(groups(docs, features, distance).select("doc_id", "part", "root"), f"{folder}/found")
    linked = components(similar_pairs(docs, found)).select(F.col("node").alias("part"), F.col("root").alias("similar"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "part")).alias("first")
    each = found.groupBy("part").agg(first).join(linked, "part", "left")
    kept = stored(
        each.groupBy(F.coalesce("similar", "part")).agg(F.min("first").alias("first")).select(
            F.col("first.doc_id").alias("_id"), F.col("first.part").alias("_part")
        ),
        f"{folder}/kept",
    )
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & F.xxhash64(docs["text"]).eqNullSafe(F.col("_part"))
    return docs.join(kept.hint("merge"), same).dropDuplicates(["_id", "_part"]).drop("_id", "_part")
