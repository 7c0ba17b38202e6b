"""Benchmark decontamination by a broadcast set of normalised n-gram hashes.

Texts become words (A-Z lower-cased; a word is a run of digits, letters and non-ASCII characters). Every window of
``width`` words of a document is hashed and looked up in the hash set of benchmark windows; a hit is verified
against the window's words. Items shorter than ``width`` are one window of their own length, and documents are
scanned once more for each such length (nine at most).

The set (hash, window text, window number) is broadcast by hint only if it takes at most ``MAX_BROADCAST`` bytes. A larger one meets the
documents' window hashes in a shuffled semi-join of narrow rows; what is left is verified against the texts, fetched by id for
documents with such hashes only. Which items a window comes from is a table of its own, joined to the hits.

Defined results: null and empty texts have no words and no hits; items without words match nothing; repeated items
are listed once each by their id; rows that repeat id and text get one result each, all alike; an empty
benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import lower_ascii, scratch_folder, stored, text_of

WIDTH = 10
#: Bytes of window texts, with some room for hashes, numbers and pointers.
MAX_BROADCAST = 128 << 20
ROW_BYTES = 64
WORD_CHARACTER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS, -1), "")


def with_window_hashes(df: DataFrame, words: str, width: int, out: str) -> DataFrame:
    """Adds the hashes of all windows of ``width`` words, combined pairwise: 1, 2, 4, ... words, then the rest."""
    count = F.size(words) - (width - 1)

    def joined(left: str, right: str, shift: int) -> Column:
        later = F.slice(right, F.lit(shift + 1), F.greatest(F.size(right) - shift, F.lit(0)))
        return F.zip_with(left, later, lambda a, b: F.xxhash64(a, b))

    df = df.withColumn("_w1", F.transform(words, lambda w: F.xxhash64(w)))
    size, covered, current, remaining = 1, 0, None, width
    while remaining:
        if remaining & 1:
            if current is None:
                current = f"_w{size}"
            else:
                df = df.withColumn(f"_c{covered + size}", joined(current, f"_w{size}", covered))
                current = f"_c{covered + size}"
            covered += size
        remaining >>= 1
        if remaining:
            df = df.withColumn(f"_w{size * 2}", joined(f"_w{size}", f"_w{size}", size))
            size *= 2
    windows = F.when(count > 0, F.slice(current, F.lit(1), F.greatest(count, F.lit(1)))).otherwise(
        F.array().cast("array<bigint>")
    )
    made = [c for c in df.columns if c.startswith(("_w", "_c")) and c not in (words,)]
    return df.withColumn(out, windows).drop(*made)


def benchmark_windows(benchmark: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(width, hash, window, number), the distinct windows of all items, and (number, item), the ids they come from; both stored."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(text_of()).alias("words"))
    parts = []
    for length in range(1, width + 1):
        chosen = items.where(F.size("words") == length if length < width else F.size("words") >= width)
        hashed = with_window_hashes(chosen, "words", length, "hashes")
        window = F.array_join(F.slice("words", F.col("h.at") + 1, length), " ").alias("window")
        placed = F.transform("hashes", lambda h, i: F.struct(i.alias("at"), h.alias("hash")))
        parts.append(
            hashed.select("item", "words", F.explode(placed).alias("h")).select(F.lit(length).alias("width"), "h.hash", window, "item")
        )
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    folder = scratch_folder(benchmark.sparkSession, "benchmark-windows")
    rows = stored(rows.distinct(), f"{folder}/rows")
    distinct = rows.select("width", "hash", "window").distinct()
    windows = stored(distinct.withColumn("number", F.monotonically_increasing_id()), f"{folder}/windows")
    return windows, stored(rows.join(windows, ["width", "hash", "window"]).select("number", "item"), f"{folder}/items")


def hit(at: Column, length: int) -> Column:
    return F.struct(at.cast("int").alias("at"), F.lit(length).alias("length"), "number")


def hits_of_broadcast(hashed: DataFrame, known: DataFrame, length: int, counted: bool) -> DataFrame:
    """(doc_id, part, words, hit) in one pass over the texts; with ``counted`` a row per text has its word count, as entry 0."""
    first = F.array(F.size("words").cast("long")) if counted else F.array().cast("array<bigint>")
    entries = hashed.select("doc_id", "part", "words", F.posexplode(F.concat(first, "hashes")).alias("entry", "value"))
    at = F.col("entry") - (1 if counted else 0)
    is_count = (F.col("entry") == 0) if counted else F.lit(False)
    looked_up = entries.join(F.broadcast(known), (F.col("value") == F.col("hash")) & ~is_count, "left" if counted else "inner")
    same = F.array_join(F.slice("words", at + 1, F.lit(length)), " ") == F.col("window")
    found = F.when(F.col("hash").isNotNull() & same, hit(at, length)).alias("hit")
    return (
        looked_up.where(is_count | F.col("hash").isNotNull())
        .select("doc_id", "part", F.when(is_count, F.col("value")).alias("words"), found)
        .where("words IS NOT NULL OR hit IS NOT NULL")
    )


def hits_of_shuffled(hashed: DataFrame, known: DataFrame, length: int, counted: bool) -> DataFrame:
    """The same from shuffles of narrow rows, for a benchmark of any size."""
    hashes = hashed.select("doc_id", "part", F.posexplode("hashes").alias("at", "hash"))
    suspects = hashes.join(known.select("hash").distinct().hint("merge"), "hash", "left_semi")
    suspects = suspects.groupBy(F.col("doc_id").alias("_id"), F.col("part").alias("_part")).agg(
        F.collect_set(F.struct("at", "hash")).alias("suspects")
    )
    texts = hashed.select("doc_id", "part", "words")
    back = texts.join(suspects, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("part") == F.col("_part")))
    placed = F.transform(
        "suspects",
        lambda s: F.struct(s["at"].alias("at"), s["hash"].alias("hash"), F.array_join(F.slice("words", s["at"] + 1, length), " ").alias("window")),
    )
    # the texts stay behind before the suspects get a row each
    made = back.select("doc_id", "part", placed.alias("placed")).select("doc_id", "part", F.inline("placed"))
    missing = F.lit(None).cast("long").alias("words")
    found = made.join(known.hint("merge"), ["hash", "window"]).select("doc_id", "part", missing, hit(F.col("at"), length).alias("hit"))
    if not counted:
        return found
    counts = hashed.select("doc_id", "part", F.size("words").cast("long").alias("words"))
    return counts.unionByName(found, allowMissingColumns=True)


def scan(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(doc_id, part, n_words, hits), one row per distinct (doc_id, text), and the (number, item) table.

    ``hits`` holds (at, length, number) of every verified window, ``at`` counted in words from 0; ``part`` is the
    SHA-256 of the text. A document's rows meet again by id and digest, and only hits and one count are shuffled.
    """
    windows, items = benchmark_windows(benchmark, width)
    room = F.sum(F.octet_length("window") + ROW_BYTES).alias("bytes")
    sizes = {row["width"]: row["bytes"] for row in windows.groupBy("width").agg(room).collect()}
    texts = docs.select("doc_id", F.sha2(text_of(), 256).alias("part"), words_of(text_of()).alias("words"))
    rows = None
    for length in sorted(sizes.keys() | {width}, reverse=True):
        known = windows.where(F.col("width") == length).select("hash", "window", "number")
        hashed = with_window_hashes(texts, "words", length, "hashes")
        hits_of = hits_of_broadcast if sizes.get(length, 0) <= MAX_BROADCAST else hits_of_shuffled
        part = hits_of(hashed, known, length, length == width)
        rows = part if rows is None else rows.unionByName(part)
    found = rows.groupBy("doc_id", "part").agg(F.max("words").alias("n_words"), F.collect_set("hit").alias("hits"))
    return found, items


def covered(hits: str = "hits") -> Column:
    """Positions of the words that hits cover."""
    return F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["at"], h["at"] + h["length"] - 1))))


def with_items(scanned: DataFrame, items: DataFrame) -> DataFrame:
    """Adds ``items``: the ids of the items found in a text, sorted as strings."""
    found = scanned.where(F.size("hits") > 0).select("doc_id", "part", F.explode("hits.number").alias("number")).distinct()
    listed = found.join(items, "number").groupBy(F.col("doc_id").alias("_id"), F.col("part").alias("_part")).agg(
        F.array_sort(F.collect_set("item")).alias("items")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("part") == F.col("_part"))
    none = F.array().cast("array<string>")
    return scanned.join(listed, same, "left").drop("_id", "_part").withColumn("items", F.coalesce("items", none))


def report(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items, contaminated."""
    found, items = scan(docs, benchmark, width)
    found = stored(found, scratch_folder(docs.sparkSession, "benchmark-found"))
    found = with_items(found, items).withColumn("n_hit", F.size(covered()).cast("long"))
    keys = docs.select("doc_id", F.sha2(text_of(), 256).alias("part"))
    repeats = keys.groupBy("doc_id", "part").agg(F.count("*").alias("copies")).where("copies > 1")
    again = repeats.select(F.col("doc_id").alias("id2"), F.col("part").alias("part2"), "copies")
    same = F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("part") == F.col("part2"))
    times = F.sequence(F.lit(1), F.coalesce("copies", F.lit(1)))
    return found.join(again, same, "left").select(
        "doc_id", "n_words", "n_hit", "items", (F.col("n_hit") > 0).alias("contaminated"), F.explode(times).alias("copy")
    ).drop("copy")


def decontaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, remove: str = "documents") -> DataFrame:
    """``docs`` without the documents that hold a benchmark window, or, with ``remove="spans"``, with the words
    of the windows cut out of the text (the rest of the text stays as it is)."""
    spark = docs.sparkSession
    hits = scan(docs, benchmark, width)[0].where(F.size("hits") > 0)
    # whole documents go by their keys alone: narrow rows, whose known size lets the texts stay where they are while it is small
    wanted = [] if remove == "documents" else ["hits"]
    found = stored(
        hits.select(F.col("doc_id").alias("_hit_id"), F.col("part").alias("_hit_part"), *wanted),
        scratch_folder(spark, "benchmark-hits"),
    )
    same = docs["doc_id"].eqNullSafe(F.col("_hit_id")) & (F.sha2(text_of(docs["text"]), 256) == F.col("_hit_part"))
    if remove == "documents":
        return docs.join(found, same, "left_anti")
    hit_words = covered()
    # pieces of the text: each word with what precedes it, then the tail
    pieces = F.split(docs["text"], f"(?<={WORD_CHARACTER})(?!{WORD_CHARACTER})", -1)
    rest = F.filter(pieces, lambda x, i: ~F.array_contains(hit_words, i))
    columns = [
        F.when(F.col("hits").isNull(), docs["text"]).otherwise(F.array_join(rest, "")).alias("text")
        if c == "text"
        else docs[f"`{c}`"]
        for c in docs.columns
    ]
    return docs.join(found, same, "left").select(*columns)
