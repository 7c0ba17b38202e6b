"""Line deduplication over levelled, sorted runs of line hashes.

A run is a table of (hash, documents, keeper), dealt by hash and sorted by it. Each new batch reduces its lines to
one row per hash, is merge-anti-joined with the runs (a hash that a run already settles, with a keeper at
least as large, adds nothing) and is written as a run of its own. When a level holds ``fan_in`` runs they are
merged into one of the next level. Hashes are 128 bits wide.

Defined results: a null or empty text is one empty line; a row is a document, so rows that repeat a doc_id
count one each and keep or lose a line together; a null doc_id is smaller than any other, and if all holders have
none they all keep the line; an empty table gives no rows; columns of the input with clashing names give way.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm.common import lower_ascii, scratch_folder, stored, stripped, text_of

MIN_CHARS = 20
MIN_DOCUMENTS = 3
BATCHES = 4
FAN_IN = 3


def line_hash(line: Column, min_chars: int) -> Column:
    """128-bit hash of the line's key; null for keys shorter than ``min_chars``."""
    key = stripped(line)
    return F.when(F.length(key) >= min_chars, F.unhex(F.md5(lower_ascii(key))))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, part, hash), each hash once per row. ``part`` tells rows without or with repeated id apart."""
    hashes = F.transform(lines_of(text_of()), lambda x: line_hash(x, min_chars))
    return docs.select(
        "doc_id",
        F.xxhash64("text").alias("part"),
        F.explode(F.array_distinct(F.array_compact(hashes))).alias("hash"),
    )


class LineRuns:
    """The runs of one corpus, kept in a folder all executors share."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str | None = None,
        min_chars: int = MIN_CHARS,
        min_documents: int = MIN_DOCUMENTS,
        fan_in: int = FAN_IN,
    ):
        self.spark = spark
        self.folder = folder or scratch_folder(spark, "line-runs")
        self.min_chars, self.min_documents, self.fan_in = min_chars, min_documents, fan_in
        self.levels: list[list[DataFrame]] = [[]]

    @property
    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, docs: DataFrame) -> None:
        """Take in a batch: its lines, less what the runs settle already, become a run of level 0."""
        batch = hashed_lines(docs, self.min_chars).groupBy("hash").agg(
            F.count("*").alias("documents"), F.max("doc_id").alias("keeper")
        )
        for run in self.runs:
            settled = run.where(F.col("documents") >= self.min_documents).select(
                "hash", F.col("keeper").alias("settled_keeper")
            )
            same = (batch["hash"] == settled["hash"]) & (settled["settled_keeper"] >= batch["keeper"])
            batch = batch.join(settled, same, "left_anti")
        self._write(batch, 0)

    def _write(self, rows: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        # an aggregate's output is dealt by hash already
        run = stored(rows.sortWithinPartitions("hash"), f"{self.folder}/{level}-{uuid.uuid4().hex}")
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_in:
            full, self.levels[level] = self.levels[level], []
            self._write(merged(full), level + 1)

    def repeated(self) -> DataFrame:
        """(hash, keeper) of the lines found in enough documents."""
        if not self.runs:
            return self.spark.createDataFrame([], "hash binary, keeper long")
        return merged(self.runs).where(F.col("documents") >= self.min_documents).select("hash", "keeper")

    def strip(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped``: repeated lines stay with their keeper only."""
        repeated = stored(self.repeated(), f"{self.folder}/repeated")
        lost = (
            hashed_lines(docs, self.min_chars)
            .join(repeated, "hash")
            .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("doc_id", "part")
            .agg(F.collect_set("hash").alias("lost_lines"))
            .select(F.col("doc_id").alias("lost_id"), F.col("part").alias("lost_part"), "lost_lines")
        )
        kept = [c for c in docs.columns if c.lower() not in ("kept_text", "n_lines", "n_dropped")]
        text = text_of()
        lines = lines_of(text)
        left = F.filter(
            lines,
            lambda x: ~F.coalesce(F.array_contains("lost_lines", line_hash(x, self.min_chars)), F.lit(False)),
        )
        has_loss = F.col("lost_lines").isNotNull()
        same = docs["doc_id"].eqNullSafe(F.col("lost_id")) & (F.xxhash64(docs["text"]) == F.col("lost_part"))
        joined = docs.join(lost, same, "left").select(
            *[docs[f"`{c}`"] for c in kept],
            F.size(lines).cast("long").alias("n_lines"),
            F.when(has_loss, left).alias("left_lines"),
        )
        return joined.select(
            *[F.col(f"`{c}`") for c in kept],
            F.coalesce(F.array_join("left_lines", "\n"), text).alias("kept_text"),
            "n_lines",
            F.coalesce(F.col("n_lines") - F.size("left_lines"), F.lit(0)).cast("long").alias("n_dropped"),
        )


def merged(runs: list[DataFrame]) -> DataFrame:
    rows = runs[0]
    for run in runs[1:]:
        rows = rows.unionByName(run)
    return rows.groupBy("hash").agg(F.sum("documents").alias("documents"), F.max("keeper").alias("keeper"))


def dedup_lines(docs: DataFrame, batches: int = BATCHES, **options) -> DataFrame:
    """Take ``docs`` in as that many batches, dealt by content, then strip the repeated lines."""
    runs = LineRuns(docs.sparkSession, **options)
    batch = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches))
    for number in range(batches):
        runs.add(docs.where(batch == number))
    return runs.strip(docs)
