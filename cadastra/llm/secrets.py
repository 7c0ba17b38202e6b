"""Secret scans over an incremental blob ledger.

Every version of a document is addressed by the SHA-256 of its text. ``SecretLedger.scan`` looks only at blobs
and rule versions that the ledger has no record of, appends what it finds, and ``findings_of`` joins the findings back to
every path (document) that holds the blob. A batch counts once its name is among the ledger's marks, so a ledger opened
again on the same folder goes on where the last scan ended, and a scan that was cut short leaves nothing.

Defined results: a null text is empty; empty texts and empty tables have no findings; repeated versions are one
blob and all its paths get its findings; columns of the input with clashing names are not read.
Matches are the leftmost non-overlapping ones of each rule, then filtered by length; offsets are code points, end exclusive.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm.common import scratch_folder, stored, text_of
from cadastra.sources.committed import is_committed

#: A private-use character marks matches; where a text has it, its neighbour stands in while offsets are taken.
MARK, STAND_IN = "\ue000", "\ue001"


@dataclass(frozen=True)
class Rule:
    """``pattern`` with, in ``group``, the part that must have ``least`` characters."""

    kind: str
    version: int
    pattern: str
    least: int
    group: int = 0


RULES = (
    Rule(
        "assign",
        1,
        r"""((?i)(?:password|passwd|secret|token|api_?key)(?-i))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        12,
        2,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 18),
    Rule("hex", 1, r"[0-9a-f]+", 16),
)


def spans(text: Column, rule: Rule) -> Column:
    """Array of (start, end) of the rule's matches."""
    # a rule on the whole match may look for long matches only: its patterns take maximal runs
    pattern = rule.pattern if rule.group else f"{rule.pattern[:-1]}{{{rule.least - fixed_part(rule)},}}"
    clean = F.replace(text, F.lit(MARK), F.lit(STAND_IN))
    pieces = F.split(F.regexp_replace(clean, f"({pattern})", f"{MARK}$1{MARK}"), MARK, -1)
    lengths = F.transform(pieces, lambda p: F.length(p))

    def found(i: Column) -> Column:
        piece = F.element_at(pieces, i)
        start = F.aggregate(F.slice(lengths, F.lit(1), i - 1), F.lit(0), lambda a, x: a + x)
        value = F.regexp_extract(piece, rule.pattern, rule.group) if rule.group else piece
        return F.struct(
            start.cast("long").alias("start"),
            (start + F.length(piece)).cast("long").alias("end"),
            (F.length(value) >= rule.least).alias("long_enough"),
        )

    odd = F.when(F.size(pieces) > 1, F.sequence(F.lit(2), F.size(pieces), F.lit(2))).otherwise(
        F.array().cast("array<int>")
    )
    kept = F.filter(F.transform(odd, found), lambda s: s["long_enough"])
    return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def fixed_part(rule: Rule) -> int:
    """Characters before the closing character class of a rule on the whole match."""
    return len(rule.pattern[: rule.pattern.rindex("[")])


class SecretLedger:
    """Blobs scanned and spans found, as append-only Parquet in a folder all executors share."""

    def __init__(self, spark: SparkSession, folder: str | None = None, rules: tuple[Rule, ...] = RULES):
        self.spark, self.rules = spark, rules
        self.folder = folder or scratch_folder(spark, "secret-ledger")
        self.marks = f"{self.folder}/marks"
        known = spark.read.parquet(self.marks).collect() if is_committed(spark, self.marks) else []
        self.batches = [f"{self.folder}/{row['batch']}" for row in known]

    @property
    def records(self) -> DataFrame:
        """(blob, kind, version, spans): one row per blob and rule version scanned."""
        schema = "blob string, kind string, version int, spans array<struct<start: bigint, end: bigint>>"
        if not self.batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*self.batches)

    def scan(self, versions: DataFrame) -> None:
        """Scan the blobs of ``versions`` (doc_id, text) for the rule versions not yet on record."""
        addressed = versions.select("doc_id", text_of().alias("text"), F.sha2(text_of(), 256).alias("blob"))
        # one holder per blob, found without moving texts
        holders = addressed.groupBy("blob").agg(F.min("doc_id").alias("holder"))
        wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in self.rules])
        todo = holders.select("blob", "holder", F.inline(wanted))
        if self.batches:
            todo = todo.join(self.records.select("blob", "kind", "version"), ["blob", "kind", "version"], "left_anti")
        todo = todo.groupBy("blob", "holder").agg(F.collect_set(F.struct("kind", "version")).alias("todo"))
        todo = todo.select(F.col("blob").alias("todo_blob"), "holder", "todo")
        same = (F.col("blob") == F.col("todo_blob")) & F.col("doc_id").eqNullSafe(F.col("holder"))
        # the narrow side is hashed, so texts are dealt once and never sorted
        unseen = addressed.join(todo.hint("shuffle_hash"), same).select("blob", "text", "todo")

        def record(rule: Rule) -> Column:
            made = F.struct(
                F.lit(rule.kind).alias("kind"),
                F.lit(rule.version).alias("version"),
                spans(F.col("text"), rule).alias("spans"),
            )
            mine = F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"))
            return F.when(F.array_contains("todo", mine), made)

        found = unseen.select("blob", F.inline(F.array_compact(F.array(*map(record, self.rules)))))
        batch = f"batch-{uuid.uuid4().hex}"
        found.dropDuplicates(["blob", "kind", "version"]).write.parquet(f"{self.folder}/{batch}")
        self.spark.range(1).select(F.lit(batch).alias("batch")).coalesce(1).write.mode("append").parquet(self.marks)
        self.batches.append(f"{self.folder}/{batch}")

    def findings_of(self, versions: DataFrame) -> DataFrame:
        """(doc_id, findings): per row of ``versions`` all spans on record for its blob under the current rules,
        as an array of (start, rank, kind, end) in order."""
        rank = F.create_map(*[x for i, r in enumerate(self.rules) for x in (F.lit(r.kind), F.lit(i))])
        current = F.lit(False)
        for rule in self.rules:
            current = current | ((F.col("kind") == rule.kind) & (F.col("version") == rule.version))
        rows = self.records.where(current & (F.size("spans") > 0)).select("blob", "kind", F.inline("spans"))
        entry = F.struct("start", F.element_at(rank, F.col("kind")).alias("rank"), "kind", "end")
        by_blob = rows.groupBy("blob").agg(F.array_sort(F.collect_set(entry)).alias("findings"))
        # stored, so that Spark knows its size and can split a blob with very many paths
        by_blob = stored(by_blob, f"{self.folder}-findings-{uuid.uuid4().hex}")
        paths = versions.select("doc_id", F.sha2(text_of(), 256).alias("blob"))
        nothing = F.array().cast(by_blob.schema["findings"].dataType)
        return paths.join(by_blob, "blob", "left").select("doc_id", F.coalesce("findings", nothing).alias("findings"))


def listing(findings: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(
        F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))),
        ",",
    )
