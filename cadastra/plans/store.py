"""Stored documents: generations of buckets behind a manifest.

Each table is dealt into buckets by a hash of the company. A load or merge writes the buckets it touches into a folder of its
own, ``<table>/generation=<token>/bucket=<n>``, and changes no file that is there. Then it writes a manifest, which names the live
generation of every bucket of every table; from the moment its file is in place readers see the change. So a read
that began before keeps its files, and a job that was cut short leaves folders that no manifest names.

Postings by activity and by pieces of names are kept like tables: a merge writes those of the buckets it touches. The
manifest also holds the last batch of each stream that was merged, so a batch that is delivered again changes nothing.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from functools import lru_cache
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from cadastra.operators.skew import tasks_for
from cadastra.plans.documents import Documents, Parts, counted, merged_parts, parts_of
from cadastra.plans.search import activity_postings, name_postings
from cadastra.session import release, shared_dir

BUCKETS = 1024
MANIFEST = "manifest"
INCOMING = "incoming"
#: Side tables that a store may keep, each with the order of its rows within a bucket.
INDEXES = {"activity": (activity_postings, ["cnae", "uf", "_id"]), "names": (name_postings, ["gram", "_id"])}


class Manifest(NamedTuple):
    """What one generation of a store consists of; ``live`` gives, per table, the generation of each bucket that has rows."""

    number: int
    buckets: int
    live: dict[str, dict[int, str]]
    schemas: dict[str, StructType]
    streams: dict[str, int]

    @property
    def indexes(self) -> list[str]:
        return [name for name in self.schemas if name in INDEXES]


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("_id"), F.lit(buckets)).cast("int")


def _manifests(spark: SparkSession, path: str) -> dict[int, str]:
    """File of each manifest, by number. A manifest is one file, which a rename puts in place: it is there whole or not at all."""
    try:
        files = spark.read.format("binaryFile").load(f"{path}/{MANIFEST}/*/part-*").inputFiles()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    return {int(re.search(rf"/{MANIFEST}/(\d+)/", file)[1]): file for file in files}


def generations(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the manifests, in order."""
    return sorted(_manifests(spark, path))


def manifest(spark: SparkSession, path: str, number: int | None = None) -> Manifest:
    """The manifest with that number, or the latest."""
    known = _manifests(spark, path)
    if not known or (number is not None and number not in known):
        raise FileNotFoundError(f"{path} holds no such set of documents")
    number = max(known) if number is None else number
    return _manifest(spark.sparkContext.applicationId, known[number], number)


@lru_cache(maxsize=64)
def _manifest(application: str, file: str, number: int) -> Manifest:
    """Manifests never change, and no two files have one name, so each is read once."""
    entries = SparkSession.active().read.schema("kind string, name string, value string").parquet(file).collect()

    def of(kind: str) -> dict[str, str]:
        return {e["name"]: e["value"] for e in entries if e["kind"] == kind}

    schemas = {name: StructType.fromJson(json.loads(value)) for name, value in of("schema").items()}
    live: dict[str, dict[int, str]] = {name: {} for name in schemas}
    for place, token in of("live").items():
        table, bucket = place.split("/")
        live[table][int(bucket)] = token
    streams = {name: int(value) for name, value in of("stream").items()}
    return Manifest(number, int(of("setting")["buckets"]), live, schemas, streams)


def _publish(spark: SparkSession, path: str, found: Manifest) -> None:
    """Writes a manifest; a second one of the same number is an error, so of two writers one has to start again."""
    rows = [("setting", "buckets", str(found.buckets))]
    rows += [("schema", name, schema.json()) for name, schema in found.schemas.items()]
    rows += [("live", f"{name}/{b}", token) for name, buckets in found.live.items() for b, token in buckets.items()]
    rows += [("stream", name, str(batch)) for name, batch in found.streams.items()]
    table = spark.createDataFrame(rows, "kind string, name string, value string").coalesce(1)
    table.write.mode("error").parquet(f"{path}/{MANIFEST}/{found.number}")


def read_table(spark: SparkSession, path: str, found: Manifest, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
    """A live table, or those buckets of it, with the column ``bucket``. Other folders are not even listed."""
    live = found.live[name]
    if buckets is not None:
        live = {b: live[b] for b in buckets if b in live}
    schema = StructType([*found.schemas[name].fields]).add("generation", StringType()).add("bucket", IntegerType())
    if not live:
        return spark.createDataFrame([], schema).drop("generation")
    root, first = f"{path}/{name}", min(found.live[name].values())
    if buckets is None and set(live.values()) == {first}:
        paths = [f"{root}/generation={first}"]
    else:
        paths = [f"{root}/generation={token}/bucket={b}" for b, token in sorted(live.items())]
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).drop("generation")


def read_documents(
    spark: SparkSession, path: str, generation: int | None = None, buckets: Iterable[int] | None = None
) -> Documents:
    """The documents of the latest generation, or of an earlier one."""
    found = manifest(spark, path, generation)
    chosen = None if buckets is None else list(buckets)
    return Documents(*[read_table(spark, path, found, name, chosen) for name in Documents._fields])


def read_index(spark: SparkSession, path: str, name: str, generation: int | None = None) -> DataFrame:
    """Postings of the same generation as the documents read with it."""
    return read_table(spark, path, manifest(spark, path, generation), name)


def stored_buckets(spark: SparkSession, path: str) -> int:
    return manifest(spark, path).buckets


def documents_by_id(spark: SparkSession, path: str, company: int) -> Documents:
    """Point lookup that lists and opens one bucket only."""
    # a constant, so no job runs for it
    asked = spark.sql("SELECT CAST(:company AS BIGINT) AS _id", {"company": company})
    number = asked.select(bucket_of(stored_buckets(spark, path))).first()[0]
    return read_documents(spark, path, buckets=[number]).each(lambda table: table.where(F.col("_id") == company))


def write_documents(
    documents: Documents | Parts, path: str, buckets: int | None = None, indexes: Iterable[str] | None = None
) -> None:
    """Full reload, as a new generation. An existing store keeps its number of buckets and its indexes unless given others."""
    parts = parts_of(documents)
    spark = parts.units.sparkSession
    known = generations(spark, path)
    before = manifest(spark, path, known[-1]) if known else None
    buckets = buckets or (before.buckets if before else BUCKETS)
    if indexes is None:
        indexes = before.indexes if before else []
    number = before.number + 1 if before else 0
    live, schemas = _write(parts, path, buckets, list(indexes))
    _publish(spark, path, Manifest(number, buckets, live, schemas, before.streams if before else {}))


def merge_into(path: str, new: Documents | Parts, stream: str | None = None, batch: int = 0) -> list[int]:
    """Merge into the stored documents; returns the buckets that were written (as many as the store has, at most).

    Batches of a named ``stream`` come in the order of their numbers; one that is merged already is left out.
    """
    parts = parts_of(new)
    spark = parts.units.sparkSession
    found = manifest(spark, path)
    if stream is not None and batch <= found.streams.get(stream, -1):
        return []
    # kept as files while the merge runs: compressed, and the same rows whenever they are read
    incoming = f"{shared_dir(spark)}/cadastra-{uuid.uuid4().hex}/{INCOMING}"
    try:
        parts = Parts(*[_kept(table, f"{incoming}/{name}") for name, table in parts._asdict().items()])
        touched = sorted(row[0] for row in parts.heads.select(bucket_of(found.buckets)).distinct().collect())
        if not touched and stream is None:
            return []
        live, schemas = found.live, found.schemas
        if touched:
            held = read_documents(spark, path, found.number, touched).each(lambda table: table.drop("bucket"))
            # what a merge keeps has its postings; only documents that come add some, with the names of companies that are new
            posted = {name: read_table(spark, path, found, name, touched) for name in found.indexes}
            names = parts.heads.join(held.headers.select("_id"), "_id", "left_anti").groupBy("_id").agg(F.min("header").alias("h"))
            added = Documents(names.select("_id", "h.razao_social"), parts.partners, parts.units)
            tasks = tasks_for(spark, held.units.count() + parts.units.count())  # from the files' footers
            written, schemas = _write(merged_parts(held, parts, tasks), path, found.buckets, found.indexes, added, posted)
            gone = set(touched)
            live = {
                name: {b: t for b, t in tokens.items() if b not in gone} | written.get(name, {}) for name, tokens in live.items()
            }
    finally:
        remove(spark, incoming)
    streams = found.streams | ({stream: batch} if stream is not None else {})
    _publish(spark, path, Manifest(found.number + 1, found.buckets, live, schemas, streams))
    return touched


def _kept(table: DataFrame, folder: str) -> DataFrame:
    table.write.parquet(folder)
    return table.sparkSession.read.schema(table.schema).parquet(folder)


def remove(spark: SparkSession, folder: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _write(
    parts: Parts,
    path: str,
    buckets: int,
    indexes: list[str],
    added: Documents | None = None,
    posted: dict[str, DataFrame] | None = None,
) -> tuple[dict[str, dict[int, str]], dict[str, StructType]]:
    """One generation of all tables. Headers are counted, and postings made, from what has been stored, or postings from
    those ``posted`` by an earlier generation and from what was ``added`` since."""
    spark, token = parts.units.sparkSession, uuid.uuid4().hex
    live: dict[str, dict[int, str]] = {}
    schemas: dict[str, StructType] = {}

    def put(name: str, table: DataFrame, order: list[str], key: str) -> DataFrame:
        folder = f"{path}/{name}/generation={token}"
        schemas[name] = table.schema
        # rebalancing splits a bucket that is larger than others over several files
        dealt = table.withColumn("bucket", bucket_of(buckets)).hint("rebalance", "bucket")
        # adaptive filters are as large as their file's keys ask for; else each takes a megabyte
        filters = {f"parquet.bloom.filter.enabled#{key}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
        dealt.sortWithinPartitions("bucket", *order).write.options(**filters).partitionBy("bucket").parquet(folder)
        stored = spark.read.schema(StructType([*table.schema.fields]).add("bucket", IntegerType())).parquet(folder)
        release(spark)
        live[name] = {int(b): token for b in {re.search(r"/bucket=(\d+)/", f)[1] for f in stored.inputFiles()}}
        return stored

    units = put("units", parts.units, ["_id"], "_id")
    partners = put("partners", parts.partners, ["_id"], "_id")
    headers = put("headers", counted(parts.heads, units), ["_id"], "_id")
    for name in indexes:
        postings, order = INDEXES[name]
        put(name, postings(added or Documents(headers, partners, units), (posted or {}).get(name)), order, order[0])
    order = [*Documents._fields, *indexes]
    return {name: live[name] for name in order}, {name: schemas[name] for name in order}


def expire(spark: SparkSession, path: str, keep: int = 1) -> list[int]:
    """Removes all but the latest ``keep`` generations, with the folders that only they name; returns their numbers.

    Reads of a removed generation fail from then on. Folders that no manifest names may belong to a job that is running, and stay.
    """
    known = generations(spark, path)
    gone, kept = known[:-keep], known[-keep:]

    def folders(numbers: list[int]) -> set[str]:
        found = [manifest(spark, path, number) for number in numbers]
        return {
            f"{path}/{name}/generation={token}/bucket={b}" for m in found for name, live in m.live.items() for b, token in live.items()
        }

    unused = folders(gone) - folders(kept)
    # manifests first, so that no reader finds one whose folders are gone
    for folder in [*(f"{path}/{MANIFEST}/{number}" for number in gone), *sorted(unused)]:
        remove(spark, folder)
    return gone
