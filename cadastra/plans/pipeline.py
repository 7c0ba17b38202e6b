"""The three load jobs: dimensions, silver, gold; plus the document load."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.operators.quality import Observed
from cadastra.operators.skew import WIDE_ROWS_PER_TASK, hot_keys, tasks_for
from cadastra.plans.documents import build_parts
from cadastra.plans.fact import KEY, build_fact, opted_in_companies, opted_in_keys
from cadastra.plans.store import write_documents
from cadastra.schemas import COMPANIES, SILVER_TABLES
from cadastra.session import release
from cadastra.sources import bronze, dimensions, gold, silver
from cadastra.sources.committed import CODEC, is_committed, read_note, write_note


def build_dimensions(spark: SparkSession, bronze_root: str, gold_root: str, overwrite: bool = False) -> None:
    dimensions.build(spark, bronze_root, gold_root, overwrite)


#: The one table a load can do without.
OPTIONAL = "socios"


def build_silver(
    spark: SparkSession, bronze_root: str, silver_root: str, overwrite: bool = False, quarantine: bool = False
) -> None:
    """Batch conversion of all four tables; ``streaming.ingest`` is the incremental form.

    Partner files may be missing; the load then goes on without a partner table. Records with too few or too many fields are
    padded and cut, as the source does, or with ``quarantine`` kept apart with each table (``silver.quarantined``).
    """
    for folder, (table, schema) in SILVER_TABLES.items():
        try:
            read = bronze.read_judged if quarantine else bronze.read_raw
            raw = read(spark, f"{bronze_root}/{folder}", schema)
        except AnalysisException as error:
            if table == OPTIONAL and error.getCondition() == "PATH_NOT_FOUND":
                continue
            raise
        if quarantine:
            silver.write_judged(raw, f"{silver_root}/{table}", schema, overwrite)
        else:
            silver.write(silver.cast_schema(raw, schema), f"{silver_root}/{table}", overwrite)
        release(spark)


def read_silver(spark: SparkSession, silver_root: str) -> dict[str, DataFrame]:
    """The silver tables by name, without the partners if there are none. A table that a job left unfinished
    is an error, not an empty table."""
    tables = {}
    for table, schema in SILVER_TABLES.values():
        path = f"{silver_root}/{table}"
        if is_committed(spark, path):
            tables[table] = silver.read(spark, path, schema)
        elif table != OPTIONAL:
            raise FileNotFoundError(f"{path} holds no complete table")
    return tables


def fact_from_silver(tables: dict[str, DataFrame], observed: Observed | None = None) -> DataFrame:
    establishments, partners = tables["estabelecimentos"], tables.get("socios")
    rows = establishments.count()  # from the files' footers
    return build_fact(
        tables["simples"],
        tables["empresas"],
        establishments,
        partners,
        hot=hot_keys(establishments, KEY),
        hot_partners=None if partners is None else hot_keys(partners, KEY),
        hot_flags=hot_keys(tables["simples"], KEY),
        hot_companies=hot_keys(tables["empresas"], KEY),
        observed=observed,
        derived=rows > WIDE_ROWS_PER_TASK,
        tasks=tasks_for(establishments.sparkSession, rows),
    )


def build_gold(
    spark: SparkSession,
    silver_root: str,
    gold_path: str,
    snapshot: str,
    overwrite: bool = False,
    observed: Observed | None = None,
) -> bool:
    """Write one dated snapshot of the fact; False if it exists already. ``observed`` takes the stage counts."""
    fact = fact_from_silver(read_silver(spark, silver_root), observed)
    written = gold.write_snapshot(fact, gold_path, snapshot, overwrite)
    release(spark)
    return written


# Bucketed form of the silver tables: each table's rows lie in buckets by company, but for those of hot companies, which lie
# apart, in an overflow table. A company that is hot in any table is so in all.

OVERFLOW = "excedente"


def bucket_silver(spark: SparkSession, silver_root: str, path: str, prefix: str, buckets: int) -> dict[str, int]:
    """Writes the bucketed form below ``path``, as catalog tables ``<prefix>_<table>``; returns the hot companies with the number of
    slices each is cut into."""
    tables = read_silver(spark, silver_root)
    hot: dict[int, int] = {}
    for df in tables.values():
        for key, slices in hot_keys(df, KEY).items():
            hot[key] = max(slices, hot.get(key, 1))
    # at most one company per four million rows
    chosen = spark.createDataFrame([(k,) for k in hot], f"{KEY} {COMPANIES[KEY].dataType.simpleString()}")
    for name, df in tables.items():
        silver.save_bucketed(df.join(F.broadcast(chosen), KEY, "left_anti"), f"{prefix}_{name}", KEY, buckets, f"{path}/{name}")
        df.join(F.broadcast(chosen), KEY, "left_semi").write.mode("overwrite").option("compression", CODEC).parquet(f"{path}/{OVERFLOW}/{name}")
    write_note(spark, f"{path}/nota", {"buckets": buckets, **{f"hot {k}": n for k, n in hot.items()}})
    return hot


def fact_from_buckets(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """The fact of the bucketed tables, joined bucket by bucket, and that of the hot companies, joined in slices."""
    note = read_note(spark, f"{path}/nota")
    hot = {int(name.split()[1]): int(n) for name, n in note.items() if name.startswith("hot ")}
    cold, heated = {}, {}
    for table, schema in SILVER_TABLES.values():
        if not is_committed(spark, f"{path}/{table}"):
            continue
        silver.open_bucketed(spark, f"{prefix}_{table}", f"{path}/{table}", schema, KEY, int(note["buckets"]))
        cold[table] = spark.table(f"{prefix}_{table}")
        heated[table] = silver.read(spark, f"{path}/{OVERFLOW}/{table}", schema)

    # rows of companies and partners in a bucket, from the files' footers; a task holds so many of them
    owners = sum(cold[name].count() for name in ("empresas", OPTIONAL) if name in cold)
    hashed = owners <= int(note["buckets"]) * WIDE_ROWS_PER_TASK

    def fact(tables: dict[str, DataFrame], slices: dict | None) -> DataFrame:
        return build_fact(
            tables["simples"], tables["empresas"], tables["estabelecimentos"], tables.get(OPTIONAL),
            hot=slices, hot_partners=slices, hot_flags=slices, hot_companies=slices,
            derived=tables["estabelecimentos"].count() > WIDE_ROWS_PER_TASK, hashed=hashed,
        )

    return fact(cold, None).unionByName(fact(heated, hot)) if hot else fact(cold, None)


def load_documents(spark: SparkSession, silver_root: str, gold_path: str, path: str) -> None:
    """Full reload of the documents from the latest snapshot; headers, with the names, come from the companies."""
    tables = read_silver(spark, silver_root)
    flags = hot_keys(tables["simples"], KEY)
    keys = opted_in_keys(tables["simples"], repeated=bool(flags))
    companies = opted_in_companies(tables["empresas"], keys, ["razao_social"], hot_keys(tables["empresas"], KEY))
    fact = gold.read(spark, gold_path).drop("snapshot")
    # a snapshot lies in no order of companies, so its rows are dealt in any case
    tasks = tasks_for(spark, fact.count()) or int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_documents(build_parts(fact, companies, tasks), path)
