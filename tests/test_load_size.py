"""What the load jobs write, shuffle and compile, on tables of a few rows."""

from __future__ import annotations

import os
from glob import glob

import pytest
from pyspark.sql import functions as F

from cadastra.functions.cleansing import typed
from cadastra.operators import skew
from cadastra.plans import pipeline
from cadastra.schemas import ESTABLISHMENTS, SILVER_TABLES
from cadastra.sources import bronze, silver
from checks import catalog, tables
from samples import plan_of, rows_of, silver_tables, table

FLAGS = [{"cnpj_basico": k, "opcao_pelo_mei": "S" if k % 2 else "N"} for k in range(8)]
COMPANIES = [{"cnpj_basico": k, "capital_social": "1,5"} for k in range(8)]
UNITS = [{"cnpj_basico": k % 8, "cnpj_ordem": k, "cnpj_dv": 1, "nome_fantasia": f"L{k}"} for k in range(64)]
PARTNERS = [{"cnpj_basico": k, "nome_socio_razao_social": n} for k in (1, 2) for n in ("A", "B")]


@pytest.fixture
def silver_root(spark, tmp_path):
    stored = silver_tables(spark, FLAGS, COMPANIES, UNITS, PARTNERS)
    for name, schema in SILVER_TABLES.values():
        silver.write(stored[name], str(tmp_path / "silver" / name))
    return str(tmp_path / "silver")


@pytest.fixture
def few_rows_a_task(spark, monkeypatch):
    monkeypatch.setattr(pipeline, "WIDE_ROWS_PER_TASK", 8)
    monkeypatch.setattr(pipeline, "tasks_for", lambda spark, rows: skew.tasks_for(spark, rows, 8))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_raw_files_are_compressed_and_none_is_too_long_for_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "RAW_RECORDS", 20)
    rows = [{**u, "bairro": " –x;\"y\" ", "cep": None} for u in UNITS]
    catalog._raw_file(table(spark, ESTABLISHMENTS, rows).coalesce(1), str(tmp_path / "raw"))
    files = glob(str(tmp_path / "raw" / "part-*"))
    assert len(files) == 4 and all(f.endswith(".gz") for f in files)
    got = silver.cast_schema(bronze.read_raw(spark, str(tmp_path / "raw"), ESTABLISHMENTS), ESTABLISHMENTS)
    assert rows_of(got.select("cnpj_ordem", "bairro", "cep")) == sorted(((k, '-x;"y"', None) for k in range(64)), key=repr)


def test_a_wide_table_is_typed_by_code_the_jvm_compiles(spark):
    text = [" a ", " b\t", "", None, "12", " 7 ", "99999999999", "-1", "x"]
    raw = spark.createDataFrame(
        [tuple(text[(i + k) % len(text)] for k in range(len(ESTABLISHMENTS))) for i in range(len(text))],
        ", ".join(f"{n} string" for n in ESTABLISHMENTS.names),
    ).repartition(2)
    each = raw.select(*[typed(F.col(f.name), f.dataType).alias(f.name) for f in ESTABLISHMENTS.fields])
    together = silver.cast_schema(raw, ESTABLISHMENTS)
    assert together.dtypes == each.dtypes and rows_of(together) == rows_of(each)

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        debug = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package")
        found = debug.codegenStringSeq(together._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # longer methods are left to the interpreter
    assert max([found.apply(i)._3().maxMethodCodeSize() for i in range(found.size())], default=0) < 8000


def test_a_load_of_many_establishments_drops_others_before_the_shuffle_and_deals_to_more_tasks(spark, silver_root, few_rows_a_task):
    df = pipeline.fact_from_silver(pipeline.read_silver(spark, silver_root))
    physical = df._jdf.queryExecution().executedPlan().toString().splitlines()
    shuffled = next(i for i, line in enumerate(physical) if "Exchange hashpartitioning" in line)
    assert ", 8)" in physical[shuffled]
    assert "BroadcastHashJoin" in physical[shuffled + 1] and "LeftSemi" in physical[shuffled + 1], physical[shuffled + 1]
    assert df.count() == 8 * 5  # companies 1, 3, 5 and 7, the first with two partners


def test_bucketed_establishments_are_joined_without_a_sort(spark, silver_root, tmp_path, few_rows_a_task):
    pipeline.bucket_silver(spark, silver_root, str(tmp_path / "b"), "size", 4)
    try:
        df = pipeline.fact_from_buckets(spark, str(tmp_path / "b"), "size")
        plan = plan_of(df).split("\n\n")[0]
        assert "ShuffledHashJoin" in plan and "Exchange hashpartitioning" not in plan
        assert rows_of(df) == rows_of(pipeline.fact_from_silver(pipeline.read_silver(spark, silver_root)))
    finally:
        for name, _ in SILVER_TABLES.values():
            spark.sql(f"DROP TABLE IF EXISTS size_{name}")


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not here")
@pytest.mark.parametrize("kept", [False, True])
def test_raw_files_made_for_a_load_go_with_it_unless_kept(spark, kept):
    folder = catalog._silver_tables(tables.registry(spark, "/root/testdata/sf0.001"), keep_raw=kept)
    assert os.path.isdir(f"{folder}/silver/estabelecimentos") and os.path.isdir(f"{folder}/bronze") == kept
