from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.operators.quality import fanout_report, stage_counts
from cadastra.plans.fact import KEY, build_fact, opted_in_keys
from cadastra.plans.pipeline import fact_from_silver
from cadastra.schemas import FACT
from cadastra.sources import gold, silver
from samples import fact, plan_of, rows_of, silver_tables

SIMPLES = [{KEY: 1, "opcao_pelo_mei": "S"}, {KEY: 1, "opcao_pelo_mei": "S"}, {KEY: 2, "opcao_pelo_mei": "N"}]
SIMPLES += [{KEY: 3, "opcao_pelo_mei": ""}, {KEY: 4, "opcao_pelo_mei": None}, {KEY: 5, "opcao_pelo_mei": "S"}]
SIMPLES += [{KEY: 6, "opcao_pelo_mei": "S"}, {KEY: 7, "opcao_pelo_mei": "S"}]
COMPANIES = [{KEY: k, "razao_social": f"C{k}", "capital_social": f"{k},5", "porte_empresa": 1} for k in (1, 2, 3, 4, 5, 7)]
UNITS = [{KEY: k, "cnpj_ordem": o, "cnpj_dv": 1} for k in (1, 2, 3, 4, 5, 6) for o in (1, 2)] + [{KEY: None, "cnpj_ordem": 9}]
PARTNERS = [{KEY: 5, "nome_socio_razao_social": n, "identificador_socio": 2, "pais": 1} for n in ("A", "B")]


def build(spark, partners=PARTNERS, **kwargs):
    t = silver_tables(spark, SIMPLES, COMPANIES, UNITS, partners)
    return build_fact(t["simples"], t["empresas"], t["estabelecimentos"], t["socios"], **kwargs)


def test_fact_keeps_opted_in_companies_and_fans_out_partners(spark):
    df = build(spark)
    assert df.schema.names == FACT.names and len(df.columns) == 39
    assert [f.dataType for f in df.schema.fields] == [f.dataType for f in FACT.fields]
    got = rows_of(df.select(KEY, "cnpj_ordem", "capital_social", "nome_socio_razao_social"))
    expected = [(1, 1, 1.5, None), (1, 2, 1.5, None)]
    expected += [(5, o, 5.5, n) for o in (1, 2) for n in ("A", "B")]
    assert got == sorted(expected, key=repr)


def test_fact_without_partner_table(spark):
    t = silver_tables(spark, SIMPLES, COMPANIES, UNITS, PARTNERS)
    df = build_fact(t["simples"], t["empresas"], t["estabelecimentos"], None)
    assert df.count() == 4 and df.where(F.col("nome_socio_razao_social").isNotNull()).count() == 0
    assert [f.dataType for f in df.schema.fields] == [f.dataType for f in FACT.fields]


def test_hot_keys_change_the_layout_only(spark):
    plain = rows_of(build(spark))
    for hot, partners, flags in [({1: 3}, None, None), ({1: 2, 5: 4}, {5: 3}, {1: 2}), (None, {5: 2, 99: 7}, None)]:
        assert rows_of(build(spark, hot=hot, hot_partners=partners, hot_flags=flags)) == plain


def test_names_are_optional(spark):
    assert rows_of(build(spark, names=True).select(KEY, "razao_social").distinct()) == [(1, "C1"), (5, "C5")]


def test_reports(spark):
    t = silver_tables(spark, SIMPLES, COMPANIES, UNITS, PARTNERS)
    assert rows_of(fanout_report(t["socios"], KEY)) == [(5, 2)]
    stages = stage_counts({"mei": opted_in_keys(t["simples"]), "fato": build(spark)})
    assert rows_of(stages) == [("fato", 6), ("mei", 4)]


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "fato")
    first = fact(spark, [{KEY: 1, "data_inicio_atividade": 20100101}, {KEY: 2, "data_inicio_atividade": 20090101}])
    second = fact(spark, [{KEY: 1, "data_inicio_atividade": 20100101}])
    assert gold.write_snapshot(first, path, "20240101")
    assert gold.write_snapshot(second, path, "20250101")
    assert not gold.write_snapshot(first, path, "20250101")
    assert gold.snapshots(spark, path) == ["20240101", "20250101"]
    assert gold.read(spark, path).count() == 1
    assert gold.read(spark, path, "20240101").count() == 2
    assert gold.read(spark, path, gold.ALL).count() == 3
    assert gold.write_snapshot(first, path, "20250101", overwrite=True)
    assert gold.read(spark, path).count() == 2 and gold.read(spark, path, "20240101").count() == 2
    plan = plan_of(gold.read(spark, path).select(KEY))
    assert "snapshot" in plan.split("PartitionFilters")[1].split("\n")[0]


def stored(spark, tmp_path):
    t = silver_tables(spark, SIMPLES, COMPANIES, UNITS, PARTNERS)
    for name, df in t.items():
        silver.write(df, str(tmp_path / name))
    return {n: silver.read(spark, str(tmp_path / n), df.schema) for n, df in t.items()}


def test_establishments_are_shuffled_once_behind_a_bloom_filter(spark, tmp_path):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df = fact_from_silver(stored(spark, tmp_path))
        plan = plan_of(df)
        assert "might_contain" in plan
        main = plan.split("Subqueries")[0]
        assert main.split("\n\n")[0].count("Exchange") == 4  # one per table
        assert rows_of(df) == rows_of(build(spark))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    tables = stored(spark, tmp_path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, df in tables.items():
            silver.save_bucketed(df, f"b_{name}", KEY, 4)
        t = {name: spark.table(f"b_{name}") for name in tables}
        df = build_fact(t["simples"], t["empresas"], t["estabelecimentos"], t["socios"])
        assert "Exchange" not in plan_of(df).split("\n\n")[0]
        assert rows_of(df) == rows_of(build(spark))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS b_{name}")


def test_establishments_meet_the_keys_below_their_own_joins(spark):
    t = silver_tables(spark, SIMPLES, COMPANIES, UNITS, PARTNERS)
    towns = spark.createDataFrame([(i, f"T{i}") for i in range(3)], "municipio bigint, bairro string")
    narrow = t["estabelecimentos"].drop("municipio", "bairro").withColumn("municipio", F.lit(1).cast("bigint"))
    wide = narrow.withColumn("municipio", F.col("cnpj_ordem").cast("bigint")).join(towns, "municipio")
    df = build_fact(t["simples"], t["empresas"], wide, t["socios"], derived=True)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    joins = [line.strip(" :+-") for line in optimized.splitlines() if "Join" in line]
    depth = {kind: [line.index("Join") for line in optimized.splitlines() if f"Join {kind}" in line] for kind in ("Inner", "LeftSemi")}
    assert max(depth["LeftSemi"]) > max(depth["Inner"]), joins
    assert rows_of(df.select(KEY, "bairro").distinct()) == [(1, "T1"), (1, "T2"), (5, "T1"), (5, "T2")]


def test_other_companies_go_before_the_shuffle_though_the_keys_are_too_many_to_broadcast(spark, tmp_path):
    t = stored(spark, tmp_path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = t["estabelecimentos"].withColumn("bairro", F.concat(F.lit("B"), F.col("cnpj_ordem")))
        df = build_fact(t["simples"], t["empresas"], wide, t["socios"], derived=True, tasks=9)
        physical = df._jdf.queryExecution().executedPlan().toString().splitlines()
        shuffled = next(i for i, line in enumerate(physical) if "Exchange hashpartitioning" in line)
        assert ", 9)" in physical[shuffled]
        # the flags are met below the first exchange, that of the establishments
        assert "BroadcastHashJoin" in physical[shuffled + 1] and "LeftSemi" in physical[shuffled + 1], physical[shuffled + 1]
        got = rows_of(df.select(KEY, "cnpj_ordem", "bairro", "nome_socio_razao_social"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    expected = [(1, o, f"B{o}", None) for o in (1, 2)] + [(5, o, f"B{o}", n) for o in (1, 2) for n in ("A", "B")]
    assert got == sorted(expected, key=repr)


def test_tasks_change_the_layout_only(spark):
    plain = rows_of(build(spark))
    for hot, partners, derived in [(None, None, False), ({1: 2, 5: 4}, {5: 3}, False), ({1: 2, 5: 4}, {5: 3}, True)]:
        assert rows_of(build(spark, hot=hot, hot_partners=partners, tasks=7, derived=derived)) == plain
