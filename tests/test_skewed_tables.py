"""Registered queries on tables in which one key holds a third of the rows, with thresholds small enough
for every hot-key path to be taken."""

from __future__ import annotations

import os

import duckdb
import pytest

from cadastra.operators import skew
from cadastra.sources import gold
from checks import catalog, compare, tables

SOURCE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SOURCE), reason="test tables are not here")

# One company, one activity, one town and one lookup id take a third of the rows each.
HOT = {
    "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 11 ELSE o_custkey END AS o_custkey",
    "lineitem": "CASE WHEN l_partkey % 3 = 0 THEN 50 ELSE l_partkey END AS l_partkey, "
    "CASE WHEN l_orderkey % 3 = 1 THEN 7 ELSE l_suppkey END AS l_suppkey",
    "customer": "CASE WHEN c_custkey = 11 THEN 'BUILDING' ELSE c_mktsegment END AS c_mktsegment",
    "events": "CASE WHEN event_id % 3 = 0 THEN 11 ELSE user_id END AS user_id",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    target = str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    for table in compare.TABLES:
        columns = f"* REPLACE ({HOT[table]})" if table in HOT else "*"
        con.execute(f"COPY (SELECT {columns} FROM '{SOURCE}/{table}.parquet') TO '{target}/{table}.parquet'")
    return target


@pytest.fixture
def small_thresholds(monkeypatch):
    def hot_keys(df, key):
        return skew.hot_keys(df, key, rows_per_task=150)
    monkeypatch.setattr(tables, "hot_keys", hot_keys)
    monkeypatch.setattr(catalog, "hot_keys", hot_keys)


NAMES = """fact_gold kpis top_cnaes cnae_by_situacao doc_lookup doc_by_uf_cnae doc_by_secondary_cnae
doc_count_by_uf doc_branches_by_uf doc_activity_index doc_stats company_sheet name_search documents_flat doc_merge
doc_store_merge doc_by_key_stored doc_by_uf_whole doc_by_secondary_cnae_whole doc_by_index_stored semi_establishments
inner_establishments_companies left_partners""".split()


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, folder, small_thresholds, name):
    registry = tables.registry(spark, folder)
    assert 11 in registry.hot["establishments"]
    assert compare.difference(spark, compare.connect(folder), folder, name) is None


def test_no_row_of_the_documents_grows_with_the_hot_company(spark, folder, small_thresholds):
    documents = tables.registry(spark, folder).documents
    assert documents.headers.where("_id = 11").count() == 1
    assert documents.units.where("_id = 11").count() > 500


MANY = ["fact_gold", "snapshot_rewrites_unfinished", "snapshot_all", "doc_requested", "doc_merge"]


@pytest.mark.parametrize("name", MANY)
def test_tables_of_more_rows_than_the_session_has_tasks_for(spark, folder, small_thresholds, monkeypatch, name):
    monkeypatch.setattr(tables, "_registries", {})
    monkeypatch.setattr(tables, "tasks_for", lambda spark, rows: skew.tasks_for(spark, rows, 600))
    registry = tables.registry(spark, folder)
    assert registry.tasks == 10 and len(registry.hot["establishments"]) > 0
    assert compare.difference(spark, compare.connect(folder), folder, name) is None


def test_a_kept_fact_has_as_many_files_as_its_joins_have_tasks(spark, folder, monkeypatch):
    monkeypatch.setattr(tables, "_registries", {})
    monkeypatch.setattr(tables, "tasks_for", lambda spark, rows: skew.tasks_for(spark, rows, 600))
    registry = tables.registry(spark, folder)
    assert len(registry.kept(registry.fact).inputFiles()) == registry.tasks == 10


@pytest.fixture
def many(spark, folder, monkeypatch):
    monkeypatch.setattr(tables, "_registries", {})
    monkeypatch.setattr(tables, "tasks_for", lambda spark, rows: skew.tasks_for(spark, rows, 600))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield tables.registry(spark, folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["fact_gold", "snapshot_latest", "snapshot_all"])
def test_rows_that_are_dealt_by_company_agree_with_sql(spark, folder, many, name):
    assert many.tasks == 10 and not many.hot["establishments"]
    assert compare.difference(spark, compare.connect(folder), folder, name) is None


def test_other_companies_lines_go_before_they_are_shuffled_and_texts_are_derived_after(many):
    plan = many.fact._jdf.queryExecution().executedPlan().toString().splitlines()

    def below(exchange):
        at = [i for i, line in enumerate(plan) if f"Exchange hashpartitioning({exchange}#" in line]
        assert len(at) == 1, plan
        return "".join(plan[at[0] + 1 : at[0] + 4])

    assert "LeftSemi" in below("l_orderkey") and "LeftSemi" in below("o_orderkey")
    assert "10), REPARTITION_BY_NUM" in next(line for line in plan if "Exchange hashpartitioning(o_custkey#" in line)
    assert "@example.com" not in "".join(plan[next(i for i, x in enumerate(plan) if "Exchange hashpartitioning(o_custkey#" in x) :])


def test_a_snapshot_is_stored_by_the_tasks_that_join_it_and_the_earlier_one_is_taken_from_it(spark, many, monkeypatch):
    monkeypatch.setattr(tables.Registry, "kept", None)
    files = gold.read(spark, catalog._stored_snapshots(many), gold.ALL).inputFiles()
    assert len([f for f in files if "/snapshot=20250101/" in f]) == many.tasks == 10
    assert len({f.rsplit("/", 1)[0] for f in files}) == 2
