"""The registered queries of the package against their SQL, and the pipeline."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from cadastra.llm import queries as registered
from checks import compare

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_all_are_registered():
    names = set(registered.queries())
    assert names <= set(driver.queries()) and "pipeline" in driver.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    df = registered.queries()[name](spark, FOLDER)
    result = compare.connect(FOLDER).execute(registered.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert compare.canonical(df.columns, [tuple(r) for r in df.collect()]) == compare.canonical(columns, result.fetchall())


def test_pipeline_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        out = spark.createDataFrame(out.collect(), out.schema)
        kept = {r.doc_id for r in out.select("doc_id").collect()}
        assert kept <= ids and len(kept) > 0.3 * len(ids), name
        ids, docs = kept, out
    assert {"slot", "shard"} <= set(docs.columns)
