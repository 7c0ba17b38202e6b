"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from checks import catalog, compare, oracle

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_agrees_with_sql(spark, con, name):
    assert compare.difference(spark, con, FOLDER, name) is None


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["uf", "total", "ativos", "media_capital", "pct_ativos"] and df.count() > 0
