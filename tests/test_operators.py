from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from cadastra.functions.dates import Period
from cadastra.operators import lookup, reshape
from cadastra.operators.filters import apply_filters, codes_of
from cadastra.operators.keyset import maybe_among
from cadastra.operators.median import exact_median
from cadastra.operators.ranking import top_n, top_n_per_group
from cadastra.operators.skew import hot_keys, salted_join, sliced_left_join, tasks_for
from cadastra.schemas import STATUS_LABELS
from samples import fact, plan_of, rows_of


def pairs(spark, rows, names="k int, v int", slices=5):
    return spark.createDataFrame(rows, names).repartition(slices)


@pytest.fixture(scope="module")
def skewed(spark):
    left = [(7, i) for i in range(60)] + [(i % 10, 100 + i) for i in range(40)] + [(None, i) for i in range(5)]
    right = [(k, k * 10 + c) for k in (1, 2, 7, 7, 42) for c in (0, 1)] + [(None, 1)]
    return pairs(spark, left), pairs(spark, right, "k int, w int")


def test_hot_keys_are_exact_for_frequent_keys(spark, skewed):
    left, _ = skewed
    assert hot_keys(left, "k", rows_per_task=10) == {7: 7}
    assert hot_keys(left, "k", rows_per_task=1000) == {}
    assert hot_keys(left, "k", rows_per_task=70) == {}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [{7: 4}, {7: 3, 1: 2, 555: 9}, {}])
def test_salted_join_equals_plain_join(skewed, how, hot):
    left, right = skewed
    assert rows_of(salted_join(left, right, "k", how, hot)) == rows_of(left.join(right, "k", how))


def test_slices_split_a_key_that_lies_in_one_partition(spark):
    left = spark.range(400).selectExpr("7 k", "id v").repartition(4, "k")
    right = spark.createDataFrame([(7, 1)], "k int, w int")
    joined = salted_join(left, right, "k", "inner", {7: 4})
    assert joined.count() == 400
    sliced = salted_join(left, right, "k", "left", {7: 4}).groupBy(F.spark_partition_id()).count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sliced.count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")


@pytest.mark.parametrize("kind", ["int", "bigint", "string"])
def test_flags_keep_every_key_that_is_there_and_few_others(spark, kind):
    rows = spark.sql(f"SELECT cast(id AS {kind}) k, id v FROM range(20000) UNION ALL SELECT NULL, -1")
    # repeated, missing and, for small numbers, unfitting keys
    keys = spark.sql("SELECT id * 7 k FROM range(2000) UNION ALL SELECT 7 UNION ALL SELECT NULL UNION ALL SELECT 1 << 40")
    kept = {r["v"] for r in maybe_among(rows, keys, "k").select("v").collect()}
    there = set(range(0, 14000, 7))
    assert there <= kept and len(kept - there) < 50
    assert maybe_among(rows, keys.limit(0), "k").count() == 0


def test_more_rows_than_the_session_has_tasks_for_get_more(spark, skewed):
    assert [tasks_for(spark, n, 100) for n in (0, 400, 401, 1000)] == [None, None, 5, 10]
    left, right = skewed
    for how, hot in [("inner", {}), ("inner", {7: 3}), ("left", {}), ("left_semi", {7: 2})]:
        joined = salted_join(left, right, "k", how, hot, tasks=9)
        assert rows_of(joined) == rows_of(left.join(right, "k", how))
        plan = plan_of(joined)
        assert ("_i#" in plan) == bool(hot) and ", 9)" in plan and "REPARTITION_BY_NUM" in plan


def test_right_side_slices(skewed):
    left, right = skewed
    plain = rows_of(left.join(right, "k"))
    assert rows_of(salted_join(left, right, "k", "inner", {7: 3}, {7: 2, 1: 3})) == plain
    assert rows_of(salted_join(left, right, "k", "inner", None, {2: 2})) == plain
    with pytest.raises(ValueError):
        salted_join(left, right, "k", "left", None, {2: 2})


def test_sliced_left_join(skewed):
    left, right = skewed
    plain = left.join(right, "k", "left").select("k", "v", "w")
    assert rows_of(sliced_left_join(left, right, "k", {7: 3, 1: 2}).select("k", "v", "w")) == rows_of(plain)


@pytest.mark.parametrize("seed", range(2))
def test_exact_median(spark, seed):
    rng = random.Random(seed)
    values = [round(rng.lognormvariate(3, 3), 2) * rng.choice([1, 1, -1]) for _ in range(401 + seed)]
    values += [500.0] * (seed * 150)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(3)
    expected = statistics.median(values)
    assert exact_median(df, "v").first()[0] == pytest.approx(expected)
    for ranges in (1, 7, 50):
        assert exact_median(df, "v", ranges).first()[0] == pytest.approx(expected)


@pytest.mark.parametrize("values, expected", [([], None), ([4.0], 4.0), ([1.0, 2.0], 1.5), ([3.0] * 4, 3.0)])
def test_exact_median_of_few_values(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_median(df, "v").first()[0] == expected
    assert exact_median(df, "v", ranges=3).first()[0] == expected


def test_exact_median_with_far_outliers(spark):
    values = [float(i) for i in range(100)] + [1e15, -1e15, 1e-300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_median(df, "v", ranges=10).first()[0] == statistics.median(values)


@pytest.mark.parametrize("ranges", [1, 5])
def test_exact_median_with_infinity_and_large_values(spark, ranges):
    def median(values):
        return exact_median(spark.createDataFrame([(v,) for v in values], "v double"), "v", ranges).first()[0]

    inf = float("inf")
    assert median([1.0, 2.0, 3.0, inf, inf]) == 3.0
    assert median([1.0, inf, inf, inf]) == inf
    assert median([1e300, 1.5e300, 1.0]) == 1e300
    assert median([1.7e308, 1.7e308]) == 1.7e308
    assert median([-inf, 5.0, 7.0, inf]) == 6.0
    assert median([2.0] * 9 + [8.0] * 9) == 5.0


def test_exact_median_is_lazy_and_has_the_same_stages_for_any_input(spark):
    few, many = (spark.range(n).selectExpr("cast(id % 997 as double) v") for n in (10, 20_000))
    exchanges = {plan_of(exact_median(df, "v", 6)).count("Exchange rangepartitioning") for df in (few, many)}
    assert len(exchanges) == 1


def test_ranking_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), (None, 2), ("c", 5), ("d", 1)], "k string, total long")
    assert [r.k for r in top_n(df, 3, "k").collect()] == ["c", None, "a"]
    assert "TakeOrderedAndProject" in plan_of(top_n(df, 3, "k"))


def test_ranking_per_group(spark):
    rows = [("x", i, i % 4) for i in range(20)] + [("y", 1, 9), (None, 3, 1), (None, 4, 1)]
    df = spark.createDataFrame(rows, "g string, k int, total int")
    top = top_n_per_group(df, 2, "g", "k")
    assert rows_of(top) == sorted([("x", 3, 3), ("x", 7, 3), ("y", 1, 9), (None, 3, 1), (None, 4, 1)], key=repr)
    plan = plan_of(top_n_per_group(df, 2, "g", "k"))
    assert plan.split("\n\n")[0].count("WindowGroupLimit") == 2  # before and after the shuffle


def test_lookup_fallbacks(spark):
    dim = spark.createDataFrame([(1, "um"), (2, "dois")], "codigo long, descricao string")
    df = spark.createDataFrame([(1,), (9,), (None,)], "c long")
    assert rows_of(lookup.describe(df, "c", dim, "Sem descrição")) == sorted(
        [(1, "um"), (9, "Sem descrição"), (None, "Sem descrição")], key=repr
    )
    assert rows_of(lookup.resolve(df, "c", dim, "t")) == sorted(
        [(1, "um"), (9, "Código 9"), (None, "Não informado")], key=repr
    )
    assert [r.opcao for r in lookup.picker(dim).collect()] == ["2 - dois", "1 - um"]


def test_large_dimensions_are_not_broadcast(spark):
    dim = spark.range(1000).selectExpr("id codigo", "cast(id as string) descricao")
    df = spark.range(10).selectExpr("id c")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "SortMergeJoin" in plan_of(lookup.describe(df, "c", dim, ""))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_shares_pivot_long_and_paths(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, total long")
    assert rows_of(reshape.with_share(df, "total", "pct")) == [("a", 1, 25.0), ("b", 3, 75.0)]
    assert reshape.with_share(df.where("total > 9"), "total", "pct").count() == 0
    cells = spark.createDataFrame([(1, 2009, 4), (1, 2009, 6), (2, 2010, 1)], "m int, a int, n int")
    assert rows_of(reshape.mean_pivot(cells, "m", "a", "n", [2009, 2010])) == [(1, 5.0, 0.0), (2, 0.0, 1.0)]
    wide = spark.createDataFrame([(2009, 5, 2)], "ano int, aberturas long, fechamentos long")
    long = reshape.to_long(wide, ["ano"], {"aberturas": "Aberturas", "fechamentos": "Fechamentos"}, "tipo", "q")
    assert rows_of(long) == [(2009, "Aberturas", 5), (2009, "Fechamentos", 2)]
    tree = spark.createDataFrame([("x", "p", 1), ("x", "q", 2), ("y", "p", 4)], "a string, b string, n long")
    assert rows_of(reshape.path_totals(tree, ["a", "b"], "n")) == sorted(
        [("x", "p", 1, 0), ("x", "q", 2, 0), ("y", "p", 4, 0), ("x", None, 3, 1), ("y", None, 4, 1), (None, None, 7, 2)],
        key=repr,
    )


def test_filters(spark):
    rows = [
        {"uf": u, "situacao_cadastral": s, "porte_empresa": p, "data_inicio_atividade": d, "cnae_fiscal_principal": c}
        for u in ("SP", "RJ", None)
        for s in (2, 8)
        for p in (1, 5)
        for d in (20091231, 20100101)
        for c in (10, 20)
    ]
    df = fact(spark, rows)
    assert apply_filters(df).count() == len(rows)
    assert apply_filters(df, states=["SP"]).count() == 16
    chosen = codes_of(STATUS_LABELS, ["Baixada"])
    assert chosen == [8]
    assert apply_filters(df, ["SP", "RJ"], chosen, [1], Period(2010, 2010), 20).count() == 2
