from __future__ import annotations

import datetime
import random
import statistics
from collections import Counter

import pytest

from cadastra.functions.dates import Period
from cadastra.plans import metrics
from samples import fact, plan_of, rows_of

TEXTS = [(4700000, "comércio " * 6), (4711111, "a" * 30), (9999999, "b" * 31)]


def sample(seed: int) -> list[dict]:
    rng = random.Random(seed)
    dates = [0, None, 20081231, 20090101, 20150630, 20201231, 20251231, 20260101, 20151300]
    return [
        {
            "cnpj_basico": i,
            "uf": rng.choice(["SP", "SP", "RJ", "MG", None]),
            "municipio": rng.choice([1, 2, 3, 4, 5, 6, 7, 8, None]),
            "situacao_cadastral": rng.choice([1, 2, 2, 2, 8, 8, 9, None]),
            "porte_empresa": rng.choice([0, 1, 3, 5, 9, None]),
            "data_inicio_atividade": rng.choice(dates),
            "data_situacao_cadastral": rng.choice([0, None, 20081231, 20120501, 20160101, 20260101]),
            "cnae_fiscal_principal": rng.choice([4700000, 4700000, 4711111, 9999999, 111301, None]),
            "capital_social": float(rng.choice([0, 10, 10, 99, 5000])),
        }
        for i in range(300)
    ]


@pytest.fixture(scope="module")
def rows():
    return sample(1)


@pytest.fixture(scope="module")
def df(spark, rows):
    return fact(spark, rows).cache()


@pytest.fixture(scope="module")
def activities(spark):
    return spark.createDataFrame(TEXTS, "codigo long, descricao string")


@pytest.fixture(scope="module")
def inside(rows):
    return [r for r in rows if 20090000 <= (r["data_inicio_atividade"] or 0) < 20260000]


def ranked(counter):
    return sorted(counter.items(), key=lambda kv: (-kv[1], kv[0] is not None, kv[0] or 0))


def test_headline_indicators(df, inside):
    r = metrics.headline_indicators(df).first()
    capitals = [x["capital_social"] for x in inside]
    active = sum(x["situacao_cadastral"] == 2 for x in inside)
    assert (r.total, r.ativos, r.total_ufs) == (len(inside), active, 4)  # null is counted as a state
    assert r.media_capital == pytest.approx(statistics.mean(capitals))
    assert r.mediana_capital == statistics.median(capitals)
    assert r.taxa_atividade == pytest.approx(active / len(inside) * 100)


def test_headline_indicators_of_nothing(df):
    r = metrics.headline_indicators(df, Period(1900, 1901)).first()
    assert tuple(r) == (0, 0, None, None, 0, 0.0)


def test_distributions(df, inside):
    got = [tuple(r) for r in metrics.status_distribution(df).collect()]
    labels = {1: "Nula", 2: "Ativa", 8: "Baixada"}
    counts = Counter(x["situacao_cadastral"] for x in inside)
    assert got == [(k, n, labels.get(k, "Desconhecido")) for k, n in ranked(counts)]
    sizes = Counter(x["porte_empresa"] for x in inside)
    assert [(r.porte_empresa, r.total) for r in metrics.size_distribution(df).collect()] == ranked(sizes)


def test_top_activities(df, inside, activities):
    counts = ranked(Counter(x["cnae_fiscal_principal"] for x in inside))[:3]
    texts = dict(TEXTS)
    got = [tuple(r) for r in metrics.top_activities(df, activities, 3).collect()]
    assert got == [(k, n, texts.get(k, "Sem descrição")) for k, n in counts]
    assert metrics.top_activities(df, activities, 99).count() == 5


def closing_year(row):
    changed = row["data_situacao_cadastral"] or 0
    closed = row["situacao_cadastral"] == 8 and changed > 0 and 2009 <= changed // 10000 <= 2025
    return changed // 10000 if closed else None


def test_yearly_flow_keeps_years_with_closings_only(df, inside):
    opened = Counter(x["data_inicio_atividade"] // 10000 for x in inside)
    closed = Counter(closing_year(x) for x in inside if closing_year(x))
    expected = [(y, opened[y], closed[y]) for y in sorted({*opened, *closed})]
    got = [tuple(r) for r in metrics.yearly_flow(df).collect()]
    assert got == expected
    assert any(o == 0 for _, o, _ in got) and any(c == 0 for _, _, c in got)
    totals = metrics.period_totals(metrics.yearly_flow(df), Period(2012, 2020)).first()
    chosen = [r for r in expected if 2012 <= r[0] <= 2020]
    o, c = sum(r[1] for r in chosen), sum(r[2] for r in chosen)
    assert tuple(totals) == (o, c, o - c)
    long = rows_of(metrics.yearly_flow_long(metrics.yearly_flow(df)))
    assert long == sorted(
        [(y, "Aberturas", o) for y, o, _ in expected] + [(y, "Fechamentos", c) for y, _, c in expected], key=repr
    )


def test_monthly_flow(df, inside):
    got = [tuple(r) for r in metrics.monthly_flow(df).collect()]
    assert got == sorted(got)
    by_month = {(y, m): (o, c, d) for y, m, o, c, d in got}
    assert by_month[2015, 13][2] is None  # no real month
    assert by_month[2009, 1][2] == datetime.date(2009, 1, 1)
    yearly = {r.ano: (r.aberturas, r.fechamentos) for r in metrics.yearly_flow(df).collect()}
    for year, totals in yearly.items():
        assert totals == tuple(sum(v[i] for (y, _), v in by_month.items() if y == year) for i in (0, 1))


def test_opening_counts_agree(df, inside):
    years = {r.ano_abertura: r.total for r in metrics.openings_by_year(df).collect()}
    assert years == Counter(x["data_inicio_atividade"] // 10000 for x in inside)
    months = Counter()
    for r in metrics.openings_by_month(df).collect():
        months[r.ano_abertura] += r.total
    sizes = Counter()
    for r in metrics.openings_by_year_and_size(df).collect():
        sizes[r.ano_abertura] += r.total
    assert months == sizes == years
    means = {r.ano_abertura: r.media_capital for r in metrics.mean_capital_by_year(df).collect()}
    for year in years:
        own = [x["capital_social"] for x in inside if x["data_inicio_atividade"] // 10000 == year]
        assert means[year] == pytest.approx(statistics.mean(own))


def test_states(df, inside):
    states = metrics.by_state(df)
    got = states.collect()
    assert [(r.uf, r.total) for r in got] == sorted(
        Counter(x["uf"] for x in inside).items(), key=lambda kv: (-kv[1], kv[0] or "")
    )
    for r in got:
        assert r.pct_ativos == pytest.approx(r.ativos / r.total * 100, abs=0.051)
    shares = metrics.state_shares(states).collect()
    assert sum(r.pct_total for r in shares) == pytest.approx(100)
    leader = metrics.state_leader(states).first()
    assert (leader.uf, leader.total, leader.n_ufs) == (got[0].uf, got[0].total, 4)
    assert leader.pct == pytest.approx(got[0].total / len(inside) * 100)


def test_towns(spark, df, inside):
    towns = spark.createDataFrame([(1, "Um"), (2, "Dois")], "codigo long, descricao string")
    top = metrics.top_towns(df, towns, 4).collect()
    assert [(r.municipio, r.total) for r in top] == ranked(Counter(x["municipio"] for x in inside))[:4]
    assert {r.descricao for r in top} <= {"Um", "Dois", "Não informado"}
    per_state = [(r.uf, r.municipio, r.total) for r in metrics.top_towns_by_state(df, towns, 2).collect()]
    expected = []
    for uf in sorted({x["uf"] for x in inside}, key=lambda u: u or ""):
        counts = Counter(x["municipio"] for x in inside if x["uf"] == uf)
        expected += [(uf, town, n) for town, n in ranked(counts)[:2]]
    assert per_state == sorted(expected, key=lambda t: (t[0] or "", -t[2], t[1] or 0))


def test_activities(df, inside, activities):
    counts = ranked(Counter(x["cnae_fiscal_principal"] for x in inside))
    detail = metrics.top_activities_detail(df, activities, 2)
    assert [(r.cnae_fiscal_principal, r.total) for r in detail.collect()] == counts[:2]
    leader = metrics.activity_leader(detail).first()
    assert leader.pct == pytest.approx(counts[0][1] / (counts[0][1] + counts[1][1]) * 100)
    assert leader.descricao == TEXTS[0][1][:40] + "..."
    top = {k for k, _ in counts[:2]}
    status = {(r.cnae_fiscal_principal, r.situacao_cadastral): r.total for r in metrics.activity_by_status(df, activities, 2).collect()}
    assert status == Counter((x["cnae_fiscal_principal"], x["situacao_cadastral"]) for x in inside if x["cnae_fiscal_principal"] in top)
    divisions = metrics.activity_divisions(df, activities).collect()
    assert {r.divisao_cnae for r in divisions} == {47, 99, 1, None}
    assert [(r.cnae_fiscal_principal, r.total) for r in divisions] == counts
    evolution = metrics.activity_evolution(df, activities, 5).collect()
    assert {len(r.cnae_desc) for r in evolution} <= {30, len("Sem descrição")}
    assert sum(r.total for r in evolution) == sum(n for k, n in counts if k is not None)


def test_plans(spark, tmp_path, rows, activities):
    path = str(tmp_path / "fato")
    fact(spark, rows).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = plan_of(metrics.by_state(stored))
    assert "GreaterThanOrEqual(data_inicio_atividade,20090000), LessThan(data_inicio_atividade,20260000)" in plan
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert sorted(f.split(":")[0] for f in schema[len("struct<") : -1].split(",")) == [
        "capital_social", "data_inicio_atividade", "situacao_cadastral", "uf",
    ]
    for build in (
        metrics.headline_indicators, metrics.status_distribution, metrics.yearly_flow, metrics.monthly_flow,
        metrics.by_state, lambda f: metrics.activity_by_status(f, activities),
        lambda f: metrics.top_towns_by_state(f, activities),
    ):
        text = plan_of(build(stored))
        assert "CartesianProduct" not in text and "NestedLoop" not in text and "EvalPython" not in text
    assert "TakeOrderedAndProject" in plan_of(metrics.top_activities(stored, activities))


@pytest.mark.parametrize("name", ["yearly", "monthly", "status", "evolution", "leader", "shares"])
def test_the_fact_is_read_once(spark, tmp_path, rows, activities, name):
    path = str(tmp_path / "fato")
    fact(spark, rows).write.parquet(path)
    stored = spark.read.parquet(path)
    df = {
        "yearly": lambda: metrics.yearly_flow(stored),
        "monthly": lambda: metrics.monthly_flow(stored),
        "status": lambda: metrics.activity_by_status(stored, activities, 2),
        "evolution": lambda: metrics.activity_evolution(stored, activities, 2),
        "leader": lambda: metrics.state_leader(metrics.by_state(stored)),
        "shares": lambda: metrics.state_shares(metrics.by_state(stored)),
    }[name]()
    assert df.collect()
    final = [tree.split("== Initial Plan ==")[0] for tree in plan_of(df).split("== Final Plan ==")[1:]]
    read = "\n".join(tree.split("\n\n")[0] for tree in final)
    assert read.count("Scan parquet") == 1
    assert read.count("ReusedExchange") >= 1
