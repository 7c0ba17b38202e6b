"""What documents, sheets and merges shuffle, on tables of a few rows."""

from __future__ import annotations

import pytest

from cadastra.operators import skew
from cadastra.plans import documents as D
from cadastra.plans import search, sheet, store
from cadastra.schemas import DOMAIN
from samples import fact, rows_of, table


def rows(ids, name="LOJA", owner="ANA", **more):
    return [
        {
            "cnpj_basico": i, "cnpj_ordem": n, "cnpj_dv": 1, "nome_fantasia": f"{name} {n % 3}", "uf": "SP", "municipio": i % 3,
            "cnae_fiscal_principal": 10 + i, "cnae_fiscal_secundaria": "11,12" if n % 2 else "", "razao_social": f"{owner} {i}",
        } | more
        for i in ids for n in range(4)
    ]


def named(spark, found):
    names = spark.createDataFrame(sorted({(r["cnpj_basico"], r["razao_social"]) for r in found}), "cnpj_basico bigint, razao_social string")
    return fact(spark, found).join(names, "cnpj_basico")


def shuffles(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


def plain(documents):
    return [rows_of(t) for t in documents]


def test_dealt_rows_meet_once_for_both_counts_of_an_establishment(spark):
    found = fact(spark, rows(range(6)) + rows(range(3)) + rows(range(2), bairro="X"))
    parts = D.build_parts(found, tasks=5)
    assert [", 5)" in line for line in shuffles(parts.units)] == [True]
    assert plain(D.whole(parts)) == plain(D.build_documents(found))


def test_merged_establishments_are_dealt_to_the_tasks_given(spark):
    old, new = (D.build_documents(fact(spark, rows(ids))) for ids in (range(4), range(2, 6)))
    merged = D.merged_parts(old, new, 5)
    assert sum(", 5)" in line for line in shuffles(merged.units)) == 1
    assert plain(D.whole(merged)) == plain(D.merge_documents(old, new))


def test_sheets_of_more_rows_than_the_session_has_tasks_for(spark):
    documents = D.build_documents(named(spark, rows(range(6))))
    activities, towns, natures = (
        table(spark, DOMAIN, [{"codigo": c, "descricao": f"D{c}"} for c in codes]) for codes in (range(10, 14), range(2), range(1))
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few, many = (sheet.company_sheets(documents, activities, towns, natures, tasks) for tasks in (None, 7))
        # towns, activities, lists and companies, each side
        assert sum(", 7)" in line for line in shuffles(many)) == 8
        assert rows_of(few) == rows_of(many)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pieces_of_names_are_made_where_a_company_s_names_meet(spark, monkeypatch):
    documents = D.build_documents(named(spark, rows(range(6))))
    postings = search.name_postings(documents)
    assert not [line for line in shuffles(postings) if "gram" in line]
    expected = rows_of(postings)
    assert len(expected) == len(set(expected)) and ("ANA", 1) in expected and (" 2", 5) in expected
    monkeypatch.setattr(search, "hot_keys", lambda df, key: {1: 2})
    assert rows_of(search.name_postings(documents)) == expected
    monkeypatch.setattr(search, "hot_keys", lambda df, key: {})
    monkeypatch.setattr(search, "tasks_for", lambda spark, count: 9)
    assert rows_of(search.name_postings(documents)) == expected


@pytest.mark.parametrize("rows_a_task", [1, 10**6])
def test_a_merge_makes_postings_of_what_is_new_only(spark, tmp_path, monkeypatch, rows_a_task):
    for module in (store, search):
        monkeypatch.setattr(module, "tasks_for", lambda spark, count: skew.tasks_for(spark, count, rows_a_task))
    path = str(tmp_path / "docs")
    store.write_documents(D.build_parts(named(spark, rows(range(6)))), path, buckets=4, indexes=store.INDEXES)
    cut = []
    inner = search._pieces
    monkeypatch.setattr(search, "_pieces", lambda name: cut.append(name) or inner(name))
    update = D.build_documents(named(spark, rows(range(4, 8), "FILIAL", "RUI", cnae_fiscal_principal=99)))
    postings, order = store.INDEXES["names"]
    seen = []
    monkeypatch.setitem(store.INDEXES, "names", (lambda d, known=None: seen.append(d.units.count()) or postings(d, known), order))
    store.merge_into(path, update)
    assert seen == [16] and len(cut) == 1  # the units of the update, not the 40 there are

    held = store.read_documents(spark, path)
    for name, whole in (("names", search.name_postings), ("activity", search.activity_postings)):
        assert rows_of(store.read_index(spark, path, name).drop("bucket")) == rows_of(whole(held))
    # companies 4 and 5 keep the name they had
    assert rows_of(store.read_index(spark, path, "names").where("gram = 'RUI'").select("_id")) == [(6,), (7,)]


