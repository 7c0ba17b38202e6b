from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cadastra.operators.skew import hot_keys
from cadastra.plans import documents as D
from cadastra.plans import search, sheet, store
from cadastra.schemas import FACT
from samples import fact, plan_of, rows_of, table


def sample(seed: int = 3, n: int = 120) -> list[dict]:
    """Company 1 holds a third of the rows; many rows are exact copies."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        company = 1 if i % 3 == 0 else rng.randint(2, 25)
        rows.append(
            {
                "cnpj_basico": company,
                "cnpj_ordem": rng.randint(1, 40),
                "cnpj_dv": rng.choice([1, 2, None]),
                "identificador_matriz_filial": rng.choice([1, 2, None]),
                "nome_fantasia": rng.choice([" Loja Ana ", "NULL", "", None, "Padaria"]),
                "situacao_cadastral": rng.choice([2, 8, 9, None]),
                "data_inicio_atividade": rng.choice([20200101, 20190505, 0, None]),
                "cnae_fiscal_principal": rng.choice([4700000, 111301, None]),
                "cnae_fiscal_secundaria": rng.choice([None, "", "1,2", " 1 , ,2", "1,x", "4700000,3,4,5,6,7"]),
                "uf": rng.choice(["SP", "RJ"]),
                "municipio": rng.choice([1, 9, None]),
                "cep": rng.choice([1310100, 0, None]),
                "numero": rng.choice(["10", None]),
                "complemento": rng.choice(["SALA", "", None]),
                "ddd_1": rng.choice([11, 0, None]),
                "telefone_1": rng.choice(["123", "", None]),
                "natureza_juridica": 2135,
                "porte_empresa": 1,
                "capital_social": company * 1.5,
                "nome_socio_razao_social": rng.choice([None, "NONE", " Ana "]) if company % 2 else None,
                "identificador_socio": 2,
            }
        )
    return rows + rows[: n // 4]


def distinct(rows):
    return {tuple(r.get(c) for c in FACT.names) for r in rows}


def units_per_company(documents):
    return {r["_id"]: r["n"] for r in documents.units.groupBy("_id").agg(F.sum("copies").alias("n")).collect()}


@pytest.fixture(scope="module")
def rows():
    return sample()


@pytest.fixture(scope="module")
def whole(spark, rows):
    return D.build_documents(fact(spark, rows).repartition(3)).each(lambda table: table.cache())


def records(documents):
    return rows_of(D.nested(documents).select("_id", *D.HEADER, "unidades", F.to_json("socios"), F.to_json("estabelecimentos")))


def test_one_header_per_company_and_one_unit_per_distinct_row(whole, rows):
    expected = Counter(r[0] for r in distinct(rows))
    assert units_per_company(whole) == dict(expected)
    assert whole.headers.count() == len(expected)
    assert {r["_id"]: r["unidades"] for r in whole.headers.collect()} == dict(expected)


def test_shape(whole):
    everything = D.nested(whole)
    assert everything.columns == D.DOCUMENT
    doc = everything.where("_id = 1").first()
    assert (doc.razao_social, doc.capital_social, doc.opcao_pelo_mei) == ("", 1.5, "S")
    assert [p.nome_socio_razao_social for p in doc.socios] == ["Ana"] and doc.socios[0].cnpj_cpf_socio == ""
    orders = [(u.cnpj_ordem, u.cnpj_dv or 0) for u in doc.estabelecimentos]
    assert orders == sorted(orders) and len(orders) == doc.unidades
    assert {u.nome_fantasia for u in doc.estabelecimentos} <= {"", "Loja Ana", "Padaria"}
    lists = {tuple(u.cnae_fiscal_secundarias) for d in everything.collect() for u in d.estabelecimentos}
    assert lists == {(), (1, 2), (4700000, 3, 4, 5, 6, 7)}
    assert all(u.identificador_matriz_filial in (1, 2) for u in doc.estabelecimentos)


def test_documents_do_not_depend_on_copies_or_layout(spark, rows, whole):
    again = D.build_documents(fact(spark, rows * 3).repartition(7))
    assert records(again) == records(whole)


def test_headers_may_come_from_the_companies(spark, rows, whole):
    known = sorted({r["cnpj_basico"] for r in rows})
    companies = spark.createDataFrame(
        [(c, 2135, 1, 1, c * 1.5, f" NOME {c} ") for c in known + [999]],
        "cnpj_basico long, natureza_juridica int, qualificacao_responsavel smallint, porte_empresa smallint, "
        "capital_social double, razao_social string",
    )
    documents = D.build_documents(fact(spark, rows), companies)
    assert rows_of(documents.headers.select("_id", "razao_social")) == sorted([(c, f"NOME {c}") for c in known], key=repr)
    assert rows_of(documents.headers.drop("razao_social")) == rows_of(whole.headers.drop("razao_social"))


def test_company_name_comes_with_the_fact(spark, rows):
    named = fact(spark, rows).withColumn("razao_social", F.lit(" null "))
    assert rows_of(D.build_documents(named).headers.select("razao_social").distinct()) == [("",)]
    named = fact(spark, rows).withColumn("razao_social", F.lit(" ANA ME "))
    assert rows_of(D.build_documents(named).headers.select("razao_social").distinct()) == [("ANA ME",)]


def test_merge(spark, rows):
    half = len(rows) // 2
    old, new = (D.build_documents(fact(spark, part)) for part in (rows[:half], rows[half:]))
    merged = D.merge_documents(old, new)
    expected = defaultdict(Counter)
    for side in (old, new):
        own = defaultdict(Counter)
        for unit in side.units.collect():
            own[unit["_id"]][str(unit["unidade"])] += unit["copies"]
        for company, counts in own.items():
            expected[company] |= counts
    got = defaultdict(Counter)
    for unit in merged.units.collect():
        got[unit["_id"]][str(unit["unidade"])] += unit["copies"]
    assert got == expected
    assert records(D.merge_documents(merged, new)) == records(merged)
    assert {r["_id"]: r["unidades"] for r in merged.headers.collect()} == {c: v.total() for c, v in expected.items()}
    assert search.by_company(merged, 1).partners.count() == 1


def test_merge_keeps_the_old_header(spark):
    old = fact(spark, [{"cnpj_basico": 1, "cnpj_ordem": 1, "capital_social": 9.0}])
    new = fact(spark, [{"cnpj_basico": 1, "cnpj_ordem": 2, "capital_social": 1.0}, {"cnpj_basico": 2, "cnpj_ordem": 1}])
    merged = D.merge_documents(D.build_documents(old), D.build_documents(new))
    assert rows_of(merged.headers.select("_id", "capital_social", "unidades")) == [(1, 9.0, 2), (2, 0.0, 1)]


def test_stored_documents(spark, tmp_path, rows, whole):
    path, half = str(tmp_path / "docs"), len(rows) // 2
    store.write_documents(D.build_documents(fact(spark, rows[:half])), path, buckets=4)
    one = fact(spark, [{"cnpj_basico": 77, "cnpj_ordem": 1}])
    assert len(store.merge_into(path, D.build_documents(one))) == 1
    assert store.documents_by_id(spark, path, 77).headers.count() == 1
    assert store.documents_by_id(spark, path, 78).headers.count() == 0
    before = records(store.read_documents(spark, path))
    store.merge_into(path, D.build_documents(one))
    assert records(store.read_documents(spark, path)) == before
    store.write_documents(whole, path, buckets=8)
    assert store.stored_buckets(spark, path) == 8
    assert records(store.read_documents(spark, path)) == records(whole)
    found = store.documents_by_id(spark, path, 1)
    assert records(found) == records(search.by_company(whole, 1))
    assert {f.split("/bucket=")[1].split("/")[0] for f in found.units.inputFiles()} == {
        str(spark.sql("SELECT pmod(xxhash64(1L), 8)").first()[0])
    }
    with pytest.raises(FileNotFoundError):
        store.read_documents(spark, str(tmp_path / "absent"))


def test_searches_return_whole_companies(whole):
    for found in (
        search.by_secondary_activity(whole, 7),
        search.by_state_and_activity(whole, "SP", 111301, limit=3),
        search.by_state_and_activity(whole, "RJ", limit=2),
    ):
        ids = [r["_id"] for r in found.headers.collect()]
        assert ids and records(found) == records(whole.each(lambda t: t.where(F.col("_id").isin(ids))))


def test_state_and_activity_may_match_different_units(spark):
    units = [
        {"cnpj_basico": 1, "cnpj_ordem": 1, "uf": "SP", "cnae_fiscal_principal": 5},
        {"cnpj_basico": 1, "cnpj_ordem": 2, "uf": "RJ", "cnae_fiscal_principal": 6},
        {"cnpj_basico": 2, "cnpj_ordem": 1, "uf": "SP", "cnae_fiscal_principal": 6},
        {"cnpj_basico": 3, "cnpj_ordem": 1, "uf": None, "cnae_fiscal_principal": None},
    ]
    docs = D.build_documents(fact(spark, units))
    assert rows_of(search.by_state_and_activity(docs, "sp", 6).headers.select("_id")) == [(1,), (2,)]
    assert rows_of(search.by_state_and_activity(docs, "sp", 6, same_unit=True).headers.select("_id")) == [(2,)]
    assert rows_of(search.by_state_and_activity(docs, "sp", limit=1).headers.select("_id")) == [(1,)]
    assert search.by_state_and_activity(docs, "xx").headers.count() == 0


def test_activity_index_table(spark, tmp_path, whole):
    path, stored = str(tmp_path / "index"), str(tmp_path / "docs")
    store.write_documents(whole, stored, buckets=4)
    for documents in (whole, store.read_documents(spark, stored)):
        search.write_activity_index(documents, path)
        index = spark.read.parquet(path)
        assert ("bucket" in index.columns) == (documents is not whole)
        found = search.by_index(documents, index, 111301, "rj").headers.select("_id")
        assert rows_of(found) == rows_of(
            search.by_state_and_activity(whole, "RJ", 111301, limit=None, same_unit=True).headers.select("_id")
        )
        assert records(search.by_index(documents, index, 7)) == records(search.by_secondary_activity(whole, 7))


@pytest.mark.parametrize("sliced", [False, True])
def test_bulk_lookup(spark, whole, sliced):
    texts = [" 1 ", "1", "999", "abc", "", None] + ["1"] * 20
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, pedido string").repartition(4)
    hot = hot_keys(asked.selectExpr("try_cast(trim(pedido) as bigint) k"), "k", 5) if sliced else None
    found = search.look_up(asked, "pedido", whole, hot)
    status = {r.n: r.status for r in found.collect()}
    assert [status[i] for i in range(6)] == ["encontrado", "encontrado", "ausente", "invalido", "invalido", "invalido"]
    assert found.count() == len(texts)
    assert {r.n: (r.capital_social, r.unidades) for r in found.collect()}[1] == (1.5, units_per_company(whole)[1])
    assert records(search.requested_documents(asked, "pedido", whole)) == records(search.by_company(whole, 1))


def test_sheets_name_all_partners_on_every_unit(spark):
    unit = {"cnpj_basico": 5, "cnpj_ordem": 1, "identificador_socio": 2}
    rows = [{**unit, "cnpj_ordem": n % 4, "nome_socio_razao_social": f"SOCIO {n % 3}"} for n in range(12)]
    none = spark.createDataFrame([], "codigo long, descricao string")
    sheets = sheet.company_sheets(D.build_documents(fact(spark, rows)), none, none, none).collect()
    assert len(sheets) == 12 and {s.n_estabelecimentos for s in sheets} == {12}
    assert {s.socios for s in sheets} == {"; ".join(f"SOCIO {n} (Pessoa Física)" for n in range(3))}


def test_sheet(spark):
    unit = {
        "cnpj_basico": 1234567, "cnpj_ordem": 1, "cnpj_dv": 9, "identificador_matriz_filial": 1,
        "nome_fantasia": " Loja ", "situacao_cadastral": 2, "data_inicio_atividade": 20100512,
        "cnae_fiscal_principal": 10, "cnae_fiscal_secundaria": "20,10,30,10,20,40", "tipo_logradouro": "RUA",
        "logradouro": "DAS FLORES", "numero": "7", "complemento": "SALA 1", "bairro": "CENTRO", "cep": 1310100,
        "uf": "SP", "municipio": 5, "ddd_1": 11, "telefone_1": "999", "ddd_2": 21, "telefone_2": "888",
        "correio_eletronico": "a@b.c", "natureza_juridica": 2135, "porte_empresa": 1, "capital_social": 1234.5,
        "nome_socio_razao_social": "ANA", "identificador_socio": 2,
    }
    bare = {"cnpj_basico": 2, "cnpj_ordem": 3, "identificador_matriz_filial": 7, "porte_empresa": 9, "municipio": 6}
    docs = D.build_documents(fact(spark, [unit, bare]))
    dims = {
        "activities": [(10, "Padaria"), (20, "Bar")], "towns": [(5, "SÃO PAULO")], "natures": [(2135, "EMPRESÁRIO")],
    }
    tables = {k: spark.createDataFrame(v, "codigo long, descricao string") for k, v in dims.items()}
    first, second = (r.asDict() for r in sheet.company_sheets(docs, **tables).orderBy(F.desc("_id")).collect())
    assert first == {
        "_id": 1234567, "razao_social": "Sem nome (Razão Social não cadastrada)",
        "cnpj_basico": "01234567", "capital_social": "R$ 1.234,50", "natureza": "EMPRESÁRIO",
        "porte": "Micro Empresa", "simples": "S", "mei": "S", "socios": "ANA (Pessoa Física)",
        "n_estabelecimentos": 1, "tipo": "Matriz", "cnpj": "01.234.567/0001-09", "situacao": "Ativa",
        "nome_fantasia": "Loja", "cnae_principal": "Padaria", "abertura": "12/05/2010",
        "endereco": "RUA DAS FLORES, 7 - SALA 1 — CENTRO — SÃO PAULO/SP — CEP 01310-100",
        "telefones": "(11) 999 | (21) 888", "email": "a@b.c",
        "cnaes_secundarios": "Bar • Padaria • Código 30 • Padaria • Bar",
    }
    assert second["natureza"] == "Não informado" and second["porte"] == "Não informado"
    assert (second["tipo"], second["cnpj"], second["situacao"]) == ("—", "00000002", "Desconhecido")
    assert second["endereco"] == ", S/N  —  — Código 6/ — CEP —-"
    assert (second["telefones"], second["email"], second["abertura"]) == ("—", "—", "—")
    assert (second["socios"], second["cnaes_secundarios"], second["nome_fantasia"]) == ("", "", "Sem nome fantasia")


def test_samples_helper_follows_the_schema(spark):
    assert table(spark, FACT, [{}]).schema == FACT


def test_establishments_without_secondary_activities_do_not_meet(spark):
    from cadastra.plans.sheet import with_secondary_texts

    rows = [(i, {"cnae_fiscal_secundarias": [7] if i % 50 == 0 else [], "cnpj_ordem": i}) for i in range(400)]
    kind = "_id bigint, u struct<cnae_fiscal_secundarias: array<bigint>, cnpj_ordem: int>"
    activities = spark.createDataFrame([(7, "Sete")], "codigo bigint, descricao string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        found = with_secondary_texts(spark.createDataFrame(rows, kind), activities).withColumn("task", F.spark_partition_id())
        got = found.collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sorted((r["_id"], r["cnaes_secundarios"]) for r in got) == [(i, "Sete" if i % 50 == 0 else "") for i in range(400)]
    tasks = [r["task"] for r in got if r["cnaes_secundarios"] == ""]
    assert max(tasks.count(t) for t in set(tasks)) < 250


def test_companies_that_are_not_asked_for_go_below_the_aggregations(spark):
    rows = [{"cnpj_basico": n, "cnpj_ordem": n % 3} for n in range(1, 400)]
    documents = D.build_documents(fact(spark, rows))
    requests = spark.createDataFrame([(" 7 ",), ("7",), ("x",), (None,), ("395",), ("9999",)], "pedido string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = search.requested_documents(requests, "pedido", documents)
        assert [sorted(r["_id"] for r in table.collect()) for table in found] == [[7, 395], [], [7, 395]]
        plan = found.units._jdf.queryExecution().optimizedPlan().toString().splitlines()
        flags = next(i for i, line in enumerate(plan) if "Join LeftSemi" in line and "_flags" in line)
        assert any("Aggregate" in line for line in plan[:flags])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
