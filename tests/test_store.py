"""Stored documents: isolation, streams, postings; marked snapshots, quarantine, clustering, sketches."""

from __future__ import annotations

import glob
import os
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cadastra.functions.dates import Period
from cadastra.operators import clustering
from cadastra.plans import documents as D
from cadastra.plans import search, sketches, store
from cadastra.schemas import COMPANIES, FACT
from cadastra.session import shared_dir
from cadastra.sources import bronze, gold, silver
from cadastra.streaming.upsert import upsert_documents
from samples import plan_of
from tests.test_documents import fact, records, rows_of


def company(n, **values):
    return {"cnpj_basico": n, "cnpj_ordem": 1, "cnpj_dv": 0, "uf": "SP", "cnae_fiscal_principal": 5, **values}


def files_under(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/**/part-*", recursive=True)}


def test_readers_keep_their_generation(spark, tmp_path):
    path = str(tmp_path / "docs")
    store.write_documents(D.build_parts(fact(spark, [company(n) for n in range(20)])), path, buckets=4)
    before = store.read_documents(spark, path)
    files = files_under(path)
    touched = store.merge_into(path, D.build_documents(fact(spark, [company(3, cnpj_ordem=2), company(77)])))
    assert len(touched) <= 2
    assert files.items() <= files_under(path).items()
    assert before.headers.count() == 20 and before.units.count() == 20
    after = store.read_documents(spark, path)
    assert after.headers.count() == 21 and after.units.count() == 22
    assert rows_of(after.headers.where("_id = 3").select("unidades")) == [(2,)]
    assert records(store.read_documents(spark, path, generation=0)) == records(before)
    assert store.generations(spark, path) == [0, 1]
    with pytest.raises(FileNotFoundError):
        store.read_documents(spark, path, generation=9)


def test_a_merge_that_is_cut_short_leaves_no_trace(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "docs")
    store.write_documents(D.build_parts(fact(spark, [company(n) for n in range(10)])), path, buckets=4)
    before = records(store.read_documents(spark, path))

    def cut(*_):
        raise RuntimeError("cut")

    update = D.build_documents(fact(spark, [company(3, cnpj_ordem=2), company(78)]))
    with monkeypatch.context() as patched:
        patched.setattr(store, "_publish", cut)
        with pytest.raises(RuntimeError):
            store.merge_into(path, update)
    assert records(store.read_documents(spark, path)) == before and store.generations(spark, path) == [0]
    store.merge_into(path, update)
    assert store.read_documents(spark, path).headers.count() == 11


def test_expired_generations_go(spark, tmp_path):
    path = str(tmp_path / "docs")
    store.write_documents(D.build_parts(fact(spark, [company(n) for n in range(10)])), path, buckets=2, indexes=["activity"])
    for n in (50, 51, 52):
        store.merge_into(path, D.build_documents(fact(spark, [company(n)])))
    kept, files = records(store.read_documents(spark, path)), len(files_under(path))
    assert store.expire(spark, path) == [0, 1, 2] and store.generations(spark, path) == [3]
    assert records(store.read_documents(spark, path)) == kept and len(files_under(path)) < files
    assert store.expire(spark, path) == []


def test_stream_batches_count_once(spark, tmp_path):
    path, source = str(tmp_path / "docs"), str(tmp_path / "fato")
    store.write_documents(D.build_parts(fact(spark, [])), path, buckets=4)
    for n in range(3):
        fact(spark, [company(n), company(n, cnpj_ordem=2)]).coalesce(1).write.mode("append").parquet(source)
    for run in range(2):  # the second run has lost its checkpoint
        upsert_documents(spark, source, path, str(tmp_path / f"check-{run}"), FACT, files_per_batch=1).awaitTermination()
    assert store.manifest(spark, path).streams == {"fato": 2} and len(store.generations(spark, path)) == 4
    whole = D.build_documents(fact(spark, [company(n, cnpj_ordem=o) for n in range(3) for o in (1, 2)]))
    assert records(store.read_documents(spark, path)) == records(whole)
    assert store.merge_into(path, whole, "fato", 2) == []
    assert store.merge_into(path, whole.each(lambda t: t.limit(0)), "fato", 3) == []
    assert store.manifest(spark, path).streams == {"fato": 3}


NAMES = ["Padaria Ümlaut Ltda", "PADARIA DO ZÉ", "ab", "a", "", None, "Zé e Irmãos", "LTDA", "Padar ia"]


@pytest.mark.parametrize("text", ["padaria", "PADARIA", "zé", "a", "b", "ltd", "ária", "ümlaut", "", "x", "padar", " ", "padariaz"])
def test_name_postings_find_what_the_scan_finds(spark, tmp_path_factory, text):
    path = str(tmp_path_factory.getbasetemp() / "named")
    if not os.path.isdir(path):
        early = [company(n, nome_fantasia=name) for n, name in enumerate(NAMES)]
        store.write_documents(D.build_parts(fact(spark, early[:5])), path, buckets=4, indexes=store.INDEXES)
        store.merge_into(path, D.build_documents(fact(spark, early[5:] + [company(0, cnpj_ordem=3, nome_fantasia="Outra padaria")])))
    documents, postings = store.read_documents(spark, path), store.read_index(spark, path, "names")
    found = search.name_search_indexed(documents, postings, text)
    assert rows_of(found) == rows_of(search.name_search(documents, text))


def test_postings_of_untouched_buckets_stay(spark, tmp_path):
    path = str(tmp_path / "docs")
    first = [company(n, cnae_fiscal_principal=n % 3) for n in range(30)]
    store.write_documents(D.build_parts(fact(spark, first)), path, buckets=8, indexes=["activity"])
    old = store.manifest(spark, path).live["activity"]
    update = [company(4, cnpj_ordem=2, cnae_fiscal_principal=9)]
    touched = store.merge_into(path, D.build_documents(fact(spark, update)))
    new = store.manifest(spark, path).live["activity"]
    assert len(touched) == 1 and {b for b in new if new[b] != old.get(b)} == set(touched)
    rebuilt = search.activity_postings(D.build_documents(fact(spark, first + update)))
    kept = store.read_index(spark, path, "activity").drop("bucket")
    assert rows_of(kept.select(rebuilt.columns)) == rows_of(rebuilt)
    plan = store.read_index(spark, path, "activity").where("cnae = 9")._jdf.queryExecution().toString()
    assert "EqualTo(cnae,9)" in plan


def test_bulk_lookup_reads_the_buckets_asked_for(spark, tmp_path):
    path = str(tmp_path / "docs")
    store.write_documents(D.build_parts(fact(spark, [company(n) for n in range(64)])), path, buckets=16)
    documents = store.read_documents(spark, path)
    requests = spark.createDataFrame([(" 7 ",), ("8",), ("999",), ("x",), (None,), ("7",)], "pedido string")
    found = search.look_up_stored(requests, "pedido", documents, 16)
    assert rows_of(found.select("pedido", "_id", "status")) == rows_of(
        search.look_up(requests, "pedido", documents).select("pedido", "_id", "status")
    )
    assert "dynamicpruning" in found._jdf.queryExecution().toString()
    read = found._jdf.queryExecution().executedPlan()
    assert found.count() == 6 and read is not None


def test_half_a_snapshot_does_not_count(spark, tmp_path):
    path = str(tmp_path / "fato")
    rows = fact(spark, [company(n) for n in range(6)])
    rows.limit(2).write.parquet(f"{path}/snapshot=20250101/load=cut")
    with pytest.raises(FileNotFoundError):
        gold.read(spark, path)
    assert gold.write_snapshot(rows, path, "20250101") and not gold.write_snapshot(rows, path, "20250101")
    before = gold.read(spark, path)
    assert before.count() == 6 and gold.snapshots(spark, path) == ["20250101"]
    assert gold.write_snapshot(rows.limit(1), path, "20250101", overwrite=True)
    assert gold.write_snapshot(rows, path, "a b/c")
    assert (before.count(), gold.read(spark, path, "20250101").count(), gold.read(spark, path, gold.ALL).count()) == (6, 1, 7)
    assert gold.read(spark, path).select("snapshot").distinct().first()[0] == "a b/c"
    assert gold.read(spark, path, "none").count() == 0


def test_quarantine_holds_what_does_not_fit(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    good = ['1;"A; ""b""";1;2;"3,0";4;x', '2;"line\nbreak";1;2;3;4;', '3;in "quotes;1;2;3;4;y']
    bad = ["4;short", '5;"a;b";1;2;3;4;5;6', "", '6;"open']
    (source / "a.csv").write_bytes("\n".join(good + bad).encode("latin1"))
    silver.write_judged(bronze.read_judged(spark, str(source), COMPANIES), target, COMPANIES)
    assert [r[0] for r in sorted(silver.read(spark, target, COMPANIES).select("cnpj_basico").collect())] == [1, 2, 3]
    found = sorted((r.reason, r.line) for r in silver.quarantined(spark, target).collect())
    assert found == [("empty", ""), ("long", bad[1]), ("short", bad[0]), ("unclosed", bad[3])]
    assert not silver.write_judged(bronze.read_judged(spark, str(source), COMPANIES), target, COMPANIES)


def test_clustering_makes_filters_leave_files_unread(spark, tmp_path):
    states = ["AC", "BA", "MG", "RJ", "SP", None]
    rows = [
        company(n, uf=states[n * 7 % 6], cnae_fiscal_principal=n * 13 % 50, data_inicio_atividade=20150101 + n * 31 % 9 * 10_000)
        for n in range(3000)
    ]
    table, counts = fact(spark, rows), {}
    for cluster in (False, True):
        path = str(tmp_path / f"fato-{cluster}")
        gold.write_snapshot(table if cluster else table.repartition(48), path, "1", cluster=cluster, files=48)
        assert gold.read(spark, path).count() == 3000
        met = {"uf": 0, "cnae_fiscal_principal": 0, "data_inicio_atividade": 0}
        wanted = {"uf": "MG", "cnae_fiscal_principal": 25, "data_inicio_atividade": 20190101}
        for file in glob.glob(f"{path}/snapshot=1/*/part-*"):
            group = pq.ParquetFile(file).metadata.row_group(0)
            for i in range(group.num_columns):
                name, stats = group.column(i).path_in_schema, group.column(i).statistics
                if name in met and stats.has_min_max and stats.min <= wanted[name] <= stats.max:
                    met[name] += 1
        counts[cluster] = met
    assert all(counts[True][name] <= 0.75 * counts[False][name] for name in met), counts
    assert sum(counts[True].values()) <= 0.5 * sum(counts[False].values()), counts


def test_cuts_of_empty_and_constant_columns(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x")], "n int, s string")
    assert clustering.clustered(df, ["n", "s"], "n", 2).count() == 2
    assert clustering.clustered(df.limit(0), ["n", "s"], "n").count() == 0


def test_sketches_against_exact_forms(spark, tmp_path):
    rows = [company(n // 2, cnpj_ordem=n % 2, capital_social=float(n * n % 5000), uf="SP" if n % 3 else None,
                    data_inicio_atividade=20150101 + n % 4 * 10_000, situacao_cadastral=2 if n % 5 else 8) for n in range(4000)]
    table, path = fact(spark, rows), str(tmp_path / "resumo")
    assert sketches.write_sketches(table, path, "1") and not sketches.write_sketches(table, path, "1")
    found = sketches.indicators(sketches.read_sketches(spark, path, "1"), years=Period(2016, 2017)).first()
    chosen = sorted(r["capital_social"] for r in rows if 20160000 < r["data_inicio_atividade"] < 20180000)
    companies = len({r["cnpj_basico"] for r in rows if 20160000 < r["data_inicio_atividade"] < 20180000})
    assert found.total == len(chosen) and abs(found.empresas - companies) <= sketches.COUNT_ERROR * companies
    rank = sum(c <= found.mediana_capital for c in chosen) / len(chosen)
    assert abs(rank - 0.5) <= sketches.RANK_ERROR and abs(found.media_capital - sum(chosen) / len(chosen)) < 1e-6
    per_state = sketches.indicators(sketches.read_sketches(spark, path, "1"), ["uf"])
    assert {r.uf: r.total for r in per_state.collect()} == {"SP": sum(r["uf"] == "SP" for r in rows), None: sum(r["uf"] is None for r in rows)}
    none = sketches.indicators(sketches.read_sketches(spark, path, "1"), years=Period(1900, 1901)).first()
    assert (none.total, none.mediana_capital) == (0, None)
    with pytest.raises(FileNotFoundError):
        sketches.read_sketches(spark, path, "2")


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path, monkeypatch):
    from cadastra.operators import skew
    from cadastra.plans import pipeline
    from cadastra.schemas import ESTABLISHMENTS, PARTNERS, TAX_REGIME
    from tests.samples import table as sample

    root = str(tmp_path / "silver")
    rows = {
        "simples": (TAX_REGIME, [{"cnpj_basico": n, "opcao_pelo_mei": "S" if n % 2 else "N"} for n in range(40)]),
        "empresas": (COMPANIES, [{"cnpj_basico": n, "capital_social": "1,0"} for n in range(40)]),
        "estabelecimentos": (ESTABLISHMENTS, [{"cnpj_basico": n % 40 if n < 200 else 7, "cnpj_ordem": n} for n in range(400)]),
        "socios": (PARTNERS, [{"cnpj_basico": n % 20, "qualificacao_socio": n} for n in range(60)]),
    }
    for name, (schema, values) in rows.items():
        silver.write(sample(spark, schema, values), f"{root}/{name}")
    monkeypatch.setattr(pipeline, "hot_keys", lambda df, key: skew.hot_keys(df, key, 100))
    hot = pipeline.bucket_silver(spark, root, str(tmp_path / "buckets"), "t_bucketed", 4)
    assert list(hot) == [7] and hot[7] > 1
    fact_rows = pipeline.fact_from_buckets(spark, str(tmp_path / "buckets"), "t_bucketed")
    expected = pipeline.fact_from_silver(pipeline.read_silver(spark, root))
    assert rows_of(fact_rows) == rows_of(expected)
    # the same files, named anew
    again = pipeline.fact_from_buckets(spark, str(tmp_path / "buckets"), "t_again")
    assert again.count() == fact_rows.count()
    monkeypatch.setattr(pipeline, "hot_keys", lambda df, key: {})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "false")
    try:
        pipeline.bucket_silver(spark, root, str(tmp_path / "cold"), "t_cold", 4)
        cold = pipeline.fact_from_buckets(spark, str(tmp_path / "cold"), "t_cold")
        plan = cold._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows_of(cold) == rows_of(expected)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
        spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")


def test_filters_are_as_large_as_their_keys(spark, tmp_path):
    path = tmp_path / "docs"
    store.write_documents(D.build_documents(fact(spark, [{"cnpj_basico": k, "cnpj_ordem": 1} for k in range(20)])), str(path), buckets=4)
    files = list(path.glob("units/*/*/*.parquet"))
    # a filter of a fixed size takes a megabyte
    assert files and max(f.stat().st_size for f in files) < 200_000


def test_a_merge_counts_nothing_it_does_not_store_and_leaves_nothing_behind(spark, tmp_path):
    new = D.build_documents(fact(spark, [{"cnpj_basico": 1, "cnpj_ordem": o} for o in (1, 2, 2)]))
    parts = D.parts_of(new)
    assert "copies" not in plan_of(parts.heads) and "copies" in plan_of(new.headers)
    path = str(tmp_path / "docs")
    store.write_documents(D.build_parts(fact(spark, [{"cnpj_basico": 1, "cnpj_ordem": 1}])), path, buckets=2)
    store.merge_into(path, new)
    store.merge_into(path, parts)
    assert rows_of(store.read_documents(spark, path).headers.select("_id", "unidades")) == [(1, 2)]
    assert not list(Path(shared_dir(spark).removeprefix("file:")).glob(f"cadastra-*/{store.INCOMING}"))
