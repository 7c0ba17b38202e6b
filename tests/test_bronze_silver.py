from __future__ import annotations

import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cadastra.operators import quality
from cadastra.plans import documents, pipeline, store
from cadastra.schemas import COMPANIES, DOMAIN, DOMAIN_TABLES, SILVER_TABLES, TAX_REGIME
from cadastra.sources import bronze, dimensions, gold, silver
from cadastra.sources.committed import is_committed
from cadastra.sources.web import harvest_links
from cadastra.streaming.ingest import ingest
from samples import plan_of, rows_of

LINES = [
    '"00000001";"PADARIA SÃO JOÃO";"2135";"50";"1000,00";"01";""',
    '"2";"A;B";"2062";"256";"0,5";"1";""',
    '"3";"DITO ""O BOM""";"65536";"-1";"1,2,3";"abc";""',
    '"4";"BARRA\\";"1";"1";"";"5";"x"',
    "5;curta",
    '6;"longa";1;1;1;1;e;demais;campos',
    '"";"   ";"";" ";"";"";""',
]
BROKEN = '"7";"LINHA\nPARTIDA";"1";"1";"1";"1";""'
EXPECTED = [
    (1, "PADARIA SÃO JOÃO", 2135, 50, "1000,00", 1),
    (2, "A;B", 2062, None, "0,5", 1),
    (3, 'DITO "O BOM"', None, None, "1,2,3", None),
    (4, "BARRA\\", 1, 1, None, 5),
    (5, "curta", None, None, None, None),
    (6, "longa", 1, 1, "1", 1),
    (None, "", None, None, None, None),
]


def put(folder, name, lines, end="\r\n"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes((end.join(lines) + end).encode("latin1"))


def typed(df):
    rows = silver.cast_schema(df, COMPANIES).drop("ente_federativo_responsavel").collect()
    return sorted((tuple(v if v != "" or i == 1 else None for i, v in enumerate(r)) for r in rows), key=repr)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_dialect(spark, tmp_path, end):
    put(tmp_path / "Empresas", "Empresas0", LINES, end)
    put(tmp_path / "Empresas", ".oculto", ["9;x;1;1;1;1;"], end)
    raw = bronze.read_raw(spark, str(tmp_path / "Empresas"), COMPANIES)
    assert typed(raw) == sorted(EXPECTED, key=repr)


@pytest.mark.parametrize("block", [None, 64])
def test_records_may_span_lines_and_blocks(spark, tmp_path, block):
    folder = tmp_path / "dados brutos"
    put(folder, "Empresas 0", LINES, "\n")
    middle = ['8;per"dida;1;1;1;1;', '"9";"UM\n\n""DOIS"";\nTRES";"1";"1";"1";"1";"\n"', "10;NORMAL;1;1;1;1;"]
    put(folder, "Empresas 1", [BROKEN, *LINES[:2], *middle, BROKEN.replace("7", "11")], "\n")
    put(folder, "Empresas 2", ['"12";"NUNCA', "FECHADA;1"], "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if block:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        got = typed(bronze.read_raw(spark, str(folder), COMPANIES))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    one = (1, 1, "1", 1)
    extra = [(7, "LINHA\nPARTIDA", *one), (8, 'per"dida', *one), (9, 'UM\n\n"DOIS";\nTRES', *one), (10, "NORMAL", *one)]
    extra += [(11, "LINHA\nPARTIDA", *one)]
    assert [r for r in got if r[0] != 12] == sorted([*EXPECTED, *EXPECTED[:2], *extra], key=repr)
    assert len(got) == len(EXPECTED) + 2 + len(extra) + 1


def test_list_files_skips_hidden(spark, tmp_path):
    put(tmp_path, "b.csv", ["1;x"])
    put(tmp_path, "a.csv", ["1;x"])
    put(tmp_path, ".c.csv", ["1;x"])
    names = [r.path.rsplit("/", 1)[1] for r in bronze.list_files(spark, str(tmp_path)).collect()]
    assert sorted(names) == ["a.csv", "b.csv"]


def test_parse_lines_agrees_with_files(spark, tmp_path):
    put(tmp_path, "f", LINES, "\n")
    lines = spark.createDataFrame([(line,) for line in LINES], "line string")
    from_file = bronze.read_raw(spark, str(tmp_path), COMPANIES)
    assert typed(bronze.parse_lines(lines, "line", COMPANIES)) == typed(from_file)


def test_file_category(spark):
    names = ["Empresas0.zip", "Simples.zip", "Socios12.ZIP", "2024.K3241.D1", ".zip", "semponto9"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = [r[0] for r in df.orderBy("i").select(bronze.file_category(F.col("n"))).collect()]
    assert got == ["Empresas", "Simples", "Socios", "2024.K", ".zip", "semponto"]


def test_cast_loss_report(spark, tmp_path):
    put(tmp_path, "f", LINES, "\n")
    report = quality.cast_loss_report(bronze.read_raw(spark, str(tmp_path), COMPANIES), COMPANIES)
    assert {r["coluna"]: (r["preenchidos"], r["perdidos"]) for r in report.collect()} == {
        "cnpj_basico": (6, 0),
        "natureza_juridica": (5, 1),
        "qualificacao_responsavel": (5, 2),
        "porte_empresa": (5, 1),
    }


def test_schema_listing(spark):
    listed = quality.schema_listing(spark.createDataFrame([], TAX_REGIME)).collect()
    assert [(r.coluna, r.tipo) for r in listed][:2] == [("cnpj_basico", "bigint"), ("opcao_pelo_simples", "string")]


def bronze_root(tmp_path):
    put(tmp_path / "bronze/Empresas", "e0", ["1;ANA;1;1;10,5;1;", "2;BIA;1;1;;1;"])
    put(tmp_path / "bronze/Estabelecimentos", "s0", ["1;1;10;1;LOJA;2;20200101;0;;;20200101;4781400;;;;;;;;SP;7107;;;;;;;;;"])
    put(tmp_path / "bronze/Simples", "t0", ["1;S;0;0;S;20200101;0", "2;S;0;0;N;0;0"])
    put(tmp_path / "bronze/Socios", "p0", ["1;2;ANA;***;49;20200101;;;;;5"])
    for folder in DOMAIN_TABLES:
        put(tmp_path / "bronze" / folder, "d0", ['"1";"AÇÃO"', '"x";"sem código"', '"7107";"SÃO PAULO"'])
    return str(tmp_path / "bronze")


def test_load_jobs_are_idempotent(spark, tmp_path):
    source, silver_root, gold_root = bronze_root(tmp_path), str(tmp_path / "silver"), str(tmp_path / "gold")
    for _ in range(2):
        pipeline.build_dimensions(spark, source, gold_root)
        pipeline.build_silver(spark, source, silver_root)
    dims = dimensions.load_all(spark, gold_root)
    assert set(dims) == {"naturezas", "qualificacoes", "motivos", "municipios", "paises", "cnaes"}
    assert sorted((r.codigo or 0, r.descricao) for r in dims["cnaes"].collect()) == [
        (0, "sem código"),
        (1, "AÇÃO"),
        (7107, "SÃO PAULO"),
    ]
    tables = pipeline.read_silver(spark, silver_root)
    assert {name: df.count() for name, df in tables.items()} == {
        "empresas": 2,
        "estabelecimentos": 1,
        "simples": 2,
        "socios": 1,
    }
    path = str(tmp_path / "gold/fato")
    assert pipeline.build_gold(spark, silver_root, path, "20250101") is True
    assert pipeline.build_gold(spark, silver_root, path, "20250101") is False
    pipeline.load_documents(spark, silver_root, path, str(tmp_path / "docs"))
    doc = documents.nested(store.read_documents(spark, str(tmp_path / "docs"))).collect()
    assert [(d["_id"], d["razao_social"], d["capital_social"], len(d["socios"])) for d in doc] == [(1, "ANA", 10.5, 1)]


def test_a_load_without_partner_files_goes_on(spark, tmp_path):
    source, silver_root, path = bronze_root(tmp_path), str(tmp_path / "silver"), str(tmp_path / "gold/fato")
    shutil.move(str(tmp_path / "bronze/Socios"), str(tmp_path / "elsewhere"))
    pipeline.build_silver(spark, source, silver_root)
    assert pipeline.build_gold(spark, silver_root, path, "20250101")
    row = gold.read(spark, path).first()
    assert row.cnpj_basico == 1 and row.nome_socio_razao_social is None
    shutil.move(str(tmp_path / "bronze/Simples"), str(tmp_path / "elsewhere2"))
    with pytest.raises(AnalysisException):
        pipeline.build_silver(spark, source, str(tmp_path / "silver2"))


def test_what_a_failed_job_left_is_no_table(spark, tmp_path):
    path = str(tmp_path / "simples")
    good = spark.createDataFrame([(1, "S", 0, 0, "S", 0, 0)], TAX_REGIME)
    for leftover in (lambda: (tmp_path / "simples").mkdir(), lambda: None):
        leftover()
        assert not is_committed(spark, path)
        with pytest.raises(FileNotFoundError):
            pipeline.read_silver(spark, str(tmp_path))
    broken = good.withColumn("opcao_pelo_mei", F.raise_error(F.lit("cut short")).cast("string"))
    with pytest.raises(Exception, match="cut short"):
        silver.write(broken, path)
    assert silver.write(good, path) is True and silver.read(spark, path, TAX_REGIME).count() == 1
    assert silver.write(good, path) is False


def test_stream_joins_broken_lines(spark, tmp_path):
    put(tmp_path / "in", "f0", LINES, "\n")
    put(tmp_path / "in", "f1", [BROKEN], "\n")
    where = [str(tmp_path / n) for n in ("in", "out", "check")]
    ingest(spark, *where, COMPANIES).awaitTermination()
    names = [r.razao_social for r in silver.read(spark, where[1], COMPANIES).collect()]
    assert len(names) == len(LINES) + 1 and "LINHA\nPARTIDA" in names


def test_stream_converts_each_file_once(spark, tmp_path):
    put(tmp_path / "in", "f0", ["1;S;0;0;S;20200101;0", "2;S;0;0;;0;0"])
    where = [str(tmp_path / n) for n in ("in", "out", "check")]

    def run():
        ingest(spark, *where, TAX_REGIME).awaitTermination()
        return silver.read(spark, where[1], TAX_REGIME).count()

    assert run() == 2
    assert run() == 2
    put(tmp_path / "in", "f1", ["3;S;0;0;S;4294967296;0"])
    assert run() == 3
    row = silver.read(spark, where[1], TAX_REGIME).where("cnpj_basico = 3").first()
    assert row.data_opcao_mei is None and row.opcao_pelo_mei == "S"


def test_link_harvest(spark):
    html = (
        '<a href="Empresas0.zip">x</a><A class=q HREF=\'b.ZIP\'>y</A><a href=c.zip>z</a><a name="n">no</a>'
        '<!-- <a href="hidden.zip"> --><a href="leia.txt">t</a><script>"<a href=\'s.zip\'>"</script>'
        '<a href="">e</a><a href="d.zip?x=1&amp;y=.zip">q</a>'
    )
    pages = spark.createDataFrame([(1, html)], "id int, html string")
    found = sorted(r.href for r in harvest_links(pages, "html", ".zip").collect())
    assert found == ["Empresas0.zip", "b.ZIP", "c.zip", "d.zip?x=1&y=.zip"]
    assert harvest_links(pages, "html").count() == 5


def test_link_harvest_of_references_and_quoted_brackets(spark):
    html = (
        '<a title="a > b" href="1.zip">x</a><a data-href="no.zip" hrefs=no.zip href=\'2.zip?a=1&#38;b=&#x32;\'>y</a>'
        '<a title="href=no.zip" href="&lt;3&gt;&quot;&apos;&amp;lt;.zip">z</a><a href="&#x1F4E6;&#233;.zip">u</a>'
        '<a href="&#0;&#xD800;&#9999999;.zip">bad</a><a href="5&nope;&.zip">kept</a><abbr href="no.zip">n</abbr>'
    )
    pages = spark.createDataFrame([(1, html), (2, None), (3, "")], "id int, html string")
    found = [r.href for r in harvest_links(pages, "html").collect()]
    assert sorted(found) == sorted(
        ["1.zip", "2.zip?a=1&b=2", "<3>\"'&lt;.zip", "\U0001f4e6é.zip", "\ufffd" * 3 + ".zip", "5&nope;&.zip"]
    )


def test_all_declared_folders_have_a_schema():
    assert set(SILVER_TABLES) == {"Empresas", "Estabelecimentos", "Simples", "Socios"}
    assert DOMAIN.names == ["codigo", "descricao"]


def test_lines_are_not_shuffled_by_file(spark, tmp_path):
    spark.createDataFrame([('1;"a"',), ('2;"b;c"',)], "value string").coalesce(1).write.text(str(tmp_path / "whole"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = bronze.read_raw(spark, str(tmp_path / "whole"), DOMAIN)
        # one join leaves out the files with broken lines, the others are among the lines of those files
        first = plan_of(df).split("Union", 1)[1].split("BroadcastExchange", 1)[0]
        assert "BroadcastHashJoin" in first and "SortMergeJoin" not in first
        assert rows_of(df) == [("1", "a"), ("2", "b;c")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
