"""Every registered query: the library applied to the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadastra.functions import formats
from cadastra.functions.cleansing import ellipsize, integer_list
from cadastra.functions.dates import Period, to_ymd
from cadastra.operators import lookup, quality, ranking, reshape
from cadastra.operators.filters import apply_filters, codes_of
from cadastra.operators.skew import hot_keys
from cadastra.plans import documents as docs
from cadastra.plans import fact as facts
from cadastra.plans import metrics, pipeline, search, sheet, sketches, store
from cadastra.schemas import COMPANIES, DOMAIN_TABLES, SIZE_LABELS, STATUS_LABELS
from cadastra.session import release, shared_dir
from cadastra.sources import bronze, dimensions, gold, silver, web
from cadastra.streaming.ingest import ingest
from cadastra.streaming.upsert import upsert_documents
from checks.tables import Registry, registry

# The test tables hold orders of 1995 to 2001, so both bounds of this window bite.
WINDOW = Period(1996, 2000)
CLOSINGS = Period(1996, 2001)
ACTIVITY, STATE = 25_000, "NATION_9"

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def query(build: Callable[[Registry], DataFrame]) -> Callable[[Registry], DataFrame]:
    _queries[build.__name__] = lambda spark, folder: build(registry(spark, folder))
    return build


def queries() -> dict[str, Query]:
    return dict(_queries)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


def scratch(spark: SparkSession) -> str:
    """A new folder below the one all executors share."""
    return f"{shared_dir(spark)}/cadastra-{uuid.uuid4().hex}"


# Load stages


@query
def mei_keys(r: Registry) -> DataFrame:
    return facts.opted_in_keys(r.tax_regime)


@query
def semi_companies(r: Registry) -> DataFrame:
    return facts.opted_in_companies(r.companies, facts.opted_in_keys(r.tax_regime))


@query
def semi_partners(r: Registry) -> DataFrame:
    return facts.opted_in_partners(r.partners, facts.opted_in_keys(r.tax_regime))


@query
def semi_establishments(r: Registry) -> DataFrame:
    return facts.opted_in_establishments(r.establishments, facts.opted_in_keys(r.tax_regime), r.hot["establishments"])


@query
def inner_establishments_companies(r: Registry) -> DataFrame:
    companies = facts.opted_in_companies(r.companies, facts.opted_in_keys(r.tax_regime))
    return facts.of_companies(r.establishments, companies, r.hot["establishments"], r.hot["companies"]).select(
        facts.KEY, "cnpj_ordem", "cnpj_dv", "natureza_juridica", "porte_empresa", "capital_social"
    )


@query
def left_partners(r: Registry) -> DataFrame:
    companies = facts.opted_in_companies(r.companies, facts.opted_in_keys(r.tax_regime))
    return facts.with_partners(companies, r.partners, r.hot["partners"], r.hot["companies"]).select(
        facts.KEY, "porte_empresa", "identificador_socio", "nome_socio_razao_social"
    )


@query
def fact_gold(r: Registry) -> DataFrame:
    return r.fact


@query
def stage_counts(r: Registry) -> DataFrame:
    keys = facts.opted_in_keys(r.tax_regime)
    return quality.stage_counts(
        {
            "mei": keys,
            "empresas": facts.opted_in_companies(r.companies, keys),
            "socios": facts.opted_in_partners(r.partners, keys),
            "fato": r.fact,
        }
    )


@query
def fanout_report(r: Registry) -> DataFrame:
    return quality.fanout_report(r.partners, facts.KEY)


@query
def distinct_rows(r: Registry) -> DataFrame:
    return r.fact.unionAll(r.fact).dropDuplicates()


def raw_lines(r: Registry) -> DataFrame:
    """Customers as lines of a company file, with the irregularities such files have."""
    nation = F.col("c_nationkey")
    amount = F.replace(F.col("c_acctbal").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    fields = [
        F.concat(F.lit('"'), F.lpad(F.col("c_custkey").cast("string"), 8, "0"), F.lit(' "')),
        F.concat(F.lit('"  '), F.col("c_name"), F.lit('; ""x"" \\"')),
        F.when(nation == 5, "").when(nation == 6, "65535").when(nation == 7, "65536").otherwise(nation.cast("string")),
        (nation + 235).cast("string"),
        F.concat(F.lit('"'), amount, F.lit('"')),
        F.when(nation < 10, "abc").when(nation < 15, "-1").otherwise("\t05 "),
    ]
    tail = F.when(nation % 2 == 0, "").otherwise(";;more;fields")
    return r.table("customer").select(F.concat(F.concat_ws(";", *fields), tail).alias("line"))


@query
def csv_typed_cast(r: Registry) -> DataFrame:
    return silver.cast_schema(bronze.parse_lines(raw_lines(r), "line", COMPANIES), COMPANIES)


@query
def csv_file_read(r: Registry) -> DataFrame:
    folder = scratch(r.spark)
    raw_lines(r).write.text(f"{folder}/Empresas")
    raw = bronze.read_raw(r.spark, f"{folder}/Empresas", COMPANIES)
    silver.write(silver.cast_schema(raw, COMPANIES), f"{folder}/empresas")
    return silver.read(r.spark, f"{folder}/empresas", COMPANIES)


@query
def stream_ingest(r: Registry) -> DataFrame:
    folder = scratch(r.spark)
    raw_lines(r).write.text(f"{folder}/Empresas")
    for _ in range(2):  # the second run finds nothing new
        ingest(
            r.spark, f"{folder}/Empresas", f"{folder}/empresas", f"{folder}/checkpoint", COMPANIES
        ).awaitTermination()
    return silver.read(r.spark, f"{folder}/empresas", COMPANIES)


def _broken_files(r: Registry) -> str:
    """Company files in which the names of some companies hold a line break."""
    folder = scratch(r.spark)
    name = F.concat(F.lit("Customer#"), F.lit("\n"))
    line = F.when(F.col("line").contains('1; ""x""'), F.replace("line", F.lit("Customer#"), name)).otherwise(F.col("line"))
    raw_lines(r).select(line.alias("line")).write.text(f"{folder}/Empresas")
    return folder


@query
def csv_line_breaks(r: Registry) -> DataFrame:
    raw = bronze.read_raw(r.spark, f"{_broken_files(r)}/Empresas", COMPANIES)
    return silver.cast_schema(raw, COMPANIES)


@query
def stream_line_breaks(r: Registry) -> DataFrame:
    folder = _broken_files(r)
    ingest(r.spark, f"{folder}/Empresas", f"{folder}/empresas", f"{folder}/checkpoint", COMPANIES).awaitTermination()
    return silver.read(r.spark, f"{folder}/empresas", COMPANIES)


#: Records of one raw file at most: a compressed file is read by one task.
RAW_RECORDS = 500_000


def _raw_file(df: DataFrame, path: str) -> None:
    """A table as the registry publishes it, compressed, as plain text is many times as large as the table; characters the encoding
    lacks are spelled with those it has."""
    text = df.select([
        F.replace(F.col(c), F.lit("–"), F.lit("-")).alias(c) if kind == "string" else F.col(c).cast("string").alias(c)
        for c, kind in df.dtypes
    ])
    options = {"sep": ";", "quoteAll": True, "escape": '"', "encoding": "ISO-8859-1", "ignoreLeadingWhiteSpace": False}
    files = {"compression": "gzip", "maxRecordsPerFile": RAW_RECORDS}
    text.write.options(**options, **files).csv(path, ignoreTrailingWhiteSpace=False)
    release(df.sparkSession)


def _silver_tables(r: Registry, partners: bool = True, keep_raw: bool = False) -> str:
    """A folder with the typed tables, loaded from raw files made for it; these go once the tables are complete, unless kept."""
    folder = scratch(r.spark)
    _raw_file(r.companies, f"{folder}/bronze/Empresas")
    _raw_file(r.establishments, f"{folder}/bronze/Estabelecimentos")
    _raw_file(r.tax_regime, f"{folder}/bronze/Simples")
    if partners:
        _raw_file(r.partners, f"{folder}/bronze/Socios")
    pipeline.build_silver(r.spark, f"{folder}/bronze", f"{folder}/silver")
    if not keep_raw:
        store.remove(r.spark, f"{folder}/bronze")
    return folder


def _job_fact(r: Registry, partners: bool) -> DataFrame:
    """The fact as the jobs load it from raw files; empty texts count as missing, as files do not tell them apart."""
    folder = _silver_tables(r, partners)
    pipeline.build_gold(r.spark, f"{folder}/silver", f"{folder}/fato", "20250101")
    fact = gold.read(r.spark, f"{folder}/fato").drop("snapshot")
    return fact.select([F.coalesce(c, F.lit("")).alias(c) if kind == "string" else c for c, kind in fact.dtypes])


@query
def job_fact(r: Registry) -> DataFrame:
    return _job_fact(r, partners=True)


@query
def job_fact_bucketed(r: Registry) -> DataFrame:
    """The fact from bucketed silver tables."""
    folder, prefix = _silver_tables(r), f"prata_{uuid.uuid4().hex}"
    pipeline.bucket_silver(r.spark, f"{folder}/silver", f"{folder}/baldes", prefix, 8)
    fact = pipeline.fact_from_buckets(r.spark, f"{folder}/baldes", prefix)
    return fact.select([F.coalesce(c, F.lit("")).alias(c) if kind == "string" else c for c, kind in fact.dtypes])


@query
def source_files(r: Registry) -> DataFrame:
    """Raw files as listed, by the table they belong to."""
    folder = _silver_tables(r, keep_raw=True)
    listed = bronze.list_files(r.spark, f"{folder}/bronze/*")
    name = bronze.base_name(F.regexp_replace("path", "/[^/]*$", ""))
    counted = listed.where("length > 0").groupBy(bronze.file_category(name).alias("tabela")).agg(F.count("*").alias("arquivos"))
    return counted.select("tabela", (F.col("arquivos") > 0).alias("tem_arquivos"))


@query
def table_columns(r: Registry) -> DataFrame:
    return quality.schema_listing(r.table("customer"))


@query
def job_fact_without_partners(r: Registry) -> DataFrame:
    return _job_fact(r, partners=False)


@query
def job_stage_counts(r: Registry) -> DataFrame:
    folder, observed = _silver_tables(r), quality.Observed()
    pipeline.build_gold(r.spark, f"{folder}/silver", f"{folder}/fato", "20250101", observed=observed)
    return observed.counts(r.spark)


@query
def job_dimensions(r: Registry) -> DataFrame:
    folder = scratch(r.spark)
    for name in DOMAIN_TABLES:
        _raw_file(r.whole_dimensions[name.lower()], f"{folder}/bronze/{name}")
    pipeline.build_dimensions(r.spark, f"{folder}/bronze", f"{folder}/gold")
    loaded = dimensions.load_all(r.spark, f"{folder}/gold")
    return reduce(DataFrame.unionAll, [d.select(F.lit(n).alias("dominio"), *d.columns) for n, d in loaded.items()])


@query
def job_rewrites_unfinished(r: Registry) -> DataFrame:
    """A table whose first job was cut short: its files are there, its mark is not."""
    path = f"{scratch(r.spark)}/empresas"
    no_mark = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
    r.companies.limit(3).write.options(**no_mark).parquet(path)
    silver.write(r.companies, path)
    silver.write(r.companies.limit(0), path)  # complete by now, so it is kept
    return silver.read(r.spark, path, COMPANIES).select("cnpj_basico", "natureza_juridica", "porte_empresa")


def _faulty_files(r: Registry) -> str:
    """Company files in which one line in three has too few fields and one too many, with one field that is never closed."""
    folder = scratch(r.spark)
    nation = F.col("c_nationkey")
    tail = F.when(nation % 3 == 0, ";").when(nation % 3 == 1, "").otherwise(";;more;fields")
    name = F.concat(F.lit('"'), F.col("c_name"), F.lit('; ""x"""'))
    fields = [F.col("c_custkey").cast("string"), name, nation.cast("string"), F.lit("49"), F.lit('"1,00"'), F.lit("05")]
    lines = r.table("customer").select(F.concat(F.concat_ws(";", *fields), tail).alias("line"))
    lines.write.text(f"{folder}/Empresas")
    open_field = r.table("region").where("r_regionkey = 0").select(F.concat(F.lit('7;"'), F.col("r_name")).alias("line"))
    open_field.write.mode("append").text(f"{folder}/Empresas")
    silver.write_judged(bronze.read_judged(r.spark, f"{folder}/Empresas", COMPANIES), f"{folder}/empresas", COMPANIES)
    return f"{folder}/empresas"


@query
def csv_quarantine(r: Registry) -> DataFrame:
    """Every input line is in the table or in its quarantine."""
    path = _faulty_files(r)
    good = silver.read(r.spark, path, COMPANIES).agg(F.lit("ok").alias("reason"), F.count("*").alias("linhas"))
    bad = silver.quarantined(r.spark, path).groupBy("reason").agg(F.count("*").alias("linhas"))
    return good.unionAll(bad)


@query
def csv_quarantined_lines(r: Registry) -> DataFrame:
    return silver.quarantined(r.spark, _faulty_files(r)).select("reason", "line")


@query
def csv_fitting_rows(r: Registry) -> DataFrame:
    return silver.read(r.spark, _faulty_files(r), COMPANIES).select("cnpj_basico", "razao_social", "natureza_juridica", "porte_empresa")


@query
def snapshot_rewrites_unfinished(r: Registry) -> DataFrame:
    """A snapshot whose job was cut short after some files were in place; it is written anew, and then kept."""
    path, fact = f"{scratch(r.spark)}/fato", r.kept(r.fact)
    fact.where("uf IS NOT NULL").write.parquet(f"{path}/snapshot=20250101/load=cut")
    gold.write_snapshot(fact, path, "20250101")
    gold.write_snapshot(fact.limit(0), path, "20250101")
    return gold.read(r.spark, path).groupBy("uf").agg(F.count("*").alias("linhas"))


@query
def job_documents(r: Registry) -> DataFrame:
    folder = _silver_tables(r)
    pipeline.build_gold(r.spark, f"{folder}/silver", f"{folder}/fato", "20250101")
    pipeline.load_documents(r.spark, f"{folder}/silver", f"{folder}/fato", f"{folder}/documentos")
    stored = store.read_documents(r.spark, f"{folder}/documentos")
    return stored.headers.select("_id", "razao_social", "natureza_juridica", "capital_social", "porte_empresa", "unidades")


@query
def cast_loss_report(r: Registry) -> DataFrame:
    return quality.cast_loss_report(bronze.parse_lines(raw_lines(r), "line", COMPANIES), COMPANIES)


def _stored_snapshots(r: Registry) -> str:
    """The fact is stored as one snapshot, as its joins deal it, and the other is taken from there: no copy of it is kept beside them,
    whose reads would make tasks of more rows than are sorted in memory."""
    path = f"{scratch(r.spark)}/fato"
    gold.write_snapshot(r.fact, path, "20250101")
    early = gold.read(r.spark, path, "20250101").drop("snapshot").where(F.col("data_inicio_atividade") < 19980000)
    gold.write_snapshot(early, path, "20240101")
    gold.write_snapshot(early, path, "20250101")  # exists already, so it is kept
    return path


@query
def snapshot_latest(r: Registry) -> DataFrame:
    return gold.read(r.spark, _stored_snapshots(r)).groupBy("uf").agg(F.count("*").alias("linhas"))


@query
def snapshot_all(r: Registry) -> DataFrame:
    stored = gold.read(r.spark, _stored_snapshots(r), gold.ALL)
    return stored.groupBy("snapshot").agg(F.count("*").alias("linhas"))


# Overview


@query
def kpis(r: Registry) -> DataFrame:
    indicators = metrics.headline_indicators(r.fact, WINDOW)
    return rounded(indicators, "media_capital", "mediana_capital", "taxa_atividade")


@query
def kpis_sketched(r: Registry) -> DataFrame:
    """Exact counts from the stored sketches, and whether median and number of companies are within their bounds."""
    path = f"{scratch(r.spark)}/resumo"
    sketches.write_sketches(r.fact, path, "20250101")
    stored = sketches.read_sketches(r.spark, path, "20250101")
    found = sketches.indicators(stored, ["uf"], years=WINDOW)
    exact = metrics.opened_in(r.fact, WINDOW).join(found.select("uf", "mediana_capital"), "uf").groupBy("uf").agg(
        F.count_if(F.col("capital_social") < F.col("mediana_capital")).alias("below"),
        F.count_if(F.col("capital_social") <= F.col("mediana_capital")).alias("upto"),
        F.count("capital_social").alias("valued"),
        F.count_distinct("cnpj_basico").alias("exact"),
    )
    low, high = 0.5 - sketches.RANK_ERROR, 0.5 + sketches.RANK_ERROR
    near = (F.col("below") <= high * F.col("valued")) & (F.col("upto") >= low * F.col("valued"))
    counted = F.abs(F.col("empresas") - F.col("exact")) <= F.greatest(sketches.COUNT_ERROR * F.col("exact"), F.lit(1))
    return found.join(exact, "uf").select("uf", "total", "ativos", near.alias("mediana_ok"), counted.alias("empresas_ok"))


@query
def dist_situacao(r: Registry) -> DataFrame:
    return metrics.status_distribution(r.fact, WINDOW)


@query
def dist_porte(r: Registry) -> DataFrame:
    return metrics.size_distribution(r.fact, WINDOW)


@query
def top_cnaes(r: Registry) -> DataFrame:
    return metrics.top_activities(r.fact, r.activities, 10, WINDOW)


@query
def top_cnaes_short(r: Registry) -> DataFrame:
    return metrics.top_activities(r.fact, r.activities, 10, WINDOW).select(
        "cnae_fiscal_principal", "total", ellipsize(F.col("descricao"), 50).alias("descricao_curta")
    )


# Time series


@query
def annual_series(r: Registry) -> DataFrame:
    return metrics.yearly_flow(r.fact, WINDOW, CLOSINGS)


@query
def monthly_series(r: Registry) -> DataFrame:
    return metrics.monthly_flow(r.fact, WINDOW, CLOSINGS)


@query
def openings_year(r: Registry) -> DataFrame:
    return metrics.openings_by_year(r.fact, WINDOW)


@query
def openings_month(r: Registry) -> DataFrame:
    return metrics.openings_by_month(r.fact, WINDOW)


@query
def openings_year_porte(r: Registry) -> DataFrame:
    return metrics.openings_by_year_and_size(r.fact, WINDOW)


@query
def avg_capital_year(r: Registry) -> DataFrame:
    return rounded(metrics.mean_capital_by_year(r.fact, WINDOW), "media_capital")


@query
def period_kpis(r: Registry) -> DataFrame:
    return metrics.period_totals(metrics.yearly_flow(r.fact, WINDOW, CLOSINGS), Period(1997, 1999))


@query
def annual_long(r: Registry) -> DataFrame:
    return metrics.yearly_flow_long(metrics.yearly_flow(r.fact, WINDOW, CLOSINGS), Period(1997, 2001))


@query
def pivot_mean(r: Registry) -> DataFrame:
    counts = metrics.openings_by_month(r.fact, WINDOW)
    return reshape.mean_pivot(counts, "mes_abertura", "ano_abertura", "total", range(1996, 2001))


# Geography


@query
def by_uf(r: Registry) -> DataFrame:
    return rounded(metrics.by_state(r.fact, WINDOW), "media_capital")


@query
def top_municipios(r: Registry) -> DataFrame:
    return metrics.top_towns(r.fact, r.towns, 15, WINDOW).withColumn(
        "municipio_nome", ellipsize(F.col("descricao"), 35)
    )


@query
def top_municipios_per_uf(r: Registry) -> DataFrame:
    return metrics.top_towns_by_state(r.fact, r.towns, 5, WINDOW)


@query
def rollup_municipios(r: Registry) -> DataFrame:
    return reshape.path_totals(metrics.top_towns_by_state(r.fact, r.towns, 5, WINDOW), ["uf", "descricao"], "total")


@query
def uf_share(r: Registry) -> DataFrame:
    return rounded(metrics.state_shares(metrics.by_state(r.fact, WINDOW)), "pct_total")


@query
def geo_leader(r: Registry) -> DataFrame:
    return rounded(metrics.state_leader(metrics.by_state(r.fact, WINDOW)), "pct")


# Activities


@query
def top_cnaes_detail(r: Registry) -> DataFrame:
    return rounded(metrics.top_activities_detail(r.fact, r.activities, 20, WINDOW), "media_capital")


@query
def cnae_by_situacao(r: Registry) -> DataFrame:
    return metrics.activity_by_status(r.fact, r.activities, 10, WINDOW)


@query
def cnae_division(r: Registry) -> DataFrame:
    return metrics.activity_divisions(r.fact, r.activities, WINDOW)


@query
def rollup_division(r: Registry) -> DataFrame:
    divisions = metrics.activity_divisions(r.fact, r.activities, WINDOW)
    return reshape.path_totals(divisions, ["divisao_cnae", "descricao"], "total")


@query
def top_cnae_evolution(r: Registry) -> DataFrame:
    return metrics.activity_evolution(r.fact, r.activities, 5, WINDOW)


@query
def cnae_leader(r: Registry) -> DataFrame:
    return rounded(metrics.activity_leader(metrics.top_activities_detail(r.fact, r.activities, 20, WINDOW)), "pct")


@query
def top_cnaes_ascending(r: Registry) -> DataFrame:
    leaders = metrics.top_activities(r.fact, r.activities, 10, WINDOW)
    ordered = ranking.ascending(leaders, "cnae_fiscal_principal")
    place = F.row_number().over(Window.orderBy("total", "cnae_fiscal_principal")) - 1  # of ten rows
    return ordered.select(place.cast("bigint").alias("posicao"), "cnae_fiscal_principal", "total")


@query
def cnae_picker(r: Registry) -> DataFrame:
    return lookup.picker(r.whole_dimensions["cnaes"])


# Filters, code resolution, formats, web


@query
def filters_all(r: Registry) -> DataFrame:
    chosen = apply_filters(
        r.fact,
        states=["NATION_3", STATE, "NATION_11"],
        statuses=codes_of(STATUS_LABELS, ["Ativa", "Baixada"]),
        sizes=codes_of(SIZE_LABELS, ["Micro Empresa", "Demais"]),
        years=Period(1997, 1999),
    )
    return chosen.groupBy("uf", "situacao_cadastral", "porte_empresa").agg(F.count("*").alias("total"))


@query
def filters_clustered(r: Registry) -> DataFrame:
    path = f"{scratch(r.spark)}/fato"
    gold.write_snapshot(r.kept(r.fact), path, "20250101", cluster=True, files=16)
    chosen = apply_filters(gold.read(r.spark, path), states=[STATE], years=Period(1997, 1999))
    return chosen.groupBy("uf", "situacao_cadastral", "cnae_fiscal_principal").agg(F.count("*").alias("total"))


@query
def filters_activity(r: Registry) -> DataFrame:
    return apply_filters(r.fact, activity=ACTIVITY).groupBy("uf").agg(F.count("*").alias("total"))


@query
def resolve_codes(r: Registry) -> DataFrame:
    counts = r.fact.groupBy(F.col("identificador_socio").alias("codigo")).agg(F.count("*").alias("total"))
    return lookup.resolve(counts, "codigo", r.countries, "descricao")


@query
def dimensions_all(r: Registry) -> DataFrame:
    named = [d.select(F.lit(n).alias("dominio"), "codigo", "descricao") for n, d in r.whole_dimensions.items()]
    return reduce(DataFrame.unionAll, named)


@query
def format_fields(r: Registry) -> DataFrame:
    price, customer = F.col("o_totalprice"), F.col("o_custkey")
    return r.table("orders").select(
        "o_orderkey",
        formats.number_text(price).alias("inteiro"),
        formats.number_text(price, 2).alias("decimal"),
        formats.currency_text(price).alias("moeda"),
        formats.percent_text(price / 1000).alias("percentual"),
        formats.date_text(to_ymd(F.col("o_orderdate"))).alias("data"),
        formats.company_id(customer, F.col("o_orderkey"), customer % 100).alias("cnpj"),
        formats.postal_code(customer).alias("cep"),
    )


@query
def secondary_codes(r: Registry) -> DataFrame:
    rows = r.fact.dropDuplicates().select(
        "cnpj_ordem", F.array_join(integer_list(F.col("cnae_fiscal_secundaria")), ",").alias("codigos")
    )
    return rows.groupBy("cnpj_ordem", "codigos").agg(F.count("*").alias("linhas"))


@query
def link_harvest(r: Registry) -> DataFrame:
    return web.harvest_links(r.table("pages"), "html")


@query
def link_harvest_suffix(r: Registry) -> DataFrame:
    return web.harvest_links(r.table("pages"), "html", suffix="EN")


@query
def file_category(r: Registry) -> DataFrame:
    archives = r.table("customer").select(
        F.concat("c_mktsegment", F.col("c_custkey").cast("string"), F.lit(".ZIP")).alias("nome")
    )
    pages = r.table("pages").select(bronze.base_name(F.col("url")).alias("nome"))
    names = archives.unionAll(pages)
    return names.groupBy(bronze.file_category(F.col("nome")).alias("categoria")).agg(F.count("*").alias("arquivos"))


# Documents


def _joined(*values: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(v.cast("string"), F.lit("-")) for v in values])


def _unit_text(u: Column) -> Column:
    first = [
        "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "nome_fantasia", "situacao_cadastral",
        "data_situacao_cadastral", "data_inicio_atividade", "cnae_fiscal_principal",
    ]
    return _joined(
        *[u[name] for name in first],
        F.array_join(u["cnae_fiscal_secundarias"], ","),
        *[u["endereco"][name] for name in docs.ADDRESS],
        *[u["contato"][name] for name in docs.CONTACT],
    )


def _partner_text(p: Column) -> Column:
    names = [
        "identificador_socio", "nome_socio_razao_social", "cnpj_cpf_socio", "qualificacao_socio",
        "data_entrada_sociedade",
    ]
    return _joined(*[p[name] for name in names])


def flattened(documents: docs.Documents) -> DataFrame:
    """Documents with their nested records as sorted text."""
    return docs.nested(documents).select(
        "_id",
        *docs.HEADER,
        F.size("socios").cast("bigint").alias("n_socios"),
        F.array_join(F.sort_array(F.transform("socios", _partner_text)), ";").alias("socios"),
        F.size("estabelecimentos").cast("bigint").alias("n_estabelecimentos"),
        F.array_join(F.sort_array(F.transform("estabelecimentos", _unit_text)), ";").alias("estabelecimentos"),
    )


@query
def documents_flat(r: Registry) -> DataFrame:
    return flattened(r.documents)


def _halves(r: Registry) -> tuple[DataFrame, DataFrame]:
    opened, fact = F.col("data_inicio_atividade"), r.kept(r.named_fact)
    return fact.where(opened < 19980000), fact.where(opened >= 19980000)


@query
def doc_merge(r: Registry) -> DataFrame:
    early, late = _halves(r)
    return flattened(docs.merge_documents(docs.build_documents(early), docs.build_documents(late)))


@query
def doc_store_merge(r: Registry) -> DataFrame:
    path = f"{scratch(r.spark)}/documentos"
    early, late = _halves(r)
    store.write_documents(docs.build_documents(early), path, buckets=8)
    update = docs.build_documents(late)
    for _ in range(2):  # merging the same rows again changes nothing
        store.merge_into(path, update)
    return flattened(store.read_documents(r.spark, path))


@query
def doc_store_generations(r: Registry) -> DataFrame:
    """Generation 0 as a read that began before the merge sees it, and generation 1."""
    path = f"{scratch(r.spark)}/documentos"
    early, late = _halves(r)
    store.write_documents(docs.build_parts(early), path, buckets=8)
    before = store.read_documents(r.spark, path).headers
    store.merge_into(path, docs.build_documents(late))
    after = store.read_documents(r.spark, path, generation=1).headers

    def numbered(headers: DataFrame, number: int) -> DataFrame:
        return headers.select(F.lit(number).alias("generation"), "_id", "unidades")

    return numbered(before, 0).unionAll(numbered(after, 1))


@query
def doc_stream_upsert(r: Registry) -> DataFrame:
    """Three batches, all of them delivered a second time."""
    folder = scratch(r.spark)
    # files that hold whole companies, as many for each batch as the joins have tasks
    files = int(r.spark.conf.get("spark.sql.shuffle.partitions"))
    r.named_fact.repartition(3 * files, "cnpj_basico").write.parquet(f"{folder}/fato")
    written = len(r.spark.read.parquet(f"{folder}/fato").inputFiles())
    store.write_documents(docs.build_parts(r.named_fact.limit(0)), f"{folder}/documentos", buckets=8)
    for run in range(2):
        upsert_documents(
            r.spark, f"{folder}/fato", f"{folder}/documentos", f"{folder}/checkpoint-{run}", r.named_fact.schema,
            files_per_batch=max(1, -(-written // 3)),
        ).awaitTermination()
    return flattened(store.read_documents(r.spark, f"{folder}/documentos"))


@query
def doc_by_index_merged(r: Registry) -> DataFrame:
    path = r.merged_store
    return flattened(search.by_index(store.read_documents(r.spark, path), store.read_index(r.spark, path, "activity"), ACTIVITY, STATE))


@query
def doc_index_merged(r: Registry) -> DataFrame:
    return store.read_index(r.spark, r.merged_store, "activity").drop("bucket")


def _name_search_indexed(r: Registry, text: str) -> DataFrame:
    path = r.merged_store
    return search.name_search_indexed(store.read_documents(r.spark, path), store.read_index(r.spark, path, "names"), text)


@query
def name_search_indexed(r: Registry) -> DataFrame:
    return _name_search_indexed(r, "r#00000004")


@query
def name_search_short(r: Registry) -> DataFrame:
    return _name_search_indexed(r, "5-")


@query
def doc_lookup_stored(r: Registry) -> DataFrame:
    stored = store.read_documents(r.spark, r.stored_documents)
    buckets = store.stored_buckets(r.spark, r.stored_documents)
    found = search.look_up_stored(_requests(r), "pedido", stored, buckets, hot_keys(r.table("events"), "user_id"))
    return found.select("event_id", "pedido", "_id", "status", "razao_social", "unidades")


@query
def doc_by_key(r: Registry) -> DataFrame:
    return flattened(search.by_company(r.documents, 11))


@query
def doc_by_key_stored(r: Registry) -> DataFrame:
    return flattened(store.documents_by_id(r.spark, r.stored_documents, 11))


def _requests(r: Registry) -> DataFrame:
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(
        F.concat(F.lit("  "), F.col("user_id").cast("string"), F.lit(" "))
    )
    return r.table("events").select("event_id", text.alias("pedido"))


@query
def doc_lookup(r: Registry) -> DataFrame:
    hot = hot_keys(r.table("events"), "user_id")
    found = search.look_up(_requests(r), "pedido", r.documents, hot)
    return found.select("event_id", "pedido", "_id", "status", "razao_social", "unidades")


@query
def doc_requested(r: Registry) -> DataFrame:
    return flattened(search.requested_documents(_requests(r), "pedido", r.documents))


def _ids(documents: docs.Documents) -> DataFrame:
    return documents.headers.select("_id")


@query
def doc_by_uf_cnae(r: Registry) -> DataFrame:
    return _ids(search.by_state_and_activity(r.documents, STATE.lower(), ACTIVITY))


@query
def doc_by_uf(r: Registry) -> DataFrame:
    return _ids(search.by_state_and_activity(r.documents, STATE))


@query
def doc_by_uf_whole(r: Registry) -> DataFrame:
    return flattened(search.by_state_and_activity(r.documents, STATE))


@query
def doc_by_uf_cnae_same_unit(r: Registry) -> DataFrame:
    return _ids(search.by_state_and_activity(r.documents, STATE, ACTIVITY, same_unit=True))


@query
def doc_count_by_uf(r: Registry) -> DataFrame:
    return search.count_by_state(r.documents)


@query
def doc_stats(r: Registry) -> DataFrame:
    return search.collection_stats(r.documents)


@query
def doc_by_secondary_cnae(r: Registry) -> DataFrame:
    return _ids(search.by_secondary_activity(r.documents, ACTIVITY))


@query
def doc_by_secondary_cnae_whole(r: Registry) -> DataFrame:
    return flattened(search.by_secondary_activity(r.documents, ACTIVITY))


def _index(r: Registry, documents: docs.Documents) -> DataFrame:
    path = f"{scratch(r.spark)}/indice"
    search.write_activity_index(documents, path)
    return r.spark.read.parquet(path)


@query
def doc_by_index(r: Registry) -> DataFrame:
    return _ids(search.by_index(r.documents, _index(r, r.documents), ACTIVITY, STATE))


@query
def doc_by_index_stored(r: Registry) -> DataFrame:
    stored = store.read_documents(r.spark, r.stored_documents)
    return flattened(search.by_index(stored, _index(r, stored), ACTIVITY, STATE))


@query
def doc_activity_index(r: Registry) -> DataFrame:
    return search.activity_index(r.documents)


@query
def doc_branches_by_uf(r: Registry) -> DataFrame:
    return search.branches_by_state(r.documents)


@query
def company_sheet(r: Registry) -> DataFrame:
    return sheet.company_sheets(r.kept_documents, r.activities, r.towns, r.natures, r.tasks)


@query
def name_search(r: Registry) -> DataFrame:
    return search.name_search(r.documents, "00042")
