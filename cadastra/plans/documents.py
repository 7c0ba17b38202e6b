"""Company documents.

A set of documents is kept in three tables, all keyed by company: ``headers`` (one row each, with the number of
its establishments), ``partners`` (one row per distinct partner) and ``units`` (one row per distinct
establishment record, with the number of ``copies``). No row grows with its company, so one layout serves
companies of every size. ``nested`` turns chosen companies into records with lists.

As in the source, an establishment counts once per distinct fact row, hence once for each partner of its
company; ``copies`` holds that number.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.cleansing import clean_name, integer_list
from cadastra.operators.skew import dealt
from cadastra.schemas import FACT

KEY = "cnpj_basico"
UNIT_KEY = [KEY, "cnpj_ordem", "cnpj_dv"]
# Field order of the nested records.
ADDRESS = ["tipo_logradouro", "logradouro", "numero", "complemento", "bairro", "cep", "uf", "municipio"]
CONTACT = ["ddd_1", "telefone_1", "ddd_2", "telefone_2", "correio_eletronico"]
HEADER = [
    "razao_social",
    "natureza_juridica",
    "capital_social",
    "porte_empresa",
    "opcao_pelo_simples",
    "opcao_pelo_mei",
]
DOCUMENT = ["_id", *HEADER, "socios", "unidades", "estabelecimentos"]

Row = Callable[[str], Column]


class Documents(NamedTuple):
    headers: DataFrame
    partners: DataFrame
    units: DataFrame

    def each(self, change: Callable[[DataFrame], DataFrame]) -> Documents:
        return Documents(*map(change, self))

    def of(self, companies: DataFrame, on: str | list[str] = "_id") -> Documents:
        """The whole documents of the companies listed (``_id``, each once)."""
        return self.each(lambda table: table.join(companies, on, "left_semi"))


class Counted(Documents):
    """Documents that still know the parts they are counted from, so that a store, which counts what it has written, spares the count."""

    parts: Parts | None = None


class Parts(NamedTuple):
    """Documents whose headers, ``heads`` (_id, header), are not counted yet."""

    heads: DataFrame
    partners: DataFrame
    units: DataFrame


def header_of(row: Row, named: bool) -> Column:
    """Company header; both regime flags are constant because the fact holds opted-in companies only."""
    return F.struct(
        (clean_name(row("razao_social")) if named else F.lit("")).alias("razao_social"),
        row("natureza_juridica").alias("natureza_juridica"),
        F.coalesce(row("capital_social"), F.lit(0.0)).alias("capital_social"),
        row("porte_empresa").alias("porte_empresa"),
        F.lit("S").alias("opcao_pelo_simples"),
        F.lit("S").alias("opcao_pelo_mei"),
    )


def partner_of(row: Row) -> Column:
    """Partner record, or null when the partner has no name."""
    name = clean_name(row("nome_socio_razao_social"))
    record = F.struct(
        row("identificador_socio").alias("identificador_socio"),
        name.alias("nome_socio_razao_social"),
        F.coalesce(row("cnpj_cpf_socio"), F.lit("")).alias("cnpj_cpf_socio"),
        row("qualificacao_socio").alias("qualificacao_socio"),
        row("data_entrada_sociedade").alias("data_entrada_sociedade"),
    )
    return F.when(name != "", record)


def establishment_of(row: Row) -> Column:
    return F.struct(
        row("cnpj_ordem").alias("cnpj_ordem"),
        row("cnpj_dv").alias("cnpj_dv"),
        F.coalesce(row("identificador_matriz_filial"), F.lit(1).cast("smallint")).alias("identificador_matriz_filial"),
        clean_name(row("nome_fantasia")).alias("nome_fantasia"),
        row("situacao_cadastral").alias("situacao_cadastral"),
        row("data_situacao_cadastral").alias("data_situacao_cadastral"),
        row("data_inicio_atividade").alias("data_inicio_atividade"),
        row("cnae_fiscal_principal").alias("cnae_fiscal_principal"),
        integer_list(row("cnae_fiscal_secundaria")).alias("cnae_fiscal_secundarias"),
        F.struct(*[row(name).alias(name) for name in ADDRESS]).alias("endereco"),
        F.struct(*[row(name).alias(name) for name in CONTACT]).alias("contato"),
    )


def build_parts(fact: DataFrame, companies: DataFrame | None = None, tasks: int | None = None) -> Parts:
    """Documents of the fact's companies, for a store, which counts establishments once they are written.

    Exact copies of fact rows collapse, with a partial aggregation before the shuffle. The company name is used when the
    fact carries it, or taken with the rest of the header from ``companies`` (opted-in rows with name), which spares
    the fact that column. Of several header rows the smallest counts. ``tasks`` deals the rows to so many, if the session's are too few
    for them (see ``tasks_for``).
    """
    named = "razao_social" in fact.columns
    content = [n for n in FACT.names if n != KEY] + (["razao_social"] if named else [])
    key = F.col(KEY).alias("_id")
    unit = establishment_of(F.col)
    # rows that are alike in all columns meet by those that number an establishment, so one exchange serves both aggregations
    rows = dealt(fact.select(KEY, *content), tasks, *UNIT_KEY).distinct()
    units = rows.groupBy(*UNIT_KEY, unit.alias("unidade")).agg(F.count("*").alias("copies")).select(key, "unidade", "copies")
    partners = fact.select(key, partner_of(F.col).alias("socio")).where("socio IS NOT NULL").distinct()
    if companies is None:
        source = fact
    else:
        named, source = True, companies.join(fact.select(KEY), KEY, "left_semi")
    return Parts(source.groupBy(key).agg(F.min(header_of(F.col, named)).alias("header")), partners, units)


def build_documents(fact: DataFrame, companies: DataFrame | None = None) -> Documents:
    """Documents of the fact's companies, see ``build_parts``."""
    return whole(build_parts(fact, companies))


def whole(parts: Parts) -> Documents:
    documents = Counted(counted(parts.heads, parts.units), parts.partners, parts.units)
    documents.parts = parts
    return documents


def parts_of(documents: Documents | Parts) -> Parts:
    """Parts as they are; of documents, the parts they come from or the headers without their numbers."""
    if isinstance(documents, Parts):
        return documents
    if isinstance(documents, Counted) and documents.parts is not None:
        return documents.parts
    plain = documents.each(lambda table: table.drop("bucket"))
    return Parts(plain.headers.select("_id", F.struct(*HEADER).alias("header")), plain.partners, plain.units)


def counted(headers: DataFrame, units: DataFrame) -> DataFrame:
    """Flat headers, from (_id, header), with the number of each company's establishments."""
    sizes = units.groupBy("_id").agg(F.sum("copies").alias("unidades"))
    return headers.join(sizes, "_id", "left").select(
        "_id", *[F.col("header")[name].alias(name) for name in HEADER], F.coalesce("unidades", F.lit(0)).alias("unidades")
    )


def nested(documents: Documents) -> DataFrame:
    """One record per company with sorted lists of partners and establishments.

    A record is as large as its company: choose companies first, as the lookups do. All other questions are answered
    from the three tables.
    """
    partners = documents.partners.groupBy("_id").agg(F.sort_array(F.collect_list("socio")).alias("socios"))
    repeated = F.flatten(F.transform("listed", lambda u: F.array_repeat(u["unidade"], u["copies"].cast("int"))))
    units = documents.units.groupBy("_id").agg(F.collect_list(F.struct("unidade", "copies")).alias("listed"))
    units = units.select("_id", F.sort_array(repeated).alias("estabelecimentos"))
    joined = documents.headers.join(partners, "_id", "left").join(units, "_id", "left")
    lists = {"socios": partners, "estabelecimentos": units}
    empty = {n: F.coalesce(n, F.array().cast(t.schema[n].dataType)).alias(n) for n, t in lists.items()}
    return joined.select(*[empty.get(n, F.col(n)) for n in DOCUMENT])


def merge_documents(old: Documents, new: Documents) -> Documents:
    """Union of two sets by company, see ``merged_parts``."""
    return whole(merged_parts(old, new))


def merged_parts(old: Documents | Parts, new: Documents | Parts, tasks: int | None = None) -> Parts:
    """Union of two sets by company.

    An existing header stays; partners are united; an establishment is kept as often as the set that
    has it most often, so merging the same documents again changes nothing. Work is dealt by company and record, to so many
    ``tasks``, if the session's are too few for the establishments (see ``tasks_for``).
    """

    sides = parts_of(old), parts_of(new)

    def both(table: str, *columns) -> DataFrame:
        first, second = (getattr(side, table).select("_id", *columns) for side in sides)
        return first.withColumn("age", F.lit(0)).unionAll(second.withColumn("age", F.lit(1)))

    # one sum per side, so one exchange of the records
    held, added = (F.coalesce(F.sum(F.when(F.col("age") == age, F.col("copies"))), F.lit(0)) for age in (0, 1))
    number = [F.col("unidade")[name].alias(f"_{name}") for name in UNIT_KEY[1:]]
    place = ["_id", *(f"_{name}" for name in UNIT_KEY[1:])]
    units = dealt(both("units", "unidade", "copies", *number), tasks, *place).groupBy(*place, "unidade")
    units = units.agg(F.greatest(held, added).alias("copies")).select("_id", "unidade", "copies")
    partners = both("partners", "socio").select("_id", "socio").distinct()
    oldest = F.min(F.struct("age", "header"))["header"].alias("header")
    headers = both("heads", "header").groupBy("_id").agg(oldest)
    return Parts(headers, partners, units)
