"""Registry tables expressed over the test tables.

Each function has a twin in ``checks.oracle``; both must stay in step.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions.dates import to_ymd
from cadastra.operators.keyset import maybe_among
from cadastra.operators.skew import dealt, hot_keys, tasks_for
from cadastra.plans.documents import Documents, build_documents, build_parts
from cadastra.plans.fact import KEY, build_fact, opted_in_keys
from cadastra.plans.store import INDEXES, merge_into, write_documents
from cadastra.schemas import COMPANIES, ESTABLISHMENTS, PARTNERS, TAX_REGIME
from cadastra.session import release, shared_dir
from cadastra.sources.silver import save_bucketed


def _shaped(df: DataFrame, schema, columns: dict[str, Column]) -> DataFrame:
    """All columns of the schema, in order and type; the ones not given are null."""
    return df.select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


class Registry:
    """Lazy registry tables of one test-data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _lines(self) -> int:
        return self.table("lineitem").count()

    @property
    def tasks(self) -> int | None:
        """Tasks of joins of establishments, if they are too many for the session's; no data is read."""
        return tasks_for(self.spark, self._lines)

    @property
    def tax_regime(self) -> DataFrame:
        segment = F.col("c_mktsegment")
        flag = (
            F.when(segment.isin("BUILDING", "MACHINERY"), "S").when(segment == "FURNITURE", "").otherwise("N")
        )
        columns = {KEY: F.col("c_custkey"), "opcao_pelo_simples": F.lit("S"), "opcao_pelo_mei": flag}
        return _shaped(self.table("customer"), TAX_REGIME, columns)

    @property
    def companies(self) -> DataFrame:
        nation = F.col("c_nationkey")
        amount = F.replace(_text(F.col("c_acctbal").cast("decimal(18,2)")), F.lit("."), F.lit(","))
        size = F.element_at(F.array(*map(F.lit, [0, 1, 3, 5, 9])), (F.col("c_custkey") % 5 + 1).cast("int"))
        columns = {
            KEY: F.col("c_custkey"),
            "razao_social": F.when(nation == 7, "null").when(nation == 8, " ").otherwise(F.col("c_name")),
            "natureza_juridica": nation,
            "qualificacao_responsavel": nation + 10,
            "capital_social": F.when(nation == 3, F.concat(F.lit("1."), amount)).otherwise(amount),
            "porte_empresa": size,
        }
        return _shaped(self.table("customer"), COMPANIES, columns)

    @property
    def establishments(self) -> DataFrame:
        return self._establishments(self.table("lineitem"), self.table("orders"))

    @property
    def opted_in_establishments(self) -> DataFrame:
        """Establishments without most of the other companies' rows. Orders meet the flags of the opted-in keys,
        and lines those of the orders left, each before it is shuffled. Which rows are of such companies is for the fact to say."""
        keys = opted_in_keys(self.tax_regime, repeated=bool(self.hot["flags"]))
        orders = maybe_among(self.table("orders"), keys.select(F.col(KEY).alias("o_custkey")), "o_custkey")
        lines = maybe_among(self.table("lineitem"), orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
        # companies with too many rows for one task are dealt in slices, by the fact's join
        sliced = any(self.hot[table] for table in ("establishments", "partners", "companies"))
        return self._establishments(lines, orders, by_company=not sliced)

    def _establishments(self, lines: DataFrame, orders: DataFrame, by_company: bool = False) -> DataFrame:
        """With ``by_company`` rows are dealt by company before the texts are derived, which make them twice as wide."""
        rows = (
            dealt(lines, self.tasks, "l_orderkey")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            # too many to be broadcast, they name the number of tasks
            .join(dealt(self.table("supplier"), self.tasks, "s_suppkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        )
        if by_company:
            rows = dealt(rows, self.tasks, "o_custkey")
        rows = rows.join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        line, flag = F.col("l_linenumber"), F.col("l_returnflag")
        part, supp = _text(F.col("l_partkey") * 500), _text(F.col("l_suppkey") * 500)
        columns = {
            KEY: F.col("o_custkey"),
            "cnpj_ordem": line,
            "cnpj_dv": F.col("l_quantity"),
            "identificador_matriz_filial": F.when(line == 1, 1).when(line < 7, 2),
            "nome_fantasia": F.when(line == 3, " none ")
            .when(line == 5, "")
            .when(line != 6, F.concat(F.lit(" "), F.col("s_name"), F.lit(" "), F.col("o_orderpriority"))),
            "situacao_cadastral": F.when(flag == "N", 2)
            .when(flag == "R", 8)
            .when(F.col("l_quantity") >= 49, 9)
            .otherwise(4),
            "data_situacao_cadastral": to_ymd(F.col("l_shipdate")),
            "motivo_situacao_cadastral": F.round(F.col("l_discount") * 100),
            "pais": F.col("n_regionkey"),
            "data_inicio_atividade": to_ymd(F.col("o_orderdate")),
            "cnae_fiscal_principal": F.col("l_partkey") * 500,
            "cnae_fiscal_secundaria": F.when(line == 2, F.concat(F.lit(" "), part, F.lit(" , ,"), supp))
            .when(line == 4, F.concat(part, F.lit(",x")))
            .when(line == 7, "")
            .when(line != 6, F.concat_ws(",", part, supp)),
            "tipo_logradouro": F.when(F.col("l_linestatus") == "O", "RUA"),
            "logradouro": F.col("o_orderpriority"),
            "numero": F.when(line != 2, _text("l_orderkey")),
            "complemento": F.when(flag == "N", F.concat(F.lit("SALA "), _text(line))).when(flag == "R", ""),
            "bairro": F.col("n_name"),
            "cep": F.when(line != 5, F.col("l_orderkey") + 1_000_000),
            "uf": F.col("n_name"),
            "municipio": F.col("l_suppkey"),
            "ddd_1": F.col("n_nationkey"),
            "telefone_1": _text(F.col("o_orderkey") + 30_000_000),
            "ddd_2": F.when(line <= 2, 11),
            "telefone_2": F.when(line == 1, "40004000").when(line == 2, ""),
            "correio_eletronico": F.when(
                line != 4, F.concat(F.lower(F.replace("s_name", F.lit("#"))), F.lit("@example.com"))
            ),
        }
        return _shaped(rows, ESTABLISHMENTS, columns)

    @property
    def partners(self) -> DataFrame:
        """Two records per supplier, so that companies have none to three partners."""
        nation, supp = F.col("s_nationkey"), F.col("s_suppkey")
        name = F.when(nation == 4, "NULL").when(nation == 5, "  ")

        def records(key: Column, kind: Column, suffix: str) -> DataFrame:
            columns = {
                KEY: key,
                "identificador_socio": kind,
                "nome_socio_razao_social": F.coalesce(name, F.concat(F.lit(" "), F.col("s_name"), F.lit(suffix))),
                "cnpj_cpf_socio": F.when(nation != 6, F.concat(F.lit("***"), _text(supp), F.lit("**"))),
                "qualificacao_socio": nation,
                "data_entrada_sociedade": nation + 20_100_101,
            }
            return _shaped(self.table("supplier"), PARTNERS, columns)

        second = records(F.expr("(s_suppkey + 1) div 2"), (supp + 1) % 4, " II ")
        return records(supp, supp % 4, " ").unionAll(second)

    # Dimensions, whole; then with codes missing on purpose, for the texts shown in their place.

    @property
    def whole_dimensions(self) -> dict[str, DataFrame]:
        def coded(table: str, code: str, text: str) -> DataFrame:
            return self.table(table).selectExpr(f"cast({code} as bigint) codigo", f"{text} descricao")

        words = F.concat_ws(" ", F.initcap("p_name"), F.lit("– comércio de"), F.lower("p_type"), F.lower("p_brand"))
        return {
            "naturezas": coded("nation", "n_nationkey", "n_name"),
            "qualificacoes": coded("region", "r_regionkey + 100", "r_name"),
            "motivos": coded("nation", "n_nationkey + 50", "n_name"),
            "municipios": coded("supplier", "s_suppkey", "s_name"),
            "paises": coded("region", "r_regionkey", "r_name"),
            "cnaes": self.table("part").select((F.col("p_partkey") * 500).alias("codigo"), words.alias("descricao")),
        }

    @property
    def activities(self) -> DataFrame:
        known = self.table("part").where("p_size > 5").select((F.col("p_partkey") * 500).alias("codigo"))
        return self.whole_dimensions["cnaes"].join(known, "codigo", "left_semi")

    @property
    def towns(self) -> DataFrame:
        known = self.table("supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("codigo"))
        return self.whole_dimensions["municipios"].join(known, "codigo", "left_semi")

    @property
    def natures(self) -> DataFrame:
        known = self.table("nation").where("n_regionkey <> 2").selectExpr("cast(n_nationkey as bigint) codigo")
        return self.whole_dimensions["naturezas"].join(known, "codigo", "left_semi")

    @property
    def countries(self) -> DataFrame:
        return self.whole_dimensions["paises"]

    # Hot keys are looked for once per folder; the pass over the test tables reads keys only.

    @cached_property
    def hot(self) -> dict[str, dict]:
        keys = dealt(self.table("lineitem").select("l_orderkey"), self.tasks, "l_orderkey").join(
            self.table("orders").select("o_orderkey", F.col("o_custkey").alias(KEY)),
            F.col("l_orderkey") == F.col("o_orderkey"),
        )
        counted = {"establishments": keys, "partners": self.partners, "flags": self.tax_regime, "companies": self.companies}
        return {name: hot_keys(df, KEY) for name, df in counted.items()}

    def _build(self, names: bool) -> DataFrame:
        hot = self.hot
        return build_fact(
            self.tax_regime,
            self.companies,
            self.opted_in_establishments if self.tasks else self.establishments,
            self.partners,
            hot["establishments"],
            hot["partners"],
            hot["flags"],
            hot["companies"],
            names=names,
            derived=not self.tasks,
            tasks=self.tasks,
        )

    @cached_property
    def fact(self) -> DataFrame:
        return self._build(names=False)

    @cached_property
    def named_fact(self) -> DataFrame:
        return self._build(names=True)

    def kept(self, fact: DataFrame) -> DataFrame:
        """The fact stored once, in as many buckets by company as its joins have tasks, for queries that read it several times."""
        table = f"fato_{uuid.uuid4().hex}"
        buckets = self.tasks or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        save_bucketed(fact, table, KEY, buckets, f"{shared_dir(self.spark)}/cadastra-{uuid.uuid4().hex}/fato")
        release(self.spark)
        return self.spark.table(table)

    @cached_property
    def documents(self) -> Documents:
        return build_documents(self.named_fact)

    @cached_property
    def kept_documents(self) -> Documents:
        """The documents of a fact that is stored once, for questions that read all three tables whole."""
        return build_documents(self.kept(self.named_fact))

    @cached_property
    def stored_documents(self) -> str:
        path = f"{shared_dir(self.spark)}/cadastra-{uuid.uuid4().hex}/documentos"
        write_documents(build_documents(self.kept(self.named_fact)), path, buckets=8)
        return path

    @cached_property
    def merged_store(self) -> str:
        """A store with postings, loaded in two parts."""
        path = f"{shared_dir(self.spark)}/cadastra-{uuid.uuid4().hex}/documentos"
        early, fact = F.col("data_inicio_atividade") < 19980000, self.kept(self.named_fact)
        write_documents(build_parts(fact.where(early)), path, buckets=8, indexes=INDEXES)
        merge_into(path, build_documents(fact.where(~early)))
        return path


_registries: dict[tuple, Registry] = {}


def registry(spark: SparkSession, folder: str) -> Registry:
    """One registry per session and folder; those of ended sessions are let go."""
    session = (spark.sparkContext.applicationId, id(spark))
    for key in [k for k in _registries if k[:2] != session]:
        del _registries[key]
    return _registries.setdefault((*session, folder), Registry(spark, folder))
