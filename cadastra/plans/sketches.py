"""Stored sketches that answer for medians and distinct companies without reading the fact: an opt-in, approximate form.

A snapshot's fact is summarised once per state and opening year: exact counts and sums, a KLL sketch of the capital and an HLL
sketch of the companies. Sketches of any choice of states and years are merged when a question is asked. A sketch has a fixed
size, and tasks make partial ones before anything is shuffled, so a state of any size is fine.

Bounds, at 99 in 100 questions or more: the median's rank lies within ``RANK_ERROR`` of one half, the number of companies within
``COUNT_ERROR`` of the exact one. ``metrics`` has the exact forms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions.dates import Period, year_of
from cadastra.functions.formats import share
from cadastra.schemas import STATUS_ACTIVE
from cadastra.sources.committed import is_committed, write_once

KLL_K = 400
HLL_LG_K = 14
RANK_ERROR = 0.02
COUNT_ERROR = 0.03


def summarised(fact: DataFrame) -> DataFrame:
    """(uf, ano, total, ativos, com_capital, soma_capital, capital, empresas), one row per state and opening year; either may be null."""
    capital = F.col("capital_social").cast("double")
    return fact.groupBy("uf", year_of(F.col("data_inicio_atividade")).alias("ano")).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("situacao_cadastral") == STATUS_ACTIVE).alias("ativos"),
        F.count(capital).alias("com_capital"),
        F.sum(capital).alias("soma_capital"),
        F.kll_sketch_agg_double(capital, KLL_K).alias("capital"),
        F.hll_sketch_agg(F.col("cnpj_basico").cast("long"), HLL_LG_K).alias("empresas"),
    )


def write_sketches(fact: DataFrame, path: str, snapshot: str, overwrite: bool = False) -> bool:
    """Summary of one snapshot, kept (and False returned) if it is there and complete."""
    return write_once(summarised(fact), f"{path}/{snapshot}", overwrite)


def read_sketches(spark: SparkSession, path: str, snapshot: str) -> DataFrame:
    if not is_committed(spark, f"{path}/{snapshot}"):
        raise FileNotFoundError(f"{path} holds no summary of {snapshot}")
    return spark.read.parquet(f"{path}/{snapshot}")


def indicators(sketches: DataFrame, by: Sequence[str] = (), years: Period | None = None) -> DataFrame:
    """Total, active, mean and approximate median capital, approximate number of companies, activity rate; per ``by`` (``uf``,
    ``ano``) if given, for establishments opened in ``years``. Counts and mean are exact."""
    chosen = sketches if years is None else sketches.where((F.col("ano") >= years.first) & (F.col("ano") <= years.last))
    merged = chosen.groupBy(*by).agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("ativos"), F.lit(0)).alias("ativos"),
        (F.sum("soma_capital") / F.sum("com_capital")).alias("media_capital"),
        F.sum("com_capital").alias("_valued"),
        F.kll_merge_agg_double("capital").alias("_capital"),
        F.hll_sketch_estimate(F.hll_union_agg("empresas")).alias("empresas"),
    )
    median = F.when(F.col("_valued") > 0, F.kll_sketch_get_quantile_double("_capital", F.lit(0.5)))
    return merged.select(
        *by, "total", "ativos", "media_capital", median.alias("mediana_capital"), "empresas",
        share(F.col("ativos"), F.col("total")).alias("taxa_atividade"),
    )
