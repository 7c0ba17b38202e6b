"""Analytic questions over the fact table.

Every function takes the fact and, where texts are needed, a dimension, and returns a lazy result.
Unless told otherwise, only establishments opened in the activity window count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.cleansing import ellipsize
from cadastra.functions.dates import Period, activity_division, month_of, month_start, year_of
from cadastra.functions.formats import label, share
from cadastra.operators.lookup import describe
from cadastra.operators.median import exact_median
from cadastra.operators.ranking import by_total, small, top_n, top_n_per_group
from cadastra.operators.reshape import to_long, with_share
from cadastra.schemas import (
    NO_DESCRIPTION,
    NOT_INFORMED,
    SIZE_LABELS,
    STATUS_ACTIVE,
    STATUS_CLOSED,
    STATUS_LABELS,
    UNKNOWN,
)

WINDOW = Period()
ACTIVITY, TOWN, STATE = "cnae_fiscal_principal", "municipio", "uf"
STATUS, SIZE = "situacao_cadastral", "porte_empresa"
OPENED, CHANGED = "data_inicio_atividade", "data_situacao_cadastral"


def opened_in(fact: DataFrame, window: Period = WINDOW) -> DataFrame:
    return fact.where(window.holds(F.col(OPENED)))


def _total() -> Column:
    return F.count("*").alias("total")


def _active() -> Column:
    return F.count_if(F.col(STATUS) == STATUS_ACTIVE).alias("ativos")


def _mean_capital() -> Column:
    return F.avg("capital_social").alias("media_capital")


def _active_share(df: DataFrame) -> DataFrame:
    return df.withColumn("pct_ativos", F.round(F.col("ativos") / F.col("total") * 100, 1))


def _status_text() -> Column:
    return label(F.col(STATUS), STATUS_LABELS, UNKNOWN)


def _size_text() -> Column:
    return label(F.col(SIZE), SIZE_LABELS, UNKNOWN)


def _with_opening_year(fact: DataFrame, window: Period) -> DataFrame:
    return opened_in(fact, window).withColumn("ano_abertura", year_of(F.col(OPENED)))


# Overview


def headline_indicators(fact: DataFrame, window: Period = WINDOW) -> DataFrame:
    """One row: total, active, mean and exact median capital, states (null counts as one), activity rate."""
    rows = opened_in(fact, window)
    states = F.count_distinct(STATE) + F.coalesce(F.max(F.col(STATE).isNull().cast("int")), F.lit(0))
    median = exact_median(rows, "capital_social").scalar()
    return rows.agg(_total(), _active(), _mean_capital(), states.alias("total_ufs")).select(
        "total",
        "ativos",
        "media_capital",
        median.alias("mediana_capital"),
        "total_ufs",
        share(F.col("ativos"), F.col("total")).alias("taxa_atividade"),
    )


def status_distribution(fact: DataFrame, window: Period = WINDOW) -> DataFrame:
    counts = opened_in(fact, window).groupBy(STATUS).agg(_total())
    return by_total(counts.withColumn("situacao_desc", _status_text()), STATUS)


def size_distribution(fact: DataFrame, window: Period = WINDOW) -> DataFrame:
    counts = opened_in(fact, window).groupBy(SIZE).agg(_total())
    return by_total(counts.withColumn("porte_desc", _size_text()), SIZE)


def top_activities(fact: DataFrame, activities: DataFrame, n: int = 10, window: Period = WINDOW) -> DataFrame:
    counts = opened_in(fact, window).groupBy(ACTIVITY).agg(_total())
    return by_total(describe(top_n(counts, n, ACTIVITY), ACTIVITY, activities, NO_DESCRIPTION), ACTIVITY)


# Time series


def _is_closing(closings: Period) -> Column:
    changed = F.col(CHANGED)
    return (F.col(STATUS) == STATUS_CLOSED) & (changed > 0) & closings.holds_year(year_of(changed))


def _flow(fact: DataFrame, opening: dict[str, Column], closing: dict[str, Column], window: Period, closings: Period):
    """Openings and closings per period.

    One scan counts each (opening period, closing period) pair; both series and their full join then
    run on these few pairs. Rows without a closing form a group with null keys, which only leaves after the
    join: a filter before it would make the two branches differ and the fact be read twice.
    """
    names = list(opening)
    closed = _is_closing(closings)
    pairs = (
        opened_in(fact, window)
        .groupBy(
            F.struct(*[c.alias(n) for n, c in opening.items()]).alias("opened"),
            F.when(closed, F.struct(*[c.alias(n) for n, c in closing.items()])).alias("closed"),
        )
        .agg(F.count("*").alias("rows"))
    )
    opened = pairs.groupBy(*[F.col(f"opened.{n}").alias(n) for n in names]).agg(F.sum("rows").alias("aberturas"))
    ended = pairs.groupBy(*[F.col(f"closed.{n}").alias(n) for n in names]).agg(F.sum("rows").alias("fechamentos"))
    return opened.join(ended, names, "full").where(F.col(names[0]).isNotNull()).na.fill(0, ["aberturas", "fechamentos"])


def yearly_flow(fact: DataFrame, window: Period = WINDOW, closings: Period = WINDOW) -> DataFrame:
    series = _flow(fact, {"ano": year_of(F.col(OPENED))}, {"ano": year_of(F.col(CHANGED))}, window, closings)
    return series.orderBy("ano")


def monthly_flow(fact: DataFrame, window: Period = WINDOW, closings: Period = WINDOW) -> DataFrame:
    def axis(ymd: Column) -> dict[str, Column]:
        return {"ano": year_of(ymd), "mes": month_of(ymd)}

    series = _flow(fact, axis(F.col(OPENED)), axis(F.col(CHANGED)), window, closings)
    return series.withColumn("data_mes", month_start(F.col("ano"), F.col("mes"))).orderBy("ano", "mes")


def openings_by_year(fact: DataFrame, window: Period = WINDOW) -> DataFrame:
    return _with_opening_year(fact, window).groupBy("ano_abertura").agg(_total()).orderBy("ano_abertura")


def openings_by_month(fact: DataFrame, window: Period = WINDOW) -> DataFrame:
    rows = _with_opening_year(fact, window).withColumn("mes_abertura", month_of(F.col(OPENED)))
    return rows.groupBy("ano_abertura", "mes_abertura").agg(_total()).orderBy("ano_abertura", "mes_abertura")


def openings_by_year_and_size(fact: DataFrame, window: Period = WINDOW) -> DataFrame:
    counts = _with_opening_year(fact, window).groupBy("ano_abertura", SIZE).agg(_total())
    return counts.withColumn("porte_desc", _size_text()).orderBy("ano_abertura", SIZE)


def mean_capital_by_year(fact: DataFrame, window: Period = WINDOW) -> DataFrame:
    return _with_opening_year(fact, window).groupBy("ano_abertura").agg(_mean_capital()).orderBy("ano_abertura")


def period_totals(yearly: DataFrame, years: Period = WINDOW) -> DataFrame:
    """Openings, closings and net balance of a year range, from the yearly series."""
    chosen = yearly.where(years.holds_year(F.col("ano")))
    return chosen.agg(
        F.sum("aberturas").alias("total_aberturas"), F.sum("fechamentos").alias("total_fechamentos")
    ).withColumn("saldo", F.col("total_aberturas") - F.col("total_fechamentos"))


def yearly_flow_long(yearly: DataFrame, years: Period = WINDOW) -> DataFrame:
    chosen = yearly.where(years.holds_year(F.col("ano")))
    names = {"aberturas": "Aberturas", "fechamentos": "Fechamentos"}
    return to_long(chosen, ["ano"], names, "tipo", "quantidade")


# Geography


def by_state(fact: DataFrame, window: Period = WINDOW) -> DataFrame:
    measures = opened_in(fact, window).groupBy(STATE).agg(_total(), _active(), _mean_capital())
    return by_total(_active_share(measures), STATE)


def top_towns(fact: DataFrame, towns: DataFrame, n: int = 15, window: Period = WINDOW) -> DataFrame:
    counts = opened_in(fact, window).groupBy(TOWN).agg(_total())
    return by_total(describe(top_n(counts, n, TOWN), TOWN, towns, NOT_INFORMED), TOWN)


def top_towns_by_state(fact: DataFrame, towns: DataFrame, n: int = 5, window: Period = WINDOW) -> DataFrame:
    counts = opened_in(fact, window).groupBy(STATE, TOWN).agg(_total())
    ranked = describe(top_n_per_group(counts, n, STATE, TOWN), TOWN, towns, NOT_INFORMED)
    return ranked.orderBy(STATE, F.desc("total"), TOWN)


def state_shares(states: DataFrame) -> DataFrame:
    """Each state's percentage of the total, from ``by_state``."""
    return by_total(with_share(states.select(STATE, "total"), "total", "pct_total"), STATE)


def state_leader(states: DataFrame) -> DataFrame:
    """The leading state, its share and the number of states, from ``by_state``."""
    counted = states.withColumn("n_ufs", states.agg(F.count("*")).scalar())
    return top_n(with_share(counted, "total", "pct"), 1, STATE).select(STATE, "total", "pct", "n_ufs")


# Activities


def top_activities_detail(
    fact: DataFrame, activities: DataFrame, n: int = 20, window: Period = WINDOW
) -> DataFrame:
    measures = opened_in(fact, window).groupBy(ACTIVITY).agg(_total(), _active(), _mean_capital())
    leaders = _active_share(top_n(measures, n, ACTIVITY))
    return by_total(describe(leaders, ACTIVITY, activities, NO_DESCRIPTION), ACTIVITY)


def _of_top_activities(counts: DataFrame, n: int) -> DataFrame:
    """Rows of ``counts`` that belong to the ``n`` most common activities.

    Totals come from the counts themselves. For the fact to be read once, nothing may be pushed into one of the
    two uses of the counts: an inner join with the distinct leaders stays above the aggregation, where a
    semi-join would not, and the null-safe comparison implies no filter. The leaders, at most ``n`` rows
    and never null, are broadcast if ``n`` is small.
    """
    totals = counts.groupBy(ACTIVITY).agg(F.sum("total").alias("total"))
    leaders = top_n(totals, n, ACTIVITY).select(F.col(ACTIVITY).alias("_leader")).where(F.col("_leader").isNotNull())
    return counts.join(small(leaders, n), F.col(ACTIVITY).eqNullSafe(F.col("_leader"))).drop("_leader")


def activity_by_status(fact: DataFrame, activities: DataFrame, n: int = 10, window: Period = WINDOW) -> DataFrame:
    counts = opened_in(fact, window).groupBy(ACTIVITY, STATUS).agg(_total())
    described = describe(_of_top_activities(counts, n), ACTIVITY, activities, NO_DESCRIPTION)
    return described.withColumn("situacao_desc", _status_text()).orderBy(ACTIVITY, STATUS)


def activity_divisions(
    fact: DataFrame, activities: DataFrame, window: Period = WINDOW, divisor: int = 100_000
) -> DataFrame:
    """Every activity with its division (the leading digits of its code)."""
    counts = opened_in(fact, window).groupBy(ACTIVITY).agg(_total())
    described = describe(counts, ACTIVITY, activities, NO_DESCRIPTION)
    return by_total(described.withColumn("divisao_cnae", activity_division(F.col(ACTIVITY), divisor)), ACTIVITY)


def activity_evolution(fact: DataFrame, activities: DataFrame, n: int = 5, window: Period = WINDOW) -> DataFrame:
    """Openings per year of the ``n`` most common activities, with a legend of at most 30 characters."""
    counts = _with_opening_year(fact, window).groupBy("ano_abertura", ACTIVITY).agg(_total())
    described = describe(_of_top_activities(counts, n), ACTIVITY, activities, NO_DESCRIPTION)
    return described.withColumn("cnae_desc", ellipsize(F.col("descricao"), 30)).orderBy("ano_abertura", ACTIVITY)


def activity_leader(leaders: DataFrame) -> DataFrame:
    """The leading activity and its share of the listed ones, from ``top_activities_detail``."""
    shared = with_share(leaders, "total", "pct")
    return top_n(shared, 1, ACTIVITY).select(
        ACTIVITY, ellipsize(F.col("descricao"), 40, keep=40).alias("descricao"), "total", "pct"
    )
