"""Joins the silver tables into the 39-column fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.functions.cleansing import money
from cadastra.operators.keyset import maybe_among
from cadastra.operators.quality import Observed
from cadastra.operators.skew import salted_join, sliced_left_join
from cadastra.schemas import COMPANY_COLUMNS, FACT, PARTNER_COLUMNS

KEY = "cnpj_basico"


def opted_in_keys(tax_regime: DataFrame, repeated: bool = True) -> DataFrame:
    """Companies that chose the micro-entrepreneur regime, each once unless ``repeated`` is off.

    A semi-join does not need unique keys. Without the aggregation Spark can derive a runtime Bloom
    filter from the regime flags and drop other companies' establishments before their shuffle; with it,
    a key that is repeated very often collapses before the shuffle.
    """
    keys = tax_regime.where(F.col("opcao_pelo_mei") == "S").select(KEY)
    return keys.distinct() if repeated else keys


def opted_in_companies(
    companies: DataFrame, keys: DataFrame, extra: Sequence[str] = (), hot: dict | None = None
) -> DataFrame:
    kept = companies.select(KEY, *COMPANY_COLUMNS, *extra).withColumn("capital_social", money(F.col("capital_social")))
    return salted_join(kept, keys, KEY, "left_semi", hot)


def opted_in_partners(partners: DataFrame, keys: DataFrame, hot: dict | None = None) -> DataFrame:
    return salted_join(partners.select(KEY, *PARTNER_COLUMNS), keys, KEY, "left_semi", hot)


def opted_in_establishments(establishments: DataFrame, keys: DataFrame, hot: dict | None = None) -> DataFrame:
    return salted_join(maybe_among(establishments, keys, KEY), keys, KEY, "left_semi", hot)


def with_partners(
    companies: DataFrame, partners: DataFrame | None, hot_partners: dict | None = None, hot_companies: dict | None = None
) -> DataFrame:
    """Companies with the data of each of their partners, or with nulls; ``None`` stands for no partner table."""
    if partners is None:
        return companies.select("*", *[F.lit(None).cast(FACT[n].dataType).alias(n) for n in PARTNER_COLUMNS])
    return sliced_left_join(companies, partners.select(KEY, *PARTNER_COLUMNS), KEY, hot_partners, hot_companies)


def of_companies(
    establishments: DataFrame,
    owners: DataFrame,
    hot: dict | None = None,
    hot_owners: dict | None = None,
    tasks: int | None = None,
    hashed: bool = False,
) -> DataFrame:
    """Establishments with the data of their companies; those of other companies go. ``hashed`` says that the owners one task
    gets fit its memory, so that establishments, which are many and wide, need not be sorted."""
    if hashed and not hot and not hot_owners:
        owners = owners.hint("shuffle_hash")
    return salted_join(establishments, owners, KEY, "inner", hot, hot_owners, tasks)


def build_fact(
    tax_regime: DataFrame,
    companies: DataFrame,
    establishments: DataFrame,
    partners: DataFrame | None,
    hot: dict | None = None,
    hot_partners: dict | None = None,
    hot_flags: dict | None = None,
    hot_companies: dict | None = None,
    names: bool = False,
    observed: Observed | None = None,
    derived: bool = False,
    tasks: int | None = None,
    hashed: bool = False,
) -> DataFrame:
    """Establishments of opted-in companies with company data and, where known, partner data.

    Keys, companies and partners share one partitioning by company, so they meet without further
    exchanges; the establishments, by far the largest table, are shuffled once. Joining partners to
    companies first gives the same rows as joining them last. Where establishments are themselves ``derived`` from joins of
    other tables, they meet the flags of the keys first, which are broadcast: Spark then drops the rows of other companies
    below those joins, however many keys there are; the join with the companies is exact. ``tasks`` is the number of tasks that
    join the establishments, if the session's is too small for them (see ``tasks_for``); ``hashed`` see ``of_companies``. ``hot``,
    ``hot_partners``, ``hot_flags`` and ``hot_companies`` (see ``hot_keys``) list companies whose establishments,
    partners, regime rows or company rows are too many for one task.

    A company with k partners yields each establishment k times. ``names`` adds ``razao_social`` as a
    40th column, for the company documents. ``observed`` counts companies and fact rows while the job runs.
    """
    watch = observed.watch if observed else lambda name, df: df
    keys = opted_in_keys(tax_regime, repeated=bool(hot_flags))
    extra = ["razao_social"] if names else []
    # The keys have already reduced the companies when the partners join them.
    chosen = watch("empresas", opted_in_companies(companies, keys, extra, hot_companies))
    owners = with_partners(chosen, partners, hot_partners, hot_companies)
    counts = [hot_partners or {}, hot_companies or {}]
    hot_owners = {k: max(c.get(k, 1) for c in counts) for c in counts for k in c}
    if derived:
        establishments = maybe_among(establishments, keys, KEY)
    return watch("fato", of_companies(establishments, owners, hot, hot_owners, tasks, hashed).select(*FACT.names, *extra))
