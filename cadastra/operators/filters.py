"""Dashboard-style filters; an empty choice means no filter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.functions.dates import Period


def codes_of(labels: Mapping[int, str], chosen: Sequence[str]) -> list[int]:
    """Codes behind the chosen labels."""
    codes = {text: code for code, text in labels.items()}
    return [codes[text] for text in chosen]


def apply_filters(
    df: DataFrame,
    states: Sequence[str] = (),
    statuses: Sequence[int] = (),
    sizes: Sequence[int] = (),
    years: Period | None = None,
    activity: int | None = None,
) -> DataFrame:
    choices = {"uf": states, "situacao_cadastral": statuses, "porte_empresa": sizes}
    for column, chosen in choices.items():
        if chosen:
            df = df.where(F.col(column).isin(*chosen))
    if years is not None:
        df = df.where(years.holds(F.col("data_inicio_atividade")))
    if activity is not None:
        df = df.where(F.col("cnae_fiscal_principal") == activity)
    return df
