"""Load checks: values lost by typing, keys that fan out, row counts per load stage."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from cadastra.functions.cleansing import blank_to_null, typed


def cast_loss_report(raw: DataFrame, schema: StructType) -> DataFrame:
    """(coluna, preenchidos, perdidos) per non-text column, from one pass over the raw text."""
    numeric = [f for f in schema.fields if not isinstance(f.dataType, StringType)]
    measures = []
    for field in numeric:
        given = blank_to_null(F.col(field.name)).isNotNull()
        measures.append(F.count_if(given).alias(f"{field.name}.given"))
        measures.append(F.count_if(given & typed(F.col(field.name), field.dataType).isNull()).alias(f"{field.name}.lost"))
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("coluna"),
                F.col(f"`{f.name}.given`").alias("preenchidos"),
                F.col(f"`{f.name}.lost`").alias("perdidos"),
            )
            for f in numeric
        ]
    )
    return raw.agg(*measures).select(F.inline(rows))


def fanout_report(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once and would multiply the rows of a join."""
    return df.groupBy(key).agg(F.count("*").alias("linhas")).where(F.col("linhas") > 1)


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """(etapa, linhas) for each named load stage; one parallel job for all of them."""
    counted = [df.agg(F.count("*").alias("linhas")).select(F.lit(name).alias("etapa"), "linhas") for name, df in stages.items()]
    report = counted[0]
    for one in counted[1:]:
        report = report.unionAll(one)
    return report


class Observed:
    """Row counts of load stages, taken while a job runs; nothing is read again for them."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, name: str, df: DataFrame) -> DataFrame:
        self._seen[name] = Observation(name)
        return df.observe(self._seen[name], F.count(F.lit(1)).alias("linhas"))

    def counts(self, spark: SparkSession) -> DataFrame:
        """(etapa, linhas), once an action on the stages has ended."""
        rows = [(name, seen.get["linhas"]) for name, seen in self._seen.items()]
        return spark.createDataFrame(rows, "etapa string, linhas long")


def schema_listing(df: DataFrame) -> DataFrame:
    """(posicao, coluna, tipo) of a table, without reading it."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "posicao int, coluna string, tipo string")
