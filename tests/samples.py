"""Small invented registry rows and helpers shared by the tests."""

from __future__ import annotations

from cadastra.schemas import COMPANIES, ESTABLISHMENTS, FACT, PARTNERS, TAX_REGIME


def table(spark, schema, rows: list[dict]):
    return spark.createDataFrame([tuple(row.get(n) for n in schema.names) for row in rows], schema)


def fact(spark, rows: list[dict]):
    return table(spark, FACT, [{"capital_social": 0.0, **row} for row in rows])


def silver_tables(spark, simples, empresas, estabelecimentos, socios):
    return {
        "simples": table(spark, TAX_REGIME, simples),
        "empresas": table(spark, COMPANIES, empresas),
        "estabelecimentos": table(spark, ESTABLISHMENTS, estabelecimentos),
        "socios": table(spark, PARTNERS, socios),
    }


def plan_of(df) -> str:
    """Physical plan text."""
    from contextlib import redirect_stdout
    from io import StringIO

    out = StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
