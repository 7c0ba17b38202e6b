from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from cadastra.functions import formats
from cadastra.functions.cleansing import blank_to_null, clean_name, ellipsize, integer_list, money, strip, unsigned
from cadastra.functions.dates import Period, activity_division, month_of, month_start, year_of
from cadastra.schemas import SIZE_LABELS, STATUS_LABELS, U8, U16, U32, UNKNOWN


def evaluate(spark, kind, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_strip_knows_every_unicode_space(spark):
    spaces = [chr(c) for c in (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, 0x2003, 0x2029, 0x202F, 0x205F, 0x3000)]
    values = [f"{s}a b{s}" for s in spaces] + [None]
    assert evaluate(spark, "string", values, strip) == ["a b"] * len(spaces) + [None]


def test_blank_to_null(spark):
    assert evaluate(spark, "string", ["", "  ", "\xa0", "x", None], blank_to_null) == [None, None, None, "x", None]


@pytest.mark.parametrize("kind, top", [(U8, 255), (U16, 65_535), (U32, 4_294_967_295)])
def test_unsigned_range(spark, kind, top):
    values = [str(top), str(top + 1), "0", "-1", "0007", " 12\t", "1.0", "abc", "", None, "1 2"]
    expected = [top, None, 0, None, 7, 12, None, None, None, None, None]
    assert evaluate(spark, "string", values, lambda c: unsigned(c, kind)) == expected


def test_money(spark):
    values = ["1000,00", "0,5", "1.234,56", "1,2,3", "", "1d", "1f", "0x1p3", None, "-7,25", "12", "1e3"]
    expected = [1000.0, 0.5, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, -7.25, 12.0, 1000.0]
    assert evaluate(spark, "string", values, money) == expected


def test_clean_name(spark):
    values = [None, "NoNe", " null ", "", "\t", " Ana  Lú ", "NONESUCH"]
    assert evaluate(spark, "string", values, lambda c: clean_name(c, "?")) == ["?"] * 5 + ["Ana  Lú", "NONESUCH"]


def test_integer_list(spark):
    values = [None, "", "1,2", " 1 , ,2", "1,x", "4781400", ","]
    expected = [[], [], [1, 2], [1, 2], [], [4781400], []]
    assert evaluate(spark, "string", values, integer_list) == expected


@pytest.mark.parametrize("limit, keep", [(30, None), (35, None), (45, None), (50, None), (40, 40)])
def test_ellipsize_counts_characters(spark, limit, keep):
    kept = keep or limit - 3
    texts = ["ç" * (limit - 1), "ç" * limit, "ç" * (limit + 1)]
    result = evaluate(spark, "string", texts, lambda c: ellipsize(c, limit, keep))
    assert result == [texts[0], texts[1], "ç" * kept + "..."]


def test_date_parts(spark):
    assert evaluate(spark, "bigint", [20251231, 0, None, 20091300], year_of) == [2025, 0, None, 2009]
    assert evaluate(spark, "bigint", [20251231, 0, None, 20091300], month_of) == [12, 0, None, 13]
    assert evaluate(spark, "bigint", [4781400, 111301, None], activity_division) == [47, 1, None]


def test_month_start_rejects_impossible_months(spark):
    df = spark.createDataFrame([(0, 2009, 1), (1, 2009, 0), (2, 2009, 13), (3, 0, 5), (4, None, 5)], "i int, y int, m int")
    rows = df.orderBy("i").select(month_start(F.col("y"), F.col("m"))).collect()
    assert [r[0] for r in rows] == [datetime.date(2009, 1, 1), None, None, None, None]


def test_period_bounds(spark):
    values = [20081231, 20090000, 20090101, 20251231, 20260000, None]
    result = evaluate(spark, "bigint", values, Period().holds)
    assert result == [False, True, True, True, False, None]


def test_date_text(spark):
    values = [20100512, 0, None, 2010, 123456789]
    assert evaluate(spark, "bigint", values, formats.date_text) == ["12/05/2010", "—", "—", "2010", "123456789"]


def test_company_id(spark):
    df = spark.createDataFrame(
        [(0, 1234567, 1, 9), (1, 123456789, 12345, 100), (2, 77, None, 1), (3, 77, 1, None)],
        "i int, b bigint, o int, d int",
    )
    texts = df.orderBy("i").select(formats.company_id(F.col("b"), F.col("o"), F.col("d"))).collect()
    assert [t[0] for t in texts] == ["01.234.567/0001-09", "12.345.6789/12345-100", "00000077", "00000077"]


def test_postal_code(spark):
    assert evaluate(spark, "bigint", [1310100, 69900123, 0, None], formats.postal_code) == [
        "01310-100",
        "69900-123",
        "—-",
        "—-",
    ]


def test_number_texts(spark):
    values = [0.0, 1234567.891, -1234.5, 2.5, 0.125]
    swap = str.maketrans(",.", ".,")
    plain = [f"{v:,.2f}".translate(swap) for v in values]
    assert evaluate(spark, "double", values, lambda c: formats.number_text(c, 2)) == plain
    assert evaluate(spark, "double", values, formats.currency_text) == [f"R$ {t}" for t in plain]
    assert evaluate(spark, "double", values, formats.number_text) == [f"{v:,.0f}".translate(swap) for v in values]
    percents = [f"{v:.1f}%".replace(".", ",") for v in values]
    assert evaluate(spark, "double", values, formats.percent_text) == percents
    assert evaluate(spark, "bigint", [1234567], formats.number_text) == ["1.234.567"]


def test_labels(spark):
    result = evaluate(spark, "smallint", [1, 2, 8, 9, None], lambda c: formats.label(c, STATUS_LABELS, UNKNOWN))
    assert result == ["Nula", "Ativa", "Baixada", "Desconhecido", "Desconhecido"]
    assert evaluate(spark, "smallint", [0, 1], lambda c: formats.label(c, SIZE_LABELS, UNKNOWN)) == [
        "Não Informado",
        "Micro Empresa",
    ]


def test_share_guards_empty_whole(spark):
    df = spark.createDataFrame([(1, 4), (0, 0)], "a int, b int")
    assert [r[0] for r in df.select(formats.share(F.col("a"), F.col("b"))).collect()] == [25.0, 0.0]
