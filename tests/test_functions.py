from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions import cleaning, convert
from martloom.functions.convert import array_from_json, int_from_text
from martloom.functions.formats import format_cell, round_exact
from martloom.functions.money import halves, units, whole
from martloom.functions.names import clean_name, csv_name, sheet_headers, unique_names


@pytest.mark.parametrize("raw, want", [
    (" Net Sales (INR) ", "Net_Sales_INR"), ("a.b - c", "a_b_c"), ("2024 qty", "col_2024_qty"),
    ("!!", "unnamed_col"), ("", "unnamed_col"), ("naïve%", "nave"),
])
def test_clean_name(raw, want):
    assert clean_name(raw) == want


def test_other_names():
    assert clean_name("Order Id", lower=True) == "order_id"
    assert unique_names(["a", "A", "a", "b"]) == ["a", "A_2", "a_3", "b"]
    assert csv_name("Total (INR) - Net.") == "total_inr_net"
    assert sheet_headers([None, " a\n b ", ""]) == ["unnamed_0", "a b", "unnamed_2"]
    assert sheet_headers(["x", "y"], header_row=False) == ["col_0", "col_1"]


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_blank_tokens(spark):
    cells = ["", " ", "-", " N/A ", "na", "NULL", "#ref!", " #div / 0! ", "none", "ok", " x "]
    assert column(spark, cells, cleaning.blank_to_null) == [
        None, None, None, None, "na", "NULL", None, None, None, "ok", " x "
    ]


def test_numbers_and_flags(spark):
    texts = ["12.5", "13.5", "nan", "abc", None, "1e3"]
    assert column(spark, texts, convert.to_int) == [12, 14, None, None, None, 1000]
    assert column(spark, ["7.9", "-7.9", "", "x"], convert.int_from_text) == [7, -7, None, None]
    assert column(spark, ["true", "TRUE", "Y", "0", "maybe"], convert.to_bool) == [True, None, True, False, None]
    assert column(spark, ["TRUE", "on", None], convert.flag_from_text) == [True, False, None]
    assert column(spark, ["{a,b}", "c", None], convert.array_from_literal) == [["a", "b"], ["c"], None]
    assert column(spark, ["nan", "NaN", "x"], convert.to_text) == [None, "NaN", "x"]
    assert column(spark, ["1,234.5", "12%", "-"], cleaning.number_text) == [1234.5, 12.0, None]


def test_dates(spark):
    cells = ["45292", "45292.25", "19999", "2024-03-01", "1970-01-01", "bad", "60000"]
    assert column(spark, cells, cleaning.serial_to_timestamp) == [
        datetime(2024, 1, 1), datetime(2024, 1, 1, 6), None, datetime(2024, 3, 1), None, None,
        datetime(2064, 4, 8),
    ]
    assert column(spark, ["2024-03-01", "x"], convert.to_date) == [date(2024, 3, 1), None]


def test_formats(spark):
    value = [1234567.891, None]
    assert column(spark, value, lambda c: format_cell(c, "comma"), "double") == ["1,234,567.89", ""]
    assert column(spark, value, lambda c: format_cell(c, "lakh:1"), "double") == ["12.3L", ""]
    assert column(spark, value, lambda c: format_cell(c, "crore"), "double") == ["0.12Cr", ""]
    assert column(spark, value, lambda c: format_cell(c, "percent:0"), "double") == ["1234568%", ""]
    assert column(spark, value, lambda c: format_cell(c, "currency:x"), "double") == ["₹1,234,567.89", ""]
    assert column(spark, ["1,234", "7%"], lambda c: format_cell(c, "comma:1")) == ["1,234.0", "7.0"]
    with pytest.raises(ValueError, match="unknown format"):
        format_cell(F.lit(1), "yard")


def test_units_are_exact(spark):
    from decimal import Decimal as D

    values = [D("0.29"), D("-0.29"), D("9999999999999999.99"), D("90071992547409.93"), None]
    kind = "decimal(18,2)"
    assert column(spark, values, lambda c: units(c, 2), kind) == [
        29, -29, 999999999999999999, 9007199254740993, None
    ]
    assert column(spark, values, lambda c: whole(*halves(units(c, 2)), 2), kind) == values


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_totals_beyond_64_bits(spark, ansi):
    from decimal import Decimal as D

    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        top = D("9999999999999999.99")
        df = spark.range(20).select(F.lit(top).cast("decimal(18,2)").alias("v"))
        high, low = halves(units(F.col("v"), 2))
        once = df.agg(F.sum(high).alias("h"), F.sum(low).alias("l"))
        assert once.select(whole(F.col("h"), F.col("l"), 2)).first()[0] == 20 * top
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_ties_round_by_the_binary_value(spark):
    values = [0.125, 2.675, 1.005, 1.115, 0.375, -0.125, 1e300, 123456789.995, 0.0, 5e-324]
    for places in (0, 1, 2, 3):
        got = column(spark, values, lambda c: round_exact(c, places), "double")
        assert got == [float(f"{v:.{places}f}") for v in values]
    assert column(spark, [2.5, 3.5], lambda c: format_cell(c, "comma:0"), "double") == ["2", "4"]


def test_white_space_of_any_kind(spark):
    cells = ["\t", "\u00a0", " NA\n", "#N/A\u00a0", "\u2003x\u3000"]
    assert column(spark, cells, cleaning.blank_to_null) == [None, None, None, None, cells[4]]
    assert column(spark, cells, cleaning.keyword)[4] == "x"
    assert column(spark, ["\t7\n", "\u00a0"], int_from_text) == [7, None]


def test_broken_json_list_keeps_its_text(spark):
    got = column(spark, ["[a", '["a", "b"]', "a", None], array_from_json)
    assert got == [["[a"], ["a", "b"], ["a"], None]


def test_rows_and_columns(spark, rows):
    df = spark.createDataFrame([(None, None, None), (1, None, "x")], "a int, b int, c string")
    assert rows(cleaning.drop_all_null(df)) == [(1, "x")]
    ragged = spark.createDataFrame([(["a"],), (["a", "b", "c"],)], "cells array<string>")
    assert rows(ragged.select(*cleaning.fit_row(F.col("cells"), 2))) == [("a", "b"), ("a", None)]
    nested = spark.createDataFrame([([["p", "q"], ["q"], ["r", "p"]],)], "x array<array<string>>")
    assert rows(nested.select(cleaning.join_unique(F.col("x"), ";"))) == [("p;q;r",)]


def test_placeholders_touch_only_text(spark, rows):
    df = spark.createDataFrame([("NA", 1)], T.StructType.fromDDL("a string, b int"))
    assert rows(cleaning.null_placeholders(df)) == [(None, 1)]


def test_integers_keep_all_digits(spark):
    from pyspark.sql import functions as F

    from martloom.functions.convert import to_int

    texts = ["9007199254740993", "-9223372036854775808", "1234567890123456789.0", "2.5", "3.5", "1e3", "x", " 7 "]
    want = [9007199254740993, -9223372036854775808, 1234567890123456789, 2, 4, 1000, None, 7]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(to_int(F.col("t"))).collect()
    assert [r[0] for r in rows] == want
    longs = spark.createDataFrame([(9007199254740993,)], "n long").select(to_int(F.col("n"))).first()
    assert longs[0] == 9007199254740993
    doubles = spark.createDataFrame([(2.5,), (-3.5,), (float("nan"),)], "d double").select(to_int(F.col("d")))
    assert [r[0] for r in doubles.collect()] == [2, -4, None]
