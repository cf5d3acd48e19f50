"""Scalar key functions (B1-B22) on small frames."""

import pytest

from ledgerlake.functions import keys as K
from ledgerlake.functions import months as M


def one(spark, col, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col).collect()]


@pytest.mark.parametrize("raw", ["64380-201-01", "64380/201/01", "  64380 201 01  "])
def test_digits_key_separators(spark, raw):
    assert one(spark, K.digits_key("v"), [raw]) == ["6438020101"]


def test_digits_key_float_and_text_zero(spark):
    assert one(spark, K.digits_key("v", "double"), [6438020101.0], "v double") == ["6438020101"]
    assert one(spark, K.digits_key("v"), ["64380201.0"]) == ["64380201"]


def test_digits_key_leading_zero_and_blanks(spark):
    assert one(spark, K.digits_key("v"), ["00456", "0045-6"]) == ["00456", "00456"]
    assert one(spark, K.digits_key("v"), [None, "", "   "]) == [None, None, None]
    assert one(spark, K.digits_key("v", "double"), [float("nan"), None], "v double") == [None, None]


def test_text_and_ident_keys(spark):
    got = one(spark, K.text_key("v"), ["Bloodworth\tWholesale", "Bloodworth    Wholesale", "  genetco inc  ", "Genetco\tInc\n"])
    assert got == ["BLOODWORTH WHOLESALE", "BLOODWORTH WHOLESALE", "GENETCO INC", "GENETCO INC"]
    assert one(spark, K.ident_key("v"), ["  abC123  "]) == ["abC123"]


def test_clean_text_deletes_non_printables(spark):
    # NBSP and zero-width space are deleted (not turned into spaces)
    assert one(spark, K.clean_text("v"), ["a b​c", "x 　 y"]) == ["abc", "x y"]


def test_strip_trailing_zero_and_numbers(spark):
    assert one(spark, K.strip_trailing_zero("v"), ["+123.00", "1.0", "1.5", " 7 "]) == ["+123", "1", "1.5", "7"]
    got = one(spark, K.to_number("v"), ["12", " 3.5 ", "1d", "NaN", "abc", "-2e3"])
    assert got == [12.0, 3.5, None, None, None, -2000.0]
    assert one(spark, K.parse_number_text("v"), [" 1,056 ", " - ", "2,000.5"]) == [1056.0, None, 2000.5]


def test_cleaned_cells_are_evaluated_once(spark):
    """A cell's chain of regexes is there once, as a number and as text; odd cells come out as before."""
    from ledgerlake.operators import clean

    cells = ["+12.00", " 7\t", "1.50", "-3.0", "1.0.0", "x", "1e3", ".5", "5.", "+.0", "NaN", "1d", "\u0663.0", "\u0663", "", " ", None, "1e999"]
    df = spark.createDataFrame([(c, c) for c in cells], "n string, t string")
    out = clean.clean_columns(df, clean.CleanSpec(required=("n", "t"), numeric=("n",)))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("translate(") == 2
    got = {r.t: r.n for r in out.collect()}
    inf = float("inf")
    assert got == {"+12": 12.0, "7": 7.0, "1.50": 1.5, "-3": -3.0, "1.0.0": None, "x": None, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "+.0": 0.0, "NaN": None, "1d": None, "\u0663": None, None: None, "1e999": inf}
    numbers = spark.createDataFrame([(1.5, 1, True), (float("nan"), None, None)], "d double, i int, b boolean")
    assert [tuple(r) for r in numbers.select(K.to_number("d", "double"), K.to_number("i", "int"), K.to_number("b", "boolean")).collect()] == [(1.5, 1.0, 1.0), (None, None, None)]


def test_segment_key(spark):
    got = one(spark, K.segment_key("v", "-", (5, 3, 2), (5, 4, 2)), ["64380-161-01", "64380-1610-1", "6438016101", "x-161-01", None])
    assert got == ["64380016101", None, None, None, None]
    assert one(spark, K.segment_key("v", "-", (5, 4), (5, 4)), ["12345-6789"]) == ["123456789"]


def test_lookup_key(spark):
    df = spark.createDataFrame(
        [("64380-020-101", "Express Scripts"), ("64380020101", " EXPRESS   SCRIPTS "), (None, "Express Scripts"), (None, None)],
        "ndc string, cust string",
    )
    got = [r[0] for r in df.select(K.lookup_key("ndc", "cust")).collect()]
    assert got == ["64380020101EXPRESS SCRIPTS", "64380020101EXPRESS SCRIPTS", "EXPRESS SCRIPTS", None]


def test_compose_key(spark):
    df = spark.createDataFrame([("a", "1"), (None, "1"), (None, None)], "x string, y string")
    got = [r[0] for r in df.select(K.compose_key([K.text_key("x"), K.digits_key("y")])).collect()]
    assert got == ["A|1", "|1", None]


def test_keyword_flag_parity_and_whole_word(spark):
    vals = ["Tobacco leaf", "APAP 500", "hydrocodone", None, "Bac tablets"]
    assert one(spark, K.keyword_flag("v", ["BAC", "APAP"]), vals) == [True, True, False, False, True]
    assert one(spark, K.keyword_flag("v", ["BAC", "APAP"], whole_word=True), vals) == [False, True, False, False, True]


def test_lowered_in(spark):
    assert one(spark, K.lowered_in("v", ["y", "yes"]), [" Yes", "Y", "no", None]) == [True, True, False, False]


def test_meaning_tag(spark):
    got = one(spark, K.meaning_tag("v"), ["NDC Code", "Material Description", "Sold-to party", "Sales Order Qty", "PO Date", "Lookup", "Foo"])
    assert got[0].startswith("Potential National") and got[2].startswith("Potential customer") and got[-1] == "UNKNOWN"


def test_month_headers():
    assert M.parse_month_header(" Jul-26 ").year == 2026
    assert (M.parse_month_header("Sept-23").year, M.parse_month_header("Sept-23").month) == (2023, 9)
    assert (M.parse_month_header(" Dec 2024 ").year, M.parse_month_header(" Dec 2024 ").month) == (2024, 12)
    assert M.parse_month_header("Jul-225") is None
    assert M.parse_month_header(" Avg Jan'26 to June'26 ") is None
    found = M.discover_month_columns(["x", " Jul-26 ", "July 2026", "Aug-26"])
    assert found[(2026, 7)] == " Jul-26 "


def test_previous_months_and_labels():
    assert M.previous_months(2026, 5) == [(2026, 2), (2026, 3), (2026, 4)]
    assert M.previous_months(2026, 1) == [(2025, 10), (2025, 11), (2025, 12)]
    assert [M.month_label(m) for _, m in M.previous_months(2026, 10)] == ["Jul", "Aug", "Sep"]


def test_month_header_parts_column(spark):
    df = spark.createDataFrame([(" Jul-26 ",), ("Sept 2023",), ("Foo-22",)], "h string")
    got = [tuple(r[0]) for r in df.select(M.month_header_parts("h")).collect()]
    assert got == [(2026, 7), (2023, 9), (None, None)]


def test_as_text_float(spark):
    got = one(spark, K.as_text("v", "double"), [64380201.0, 1.5, None], "v double")
    assert got == ["64380201.0", "1.5", None]
