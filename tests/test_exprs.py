import datetime as dt

from pyspark.sql import functions as F

from claimsmith.functions import exprs as X

D = dt.date


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_strict_greatest_least_null(spark):
    rows = [(D(2020, 1, 5), D(2020, 1, 1)), (None, D(2020, 1, 1)), (D(2020, 1, 5), None)]
    schema = "a date, b date"
    assert one(spark, X.strict_greatest("a", "b"), rows, schema) == [D(2020, 1, 5), None, None]
    assert one(spark, X.strict_least("a", "b"), rows, schema) == [D(2020, 1, 1), None, None]


def test_months_crossed_counts_boundaries(spark):
    rows = [(D(2024, 1, 31), D(2024, 2, 1)), (D(2024, 1, 1), D(2024, 1, 31)), (D(2023, 12, 31), D(2025, 1, 1))]
    assert one(spark, X.months_crossed("a", "b"), rows, "a date, b date") == [1, 0, 13]


def test_years_crossed(spark):
    assert one(spark, X.years_crossed("a", "b"), [(D(2000, 12, 31), D(2001, 1, 1))], "a date, b date") == [1]


def test_try_number_and_text(spark):
    rows = [("0170",), ("170.6",), ("ABC",), (None,)]
    got = one(spark, X.number_text(X.try_number("s")), rows, "s string")
    assert got == ["170", "171", None, None]


def test_bracket_text_null_when_absent(spark):
    rows = [("[HIGH] x",), ("no bracket",), ("[] empty",)]
    assert one(spark, X.bracket_text("t"), rows, "t string") == ["HIGH", None, ""]


def test_event_id_and_null(spark):
    rows = [("12", D(2001, 2, 3)), (None, D(2001, 2, 3))]
    assert one(spark, X.event_id("m", "d"), rows, "m string, d date") == ["1220010203", None]


def test_yyyymm_bad_text_is_null(spark):
    assert one(spark, X.yyyymm_to_date("ym"), [("200102",), ("20x102",)], "ym string") == [D(2001, 2, 1), None]


def test_code_between_is_lexicographic(spark):
    rows = [("0100",), ("021",), ("0211",), ("1",)]
    assert one(spark, X.code_between("c", "0100", "0210"), rows, "c string") == [True, True, False, False]
