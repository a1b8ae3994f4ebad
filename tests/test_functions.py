from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from railmart.functions import bins, calendar, numbers, text
from tests.helpers import rows, values


def frame(spark, items, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i INT, v {kind}").orderBy("i")


def test_title_case_after_every_non_letter(spark):
    names = [" TIMES square-42nd st ", "o'neil", "\tPENN  station\n", "161ST st", "", None, "ÉCOLE d'été"]
    df = frame(spark, names).withColumn("v", text.clean_name(F.col("v")))
    assert values(df) == ["Times Square-42Nd St", "O'Neil", "Penn  Station", "161St St", "", None, "École D'Été"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="abC XYz-'0123.\t", max_size=20), min_size=40, max_size=40))
def test_title_case_matches_python(spark, names):
    df = frame(spark, names).withColumn("v", text.clean_name(F.col("v")))
    assert values(df) == [n.strip().title() for n in names]


def test_boroughs(spark):
    names = ["M", " mn", "BK", "q", "Qn", "bx", "SI", "manhattan", "Elsewhere", None]
    df = frame(spark, names).withColumn("v", text.borough_name(F.col("v")))
    assert values(df) == [
        "Manhattan", "Manhattan", "Brooklyn", "Queens", "Queens", "Bronx", "Staten Island", "Manhattan", "Elsewhere", None,
    ]


def test_routes_and_codes(spark):
    df = frame(spark, ["A C E", "7", None])
    assert values(df.withColumn("v", text.route_list(F.col("v")))) == ["A,C,E", "7", None]
    assert values(frame(spark, [" a ", "sir"]).withColumn("v", text.clean_code(F.col("v")))) == ["A", "SIR"]


def test_text_key(spark):
    import hashlib

    df = frame(spark, ["Penn Station"]).withColumn("v", text.text_key(F.col("v")))
    assert values(df) == [hashlib.md5(b"Penn Station").hexdigest()[:8].upper()]


def test_numbers_as_text(spark):
    df = frame(spark, ["12", "x", "", None, "-3", "1.5", "NaN", "inf", " 7 "])
    assert values(df.withColumn("v", numbers.to_number(F.col("v")))) == [12, None, None, None, -3, 1.5, None, None, 7]
    positive = df.withColumn("v", numbers.non_negative(numbers.to_number(F.col("v"))))
    assert values(positive) == [12, None, None, None, None, 1.5, None, None, 7]


def test_bounds_are_inclusive(spark):
    df = frame(spark, [40.39, 40.4, 41.0, 41.01], "double")
    assert values(df.withColumn("v", numbers.within(F.col("v"), 40.4, 41.0))) == [None, 40.4, 41.0, None]


@pytest.mark.parametrize(
    ("num", "den", "scale", "times", "expected"),
    [(1, 8, 2, 1, 0.13), (201, 20000, 2, 100, 1.01), (1, 3, 2, 100, 33.33), (5, 0, 2, 100, None), (None, 2, 2, 1, None), (-1, 8, 2, 1, -0.13), (5, 2, 0, 1, 3.0)],
)
def test_rounding_is_half_up_on_exact_ties(spark, num, den, scale, times, expected):
    df = spark.createDataFrame([(num, den)], "a BIGINT, b BIGINT")
    assert rows(df.select(numbers.rounded_ratio(F.col("a"), F.col("b"), scale, times))) == [(expected,)]


def test_safe_division(spark):
    df = spark.createDataFrame([(6, 3), (6, 0), (6, None), (None, 3)], "a INT, b INT")
    assert [r[0] for r in rows(df.select(numbers.divide_or_zero(F.col("a"), F.col("b"))))] == [2, 0, 0, 0]


DURATIONS = [-1, 0, 1, 5, 6, 10, 11, 15, 16, 30, 31, 60, 61, None]


def test_category_edges(spark):
    df = frame(spark, DURATIONS, "int").withColumn("v", bins.delay_category(F.col("v")))
    assert values(df) == [
        None, None, "Minor", "Minor", "Moderate", "Moderate", "Moderate", "Moderate", "Significant", "Significant",
        "Major", "Major", "Severe", None,
    ]


def test_severity_edges(spark):
    df = frame(spark, DURATIONS, "int")
    assert values(df.withColumn("v", bins.delay_severity(F.col("v")))) == [
        None, None, "Low", "Low", "Low", "Low", "Medium", "Medium", "Medium", "Medium", "High", "High", "High", None,
    ]
    assert values(df.withColumn("v", bins.delay_severity(F.col("v"), "sample"))) == [
        "Low", "Low", "Low", "Low", "Medium", "Medium", "Medium", "Medium", "Medium", "Medium", "High", "High", "High", None,
    ]


def test_performance_bands(spark):
    df = frame(spark, [95.0, 90.0, 89.9, 80.0, 70.0, 69.9, None], "double")
    assert values(df.withColumn("v", bins.performance_band(F.col("v")))) == [
        "Excellent", "Excellent", "Good", "Good", "Fair", "Needs Improvement", "Needs Improvement",
    ]


def test_times_from_many_layouts(spark):
    items = ["2024-03-05", "2024-03-05 07:08:09", "2024-03-05T07:08:09.000", "3/5/2024", "03/05/2024 07:08:09", "soon", None]
    df = frame(spark, items).withColumn("v", calendar.to_datetime(F.col("v")))
    day, second = dt.datetime(2024, 3, 5), dt.datetime(2024, 3, 5, 7, 8, 9)
    assert values(df) == [day, second, second, day, second, None, None]


def test_keys_and_fiscal_year(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 30),), (dt.date(2024, 7, 1),), (dt.date(2025, 1, 5),)], "d DATE")
    got = rows(df.select(calendar.date_key(F.col("d")), calendar.fiscal_year(F.col("d")), calendar.fiscal_quarter(F.col("d")), calendar.is_weekend(F.col("d"))))
    assert got == [(20240630, 2024, 4, True), (20240701, 2025, 1, False), (20250105, 2025, 3, True)]


def test_first_of_month(spark):
    df = spark.createDataFrame([("2024", "3"), ("2024", "13"), (None, "3"), ("2024", "12")], "y STRING, m STRING")
    got = [r[0] for r in rows(df.select(calendar.first_of_month(F.col("y"), F.col("m"))))]
    assert got == [dt.date(2024, 3, 1), None, None, dt.date(2024, 12, 1)]
