from __future__ import annotations

import datetime as dt

import pytest

from railmart.operators import windows
from tests.helpers import bag, planned, rows


@pytest.fixture(scope="module")
def months(spark):
    """January, February and April."""
    data = [(dt.date(2024, 1, 1), 2024, 1, 100), (dt.date(2024, 2, 1), 2024, 2, 150), (dt.date(2024, 4, 1), 2024, 4, 75), (dt.date(2025, 2, 1), 2025, 2, 300)]
    return spark.createDataFrame(data, "month DATE, year INT, m INT, v BIGINT")


def test_previous_row_skips_a_gap(months):
    out = windows.change_from_previous_row(months, "v", ["year", "m"]).orderBy("month")
    assert rows(out.select("prev_v", "change_pct")) == [(None, None), (100, 50.0), (150, -50.0), (75, 300.0)]


def test_previous_calendar_month_sees_a_gap(months):
    out = windows.change_from_month(months, "v", "month", 1).orderBy("month")
    assert rows(out.select("prev_v", "change_pct")) == [(None, 0.0), (100, 50.0), (None, 0.0), (None, 0.0)]


def test_year_before(months):
    out = windows.change_from_month(months, "v", "month", 12).orderBy("month")
    assert rows(out.select("prev_v", "change_pct"))[-1] == (150, 100.0)


def test_missing_group_lines_up(spark):
    data = [(None, dt.date(2024, 1, 1), 10), (None, dt.date(2024, 2, 1), 30), ("a", dt.date(2024, 2, 1), 5)]
    df = spark.createDataFrame(data, "g STRING, month DATE, v BIGINT")
    out = windows.change_from_month(df, "v", "month", 1, ["g"]).filter("g IS NULL").orderBy("month")
    assert rows(out.select("prev_v", "change_pct")) == [(None, 0.0), (10, 200.0)]


@pytest.fixture(scope="module")
def days(spark):
    data = [(dt.date(2023, 12, 31), 7), (dt.date(2024, 1, 1), 10), (dt.date(2024, 1, 3), 20), (dt.date(2024, 1, 8), 60)]
    return spark.createDataFrame(data, "day DATE, v BIGINT")


def test_rolling_mean_counts_calendar_days(days):
    out = windows.rolling_mean(days, "v", "day", 7, "avg").orderBy("day")
    assert [r.avg for r in out.collect()] == [7.0, 8.5, pytest.approx(37 / 3), 40.0]


def test_year_to_date_restarts(days):
    out = windows.year_to_date(days, "v", "day", "ytd").orderBy("day")
    assert [r.ytd for r in out.collect()] == [7, 10, 30, 90]


def test_trend_line(spark):
    data = [(dt.date(1970, 1, 1) + dt.timedelta(days=i), 5 + 3 * i) for i in range(10)]
    df = spark.createDataFrame(data, "day DATE, v BIGINT")
    assert windows.trend_line(df, "v", "day").first()[:] == pytest.approx((3.0, 5.0, 10))


@pytest.mark.parametrize("n", [0, 1, 3, 500])
def test_a_total_beside_each_row(spark, n):
    """Rows with null and repeated keys and null values count; no task holds all rows and the input is read once."""
    data = [(None if k % 7 == 3 else f"r{k // 2}", None if k % 5 == 4 else k) for k in range(n)]
    given = spark.createDataFrame(data, "reason STRING, v BIGINT")
    out = windows.with_total(given, "v", "total", ["reason"])
    assert out.columns == ["reason", "v", "total"]
    whole = sum(v for _, v in data if v is not None) if n else None
    assert bag(out) == sorted([(*r, whole) for r in data], key=repr)
    plan = planned(windows.with_total(given, "v", "total", ["reason"]))
    assert "SinglePartition" not in plan and "Subquery" not in plan and "Join" not in plan
