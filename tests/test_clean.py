from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from railmart import adapters
from railmart.operators import clean, quality
from railmart.operators.dims import keep_one
from tests.helpers import bag, rows

T = dt.datetime(2024, 1, 5, 8)


def table(spark, names, data, kinds=None):
    schema = ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds or ["STRING"] * len(names), strict=True))
    return spark.createDataFrame(data, schema)


def test_stations(spark):
    df = table(
        spark,
        ["Stop Name", "Borough", "GTFS-Latitude", "lon", "Daytime Routes", "seq"],
        [
            ("Times Square", "M", "40.756", "-73.987", "A C E", 1),
            (" penn station ", "Mn", "40.39", "-74.31", "1", 2),
            ("GRAND CENTRAL", "Manhattan", "x", "-73.7", None, 3),
            ("Penn Station", "Bk", "40.7", "-73.9", "9", 4),
            (None, "Q", "40.7", "-73.9", "9", 5),
            (None, "Q", "40.7", "-73.9", "9", 6),
        ],
        ["STRING"] * 5 + ["INT"],
    )
    stats = clean.CleaningStats()
    out = clean.clean_stations(df, "seq", stats)
    got = bag(out.select("station_name", "borough", "latitude", "longitude", "lines_served", "seq"))
    assert got == [
        ("Grand Central", "Manhattan", None, -73.7, None, 3),
        ("Penn Station", "Manhattan", None, None, "1", 2),
        ("Times Square", "Manhattan", 40.756, -73.987, "A,C,E", 1),
    ]

    assert stats.get() == {
        "total_records": 6, "cleaned_records": 3, "dropped_records": 1, "nulls_filled": 0, "duplicates_removed": 2,
    }


def test_first_present_column_wins_for_all_rows(spark):
    df = table(spark, ["station_name", "latitude", "lat"], [("A", None, "40.5")])
    assert rows(clean.clean_stations(df).select("latitude")) == [(None,)]


def test_plain_line_column_serves_as_routes(spark):
    df = table(spark, ["station_name", "line"], [("A", "8 Av")])
    assert rows(clean.clean_stations(df).select("lines_served")) == [("8 Av",)]


def test_ridership(spark):
    df = table(
        spark,
        ["transit timestamp", "station", "line", "total_entries", "exit", "seq"],
        [
            ("2024-01-05 08:00:00", " 5th av ", " a", "12", "-3", 2),
            ("2024-01-05 08:00:00", "5TH AV", "A ", "99", "1", 1),
            ("2024-01-05 09:30:15", "5th av", "a", "x", None, 3),
            ("never", "5th av", "a", "4", "4", 4),
        ],
        ["STRING"] * 5 + ["INT"],
    )
    stats = clean.CleaningStats()
    out = clean.clean_ridership(df, "seq", stats)
    got = rows(out.select("datetime", "date", "time", "hour", "station_name", "line_name", "entries", "exits").orderBy("datetime"))
    assert got == [
        (T, T.date(), "08:00:00", 8, "5Th Av", "A", 99.0, 1.0),
        (T.replace(hour=9, minute=30, second=15), T.date(), "09:30:15", 9, "5Th Av", "A", 0.0, 0.0),
    ]
    assert stats.get() == {
        "total_records": 4, "cleaned_records": 2, "dropped_records": 1, "nulls_filled": 3, "duplicates_removed": 1,
    }


def test_time_precedence(spark):
    df = table(spark, ["date", "datetime", "station_name"], [("2024-01-05", "2024-01-05 08:00:00", "A")])
    assert clean.clean_ridership(df).first().hour == 8
    assert clean.clean_ridership(df, time_columns=clean.RIDERSHIP_TIME_DATE_FIRST).first().hour == 0


def test_outliers_are_cut_to_the_limit(spark):
    import statistics

    entries = [100.0] * 20 + [100000.0]
    df = spark.createDataFrame([(v, 5.0) for v in entries], "entries DOUBLE, exits DOUBLE")
    out = clean.winsorise(df, ["entries", "exits"])
    limit = statistics.mean(entries) + 3 * statistics.stdev(entries)
    assert limit < 100000
    assert out.agg(F.max("entries"), F.min("entries"), F.max("exits")).first()[:] == pytest.approx((limit, 100.0, 5.0))


def test_delays(spark):
    df = table(
        spark,
        ["start_date", "end_date", "route", "cause", "seq"],
        [
            ("2024-01-05 08:00:00", "2024-01-05 08:12:30", " a", " signal ", 1),
            ("2024-01-05 08:00:00", "2024-01-05 09:12:30", "A", "signal", 2),
            ("2024-01-05 08:00:00", "2024-01-05 07:00:00", "B", "door", 3),
            ("2024-01-05 10:00:00", None, "C", None, 4),
            ("2024-01-05 10:00:00", "2024-01-05 10:40:00", "D", None, 5),
        ],
        ["STRING"] * 4 + ["INT"],
    )
    stats = clean.CleaningStats()
    out = clean.clean_delays(df, "seq", stats)
    got = rows(out.select("line_name", "delay_reason", "delay_duration_minutes", "delay_category", "severity_level").orderBy("line_name"))
    # The median counts every row before copies go: 0, 12.5, 40, 72.5.
    assert got == [
        ("A", "signal", 12.5, "Moderate", "Medium"),
        ("B", "door", 0.0, None, None),
        ("C", None, 26.25, None, None),
        ("D", None, 40.0, "Major", "High"),
    ]
    assert stats.get()["nulls_filled"] == 1
    assert stats.get()["duplicates_removed"] == 1


def test_delay_minutes_preferred_over_times(spark):
    df = table(spark, ["start_date", "end_date", "delay_minutes"], [("2024-01-05", "2024-01-06", "-4")])
    assert rows(clean.clean_delays(df).select("delay_duration_minutes", "delay_category")) == [(-4.0, None)]


@pytest.mark.parametrize(
    ("values", "expected"),
    [([0.5, 1.0, None], [50.0, 100.0, None]), ([0.5, 1.01, None], [0.5, 1.01, None]), ([None, None, None], [None, None, None])],
)
def test_percentages_rescale_as_a_whole(spark, values, expected):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, otp DOUBLE")
    assert [r.otp for r in clean.rescale_percentages(df, ["otp", "absent"]).orderBy("i").collect()] == expected


def test_performance_keeps_the_last(spark):
    df = table(
        spark,
        ["period_year", "period_month", "indicator_line", "scheduled_trips", "seq"],
        [("2024", "3", "a ", "10", 1), ("2024", "03", "A", "20", 2), ("2024", "x", "A", None, 3)],
        ["STRING"] * 4 + ["INT"],
    )
    out = clean.clean_performance(df, "seq").select("date", "line_name", "scheduled_trips", "seq")
    assert bag(out) == [(None, "A", 0, 3), (dt.date(2024, 3, 1), "A", 20, 2)]


def test_performance_period_text(spark):
    df = table(spark, ["period", "line"], [("2024-03-07", "a")])
    assert rows(clean.clean_performance(df).select("date", "line_name")) == [(dt.date(2024, 3, 7), "A")]


def test_first_copy_is_stable_under_repartition(spark):
    df = spark.range(4000).select((F.col("id") % 7).alias("k"), F.col("id").alias("seq"), F.xxhash64("id").alias("x"))
    answers = {tuple(bag(keep_one(df.repartition(n, "x"), ["k"], "seq").select("k", "seq"))) for n in (1, 3, 9)}
    assert answers == {tuple((k, k) for k in range(7))}
    last = {tuple(bag(keep_one(df.repartition(n, "x"), ["k"], "seq", last=True).select("seq"))) for n in (1, 9)}
    assert len(last) == 1


def test_copies_are_dropped_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    plan = keep_one(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
    assert "Window" not in plan


def test_clean_all_takes_what_is_there(spark):
    stats = {}
    out = clean.clean_all({"stations": table(spark, ["station_name"], [("a",)])}, stats=stats)
    assert list(out) == ["stations"] == list(stats)


def test_quality_report(spark):
    df = spark.createDataFrame(
        [(1.0, "a", None), (float("nan"), "a", None), (None, "b", None), (1.0, "a", None)], "x DOUBLE, y STRING, z INT"
    )
    valid, report = quality.quality_report(df, ["y", "w"])
    assert not valid
    assert report == {
        "total_records": 4,
        "total_columns": 3,
        "missing_required_cols": ["w"],
        "null_percentages": {"x": 50.0, "z": 100.0},
        "duplicate_count": 1,
        "issues": ["Missing required column: w", "High null rate (100.0%) in column: z"],
    }
    valid, report = quality.quality_report(df.select("x", "y"), ["y"])
    assert valid
    assert quality.quality_report(df.limit(0))[1]["duplicate_count"] == 0


def counted_in(stats):
    """Counters of the marked rows, which must equal those of the separate query."""
    before = stats.get()
    stats.count(stats.marked)
    assert stats.get() == before
    return stats.marked.filter(clean.KEPT).drop(*clean.MARKS)


@pytest.mark.parametrize("feed", ["stations", "ridership", "delays", "performance"])
def test_counters_of_marked_rows_equal_those_of_the_query(spark, small_data, feed):
    stats = clean.CleaningStats()
    out = clean.CLEANERS[feed](adapters.feed(spark, small_data, feed), "ingest_seq", stats)
    marked = counted_in(stats)
    assert marked.columns == out.columns and bag(marked) == bag(out)


def test_counters_of_marked_rows_without_keys_and_without_rows(spark):
    stats = clean.CleaningStats()
    out = clean.clean_ridership(table(spark, ["entries", "exits"], [("1", None), ("1", None), ("x", "2")]), None, stats)
    assert bag(counted_in(stats)) == bag(out) and stats.get()["nulls_filled"] == 3
    stats = clean.CleaningStats()
    clean.clean_delays(table(spark, ["line", "delay_minutes"], [("a", "1")]).filter("false"), None, stats)
    assert counted_in(stats).count() == 0 and set(stats.get().values()) == {0}
