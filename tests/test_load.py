from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from railmart import full_load
from railmart.operators import clean, dims, load
from railmart.schemas import DIM_STATIONS, FACT_PERFORMANCE, read_schema
from tests.helpers import bag, rows

DAY = dt.date(2024, 1, 5)


def star_dims(spark):
    lines = spark.createDataFrame([(1, "A"), (2, "B"), (9, "A")], "line_id BIGINT, line_name STRING")
    stations = spark.createDataFrame([(10, "Penn"), (11, "Canal")], "station_id BIGINT, station_name STRING")
    return lines, stations


def test_ridership_lookups_and_keys(spark):
    lines, stations = star_dims(spark)
    df = spark.createDataFrame(
        [(DAY, 8, "Penn", "A", 5.9, 1.0), (DAY, 0, "Nowhere", "SIR", 2.0, 2.0), (None, 8, "Penn", "A", 1.0, 1.0), (DAY, 9, None, None, 1.0, None)],
        "date DATE, hour INT, station_name STRING, line_name STRING, entries DOUBLE, exits DOUBLE",
    )
    out = load.load_ridership(df, lines, stations, source="sample")
    got = bag(out.select("date_key", "time_key", "station_id", "line_id", "entries", "exits", "total_traffic", "data_source"))
    assert got == sorted(
        [
            (20240105, 800, 10, 1, 5, 1, 6, "sample"),
            (20240105, 0, None, None, 2, 2, 4, "sample"),
            (20240105, 900, None, None, 1, 0, 1, "sample"),
        ],
        key=repr,
    )
    assert out.select("ridership_id").distinct().count() == 3
    large = load.load_ridership(df, lines, stations, source="sample", small=frozenset())
    assert bag(large.drop("ridership_id", "created_at")) == bag(out.drop("ridership_id", "created_at"))


def test_ids_continue_after_the_existing_rows(spark):
    lines, stations = star_dims(spark)
    df = spark.createDataFrame([(DAY, 8, "Penn", "A", 5, 1)] * 3, "date DATE, hour INT, station_name STRING, line_name STRING, entries INT, exits INT")
    first = load.load_ridership(df, lines, stations)
    second = load.load_ridership(df, lines, stations, existing=spark.createDataFrame([(100,)], "ridership_id BIGINT"))
    assert second.agg(F.min("ridership_id")).first()[0] > 100
    assert first.agg(F.min("ridership_id")).first()[0] >= 1


def test_delay_defaults(spark):
    lines, stations = star_dims(spark)
    df = spark.createDataFrame(
        [(DAY, dt.datetime(2024, 1, 5, 8, 59), "B", "Canal", None, None, None)],
        "date DATE, incident_datetime TIMESTAMP_NTZ, line_name STRING, station_name STRING, delay_category STRING, severity_level STRING, delay_duration_minutes DOUBLE",
    )
    got = rows(
        load.load_delays(df, lines, stations).select(
            "date_key", "time_key", "line_id", "station_id", "delay_duration_minutes", "delay_category", "delay_reason",
            "severity_level", "passenger_impact_estimate", "is_resolved", "resolution_time_minutes",
        )
    )
    assert got == [(20240105, 800, 2, 11, 0, "Unknown", "", "Medium", 0, True, None)]


def test_delay_hour_from_time_text_and_carried_columns(spark):
    lines, stations = star_dims(spark)
    df = spark.createDataFrame(
        [(DAY, "17:45:00", "B", "Canal", False, 12)],
        "date DATE, time STRING, line_name STRING, station_name STRING, is_resolved BOOLEAN, resolution_time_minutes INT",
    )
    got = load.load_delays(df, lines, stations).select("time_key", "is_resolved", "resolution_time_minutes")
    assert rows(got) == [(1700, False, 12)]


def performance(spark, data):
    return spark.createDataFrame(
        data, "date DATE, line_name STRING, scheduled_trips INT, actual_trips INT, on_time_trips INT, late_trips INT, canceled_trips INT, seq INT"
    )


MEASURES = ["date_key", "line_id", "scheduled_trips", "actual_trips", "on_time_trips", "late_trips", "canceled_trips", "on_time_percentage"]


def test_performance_upsert(spark):
    lines, _ = star_dims(spark)
    empty = spark.createDataFrame([], read_schema(FACT_PERFORMANCE))
    batch = [
        (DAY, "A", 10, 9, 8, 1, 1, 1),
        (DAY, "A", 20, 19, 18, 2, 2, 2),
        (DAY, "SIR", 3, 3, 3, 0, 0, 3),
        (DAY, "SIR", 4, 4, 1, 0, 0, 4),
        (DAY, "B", 0, 0, 0, 0, 0, 5),
    ]
    first = load.load_performance(performance(spark, batch), lines, empty, "seq")
    key = 20240105
    as_floats = [F.col(c).cast("double") if c == "on_time_percentage" else F.col(c) for c in MEASURES]
    assert bag(first.select(*as_floats)) == sorted(
        [(key, 1, 20, 19, 18, 2, 2, 90.0), (key, 2, 0, 0, 0, 0, 0, 0.0), (key, None, 3, 3, 3, 0, 0, 100.0), (key, None, 4, 4, 1, 0, 0, 25.0)],
        key=repr,
    )
    stored = first.collect()
    assert len({r.performance_id for r in stored}) == 4
    old = spark.createDataFrame(stored, read_schema(FACT_PERFORMANCE))
    change = performance(spark, [(DAY, "A", 40, 39, 10, 7, 7, 1), (DAY, "SIR", 9, 9, 9, 9, 9, 2)])
    second = load.load_performance(change, lines, old, "seq")
    got = bag(second.select(*as_floats))
    assert (key, 1, 40, 39, 10, 2, 2, 25.0) in got
    assert len(got) == 5
    everything = bag(load.load_performance(change, lines, old, "seq", update="all").select(*as_floats))
    assert (key, 1, 40, 39, 10, 7, 7, 25.0) in everything
    assert second.select("performance_id").distinct().count() == 5


def test_layout_keeps_rows_and_narrows_files(spark, tmp_path):
    # Half of all rows fall on one day.
    days = F.when(F.col("id") % 2 == 0, 20240101).otherwise(20240101 + F.col("id") % 28).cast("int")
    rides = spark.range(0, 4000, 1, 8).select(
        F.col("id").alias("ridership_id"), days.alias("date_key"), (F.col("id") % 1440).cast("int").alias("time_key"),
        (F.col("id") % 50).alias("station_id"),
    )
    out = load.laid_out(rides, "ridership_id").write.mode("overwrite")
    out.option("compression", "none").parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    assert stored.columns == rides.columns
    assert stored.select("ridership_id").distinct().count() == 4000
    assert bag(stored.drop("ridership_id")) == bag(rides.drop("ridership_id"))


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id BIGINT, k STRING, v INT")
    new = spark.createDataFrame([("b", 7), ("c", 8)], "k STRING, v INT")
    once = load.upsert(old, new, ["k"], ["v"], serial="id")
    twice = load.upsert(once, new, ["k"], ["v"], serial="id")
    assert bag(once) == bag(twice)
    assert bag(once.select("k", "v")) == [("a", 5), ("b", 7), ("c", 8)]


def test_stations_update_only_listed_columns(spark):
    stamp = dt.datetime(2020, 1, 1)
    old = spark.createDataFrame(
        [(1, "Penn", "Old", "X", True, stamp, stamp)],
        "station_id BIGINT, station_name STRING, borough STRING, lines_served STRING, ada_accessible BOOLEAN, created_at TIMESTAMP, updated_at TIMESTAMP",
    )
    feed = spark.createDataFrame(
        [("Penn", "Manhattan", float("nan"), "A,C", 1), ("Penn", "Queens", 40.5, "A,C", 2), ("Canal", "Manhattan", 40.7, "J", 3), (None, "Bronx", 40.7, "J", 4)],
        "station_name STRING, borough STRING, latitude DOUBLE, lines_served STRING, seq INT",
    )
    out = load.load_stations(feed, old, "seq")
    assert out.columns == list(DIM_STATIONS)
    penn, canal = out.orderBy(F.desc("station_name")).collect()
    assert (penn.station_id, penn.borough, float(penn.latitude), penn.lines_served, penn.ada_accessible) == (1, "Queens", 40.5, "X", True)
    assert penn.created_at == stamp
    assert penn.updated_at > stamp
    assert (canal.station_name, canal.ada_accessible, canal.station_id > 1) == ("Canal", False, True)


def test_daily_summary(spark):
    times = dims.time_dimension(spark)
    rides = spark.createDataFrame(
        [(20240105, 800, 1, 1, 10, 1), (20240105, 815, 1, 1, 5, 1), (20240105, 1200, 1, 1, 5, 1), (20240105, None, 1, None, 3, 1)],
        "date_key INT, time_key INT, station_id BIGINT, line_id BIGINT, entries INT, exits INT",
    )
    out = load.daily_summary(rides, times).select("line_id", "total_entries", "peak_hour_entries", "off_peak_entries", F.col("avg_entries_per_hour").cast("double"))
    assert bag(out) == [(1, 20, 15, 5, 10.0), (None, 3, 0, 3, None)]


def test_date_dimension(spark):
    df = dims.date_dimension(spark, dt.date(2024, 6, 30), dt.date(2024, 7, 1))
    assert [r.date_key for r in df.orderBy("date_key").collect()] == [20240630, 20240701]
    sunday = df.orderBy("date_key").first()
    assert (sunday.day_of_week, sunday.day_name, sunday.week_of_year, sunday.is_weekend) == (0, "Sunday", 26, True)
    assert (sunday.is_holiday, sunday.holiday_name, sunday.fiscal_year, sunday.fiscal_quarter) == (False, None, 2024, 4)
    named = spark.createDataFrame([(dt.date(2024, 7, 1), "Canada Day")], "full_date DATE, holiday_name STRING")
    monday = dims.date_dimension(spark, dt.date(2024, 7, 1), dt.date(2024, 7, 1), named).first()
    assert (monday.is_holiday, monday.holiday_name, monday.fiscal_year, monday.fiscal_quarter) == (True, "Canada Day", 2025, 1)


def test_time_dimension(spark):
    df = dims.time_dimension(spark)
    assert df.count() == 1440
    got = {r.time_key: (r.full_time, r.hour_12, r.am_pm, r.time_period, r.is_peak_hour, r.peak_type) for r in df.collect()}
    assert got[0] == ("00:00:00", 12, "AM", "Late Night", False, None)
    assert got[959] == ("09:59:00", 9, "AM", "Morning Rush", True, "Morning")
    assert got[1200] == ("12:00:00", 12, "PM", "Midday", False, None)
    assert got[1600] == ("16:00:00", 4, "PM", "Evening Rush", True, "Evening")
    assert got[2359] == ("23:59:00", 11, "PM", "Night", False, None)


def test_line_dimension(spark):
    df = dims.line_dimension(spark)
    assert df.count() == 23 == df.select("line_name").distinct().count()
    assert df.filter("line_name = 'S'").first().service_pattern == "Shuttle"


def test_insert_absent_keeps_existing_rows(spark):
    old = spark.createDataFrame([(1, "old")], "k INT, v STRING")
    new = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k INT, v STRING")
    assert bag(dims.insert_absent(old, new, ["k"], "v")) == [(1, "old"), (2, "a")]


def test_length_limits(spark):
    df = spark.createDataFrame([("abc",), ("ab",)], "v STRING")
    assert bag(df.select("v", load.check_lengths(df, {"v": 2, "w": 1}))) == [("ab", None), ("abc", "v longer than 2")]


@pytest.mark.parametrize("junk", ["1e30", "3000000000", "x"])
def test_one_junk_number_does_not_stop_a_load(spark, junk):
    feed = spark.createDataFrame(
        [("2024-01-01 08:00:00", "A", "1", junk, "4"), ("2024-01-01 09:00:00", "A", "1", "5", "6")],
        "transit_timestamp string, station string, line string, entries string, exits string",
    )
    lines = spark.createDataFrame([(1, "1")], "line_id long, line_name string")
    stations = spark.createDataFrame([(7, "A")], "station_id long, station_name string")
    rows = load.load_ridership(clean.clean_ridership(feed), lines, stations).orderBy("time_key").collect()
    assert [r.exits for r in rows] == [4, 6] and rows[1].entries == 5


def test_two_days_and_a_repeat_in_one_folder(spark, tmp_path):
    def feeds(day):
        rides = [(f"2024-0{day}-01 0{h}:00:00", "A", "1", str(h), "2") for h in range(1, 4)]
        late = [(f"2024-0{day}-01", "1", "signal", "12", "A"), (f"2031-0{day}-01", "1", "signal", "3", "A")]
        return {
            "stations": spark.createDataFrame([("A", "M")], "stop_name string, borough string"),
            "ridership": spark.createDataFrame(rides, "transit_timestamp string, station string, line string, entries string, exits string"),
            "delays": spark.createDataFrame(late, "start_date string, route string, cause string, delay_minutes string, station_name string"),
        }

    folder = str(tmp_path / "star")
    for day in (1, 2, 2):
        result = full_load.run(spark, feeds(day), folder)
        assert result["status"] == "completed", result
    assert result["tables_loaded"]["ridership"] == 0
    for table, serial, n in (("fact_ridership", "ridership_id", 6), ("fact_delays", "delay_id", 4)):
        rows = full_load.read_table(spark, folder, table)
        assert rows.count() == rows.select(serial).distinct().count() == n
    dates = spark.read.parquet(f"{folder}/dim_date")
    assert full_load.read_table(spark, folder, "fact_delays").join(dates, "date_key", "left_anti").count() == 0
    assert full_load.read_table(spark, folder, "dim_stations").count() == 1
