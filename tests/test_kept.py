"""Kept results: states merge to exact distinct counts, the ledger says which months to renew, a stopped refresh changes nothing."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from railmart import full_load
from railmart.operators.dims import date_dimension, time_dimension
from railmart.operators.distinct import count_ids, day_bits, days_in, id_bitmaps
from railmart.operators.ordered import with_positions
from railmart.plans import kept, marts
from railmart.schemas import conform
from railmart.sources.parts import PartTable
from railmart.sources.sinks import write_frames
from tests.helpers import bag, rows

ALL = ["station_months", "hour_months", "active_days", "daily_kpis"]


def rides(spark, *values):
    df = spark.createDataFrame(list(values), "date_key INT, time_key INT, station_id LONG, line_id LONG, entries INT, exits INT")
    return df.withColumn("total_traffic", F.col("entries") + F.col("exits"))


def add(spark, folder, name, df, batch):
    table = full_load.table_at(spark, str(folder), name)
    return table.append(conform(df, table.schema), batch)


def stations(spark, folder, batch, *values):
    table = full_load.table_at(spark, str(folder), "dim_stations")
    df = conform(spark.createDataFrame(list(values), "station_id LONG, station_name STRING, borough STRING, lines_served STRING"), table.schema)
    table.replace(df, list(range(full_load.STATION_PARTS)), batch)


def calendar(spark, folder, last):
    write_frames({"dim_date": date_dimension(spark, dt.date(2024, 1, 1), last)}, str(folder), fmt="parquet")


@pytest.fixture
def loaded(spark, tmp_path):
    folder = tmp_path / "loaded"
    calendar(spark, folder, dt.date(2024, 2, 29))
    lines = spark.createDataFrame([(1, "A", "blue", "x"), (2, "A", "blue", "x")], "line_id LONG, line_name STRING, line_color STRING, line_group STRING")
    write_frames({"dim_time": time_dimension(spark), "dim_subway_lines": lines}, str(folder), fmt="parquet")
    stations(spark, folder, "s1", (1, "P", "X", "A"), (2, "P", "X", "A"), (3, "Q", "Y", "A"))
    add(spark, folder, "fact_ridership", rides(
        spark, (20240101, 800, 1, 1, 5, 1), (20240101, 815, 2, 2, 7, None), (20240131, 800, 1, 1, 1, 1), (20240201, 900, 3, None, 2, 2),
        (20240201, 900, None, 1, 4, 4), (20240201, None, 1, 1, None, None),
    ), "r1")
    return folder


def same_as_marts(spark, folder, root):
    star = kept.loaded_star(spark, str(folder))
    read = lambda name: kept.kept_table(spark, str(root), name).read()
    by_station = kept.station_performance(star, read("station_months"))
    assert bag(by_station) == bag(marts.station_performance(star).select(by_station.columns))
    assert bag(kept.top_stations(star, read("station_months"))) == bag(marts.top_stations(star))
    assert bag(kept.hourly_ridership(star, read("hour_months"))) == bag(marts.hourly_ridership(star))
    assert bag(kept.peak_hours(read("hour_months"))) == bag(marts.peak_hours(star))
    days = marts.daily_kpis(star)
    assert bag(read("daily_kpis").select(days.columns)) == bag(days)
    months = star.ridership.filter("station_id IS NOT NULL").join(star.dates, "date_key").groupBy("month_name").agg(F.countDistinct("station_id"))
    assert bag(kept.active_stations(star, read("active_days"), ["month_name"])) == bag(months)


def test_one_late_row_renews_one_month(spark, loaded, tmp_path):
    root = tmp_path / "kept"
    assert set(map(tuple, kept.refresh(spark, str(loaded), str(root)).values())) == {(202401, 202402)}
    same_as_marts(spark, loaded, root)
    held = {n: {p.key: p.path for p in kept.kept_table(spark, str(root), n).manifest().parts} for n in ALL}
    assert set(kept.refresh(spark, str(loaded), str(root)).keys()) == set(ALL)
    assert all(kept.kept_table(spark, str(root), n).manifest().version == 1 for n in ALL)

    add(spark, loaded, "fact_ridership", rides(spark, (20240101, 830, 2, 1, 3, 3)), "r2")
    assert kept.refresh(spark, str(loaded), str(root)) == dict.fromkeys(ALL, [202401])
    for name in ALL:
        now = {p.key: p.path for p in kept.kept_table(spark, str(root), name).manifest().parts}
        assert now[202402] == held[name][202402] and now[202401] != held[name][202401]
    same_as_marts(spark, loaded, root)
    # A day seen by both loads and by two stations of one name counts once.
    star = kept.loaded_star(spark, str(loaded))
    top = kept.top_stations(star, kept.kept_table(spark, str(root), "station_months").read())
    assert {r.station_name: r.days_with_service for r in top.collect()} == {"P": 3, "Q": 1}


def test_other_facts_dimensions_and_the_calendar(spark, loaded, tmp_path):
    root = tmp_path / "kept"
    kept.refresh(spark, str(loaded), str(root))
    delays = spark.createDataFrame([(20240201, 800, 1, 3, 12)], "date_key INT, time_key INT, line_id LONG, station_id LONG, delay_duration_minutes INT")
    add(spark, loaded, "fact_delays", delays, "d1")
    assert kept.refresh(spark, str(loaded), str(root)) == {**dict.fromkeys(ALL, []), "daily_kpis": [202402]}
    stations(spark, loaded, "s2", (1, "P", "Z", "A"), (2, "P", "X", "A"), (3, "Q", "Y", "A"))
    assert kept.refresh(spark, str(loaded), str(root)) == {**dict.fromkeys(ALL, []), "hour_months": [202401, 202402]}
    calendar(spark, loaded, dt.date(2024, 4, 10))
    assert kept.refresh(spark, str(loaded), str(root)) == {**dict.fromkeys(ALL, []), "daily_kpis": [202403, 202404]}
    calendar(spark, loaded, dt.date(2024, 4, 30))
    assert kept.refresh(spark, str(loaded), str(root))["daily_kpis"] == [202404]
    same_as_marts(spark, loaded, root)


def test_a_stopped_refresh_leaves_the_old_result(spark, loaded, tmp_path, monkeypatch):
    root = tmp_path / "kept"
    kept.refresh(spark, str(loaded), str(root))
    before = bag(kept.kept_table(spark, str(root), "daily_kpis").read())
    add(spark, loaded, "fact_ridership", rides(spark, (20240101, 830, 2, 1, 3, 3)), "r2")
    with monkeypatch.context() as broken:
        broken.setattr(PartTable, "_commit", lambda self, manifest: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError, match="stopped"):
            kept.refresh(spark, str(loaded), str(root), ["daily_kpis"])
    assert bag(kept.kept_table(spark, str(root), "daily_kpis").read()) == before
    assert kept.refresh(spark, str(loaded), str(root), ["daily_kpis"]) == {"daily_kpis": [202401]}
    kept.refresh(spark, str(loaded), str(root))
    same_as_marts(spark, loaded, root)


def test_a_refresh_reads_the_files_of_its_months_only(spark, loaded):
    star = kept.loaded_star(spark, str(loaded), [202402])
    assert all("part_key=202402" in f for f in star.ridership.inputFiles()) and star.ridership.count() == 3
    assert star.dates.count() == 29


def test_states_without_rows(spark, loaded, tmp_path):
    empty = tmp_path / "empty"
    calendar(spark, empty, dt.date(2024, 1, 2))
    write_frames({"dim_time": time_dimension(spark), "dim_subway_lines": spark.read.parquet(f"{loaded}/dim_subway_lines")}, str(empty), fmt="parquet")
    assert kept.refresh(spark, str(empty), str(tmp_path / "kept")) == {**dict.fromkeys(ALL, []), "daily_kpis": [202401]}
    star = kept.loaded_star(spark, str(empty))
    assert kept.station_performance(star, kept.kept_table(spark, str(tmp_path / "kept"), "station_months").read()).count() == 0


def test_bits_and_bitmaps_count_like_distinct(spark):
    df = spark.createDataFrame(
        [("a", 20240131, 1), ("a", 20240131, 40_000), ("a", 20240101, 1), ("b", 20240229, None), ("b", None, 32_768), ("b", None, -5), ("b", None, 32_769)],
        "g STRING, date_key INT, id LONG",
    )
    assert bag(df.groupBy("g").agg(day_bits().alias("d")).select("g", days_in("d"))) == [("a", 2), ("b", 1)]
    halves = id_bitmaps(df.filter("date_key IS NULL"), ["g"], "id").unionByName(id_bitmaps(df, ["g"], "id"))
    assert bag(count_ids(halves, ["g"], "n")) == [("a", 2), ("b", 3)]


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_positions_follow_the_order(spark, n):
    df = spark.range(n).select(F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("v"), (F.col("id") * 7919 % 5003).alias("k"))
    got = rows(with_positions(df.repartition(6), [F.col("v").desc_nulls_first(), F.col("k").asc()]).orderBy("position"))
    assert [r[2] for r in got] == list(range(1, n + 1))
    assert [r[:2] for r in got] == sorted([r[:2] for r in got], key=lambda r: (r[0] is not None, -(r[0] or 0), r[1]))
