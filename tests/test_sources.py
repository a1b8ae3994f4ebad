from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from railmart import full_load
from railmart.operators.dims import keep_one
from railmart.schemas import STAR_TABLES, read_schema
from railmart.sources import landing, sinks
from tests.helpers import bag, rows


def test_csv_positions_do_not_depend_on_split_size(spark, tmp_path):
    path = tmp_path / "stations.csv"
    lines = ["station_id,station_name"] + [f"{i},name {i % 5}" for i in range(500)]
    path.write_text("\n".join(lines) + "\n")
    schema = {"station_id": "STRING", "station_name": "STRING"}
    answers = set()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("134217728", "1000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = landing.read_csv(spark, str(path), schema, positions=True)
            answers.add(tuple(bag(keep_one(df, ["station_name"], landing.INGEST_SEQ).select("station_id", "station_name"))))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert answers == {tuple((str(i), f"name {i}") for i in range(5))}


def test_json_pages_with_window_year_and_cap(spark, tmp_path):
    root = str(tmp_path)
    for name, records in {
        "subway_ridership": [{"transit_timestamp": f"2024-01-{d:02}T05:00:00", "entries": d} for d in range(1, 11)],
        "performance_subway": [{"period_year": y, "line": "A"} for y in (2023, 2024, 2024)],
        "turnstile_usage": [{"date": "2024-01-02", "entries": "5"}],
    }.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "page-0.json").write_text("\n".join(json.dumps(r) for r in records))
    read = landing.read_dataset
    assert read(spark, root, "subway_ridership", "2024-01-04").count() == 7
    assert read(spark, root, "subway_ridership", "2024-01-04", "2024-01-06").count() == 2
    assert read(spark, root, "subway_ridership").first().entries in {str(d) for d in range(1, 11)}
    assert [r.entries for r in read(spark, root, "subway_ridership", max_records=2).collect()] == ["1", "2"]
    assert read(spark, root, "performance_subway", year=2024).count() == 2
    assert read(spark, root, "turnstile_usage", "2024-01-03").count() == 0
    assert set(landing.CATALOG) == {
        "subway_stations", "subway_ridership", "hourly_ridership", "performance_subway", "subway_delays", "turnstile_usage",
    }


def test_volume_gate(spark):
    thin = {"a": spark.range(600), "b": spark.range(399)}
    assert not landing.enough_rows(thin)
    enough = {**thin, "c": spark.range(1)}
    assert landing.require_rows(enough) is enough
    for frames in (thin, {}):
        with pytest.raises(ValueError, match="fewer than 1000 rows"):
            landing.require_rows(frames)


def test_default_window():
    assert landing.extract_window(as_of=dt.date(2024, 12, 31)) == (dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    assert landing.extract_window("2020-01-01", "2020-02-01") == ("2020-01-01", "2020-02-01")


def test_window_reaches_the_scan(spark, small_data):
    df = spark.read.parquet(f"{small_data}/orders.parquet")
    recent = landing.in_window(df, "o_orderdate", "2000-12-31")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "LessThan(o_orderdate" in plan


def test_delimited_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "x"), (None, "a b", "y")], "i INT, s STRING, t STRING")
    sinks.write_delimited(df, str(tmp_path / "t"), ["i", "s"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*")))
    assert sorted(text.splitlines()) == ["1\t\\N", "\\N\ta b"]
    assert bag(sinks.read_delimited(spark, str(tmp_path / "t"), {"i": "INT", "s": "STRING"})) == [(1, None), (None, "a b")]


def test_tables(spark):
    table = "append_target"
    assert not sinks.table_exists(spark, table)
    sinks.append_rows(spark.createDataFrame([(1, "a")], "id BIGINT, v STRING"), table)
    sinks.append_rows(spark.createDataFrame([("b", 2)], "v STRING, id INT"), table)
    sinks.append_rows(spark.createDataFrame([(3, "c")], "id BIGINT, v STRING"), table, ["id"])
    sinks.insert_ignoring(spark.createDataFrame([(3, "no"), (4, "d"), (4, "d")], "id BIGINT, v STRING"), table, ["id"])
    assert sinks.table_row_count(spark, table) == 4
    assert bag(spark.table(table)) == [(1, "a"), (2, "b"), (3, None), (4, "d")]
    sinks.refresh_table(spark.createDataFrame([(9,)], "n INT"), "kpis")
    sinks.refresh_table(spark.createDataFrame([(10,)], "n INT"), "kpis")
    assert rows(spark.table("kpis")) == [(10,)]
    got = sinks.run_query(spark, "SELECT v FROM append_target WHERE id = :id", {"id": 2})
    assert rows(got) == [("b",)]
    assert bag(sinks.row_counts({"x": spark.range(3), "y": spark.range(0)})) == [("x", 3), ("y", 0)]


def test_star_tables_are_created_once(spark):
    spark.sql("CREATE DATABASE transit")
    assert sinks.create_tables(spark, STAR_TABLES, "transit") == list(STAR_TABLES)
    assert sinks.create_tables(spark, STAR_TABLES, "transit") == []
    alert = (1, 20240105, None, None, 8, "Delay", "h", "d", ["Penn", "Canal"], False, None, None, None)
    rows_in = spark.createDataFrame([alert], read_schema(STAR_TABLES["fact_service_alerts"]))
    sinks.append_rows(rows_in, "transit.fact_service_alerts")
    assert spark.table("transit.fact_service_alerts").first().affected_stations == ["Penn", "Canal"]
    spark.sql("DROP DATABASE transit CASCADE")


def test_partition_refresh_leaves_other_months(spark, tmp_path):
    path = str(tmp_path / "months")
    sinks.refresh_partitions(spark.createDataFrame([(1, 10), (2, 20)], "m INT, v INT"), path, ["m"])
    sinks.refresh_partitions(spark.createDataFrame([(2, 25)], "m INT, v INT"), path, ["m"])
    assert bag(spark.read.parquet(path).select("m", "v")) == [(1, 10), (2, 25)]


def test_large_partition_is_written_by_several_tasks(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    try:
        spark.conf.set(size, "64k")
        df = spark.range(0, 200000, 1, 8).select(F.lit(1).alias("m"), F.xxhash64("id").alias("v"))
        sinks.refresh_partitions(df, str(tmp_path / "big"), ["m"])
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "big" / "m=1").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "big")).count() == 200000


def test_rejected_rows_keep_their_payload(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id INT, v STRING")
    good, bad = sinks.split_rejected(df, sinks.required_error(["id", "v"]), "demo")
    assert rows(good) == [(1, "a")]
    assert rows(bad.select("dataset", "raw_data", "processed", "error_message")) == [("demo", '{"v":"b"}', False, "missing id")]


def test_export_skips_empty_results(spark, tmp_path):
    results = {"full": spark.range(2), "empty": spark.range(0)}
    assert sinks.export_results(results, str(tmp_path)) == ["full"]
    assert spark.read.option("header", True).csv(str(tmp_path / "full")).count() == 2


@pytest.fixture
def sample_folder(spark, tmp_path):
    texts = {
        "stations": "station_id,station_name,station_complex_id,gtfs_stop_id,borough,latitude,longitude,structure_type,ada_accessible,lines_served,division\n"
        "A1,Penn Station,SC1,S1,Manhattan,40.75,-73.99,Underground,true,\"A,C\",IND\nA2,Canal Street,SC2,S2,Manhattan,40.72,-74.0,Elevated,false,J,BMT\n",
        "ridership": "date,time,hour,station_id,station_name,line_name,entries,exits,is_weekend,is_peak_hour,datetime\n"
        "2025-01-05,08:10:00,8,A1,Penn Station,A,100,90,true,true,2025-01-05 08:10:00\n"
        "2025-01-05,08:10:00,8,A1,Penn Station,A,1,1,true,true,2025-01-05 08:10:00\n"
        "2025-01-06,09:00:00,9,A2,Canal Street,SIR,50,40,false,true,2025-01-06 09:00:00\n",
        "delays": "date,time,incident_datetime,line_name,station_name,delay_duration_minutes,delay_category,delay_reason,severity_level,passenger_impact_estimate,is_resolved,resolution_time_minutes\n"
        "2025-01-05,17:30:00,2025-01-05 17:30:00,A,Penn Station,12,Moderate,Signal problems,Medium,900,true,20\n",
        "performance": "date,line_name,scheduled_trips,actual_trips,on_time_trips,late_trips,canceled_trips,on_time_percentage,mean_distance_between_failures,wait_assessment,customer_journey_time_performance\n"
        "2025-01-05,A,200,195,180,15,5,90.0,75000.5,80.5,85.25\n",
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_full_load(spark, sample_folder, tmp_path):
    raw = landing.read_sample_files(spark, sample_folder, positions=True)
    out = str(tmp_path / "out")
    result = full_load.run(spark, raw, out, order_by=landing.INGEST_SEQ, source="sample")
    assert result["status"] == "completed", result
    assert result["tables_loaded"] == {"stations": 2, "ridership": 2, "delays": 1, "performance": 1}
    assert result["cleaning"]["ridership"]["duplicates_removed"] == 1
    rides = full_load.read_table(spark, out, "fact_ridership")
    assert bag(rides.select("date_key", "time_key", "line_id", "entries", "data_source")) == [
        (20250105, 800, 8, 100, "sample"), (20250106, 900, None, 50, "sample"),
    ]
    assert rides.filter("station_id IS NULL").count() == 0
    assert rides.select("ridership_id").distinct().count() == 2
    delay = full_load.read_table(spark, out, "fact_delays").first()
    assert (delay.time_key, delay.severity_level, delay.resolution_time_minutes) == (1700, "Medium", 20)
    log = full_load.read_log(spark, out)
    assert bag(log.select("status", "records_processed", "records_inserted")) == [("completed", 7, 6), ("running", 0, 0)]
    details = json.loads(log.filter("status = 'completed'").first().execution_details)
    assert details["tables_loaded"]["stations"] == 2
    # A second run over its own output changes nothing but stamps.
    again = full_load.run(
        spark, raw, str(tmp_path / "again"), order_by=landing.INGEST_SEQ,
        existing={"dim_stations": f"{out}/dim_stations", "fact_performance": f"{out}/fact_performance"},
    )
    assert again["tables_loaded"]["stations"] == 2
    ids = [bag(full_load.read_table(spark, p, "dim_stations").select("station_id", "station_name")) for p in (out, str(tmp_path / "again"))]
    assert ids[0] == ids[1]
    assert spark.read.parquet(f"{out}/dim_date").agg(F.min("date_key"), F.max("date_key")).first()[:] == (20240101, 20261231)


def test_failed_load_is_logged(spark, tmp_path):
    broken = {"stations": spark.createDataFrame([(1,)], "station_name INT").selectExpr("raise_error('no data') AS station_name")}
    result = full_load.run(spark, broken, str(tmp_path / "out"))
    assert result["status"] == "failed"
    assert "no data" in result["errors"][0]
    assert bag(full_load.read_log(spark, str(tmp_path / "out")).select("status")) == [("failed",), ("running",)]


def test_date_bounds_leave_out_folders_of_other_months(spark, tmp_path):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-20', DATE'2024-04-10')) AS d")
    pages = days.selectExpr("CAST(d AS STRING) AS transit_timestamp", "'s' AS station", "'1' AS entries")
    pages = pages.unionByName(spark.createDataFrame([("no time", "s", "1")], pages.schema))
    landing.land(pages, str(tmp_path), "subway_ridership")
    everything = landing.read_dataset(spark, str(tmp_path), "subway_ridership")
    assert everything.count() == pages.count() and landing.MONTH not in everything.columns
    cut = landing.read_dataset(spark, str(tmp_path), "subway_ridership", "2024-02-10", "2024-03-05")
    assert cut.count() == 25
    assert "PartitionFilters: [isnotnull(landed_month" in cut._jdf.queryExecution().executedPlan().toString()
