"""Tables in parts: batches are added once, other parts keep their files, stopped writes leave no trace."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from railmart import full_load
from railmart.sources.parts import Manifest, PartTable
from tests.helpers import bag

SCHEMA = {"id": "BIGINT", "date_key": "INT", "v": "INT"}


def table(spark, root):
    return PartTable(spark, str(root), SCHEMA, F.floor(F.col("date_key") / 100), "id", ("date_key",))


def rows(spark, *values):
    return spark.createDataFrame([(None, d, v) for d, v in values], "id BIGINT, date_key INT, v INT")


def files_of(known, key):
    return sorted(f for p in known.manifest().parts if p.key == key for f in os.listdir(p.path) if f.endswith(".parquet"))


def test_equal_rows_of_two_batches_stay_and_a_batch_counts_once(spark, tmp_path):
    known = table(spark, tmp_path / "t")
    assert known.read().count() == 0 and known.changed_since(0) == []
    assert known.append(rows(spark, (20240101, 5), (20240101, 5), (20240201, 1)), "a") == 3
    assert known.append(rows(spark, (20240101, 5)), "b") == 1
    assert known.append(rows(spark, (20240101, 5)), "b") == 0
    got = known.read().collect()
    assert len(got) == 4 == len({r.id for r in got}) and min(r.id for r in got) >= 1
    assert bag(known.read([202401]).select("v")) == [(5,)] * 3
    assert bag(known.ledger()) == [("a", 1, 3, 2), ("b", 2, 1, 1)]
    assert known.changed_since(1) == [202401] and known.changed_since(2) == []


def test_replaced_months_leave_the_files_of_others(spark, tmp_path):
    known = table(spark, tmp_path / "t")
    known.append(rows(spark, (20240101, 1), (20240201, 2)), "a")
    before, ids = files_of(known, 202402), {r.v: r.id for r in known.read().collect()}
    merged = known.read([202401]).unionByName(rows(spark, (20240102, 3)))
    assert known.replace(merged, [202401], "b") == 2
    assert files_of(known, 202402) == before
    after = {r.v: r.id for r in known.read().collect()}
    assert after[1] == ids[1] and after[2] == ids[2] and len(set(after.values())) == 3
    assert known.replace(rows(spark), [202401], "c") == 0 and bag(known.read().select("v")) == [(2,)]


def test_a_stopped_write_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    known = table(spark, tmp_path / "t")
    known.append(rows(spark, (20240101, 1)), "a")
    with monkeypatch.context() as broken:
        broken.setattr(PartTable, "_commit", lambda self, manifest: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError, match="stopped"):
            known.append(rows(spark, (20240101, 2), (20240301, 2)), "b")
    assert bag(known.read().select("v")) == [(1,)] and not known.has("b")
    assert known.vacuum() == 2
    assert known.append(rows(spark, (20240101, 2)), "b") == 1 and known.vacuum() == 0
    with pytest.raises(RuntimeError, match="another writer"):
        known._commit(Manifest(version=2))
    assert bag(known.read().select("v")) == [(1,), (2,)]


def test_compaction_keeps_rows_ids_and_batches(spark, tmp_path):
    known = table(spark, tmp_path / "t")
    for k in range(4):
        known.append(rows(spark, (20240101 + k, k), (20240201, k)), f"b{k}")
    before = bag(known.read())
    assert known.compact([202401]) == 1 and len(known.manifest().parts) == 5
    assert known.compact() == 1 and len(known.manifest().parts) == 2
    assert bag(known.read()) == before and known.append(rows(spark, (20240101, 9)), "b2") == 0


def feeds(spark, delays):
    return {
        "stations": spark.createDataFrame([("A", "M"), ("B", "Q")], "stop_name string, borough string"),
        "delays": spark.createDataFrame(delays, "start_date string, route string, cause string, delay_minutes string, station_name string"),
    }


def test_two_incidents_of_one_hour_stay_in_one_load_and_in_two(spark, tmp_path):
    first, second = ("2024-01-05 08:05:00", "1", "signal", "12", "A"), ("2024-01-05 08:40:00", "1", "signal", "12", "A")
    for name, loads in (("one", [[first, second]]), ("two", [[first], [second], [second]])):
        folder = str(tmp_path / name)
        for k, some in enumerate(loads):
            result = full_load.run(spark, feeds(spark, some), folder, batch=f"day-{min(k, 1)}")
            assert result["status"] == "completed", result
        got = full_load.read_table(spark, folder, "fact_delays").select("time_key", "delay_duration_minutes", "delay_id").collect()
        assert [r[:2] for r in got] == [(800, 12)] * 2 and len({r.delay_id for r in got}) == 2


def test_junk_days_go_to_the_quarantine(spark, tmp_path):
    folder = str(tmp_path / "star")
    days = ["2024-01-05", "9999-12-31", "0001-01-01", "never", "2024-01-06"]
    result = full_load.run(spark, feeds(spark, [(d, "1", f"cause {d}", "3", "A") for d in days]), folder)
    assert result["status"] == "completed" and result["quarantined"] == 3 and result["tables_loaded"]["delays"] == 2
    refused = full_load.read_table(spark, folder, "quarantine")
    assert bag(refused.select("dataset", "error_message")) == [("delays", "missing date"), ("delays", "no calendar day"), ("delays", "no calendar day")]
    assert refused.filter("raw_data LIKE '%cause never%'").count() == 1
    assert spark.read.parquet(f"{folder}/dim_date").count() == (full_load.DIM_END - full_load.DIM_START).days + 1
    log = full_load.read_log(spark, folder).filter("status = 'completed'").first()
    assert (log.records_failed, log.records_inserted) == (3, 4)


def test_station_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    folder = str(tmp_path / "star")
    names = [f"S{k}" for k in range(40)]
    many = spark.createDataFrame([(n, "M") for n in names], "stop_name string, borough string")
    assert full_load.run(spark, {"stations": many}, folder)["tables_loaded"] == {"stations": 40}
    known = full_load.table_at(spark, folder, "dim_stations")
    before = {p.key: p.path for p in known.manifest().parts}
    full_load.run(spark, {"stations": spark.createDataFrame([("S7", "Q"), ("New", "Q")], "stop_name string, borough string")}, folder)
    kept = [k for k, path in before.items() if path in {p.path for p in known.manifest().parts}]
    assert len(kept) >= len(before) - 2
    got = known.read().collect()
    assert len(got) == 41 == len({r.station_id for r in got}) and {r.station_name: r.borough for r in got}["S7"] == "Queens"
    assert all(r.updated_at >= dt.datetime(2024, 1, 1) for r in got)


def test_feeds_are_read_from_what_the_load_stored(spark, tmp_path, monkeypatch):
    folder, asked = str(tmp_path / "star"), []
    name = full_load.content_name
    monkeypatch.setattr(full_load, "content_name", lambda df: asked.append(df) or name(df))
    raw = spark.createDataFrame([("2024-01-05", "1", "signal", 3)], "start_date string, route string, cause string, delay_minutes int")
    for loaded in (1, 0):
        result = full_load.run(spark, {"delays": raw.withColumn("nothing", F.lit(None))}, folder)
        assert result["status"] == "completed" and result["tables_loaded"] == {"delays": loaded}
    files = [f for df in asked for f in df.inputFiles()]
    assert len(asked) == 2 and files and all(f"{folder}/raw/delays" in f for f in files)
