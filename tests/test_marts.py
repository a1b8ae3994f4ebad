"""Marts over the event tables: both join strategies agree, and the plans are the ones meant for large data."""

from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F

from checks import registry
from railmart import adapters
from railmart.plans import exports, marts, metrics
from railmart.plans.metrics import Slice
from tests.helpers import bag, planned, rows


@pytest.fixture(scope="module")
def star(spark, small_data):
    return adapters.star(spark, small_data)


@pytest.fixture(scope="module")
def large(star):
    """The same star with no dimension taken to be small."""
    return dataclasses.replace(star, small=frozenset())


STATION_MARTS = [
    marts.daily_ridership,
    marts.hourly_ridership,
    marts.station_performance,
    lambda s: marts.station_performance(s, nulls="last"),
    marts.delay_analysis,
    marts.top_stations,
    marts.borough_traffic,
    lambda s: marts.station_summary(s, "#00000001"),
    lambda s: marts.busiest_station_on(s, "2024-01-30"),
    metrics.station_map,
    lambda s: metrics.measure(s, ["total_ridership", "total_delays"], ["borough"]),
    lambda s: metrics.measure(s, registry.of_fact("ridership"), ["borough", "hour"], registry.RUSH),
    lambda s: metrics.measure(s, registry.of_fact("delays"), ["line_name"], Slice(boroughs=("ASIA",))),
    lambda s: metrics.measure(s, ["active_stations", "otp_rate", "severe_delays"], (), Slice(boroughs=("ASIA",))),
    lambda s: metrics.rolling_seven_days(s, ["borough"]),
    metrics.borough_by_weekday,
]


@pytest.mark.parametrize("mart", STATION_MARTS)
def test_large_dimensions_give_the_same_rows(star, large, mart):
    assert bag(mart(large)) == bag(mart(star))


def test_checked_sizes(star):
    assert star.small == {"lines", "stations", "dates", "times"}


@pytest.mark.parametrize("name", [n for n in registry.all_queries() if "clusters" not in n])
def test_no_product_and_no_window_over_raw_rows(spark, small_data, name):
    plan = planned(registry.all_queries()[name](spark, small_data))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "localCheckpoint" not in plan


def test_dimensions_are_broadcast(star):
    plan = planned(marts.line_performance(star))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


def test_only_needed_columns_are_read(star):
    plan = planned(marts.ridership_on(star, "2024-01-30"))
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "event_type" in line)
    assert "props" not in scan.split("ReadSchema")[1]
    assert "Not(EqualTo(event_type,error))]" in scan


def test_day_filter_prunes_a_stored_star(spark, star, tmp_path):
    path = str(tmp_path / "rides")
    star.ridership.repartition(1).write.partitionBy("date_key").parquet(path)
    stored = dataclasses.replace(star, ridership=spark.read.parquet(path))
    plan = planned(marts.ridership_on(stored, "2024-01-30"))
    assert "PartitionFilters: [isnotnull(date_key" in plan
    assert rows(marts.ridership_on(stored, "2024-01-30")) == rows(marts.ridership_on(star, "2024-01-30"))


def test_shares_add_up(star):
    causes = marts.delay_causes(star).agg(F.sum("pct_of_all_delays")).first()[0]
    assert causes == pytest.approx(100, abs=0.2)
    boroughs = marts.borough_traffic(star).agg(F.sum("traffic_share_pct")).first()[0]
    assert boroughs == pytest.approx(100, abs=0.1)


def test_orders(star):
    lines = [r.total_delays for r in marts.delay_summary_by_line(star).collect()]
    assert lines == sorted(lines, reverse=True)
    periods = [r.time_period for r in marts.time_period_performance(star).collect()]
    assert periods == ["Late Night", "Morning Rush", "Midday", "Evening Rush", "Night"]


def test_stations_without_rides_rank_first_or_last(star):
    first = marts.station_performance(star).filter("total_traffic IS NULL")
    assert first.count() == 135
    assert [r[0] for r in first.select("traffic_rank").distinct().collect()] == [1]
    last = marts.station_performance(star, nulls="last").filter("total_traffic IS NULL")
    assert [r[0] for r in last.select("traffic_rank").distinct().collect()] == [16]


def test_slicers_skip_facts_they_cannot_reach(star):
    severe = metrics.measure(star, ["total_delays", "otp_rate"], (), Slice(severities=("High",))).first()
    assert severe.total_delays == star.delays.filter("severity_level = 'High'").count()
    assert severe.otp_rate == metrics.measure(star, ["otp_rate"]).first().otp_rate


def test_raw_rows_never_meet_a_large_station_table(large):
    plan = planned(metrics.measure(large, ["total_entries"], ["borough"]))
    # The first shuffle already carries sums per station.
    first = [line for line in plan.splitlines() if "Exchange hashpartitioning(station_id" in line or "HashAggregate(keys=[station_id" in line]
    assert first
    assert "partial_sum(_entries" in plan


def test_nothing_selected(star):
    nowhere = Slice(boroughs=("Atlantis",))
    got = metrics.measure(star, ["total_delays", "total_entries", "active_stations"], (), nowhere).first()
    assert got.asDict() == {"total_delays": 0, "total_entries": None, "active_stations": 0}


def test_unknown_column_is_named(star):
    with pytest.raises(ValueError, match="performance has no column borough"):
        metrics.measure(star, ["otp_rate"], ["borough"])


def test_sliced_station_map(star):
    got = metrics.station_map(star, Slice(boroughs=("ASIA",), weekend=True))
    assert {r.borough for r in got.collect()} <= {"ASIA"}
    whole = metrics.measure(star, ["total_traffic"], (), Slice(boroughs=("ASIA",), weekend=True)).first()[0]
    assert got.agg(F.sum("total_traffic")).first()[0] == whole


def test_clusters(star):
    got = metrics.delay_clusters(star, k=3)
    assert got.select("cluster").distinct().count() == 3
    assert got.count() == metrics.line_delay_profile(star).na.drop(subset=["avg_delay_minutes"]).count()
    assert bag(got) == bag(metrics.delay_clusters(star, k=3))


def test_export_folder(spark, star, tmp_path):
    written = exports.export_for_bi(star, str(tmp_path))
    assert written == list(exports.EXPORTS)
    back = spark.read.option("header", True).csv(str(tmp_path / "stations"))
    assert back.count() == star.stations.count()


@pytest.mark.parametrize("mart", [marts.delay_causes, marts.borough_traffic])
def test_shares_read_the_facts_once(star, mart):
    plan = planned(mart(star))
    assert plan[plan.index("Initial Plan") if "Initial Plan" in plan else 0 :].count("events.parquet") == 1


def test_marts_of_large_tables_run_nothing_while_planned(spark, large):
    group = "planning-only"
    spark.sparkContext.setJobGroup(group, group)
    try:
        marts.station_performance(large)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("kind", ["star", "large"])
def test_station_search_in_sql(spark, request, kind):
    """The SQL name gives the rows of the Python name, wildcards and names that no station has included."""
    chosen = request.getfixturevalue(kind)
    exports.register(spark, chosen, views=["vw_line_performance"])
    for name in ("mer#0000001", "CUSTOMER#00000_1", "none such"):
        assert bag(spark.sql(f"SELECT * FROM get_station_summary('{name}')")) == bag(marts.station_summary(chosen, name))


def test_station_search_drops_other_facts_before_the_sums(spark, star):
    exports.register(spark, star, views=["vw_line_performance"])
    plan = planned(spark.sql("SELECT * FROM get_station_summary('mer#0000001')"))
    sums = [line for line in plan.splitlines() if "partial_sum(entries" in line or "partial_count(delay_id" in line or "partial_sum(delay_duration" in line]
    assert sums and plan.count("LeftSemi, BuildRight") == 2
    assert "SortMergeJoin" not in plan
