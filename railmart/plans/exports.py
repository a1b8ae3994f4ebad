"""Result sets for a BI tool, and the star registered under SQL names."""

from __future__ import annotations

import datetime as dt
from calendar import monthrange
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart.plans import marts
from railmart.plans.metrics import in_days
from railmart.plans.star import Star
from railmart.sources.sinks import export_results, refresh_partitions


def ridership_summary(star: Star) -> DataFrame:
    day = ["full_date", "day_name", "month_name", "year", "is_weekend"]
    place, line = ["station_name", "borough"], ["line_name", "line_color"]
    per_day = star.attach_station(
        star.ridership,
        ["date_key", "line_id"],
        place,
        {"entries": F.sum("entries"), "exits": F.sum("exits"), "traffic": F.sum("total_traffic")},
    )
    named = star.attach(star.attach(per_day, "dates", day, "inner"), "lines", line)
    return named.groupBy(*day, *place, *line).agg(
        F.sum("entries").alias("total_entries"), F.sum("exits").alias("total_exits"), F.sum("traffic").alias("total_traffic")
    )


def delay_analysis(star: Star) -> DataFrame:
    rows = star.attach(star.delays, "dates", ["full_date", "day_name", "month_name"], "inner")
    rows = star.attach(rows, "times", ["time_period", "is_peak_hour"])
    rows = star.attach(rows, "lines", ["line_name", "line_color"], spread_by="delay_id")
    return rows.select(
        "full_date", "day_name", "month_name", "time_period", "is_peak_hour", "line_name", "line_color",
        "delay_category", "severity_level", "delay_reason", "delay_duration_minutes", "passenger_impact_estimate",
    )


def performance_trends(star: Star) -> DataFrame:
    """Keeps days of unknown lines, unlike the line performance view."""
    measures = ["on_time_percentage", "wait_assessment", "customer_journey_time_performance"]
    rows = marts.optional(star.performance, {c: "decimal(5,2)" for c in measures})
    rows = star.attach(rows, "dates", ["full_date", "month_name", "year", "is_weekend"], "inner")
    rows = star.attach(rows, "lines", marts.LINE_COLUMNS)
    out = rows.select(
        "full_date", "month_name", "year", "is_weekend", *marts.LINE_COLUMNS, "scheduled_trips", "actual_trips",
        "on_time_trips", "late_trips", "canceled_trips", *measures,
    )
    return marts.as_double(out, *measures)


def stations(star: Star) -> DataFrame:
    columns = {
        "latitude": "double", "longitude": "double", "structure_type": "string", "division": "string",
    }
    return marts.optional(star.stations, columns).select(
        "station_id", "station_name", "borough", "latitude", "longitude", "structure_type", "ada_accessible",
        "lines_served", "division",
    )


def subway_lines(star: Star) -> DataFrame:
    return star.lines


EXPORTS = {
    "ridership_summary": ridership_summary,
    "delay_analysis": delay_analysis,
    "performance_trends": performance_trends,
    "stations": stations,
    "subway_lines": subway_lines,
}


def export_for_bi(star: Star, folder: str) -> list[str]:
    """CSV folder per result set; empty ones are skipped."""
    return export_results({name: build(star) for name, build in EXPORTS.items()}, folder)


VIEWS = {
    "vw_daily_ridership": marts.daily_ridership,
    "vw_hourly_ridership": marts.hourly_ridership,
    "vw_station_performance": marts.station_performance,
    "vw_line_performance": marts.line_performance,
    "vw_delay_analysis": marts.delay_analysis,
    "vw_delay_summary_by_line": marts.delay_summary_by_line,
    "vw_monthly_trends": marts.monthly_trends,
    "mv_daily_kpis": marts.daily_kpis,
}
TABLES = {
    "dim_subway_lines": "lines",
    "dim_stations": "stations",
    "dim_date": "dates",
    "dim_time": "times",
    "fact_ridership": "ridership",
    "fact_delays": "delays",
    "fact_performance": "performance",
}


def refresh_daily_kpis(
    star: Star, path: str, start: dt.date | None = None, end: dt.date | None = None, mode: str = "literal"
) -> None:
    """Store the daily KPIs by month: all of them, or only the months from ``start`` to ``end``.

    A partial refresh reads just the facts of those months and leaves the other months alone.
    """
    first = start.replace(day=1) if start else None
    last = end.replace(day=monthrange(end.year, end.month)[1]) if end else None
    tables = ("dates", "ridership", "delays", "performance")
    cut = replace(star, **{t: in_days(getattr(star, t), first, last) for t in tables})
    refresh_partitions(marts.daily_kpis(cut, mode), path, ["year", "month_number"])


def station_search(small: bool) -> str:
    """Body of get_station_summary: the joined totals of the stations found, as `marts.station_totals` gives them.

    Where the stations are few enough to broadcast, facts of other stations are dropped before the sums. Otherwise each fact is
    summed by station first, so a busy station is one row when it meets the stations found.
    """
    hint, only = ("/*+ BROADCAST(found) */", "LEFT SEMI JOIN found USING (station_id)") if small else ("", "")
    return f"""
        WITH found AS (SELECT station_id, station_name, borough FROM dim_stations
                       WHERE station_name ILIKE concat('%', get_station_summary.wanted, '%')),
        rides AS (SELECT {hint} station_id, count(*) AS n, sum(entries) AS entries, sum(exits) AS exits, count(entries) AS counted
                  FROM fact_ridership {only} GROUP BY station_id),
        late AS (SELECT {hint} station_id, count(*) AS n, count(delay_id) AS delays, sum(delay_duration_minutes) AS minutes,
                        count(delay_duration_minutes) AS timed
                 FROM fact_delays {only} GROUP BY station_id),
        joined AS (SELECT s.station_name, s.borough, r.entries, r.exits, r.counted, d.delays, d.minutes, d.timed,
                          CAST(greatest(coalesce(d.n, 0), 1) AS DECIMAL(19,0)) AS by_ride,
                          CAST(greatest(coalesce(r.n, 0), 1) AS DECIMAL(19,0)) AS by_delay
                   FROM found s LEFT JOIN rides r ON s.station_id = r.station_id LEFT JOIN late d ON s.station_id = d.station_id)
        SELECT station_name, borough, coalesce(sum(entries * by_ride), 0), coalesce(sum(exits * by_ride), 0),
               round(try_divide(CAST(sum(entries * by_ride) AS DOUBLE), CAST(sum(counted * by_ride) AS DOUBLE)), 2),
               coalesce(sum(delays * by_delay), 0),
               round(coalesce(try_divide(CAST(sum(minutes * by_delay) AS DOUBLE), CAST(sum(timed * by_delay) AS DOUBLE)), 0.0D), 2)
        FROM joined GROUP BY station_name, borough"""


def register(spark: SparkSession, star: Star, views: Sequence[str] | None = None) -> None:
    """Temp views for tables and marts, and the two table functions, so that SQL text can use them."""
    for name, attribute in TABLES.items():
        getattr(star, attribute).createOrReplaceTempView(name)
    for name in views or VIEWS:
        VIEWS[name](star).createOrReplaceTempView(name)
    marts.station_totals(star).createOrReplaceTempView("station_totals")
    marts.line_days(star).createOrReplaceTempView("line_days")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION get_station_summary(wanted STRING)
        RETURNS TABLE (station_name STRING, borough STRING, total_entries DECIMAL(38,0), total_exits DECIMAL(38,0),
                       avg_daily_entries DOUBLE, delay_count DECIMAL(38,0), avg_delay_minutes DOUBLE)
        RETURN {station_search("stations" in star.small)}""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION get_line_performance(wanted STRING, first_day DATE, last_day DATE)
        RETURNS TABLE (line_name STRING, date_val DATE, scheduled_trips BIGINT, on_time_trips BIGINT,
                       on_time_pct DOUBLE, delay_count BIGINT)
        RETURN SELECT line_name, date_val, scheduled_trips, on_time_trips, on_time_pct, delay_count
               FROM line_days
               WHERE line_name = get_line_performance.wanted
                 AND date_val BETWEEN get_line_performance.first_day AND get_line_performance.last_day""")
