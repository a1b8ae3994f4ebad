"""Every named query as a function of (spark, sf_dir)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart import adapters, full_load
from railmart.functions import calendar, text
from railmart.operators import clean, dims, load, quality
from railmart.operators.ordered import with_positions
from railmart.plans import exports, kept, marts, metrics, reports
from railmart.plans.star import Star
from railmart.schemas import conform
from railmart.sources import landing, sinks

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = "2024-01-30"


def plain_types(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines hand out the same type."""
    return df.withColumns({c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")})


_stars: dict[tuple, Star] = {}
NOTHING_SMALL: frozenset[str] = frozenset()


def star_of(spark: SparkSession, sf_dir: str, long: bool = False) -> Star:
    """The star is only a set of plans; one per session and folder serves all queries."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir, long)
    if key not in _stars:
        _stars[key] = adapters.star(spark, sf_dir, long=long)
    return _stars[key]


def on_star(mart: Callable[..., DataFrame], *args, long: bool = False, large: bool = False, **kwargs) -> Query:
    """``large`` treats every dimension as too large for a broadcast."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = star_of(spark, sf_dir, long)
        return plain_types(mart(replace(star, small=NOTHING_SMALL) if large else star, *args, **kwargs))

    return run


MARTS: dict[str, Query] = {
    "daily_ridership": on_star(marts.daily_ridership),
    "hourly_ridership": on_star(marts.hourly_ridership),
    "station_performance": on_star(marts.station_performance),
    "station_performance_nulls_last": on_star(marts.station_performance, nulls="last"),
    "line_performance": on_star(marts.line_performance),
    "delay_analysis": on_star(marts.delay_analysis),
    "delay_summary_by_line": on_star(marts.delay_summary_by_line),
    "monthly_trends": on_star(marts.monthly_trends),
    "monthly_trends_seven_years": on_star(marts.monthly_trends, long=True),
    "daily_kpis": on_star(marts.daily_kpis),
    "daily_kpis_independent": on_star(marts.daily_kpis, mode="independent"),
    "station_summary": on_star(marts.station_summary, "CUSTOMER#00000_1"),
    "station_totals": on_star(marts.station_totals),
    "line_days": on_star(marts.line_days),
    "line_performance_between": on_star(marts.line_performance_between, "NATION_3", "2024-01-05", "2024-01-25"),
    "avg_delays_per_line": on_star(marts.avg_delays_per_line),
    "peak_hours": on_star(marts.peak_hours),
    "on_time_by_line": on_star(marts.on_time_by_line),
    "top_stations": on_star(marts.top_stations),
    "delay_causes": on_star(marts.delay_causes),
    "weekend_vs_weekday": on_star(marts.weekend_vs_weekday),
    "borough_traffic": on_star(marts.borough_traffic),
    "time_period_performance": on_star(marts.time_period_performance),
    "time_period_performance_independent": on_star(marts.time_period_performance, mode="independent"),
    "ridership_on": on_star(marts.ridership_on, AS_OF),
    "recent_on_time": on_star(marts.recent_on_time, "2024-02-10"),
    "delays_in_month": on_star(marts.delays_in_month, AS_OF),
    "busiest_station_on": on_star(marts.busiest_station_on, AS_OF),
    "top_stations_by_entries": on_star(marts.top_stations_by_entries),
    "avg_delay_by_line": on_star(marts.avg_delay_by_line),
    "avg_otp_by_line": on_star(marts.avg_otp_by_line),
}

# The same results with every dimension joined by a shuffle.
LARGE: dict[str, Query] = {
    "daily_ridership_large": on_star(marts.daily_ridership, large=True),
    "hourly_ridership_large": on_star(marts.hourly_ridership, large=True),
    "station_performance_large": on_star(marts.station_performance, large=True),
    "delay_analysis_large": on_star(marts.delay_analysis, large=True),
    "top_stations_large": on_star(marts.top_stations, large=True),
    "borough_traffic_large": on_star(marts.borough_traffic, large=True),
    "station_summary_large": on_star(marts.station_summary, "CUSTOMER#00000_1", large=True),
    "ridership_measures_by_borough_large": on_star(
        lambda star: metrics.measure(star, of_fact("ridership"), ["borough"]), large=True
    ),
}


# --- Measures and visuals ---------------------------------------------------------------------------------------

WEEKDAYS = metrics.Slice(weekend=False, lines=("NATION_1", "NATION_2", "NATION_3"), start="2024-01-03", end="2024-01-28")
RUSH = metrics.Slice(boroughs=("ASIA", "EUROPE"), time_periods=("Morning Rush", "Evening Rush"))


def of_fact(fact: str) -> list[str]:
    return [name for name, m in metrics.MEASURES.items() if m.fact == fact]


def rounded(query: Query, columns: Sequence[str], places: int) -> Query:
    """For results whose last digits depend on the order of addition."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(spark, sf_dir).withColumns({c: F.round(c, places) for c in columns})

    return run


MEASURES: dict[str, Query] = {
    "ridership_measures_by_borough": on_star(metrics.measure, of_fact("ridership"), ["borough"]),
    "delay_measures_by_line": on_star(metrics.measure, of_fact("delays"), ["line_name"]),
    "performance_measures_by_group": on_star(metrics.measure, of_fact("performance"), ["line_group"]),
    "measures_across_facts": on_star(
        metrics.measure, ["total_ridership", "total_delays", "otp_rate", "otp_status"], ["line_name"], WEEKDAYS
    ),
    "measures_in_total": on_star(metrics.measure, ["total_ridership", "avg_delay_minutes", "otp_vs_target"]),
    "rush_hour_slice": on_star(metrics.measure, ["total_entries", "active_stations"], ["line_group", "hour"], RUSH),
    "severity_slice": on_star(
        metrics.measure, ["total_delays", "passengers_affected"], ["borough"], metrics.Slice(severities=("High",))
    ),
    "avg_daily_ridership": on_star(metrics.avg_daily_ridership, ["borough"]),
    "rolling_seven_days": on_star(metrics.rolling_seven_days, long=True),
    "rolling_seven_days_by_borough": on_star(metrics.rolling_seven_days, ["borough"]),
    "year_to_date": on_star(metrics.year_to_date, long=True),
    "month_over_month": on_star(metrics.month_over_month, long=True),
    "year_over_year": on_star(metrics.year_over_year, ["borough"], long=True),
    "entries_trend": rounded(on_star(metrics.entries_trend, ["borough"], long=True), ["slope", "intercept"], 4),
    "delays_by_line_and_severity": on_star(metrics.delays_by_line_and_severity),
    "ridership_trend_by_month": on_star(metrics.ridership_trend, "month", long=True),
    "ridership_trend_by_quarter": on_star(metrics.ridership_trend, "quarter", ["borough"], long=True),
    "ridership_trend_by_year": on_star(metrics.ridership_trend, "year", long=True),
    "ridership_trend_by_day": on_star(metrics.ridership_trend, "day", ["borough"]),
    "station_map": on_star(metrics.station_map),
    "borough_by_weekday": on_star(metrics.borough_by_weekday),
    "kpi_cards": on_star(metrics.kpi_cards),
    "ridership_by_hour": on_star(metrics.ridership_by_hour),
    "delay_scatter": on_star(metrics.delay_scatter),
    "line_delay_profile": on_star(metrics.line_delay_profile),
    "delay_clusters": on_star(metrics.delay_clusters),
    "delay_scatter_clusters": on_star(metrics.delay_clusters, 4, "point"),
    "delay_cluster_checks": on_star(metrics.cluster_checks),
    "delay_scatter_cluster_checks": on_star(metrics.cluster_checks, 4, "point"),
}

# --- Exports ----------------------------------------------------------------------------------------------------

EXPORTS: dict[str, Query] = {f"export_{name}": on_star(build) for name, build in exports.EXPORTS.items()}


def sql_call(call: str) -> Query:
    """SQL text over the registered views and functions."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        exports.register(spark, star_of(spark, sf_dir), views=["vw_line_performance"])
        return plain_types(spark.sql(call))

    return run


SQL_NAMES: dict[str, Query] = {
    "sql_station_summary": sql_call("SELECT * FROM get_station_summary('mer#0000001')"),
    "sql_line_performance": sql_call(
        "SELECT * FROM get_line_performance('NATION_7', DATE'2024-01-10', DATE'2024-01-20')"
    ),
    "sql_view": sql_call("SELECT performance_category, count(*) AS days FROM vw_line_performance GROUP BY 1"),
}

# --- Cleaning ---------------------------------------------------------------------------------------------------

CLEAN_COLUMNS = {
    "stations": ["ingest_seq", "station_name", "borough", "latitude", "longitude", "lines_served"],
    "ridership": ["ingest_seq", "datetime", "date", "time", "hour", "station_name", "line_name", "entries", "exits"],
    "delays": [
        "ingest_seq", "incident_datetime", "date", "time", "line_name", "station_name", "delay_reason",
        "delay_duration_minutes", "delay_category", "severity_level", "passenger_impact_estimate",
    ],
    "performance": [
        "ingest_seq", "date", "line_name", "on_time_percentage", "wait_assessment", "scheduled_trips", "on_time_trips",
    ],
}


def cleaned(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return clean.CLEANERS[name](adapters.feed(spark, sf_dir, name), order_by="ingest_seq")


def cleaner(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = cleaned(spark, sf_dir, name).select(*CLEAN_COLUMNS[name])
        if name == "ridership":
            df = df.withColumns({c: F.round(c, 4) for c in ("entries", "exits")})
        return df

    return run


def null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_rates(cleaned(spark, sf_dir, "delays").select(*CLEAN_COLUMNS["delays"]))


def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_count(adapters.feed(spark, sf_dir, "ridership").drop("ingest_seq"))


def duration_from_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delays that carry an end instead of a duration."""
    events = adapters.table(spark, sf_dir, "events").filter("event_type = 'error'")
    later = F.expr("timestampadd(MINUTE, CAST(floor(value) AS INT), date_trunc('minute', ts))")
    feed = events.select(
        F.col("event_id").alias("ingest_seq"), F.date_trunc("minute", "ts").cast("string").alias("start_date"),
        later.cast("string").alias("end_date"), F.lit("a line").alias("route"), F.concat(F.lit("cause "), "event_id").alias("cause"),
    )
    out = clean.CLEANERS["delays"](feed, "ingest_seq")
    return out.select("ingest_seq", F.col("delay_duration_minutes").cast("double").alias("delay_duration_minutes"))


CLEANING: dict[str, Query] = {
    **{f"clean_{name}": cleaner(name) for name in clean.CLEANERS},
    "null_rates": null_rates,
    "duplicate_rows": duplicate_rows,
    "duration_from_times": duration_from_times,
}

# --- Loads ------------------------------------------------------------------------------------------------------


def load_ridership(large: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = star_of(spark, sf_dir)
        feed = cleaned(spark, sf_dir, "ridership")
        small = NOTHING_SMALL if large else star.small
        rows = load.load_ridership(feed, star.lines, star.stations, row_id="ingest_seq", small=small)
        return rows.drop("ridership_id", "created_at")

    return run


def load_delays(large: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = star_of(spark, sf_dir)
        feed = cleaned(spark, sf_dir, "delays")
        small = NOTHING_SMALL if large else star.small
        rows = load.load_delays(feed, star.lines, star.stations, row_id="ingest_seq", small=small)
        return rows.drop("delay_id", "created_at", "affected_services", "resolution_time_minutes")

    return run


def full_load_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full job run for the first half of the ridership and delay feeds, for the second, and for the second again."""
    folder = sinks.shared_folder(spark, "full_load")
    feeds = {name: adapters.feed(spark, sf_dir, name) for name in ("stations", "ridership", "delays", "performance")}
    for late in (False, True, True):
        part = dict(feeds)
        for name, at in (("ridership", "transit_timestamp"), ("delays", "start_date")):
            part[name] = feeds[name].filter((F.col(at) >= "2024-01-16") == F.lit(late))
        result = full_load.run(spark, part, folder, order_by="ingest_seq")
        if result["status"] != "completed":
            raise RuntimeError(result["errors"])
    counts = []
    for table, serial in (("fact_ridership", "ridership_id"), ("fact_delays", "delay_id")):
        rows = full_load.read_table(spark, folder, table)
        counts.append(
            rows.groupBy(F.lit(table).alias("table_name"), "date_key").agg(
                F.count(F.lit(1)).alias("records"), F.countDistinct(serial).alias("ids")
            )
        )
    return counts[0].unionByName(counts[1])


def full_load_split_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridership and delays loaded in two batches that both hold rows of every day, the second batch twice."""
    folder = sinks.shared_folder(spark, "full_load")
    feeds = {name: adapters.feed(spark, sf_dir, name) for name in ("stations", "ridership", "delays")}
    for batch in ("odd", "even", "even"):
        part = {name: df if name == "stations" else df.filter((F.col("ingest_seq") % 2 == 0) == F.lit(batch == "even")) for name, df in feeds.items()}
        result = full_load.run(spark, part, folder, order_by="ingest_seq", batch=batch)
        if result["status"] != "completed":
            raise RuntimeError(result["errors"])
    rides, delays = (full_load.read_table(spark, folder, t) for t in ("fact_ridership", "fact_delays"))
    ids = lambda serial: [F.count(F.lit(1)).alias("records"), F.countDistinct(serial).alias("ids")]
    names = lambda t: F.lit(t).alias("table_name")
    rides = rides.groupBy(names("fact_ridership"), "date_key").agg(*ids("ridership_id"), F.sum("total_traffic").alias("total"))
    delays = delays.groupBy(names("fact_delays"), "date_key").agg(*ids("delay_id"), F.sum("delay_duration_minutes").alias("total"))
    return rides.unionByName(delays)


def full_load_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delays of which some have no date or an impossible one: what is loaded, what is refused and why, and the calendar's days."""
    folder = sinks.shared_folder(spark, "full_load")
    feed = adapters.feed(spark, sf_dir, "delays")
    seq = F.col("ingest_seq")
    day = F.when(seq % 7 == 0, F.lit("9999-12-31")).when(seq % 7 == 1, F.lit("0001-01-01")).when(seq % 7 == 2, F.lit("soon")).otherwise(F.col("start_date"))
    result = full_load.run(spark, {"delays": feed.withColumn("start_date", day)}, folder, order_by="ingest_seq", batch="junk")
    if result["status"] != "completed":
        raise RuntimeError(result["errors"])
    refused = full_load.read_table(spark, folder, "quarantine").select(F.col("error_message").alias("what"))
    loaded = full_load.read_table(spark, folder, "fact_delays").select(F.lit("loaded").alias("what"))
    days = spark.read.parquet(f"{folder}/dim_date").select(F.lit("calendar").alias("what"))
    return refused.union(loaded).union(days).groupBy("what").agg(F.count(F.lit(1)).alias("records"))


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit rows of a load of the delay feed and of the same batch once more."""
    folder = sinks.shared_folder(spark, "full_load")
    for _ in range(2):
        result = full_load.run(spark, {"delays": adapters.feed(spark, sf_dir, "delays")}, folder, order_by="ingest_seq", batch="all")
        if result["status"] != "completed":
            raise RuntimeError(result["errors"])
    return full_load.read_log(spark, folder).select("job_name", "status", "records_processed", "records_inserted", "records_failed")


def sample_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delays binned again by the sample profile."""
    rows = load.rebin(star_of(spark, sf_dir).delays, "sample")
    return rows.groupBy("severity_level").agg(
        F.count(F.lit(1)).alias("delays"), F.min("delay_duration_minutes").alias("least"), F.max("delay_duration_minutes").alias("most")
    )


def cleaning_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of cleaning the delay feed."""
    stats = clean.CleaningStats()
    clean.CLEANERS["delays"](adapters.feed(spark, sf_dir, "delays"), "ingest_seq", stats)
    return stats.frame


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters that a load of the delay feed takes from what it wrote."""
    folder = sinks.shared_folder(spark, "full_load")
    result = full_load.run(spark, {"delays": adapters.feed(spark, sf_dir, "delays")}, folder, order_by="ingest_seq", batch="all")
    if result["status"] != "completed":
        raise RuntimeError(result["errors"])
    counts = result["cleaning"]["delays"]
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} LONG" for name in counts))


def load_performance(update: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        existing = adapters.view(spark, sf_dir, adapters.EXISTING["performance"])
        star = star_of(spark, sf_dir)
        feed = cleaned(spark, sf_dir, "performance")
        rows = load.load_performance(feed, star.lines, existing, "ingest_seq", update, star.small)
        return plain_types(
            rows.select(
                "date_key", "line_id", "scheduled_trips", "actual_trips", "on_time_trips", "late_trips",
                "canceled_trips", "on_time_percentage",
            )
        )

    return run


def load_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing = adapters.view(spark, sf_dir, adapters.EXISTING["stations"])
    rows = load.load_stations(cleaned(spark, sf_dir, "stations"), existing, "ingest_seq")
    old = F.when(F.col("division") == "IND", F.col("station_id")).alias("kept_id")
    return plain_types(rows.select(old, "station_name", "borough", "latitude", "longitude", "lines_served", "division"))


def station_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which stations an upsert creates and which it stamps; the earlier rows carry neither time."""
    existing = adapters.view(spark, sf_dir, adapters.EXISTING["stations"])
    out = load.load_stations(cleaned(spark, sf_dir, "stations"), existing, "ingest_seq")
    return out.select("station_name", F.col("created_at").isNotNull().alias("created"), F.col("updated_at").isNotNull().alias("stamped"))


def nan_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that are none become NULL before a load."""
    customers = adapters.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    nan = F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    return load.null_out_nan(customers.withColumn("c_acctbal", nan))


def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = star_of(spark, sf_dir)
    rows = load.daily_summary(star.ridership, star.times)
    return plain_types(rows.drop("daily_ridership_id", "created_at", "data_source"))


def date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days orders were placed on."""
    orders = adapters.table(spark, sf_dir, "orders")
    days = orders.select(F.to_date("o_orderdate").alias("full_date")).distinct()
    return dims.date_attributes(days)


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order days with the year-end holidays marked."""
    orders = adapters.table(spark, sf_dir, "orders")
    days = orders.select(F.to_date("o_orderdate").alias("full_date")).distinct()
    marked = days.filter(calendar.sample_holiday(F.col("full_date"))).withColumn("holiday_name", F.lit("Year End"))
    return dims.date_attributes(days, marked).select("date_key", "is_holiday", "holiday_name")


def time_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per minute of the day on the time dimension."""
    events = adapters.table(spark, sf_dir, "events")
    per_minute = events.groupBy(calendar.time_key(F.hour("ts"), F.minute("ts")).alias("time_key")).agg(
        F.count(F.lit(1)).alias("events")
    )
    return dims.time_dimension(spark).join(per_minute, "time_key", "left")


def insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with shipments added to the days with orders."""
    orders, items = (adapters.table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    have = orders.select(F.to_date("o_orderdate").alias("full_date")).distinct().withColumn("origin", F.lit("order"))
    new = items.select(F.to_date("l_shipdate").alias("full_date"), F.lit("shipment").alias("origin"))
    return dims.insert_absent(have, new, ["full_date"])


def text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = adapters.table(spark, sf_dir, "customer")
    return customers.select("c_name", text.text_key(F.col("c_name")).alias("text_key"))


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = star_of(spark, sf_dir)
    return sinks.row_counts({n: getattr(star, a) for n, a in exports.TABLES.items()})


LOADS: dict[str, Query] = {
    "load_stations": load_stations,
    "load_ridership": load_ridership(large=False),
    "load_delays": load_delays(large=False),
    "load_ridership_large": load_ridership(large=True),
    "load_delays_large": load_delays(large=True),
    "full_load_two_days": full_load_two_days,
    "full_load_split_day": full_load_split_day,
    "full_load_quarantine": full_load_quarantine,
    "load_audit": load_audit,
    "sample_severity": sample_severity,
    "cleaning_counts": cleaning_counts,
    "load_counts": load_counts,
    "station_stamps": station_stamps,
    "nan_balances": nan_balances,
    "load_performance": load_performance("listed"),
    "load_performance_all_columns": load_performance("all"),
    "daily_summary": daily_summary,
    "date_dimension": date_dimension,
    "date_dimension_holidays": holidays,
    "time_dimension": time_dimension,
    "insert_absent": insert_absent,
    "text_keys": text_keys,
    "row_counts": row_counts,
}

# --- Sources and sinks ------------------------------------------------------------------------------------------


def landed_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridership pages landed as JSON, read back with a source-side window."""
    root = sinks.shared_folder(spark, "landing")
    landing.land(adapters.feed(spark, sf_dir, "ridership").drop("ingest_seq"), root, "subway_ridership")
    df = landing.read_dataset(spark, root, "subway_ridership", "2024-01-10", "2024-01-20")
    return df.groupBy("station").agg(F.count(F.lit(1)).alias("records"), F.max("transit_timestamp").alias("latest"))


def landed_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record cap of a landed data set: a report of its first 500 rows."""
    root = sinks.shared_folder(spark, "landing")
    adapters.feed(spark, sf_dir, "performance").drop("ingest_seq").write.json(f"{root}/performance_subway")
    columns = ["period_year", "period_month", "line", "on_time_percentage"]
    df = landing.read_dataset(spark, root, "performance_subway", year=1997)
    return landing.first_rows(df.select(*columns, "wait_assessment", "scheduled_trips"), 500)


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean delays written as CSV and read back with their schema."""
    folder = sinks.shared_folder(spark, "processed")
    df = cleaned(spark, sf_dir, "delays").select(*CLEAN_COLUMNS["delays"]).drop("ingest_seq", "incident_datetime")
    path = sinks.write_frames({"delays": df}, folder, "_cleaned")["delays"]
    return landing.read_csv(spark, path, dict(df.dtypes))


def delimited_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delays with gaps written for a bulk loader, NULL as backslash N, and read back."""
    path = sinks.shared_folder(spark, "bulk")
    df = star_of(spark, sf_dir).delays
    columns = ["delay_id", "line_id", "delay_category", "delay_reason"]
    sinks.write_delimited(df, path, columns)
    return sinks.read_delimited(spark, path, {c: dict(df.dtypes)[c] for c in columns})


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridership rows that cannot be loaded, by reason."""
    feed = adapters.feed(spark, sf_dir, "ridership")
    timed = feed.withColumn("datetime", calendar.to_datetime(F.col("transit_timestamp")))
    _, rejected = sinks.split_rejected(timed, sinks.required_error(["datetime", "exits"]), "ridership")
    rejected = rejected.withColumn("line", F.get_json_object("raw_data", "$.line"))
    return rejected.groupBy("dataset", "processed", "error_message", "line").agg(F.count(F.lit(1)).alias("records"))


def refreshed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly ridership stored by year, then the partitions of two years replaced from doubled facts."""
    path = sinks.shared_folder(spark, "monthly")
    star = star_of(spark, sf_dir, True)
    months = marts.monthly_trends(star).select("year", "month_number", "total_entries")
    sinks.refresh_partitions(months, path, ["year"])
    late = months.filter(F.col("year") >= 2000).withColumn("total_entries", F.col("total_entries") * 2)
    sinks.refresh_partitions(late, path, ["year"])
    return spark.read.schema("month_number INT, total_entries BIGINT, year INT").parquet(path)


def refreshed_daily_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily KPIs stored by month in the independent mode, then January 2024 replaced in the literal one."""
    path = sinks.shared_folder(spark, "kpis")
    star = star_of(spark, sf_dir)
    exports.refresh_daily_kpis(star, path, mode="independent")
    exports.refresh_daily_kpis(star, path, dt.date(2024, 1, 10), dt.date(2024, 1, 20))
    schema = "full_date DATE, day_name STRING, is_weekend BOOLEAN, total_entries DECIMAL(38,0), total_exits DECIMAL(38,0), " \
        "active_stations BIGINT, delay_count BIGINT, avg_delay_minutes DOUBLE, system_avg_otp DOUBLE, year INT, month_number INT"
    return plain_types(spark.read.schema(schema).parquet(path))


def parameterised(spark: SparkSession, sf_dir: str) -> DataFrame:
    star_of(spark, sf_dir).delays.createOrReplaceTempView("fact_delays")
    return sinks.run_query(
        spark,
        "SELECT delay_reason, count(*) AS delays FROM fact_delays WHERE delay_duration_minutes >= :least GROUP BY 1",
        {"least": 30},
    )


def last_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value of the default extract window."""
    orders = adapters.table(spark, sf_dir, "orders")
    recent = landing.in_window(orders, "o_orderdate", "2000-12-31")
    return recent.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), F.min("o_orderdate").alias("first"))


def exported_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export of all result sets: names and rows of what was written. Without performance rows one set is empty and left out."""
    star, folder = star_of(spark, sf_dir), sinks.shared_folder(spark, "exports")
    names = exports.export_for_bi(replace(star, performance=star.performance.filter("false")), folder)
    return sinks.row_counts({name: spark.read.option("header", True).csv(f"{folder}/{name}") for name in names})


def quality_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on a ridership feed with repeated rows, a column that is mostly empty and one that is not there."""
    feed = adapters.feed(spark, sf_dir, "ridership").withColumn("station", F.when(F.col("ingest_seq") % 3 == 0, F.col("station")))
    twice = feed.unionByName(feed.filter(F.col("line").startswith("c")))
    passed, report = quality.quality_report(twice, ["station", "fare"])
    found = [("passed", str(passed).lower()), *(("issue", text) for text in report["issues"])]
    found += [(name, str(report[name])) for name in ("total_records", "total_columns", "duplicate_count")]
    return spark.createDataFrame(found, "what STRING, value STRING")


STORES: dict[str, Query] = {
    "exported_sets": exported_sets,
    "quality_verdict": quality_verdict,
    "landed_window": landed_window,
    "landed_cap": landed_cap,
    "csv_round_trip": csv_round_trip,
    "delimited_round_trip": delimited_round_trip,
    "quarantine": quarantine,
    "refreshed_months": refreshed_months,
    "refreshed_daily_kpis": refreshed_daily_kpis,
    "parameterised": parameterised,
    "last_year": last_year,
}

# --- Kept results and positions ---------------------------------------------------------------------------------


def refreshed_twice(spark: SparkSession, sf_dir: str, names: Sequence[str], long: bool = False) -> tuple[Star, str]:
    """Facts loaded in two batches with a refresh after each: the later days come second, and so does the 31st of every month."""
    star = star_of(spark, sf_dir, long)
    rides = star.ridership.withColumn("total_traffic", F.col("entries") + F.col("exits"))
    facts = {"fact_ridership": rides, "fact_delays": star.delays, "fact_performance": star.performance}
    days = star.dates if long else star.dates.filter(F.col("year") == 2024)
    folder, root = sinks.shared_folder(spark, "loaded"), sinks.shared_folder(spark, "kept")
    sinks.write_frames({"dim_date": days, "dim_time": star.times, "dim_subway_lines": star.lines}, folder, fmt="parquet")
    stations = full_load.table_at(spark, folder, "dim_stations")
    stations.replace(conform(star.stations, stations.schema), [], "all")
    late = (F.col("date_key") >= (20000101 if long else 20240116)) | (F.col("date_key") % 100 == 31)
    for batch in ("first", "late"):
        for fact in sorted({f for n in names for f in kept.RESULTS[n].facts}):
            table = full_load.table_at(spark, folder, fact)
            table.append(conform(facts[fact].filter(late == F.lit(batch == "late")), table.schema), batch)
        kept.refresh(spark, folder, root, names)
    return kept.loaded_star(spark, folder), root


def from_kept(name: str, answer: Callable[[Star, DataFrame], DataFrame], long: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star, root = refreshed_twice(spark, sf_dir, [name], long)
        return plain_types(answer(star, kept.kept_table(spark, root, name).read()))

    return run


def kept_refreshes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months that the second refresh renewed, with their rows."""
    _, root = refreshed_twice(spark, sf_dir, ["station_months"], long=True)
    table = kept.kept_table(spark, root, "station_months")
    return table.read(table.changed_since(1)).groupBy("month").agg(F.count(F.lit(1)).alias("stations"), F.sum("entries").alias("entries"))


KEPT: dict[str, Query] = {
    "kept_station_performance": from_kept("station_months", kept.station_performance, long=True),
    "kept_top_stations": from_kept("station_months", kept.top_stations, long=True),
    "kept_hourly_ridership": from_kept("hour_months", kept.hourly_ridership),
    "kept_peak_hours": from_kept("hour_months", lambda star, states: kept.peak_hours(states)),
    "kept_active_by_month": from_kept("active_days", lambda star, states: kept.active_stations(star, states, ["year", "month_number"]), long=True),
    "kept_active_by_weekday": from_kept("active_days", lambda star, states: kept.active_stations(star, states, ["day_name"]), long=True),
    "kept_daily_kpis": from_kept("daily_kpis", lambda star, rows: rows.drop("month")),
    "kept_refreshes": kept_refreshes,
}

# The order of sorted marts, completed by names where values can be equal.
ORDERS: dict[str, list[tuple[str, str]]] = {
    "daily_ridership": [
        ("full_date", "asc nulls first"), ("total_traffic", "desc nulls first"), ("station_name", "asc nulls first"), ("line_name", "asc nulls first"),
    ],
    "delay_summary_by_line": [("total_delays", "desc nulls first"), ("line_name", "asc nulls first")],
    "monthly_trends": [("year", "asc nulls first"), ("month_number", "asc nulls first")],
    "peak_hours": [("total_entries", "desc nulls first"), ("hour", "asc nulls first")],
    "delay_causes": [("incident_count", "desc nulls first"), ("delay_reason", "asc nulls first")],
    "borough_traffic": [("total_traffic", "desc nulls first"), ("borough", "asc nulls first")],
    "station_performance": [("traffic_rank", "asc nulls last"), ("station_id", "asc nulls last")],
}


def in_order(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        keys = [getattr(F.col(c), how.replace(" ", "_"))() for c, how in ORDERS[name]]
        return with_positions(MARTS[name](spark, sf_dir), keys)

    return run


POSITIONS: dict[str, Query] = {f"ordered_{name}": in_order(name) for name in ORDERS}

# --- Reports ----------------------------------------------------------------------------------------------------


def on_clean(report: Callable[..., DataFrame], *names: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frames = [cleaned(spark, sf_dir, n) for n in names]
        for i, n in enumerate(names):
            if n == "ridership":
                frames[i] = frames[i].withColumns({c: F.col(c).cast("long") for c in ("entries", "exits")})
        return report(*frames)

    return run


REPORTS: dict[str, Query] = {
    "report_top_stations": on_clean(reports.top_stations_report, "ridership"),
    "report_boroughs": on_clean(reports.borough_report, "ridership", "stations"),
    "report_peaks": on_clean(reports.peak_report, "ridership"),
    "report_on_time": rounded(on_clean(reports.on_time_report, "performance"), ["avg_otp"], 6),
    "report_causes": rounded(on_clean(reports.causes_report, "delays"), ["avg_minutes"], 9),
    "report_line_delays": rounded(on_clean(reports.line_delays_report, "delays"), ["avg_minutes"], 9),
    "report_weekend": on_clean(reports.weekend_report, "ridership"),
    "report_summary": on_clean(reports.summary_report, "stations", "ridership", "delays", "performance"),
}


def all_queries() -> dict[str, Query]:
    return {**MARTS, **LARGE, **MEASURES, **EXPORTS, **SQL_NAMES, **CLEANING, **LOADS, **STORES, **KEPT, **POSITIONS, **REPORTS}
