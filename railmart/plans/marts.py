"""The star's views, table functions and analytical queries.

Every mart is ``mart(star, ...) -> DataFrame``. Facts are summed per integer key before anything else, so a shuffle
carries one row per key and task instead of raw rows. Ratios and percentages are doubles.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railmart.functions import calendar as cal
from railmart.functions.bins import performance_band
from railmart.functions.numbers import ratio, rounded_mean, rounded_ratio
from railmart.operators import fanout
from railmart.operators.dims import PERIOD_ORDER
from railmart.operators.fanout import Fact, fan_out
from railmart.operators.ordered import median_of_counts, rank_desc
from railmart.operators.windows import change_from_previous_row, with_total
from railmart.plans.star import Star

Day = dt.date | str | None

DAY_COLUMNS = ["full_date", "day_name", "day_of_week", "month_name", "month_number", "quarter", "year", "is_weekend", "is_holiday"]
PLACE_COLUMNS = ["station_name", "borough", "latitude", "longitude"]
LINE_COLUMNS = ["line_name", "line_color", "line_group"]


def sums(*columns: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def rows_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def exact(column: str) -> Column:
    """Stored percentages have two places; as decimals their sums do not depend on the order of addition."""
    return F.col(column).cast("decimal(9,2)")


def percent_mean(column: str) -> Column:
    return ratio(F.sum(exact(column)), F.count(column))


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns if c in df.columns})


def optional(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Add NULL columns a smaller star lacks."""
    missing = {c: F.lit(None).cast(t) for c, t in schema.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def _stations(star: Star) -> Star:
    return replace(
        star,
        stations=optional(
            star.stations,
            {"latitude": "double", "longitude": "double", "structure_type": "string", "division": "string"},
        ),
    )


def _performance(star: Star) -> DataFrame:
    return optional(
        star.performance,
        {"wait_assessment": "decimal(5,2)", "customer_journey_time_performance": "decimal(5,2)"},
    )


# --- Views ------------------------------------------------------------------------------------------------------


def daily_ridership(star: Star) -> DataFrame:
    """Entries, exits and traffic by day, station and line."""
    star = _stations(star)
    per_day = star.attach_station(
        star.ridership,
        ["date_key", "line_id"],
        PLACE_COLUMNS,
        {
            "entries": F.sum("entries"),
            "exits": F.sum("exits"),
            "traffic": F.sum("total_traffic"),
            "counted": F.count("entries"),
            "records": F.count(F.lit(1)),
        },
    )
    named = star.attach(star.attach(per_day, "dates", DAY_COLUMNS, "inner"), "lines", LINE_COLUMNS)
    return named.groupBy(*DAY_COLUMNS, *PLACE_COLUMNS, *LINE_COLUMNS).agg(
        F.sum("entries").alias("total_entries"),
        F.sum("exits").alias("total_exits"),
        F.sum("traffic").alias("total_traffic"),
        ratio(F.sum("entries"), F.sum("counted")).alias("avg_entries"),
        F.sum("records").alias("record_count"),
    )


def hourly_ridership(star: Star) -> DataFrame:
    """Hourly pattern by weekday, line and borough."""
    hour = ["hour", "time_period", "is_peak_hour", "am_pm"]
    timed = star.attach(star.ridership, "times", hour, "inner")
    per_hour = star.attach_station(
        timed,
        [*hour, "date_key", "line_id"],
        ["borough"],
        {"entries": F.sum("entries"), "exits": F.sum("exits"), "counted": F.count("entries")},
    )
    named = star.attach(per_hour, "dates", ["full_date", "day_name", "is_weekend"], "inner")
    named = star.attach(named, "lines", ["line_name", "line_color"])
    return named.groupBy(*hour, "day_name", "is_weekend", "line_name", "line_color", "borough").agg(
        F.sum("entries").alias("total_entries"),
        F.sum("exits").alias("total_exits"),
        ratio(F.sum("entries"), F.sum("counted")).alias("avg_entries_per_record"),
        F.countDistinct("full_date").alias("days_count"),
    )


def station_performance(star: Star, nulls: str = "first") -> DataFrame:
    """Totals and ranks of every station. Stations without ridership rank first, or last with ``nulls='last'``.

    Always a plan over the facts. Ranking a large station table looks at the totals several times; a caller who wants
    them computed once can write them out with ``sinks.stored``.
    """
    per_station = star.ridership.groupBy("station_id").agg(
        F.countDistinct("date_key").alias("days_with_data"),
        F.sum("entries").alias("total_entries"),
        F.sum("exits").alias("total_exits"),
        F.sum("total_traffic").alias("total_traffic"),
        ratio(F.sum("entries"), F.count("entries")).alias("avg_daily_entries"),
        F.max("entries").alias("peak_entries"),
    )
    return ranked_stations(star, per_station, nulls)


def ranked_stations(star: Star, per_station: DataFrame, nulls: str = "first") -> DataFrame:
    """Every station with its totals, however they were summed, and its ranks by traffic."""
    star = _stations(star)
    about = ["station_id", "station_name", "borough", "latitude", "longitude", "lines_served", "ada_accessible"]
    all_stations = star.stations.select(*about).join(per_station, "station_id", "left")
    all_stations = all_stations.withColumn("days_with_data", F.coalesce("days_with_data", F.lit(0)))
    small = "stations" in star.small
    return rank_desc(
        all_stations,
        "total_traffic",
        {"traffic_rank": [], "borough_rank": ["borough"]},
        row_id="station_id",
        nulls=nulls,
        one_task=small,
    )


def line_performance(star: Star) -> DataFrame:
    """Daily performance of every line with its band."""
    rows = star.attach(_performance(star), "dates", ["full_date", "day_name", "month_name", "year", "is_weekend"], "inner")
    rows = star.attach(rows, "lines", [*LINE_COLUMNS, "service_pattern"], "inner")
    out = rows.select(
        "full_date", "day_name", "month_name", "year", "is_weekend", *LINE_COLUMNS, "service_pattern",
        "scheduled_trips", "actual_trips", "on_time_trips", "late_trips", "canceled_trips", "on_time_percentage",
        "wait_assessment", "customer_journey_time_performance",
        performance_band(F.col("on_time_percentage")).alias("performance_category"),
    )
    return as_double(out, "on_time_percentage", "wait_assessment", "customer_journey_time_performance")


def _delay_rows(star: Star) -> DataFrame:
    return optional(star.delays, {"resolution_time_minutes": "int"})


def delay_analysis(star: Star) -> DataFrame:
    """Every delay with all its dimensions."""
    rows = star.attach(_delay_rows(star), "dates", ["full_date", "day_name", "month_name", "year", "is_weekend"], "inner")
    rows = star.attach(rows, "times", ["hour", "time_period", "is_peak_hour"])
    rows = star.attach(rows, "lines", LINE_COLUMNS, spread_by="delay_id")
    rows = star.attach(rows, "stations", ["station_name", "borough"], spread_by="delay_id")
    return rows.select(
        "full_date", "day_name", "month_name", "year", "is_weekend", "hour", "time_period", "is_peak_hour",
        *LINE_COLUMNS, "station_name", "borough", "delay_category", "severity_level", "delay_reason",
        "delay_duration_minutes", "passenger_impact_estimate", "resolution_time_minutes",
    )


def delay_summary_by_line(star: Star) -> DataFrame:
    per_line = (
        star.attach(star.delays, "times", ["is_peak_hour"])
        .groupBy("line_id")
        .agg(
            F.count(F.lit(1)).alias("delays"),
            F.sum("delay_duration_minutes").alias("minutes"),
            F.count("delay_duration_minutes").alias("timed"),
            F.max("delay_duration_minutes").alias("longest"),
            F.sum("passenger_impact_estimate").alias("affected"),
            rows_where(F.col("severity_level") == "High").alias("severe"),
            rows_where(F.col("is_peak_hour")).alias("peak"),
        )
    )
    return (
        star.attach(per_line, "lines", LINE_COLUMNS)
        .groupBy(*LINE_COLUMNS)
        .agg(
            F.sum("delays").alias("total_delays"),
            ratio(F.sum("minutes"), F.sum("timed")).alias("avg_delay_minutes"),
            F.max("longest").alias("max_delay_minutes"),
            F.sum("affected").alias("total_passengers_affected"),
            F.sum("severe").alias("severe_delays"),
            F.sum("peak").alias("peak_hour_delays"),
            rounded_ratio(F.sum("peak"), F.sum("delays"), 2, 100).alias("peak_hour_delay_pct"),
        )
        .orderBy(F.col("total_delays").desc_nulls_first())
    )


def monthly_trends(star: Star) -> DataFrame:
    """Monthly sums against the month row before."""
    per_day = star.ridership.groupBy("date_key").agg(*sums("entries", "exits"), F.count("entries").alias("counted"))
    months = (
        star.attach(per_day, "dates", ["year", "month_number", "month_name"], "inner")
        .groupBy("year", "month_number", "month_name")
        .agg(
            F.sum("entries").alias("total_entries"),
            F.sum("exits").alias("total_exits"),
            ratio(F.sum("entries"), F.sum("counted")).alias("avg_daily_entries"),
        )
    )
    return (
        change_from_previous_row(months, "total_entries", ["year", "month_number"])
        .withColumnsRenamed({"prev_total_entries": "prev_month_entries", "change_pct": "mom_change_pct"})
        .orderBy("year", "month_number")
    )


def daily_kpis(star: Star, mode: str = "literal") -> DataFrame:
    """One row per calendar day. ``literal`` repeats each fact's rows once per row of the other facts, as the
    three-way join does; ``independent`` gives each fact's own totals."""
    days = star.dates.select("date_key", "full_date", "year", "month_number", "day_name", "is_weekend")
    rides = Fact(
        star.ridership,
        {"entries": F.sum("entries"), "exits": F.sum("exits")},
        {"stations": F.countDistinct("station_id")},
    )
    delays = Fact(
        star.delays,
        {"minutes": F.sum("delay_duration_minutes"), "timed": F.count("delay_duration_minutes")},
        {"delays": F.count("delay_id")},
    )
    performance = Fact(
        star.performance, {"otp": F.sum(exact("on_time_percentage")), "rated": F.count("on_time_percentage")}
    )
    joined = fan_out(days, "date_key", {"ridership": rides, "delays": delays, "performance": performance}, mode)
    return joined.groupBy("full_date", "year", "month_number", "day_name", "is_weekend").agg(
        fanout.whole("entries").alias("total_entries"),
        fanout.whole("exits").alias("total_exits"),
        F.coalesce(F.sum("stations"), F.lit(0)).alias("active_stations"),
        F.coalesce(F.sum("delays"), F.lit(0)).alias("delay_count"),
        F.coalesce(fanout.mean("minutes", "timed"), F.lit(0.0)).alias("avg_delay_minutes"),
        F.coalesce(fanout.mean("otp", "rated"), F.lit(0.0)).alias("system_avg_otp"),
    )


# --- Parameterised lookups --------------------------------------------------------------------------------------


def station_totals(star: Star, stations: DataFrame | None = None, mode: str = "literal") -> DataFrame:
    """Ridership and delays per station name and borough, for all or a filtered set of stations."""
    dim = (star.stations if stations is None else stations).select("station_id", "station_name", "borough")

    def of_these(rows: DataFrame) -> DataFrame:
        if stations is None or "stations" not in star.small:
            return rows
        return rows.join(F.broadcast(dim.select("station_id")), "station_id", "left_semi")

    rides = Fact(
        of_these(star.ridership),
        {"entries": F.sum("entries"), "exits": F.sum("exits"), "counted": F.count("entries")},
    )
    delays = Fact(
        of_these(star.delays),
        {
            "delays": F.count("delay_id"),
            "minutes": F.sum("delay_duration_minutes"),
            "timed": F.count("delay_duration_minutes"),
        },
    )
    joined = fan_out(dim, "station_id", {"ridership": rides, "delays": delays}, mode)
    return joined.groupBy("station_name", "borough").agg(
        F.coalesce(fanout.whole("entries"), F.lit(0)).alias("total_entries"),
        F.coalesce(fanout.whole("exits"), F.lit(0)).alias("total_exits"),
        F.round(fanout.mean("entries", "counted"), 2).alias("avg_daily_entries"),
        F.coalesce(fanout.whole("delays"), F.lit(0)).alias("delay_count"),
        F.round(F.coalesce(fanout.mean("minutes", "timed"), F.lit(0.0)), 2).alias("avg_delay_minutes"),
    )


def station_summary(star: Star, name: str, mode: str = "literal") -> DataFrame:
    """Stations whose name contains ``name`` in any case; ``%`` and ``_`` in it are wildcards."""
    found = star.stations.filter(F.col("station_name").ilike(f"%{name}%"))
    return station_totals(star, found, mode)


def line_days(star: Star) -> DataFrame:
    """Trips and delays per line and day."""
    delays = star.delays.groupBy("date_key", "line_id").agg(F.count("delay_id").alias("delays"))
    rows = star.performance.join(delays, ["date_key", "line_id"], "left")
    rows = star.attach(rows, "dates", ["full_date"], "inner")
    rows = star.attach(rows, "lines", ["line_name"], "inner")
    by = ["line_name", "full_date", "scheduled_trips", "on_time_trips", "on_time_percentage"]
    out = rows.groupBy(*by).agg(F.coalesce(F.sum("delays"), F.lit(0)).alias("delay_count"))
    return out.select(
        "line_name",
        F.col("full_date").alias("date_val"),
        "scheduled_trips",
        "on_time_trips",
        F.col("on_time_percentage").cast("double").alias("on_time_pct"),
        "delay_count",
    )


def line_performance_between(star: Star, line: str, start: Day, end: Day) -> DataFrame:
    """One line's days from ``start`` to ``end``, both included."""
    first, last = cal.as_of_date(start), cal.as_of_date(end)
    in_range = F.col("date_key").between(cal.date_key(first), cal.date_key(last))
    cut = replace(star, performance=star.performance.filter(in_range), delays=star.delays.filter(in_range))
    days = line_days(cut).filter((F.col("line_name") == line) & F.col("date_val").between(first, last))
    return days.orderBy("date_val")


# --- Analytical queries -----------------------------------------------------------------------------------------


def avg_delays_per_line(star: Star) -> DataFrame:
    """Delay statistics per line, with the exact median, all from the counts of distinct durations."""
    by = ["line_name", "line_color"]
    minutes, n = F.col("delay_duration_minutes"), F.col("n")
    per_id = star.delays.groupBy("line_id", "delay_duration_minutes").agg(F.count(F.lit(1)).alias("n"))
    counts = star.attach(per_id, "lines", by, "inner").groupBy(*by, "delay_duration_minutes").agg(F.sum("n").alias("n"))
    wide = minutes.cast("decimal(10,0)")
    total = F.sum(wide * n).cast("decimal(38,0)")
    squares = F.sum(wide * wide * n).cast("decimal(38,0)")
    timed = F.sum(F.when(minutes.isNotNull(), n))
    variance = F.try_divide((squares * timed - total * total).cast("double"), (timed * (timed - 1)).cast("double"))
    stats = counts.groupBy(*by).agg(
        F.sum("n").alias("delay_count"),
        rounded_mean(total, timed).alias("avg_delay_minutes"),
        F.round(F.sqrt(variance), 2).alias("stddev_delay"),
        F.min(minutes).alias("min_delay"),
        F.max(minutes).alias("max_delay"),
    )
    middle = median_of_counts(counts.filter(minutes.isNotNull()), "delay_duration_minutes", "n", "median_delay", by)
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"m.{c}")) for c in by]
    return (
        stats.alias("s")
        .join(middle.alias("m"), same, "left")
        .select("s.*", "m.median_delay")
        .orderBy(F.col("avg_delay_minutes").desc_nulls_first())
    )


def peak_hours(star: Star) -> DataFrame:
    hour = ["hour", "time_period", "am_pm"]
    per_minute = star.ridership.groupBy("date_key", "time_key").agg(*sums("entries", "exits"), F.count("entries").alias("counted"))
    per_day = (
        star.attach(per_minute, "times", hour, "inner").groupBy(*hour, "date_key").agg(*sums("entries", "exits", "counted"))
    )
    return (
        star.attach(per_day, "dates", ["full_date"], "inner")
        .groupBy(*hour)
        .agg(
            F.sum("entries").alias("total_entries"),
            F.sum("exits").alias("total_exits"),
            ratio(F.sum("entries"), F.sum("counted")).alias("avg_entries"),
            F.countDistinct("full_date").alias("days_measured"),
            rounded_ratio(F.sum("entries"), F.countDistinct("full_date"), 0).alias("avg_hourly_entries"),
        )
        .orderBy(F.col("total_entries").desc_nulls_first())
    )


def on_time_by_line(star: Star) -> DataFrame:
    by = ["line_name", "line_group", "service_pattern"]

    def mean_of(column: str) -> Column:
        return rounded_mean(F.sum(exact(column)), F.count(column), 2, decimals=2)

    return (
        star.attach(_performance(star), "lines", by, "inner")
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("days_measured"),
            mean_of("on_time_percentage").alias("avg_otp"),
            F.min("on_time_percentage").cast("double").alias("min_otp"),
            F.max("on_time_percentage").cast("double").alias("max_otp"),
            mean_of("wait_assessment").alias("avg_wait_assessment"),
            mean_of("customer_journey_time_performance").alias("avg_cjtp"),
        )
        .orderBy(F.col("avg_otp").desc_nulls_first())
    )


def top_stations(star: Star, k: int = 10) -> DataFrame:
    """The ``k`` stations with most traffic; equal traffic is ordered by name."""
    by = ["station_name", "borough", "lines_served"]
    per_day = star.attach_station(
        star.ridership,
        ["date_key"],
        by,
        {"traffic": F.sum("total_traffic"), "entries": F.sum("entries"), "exits": F.sum("exits")},
        how="inner",
    )
    return (
        per_day.groupBy(*by)
        .agg(
            F.sum("traffic").alias("total_traffic"),
            F.sum("entries").alias("total_entries"),
            F.sum("exits").alias("total_exits"),
            F.countDistinct("date_key").alias("days_with_service"),
            rounded_ratio(F.sum("traffic"), F.countDistinct("date_key"), 0).alias("avg_daily_traffic"),
        )
        .orderBy(F.col("total_traffic").desc_nulls_first(), "station_name", "borough", "lines_served")
        .limit(k)
    )


def delay_causes(star: Star) -> DataFrame:
    causes = star.delays.groupBy("delay_reason").agg(
        F.count(F.lit(1)).alias("incident_count"),
        rounded_mean(F.sum("delay_duration_minutes"), F.count("delay_duration_minutes")).alias("avg_duration"),
        F.sum("passenger_impact_estimate").alias("total_passengers_affected"),
    )
    # The facts are read once, and no task holds all causes, however many texts there are.
    share = rounded_ratio(F.col("incident_count"), F.col("_all"), 2, 100)
    causes = with_total(causes, "incident_count", "_all", ["delay_reason"])
    return causes.withColumn("pct_of_all_delays", share).drop("_all").orderBy(F.col("incident_count").desc_nulls_first())


def weekend_vs_weekday(star: Star) -> DataFrame:
    """Mean on-time percentage counts once per ridership record of the line and day."""
    per_line_day = star.ridership.groupBy("date_key", "line_id").agg(
        F.sum("entries").alias("entries"), F.count("entries").alias("counted"), F.count(F.lit(1)).alias("records")
    )
    performance = star.performance.select("date_key", "line_id", exact("on_time_percentage").alias("otp"))
    rated = F.when(F.col("otp").isNotNull(), F.col("records"))
    return (
        star.attach(per_line_day.join(performance, ["date_key", "line_id"], "left"), "dates", ["is_weekend"], "inner")
        .groupBy("is_weekend")
        .agg(
            F.sum("entries").alias("total_entries"),
            ratio(F.sum("entries"), F.sum("counted")).alias("avg_entries"),
            ratio(F.sum(F.col("otp") * F.col("records")), F.sum(rated)).alias("avg_otp"),
        )
        .select(F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"), "total_entries", "avg_entries", "avg_otp")
    )


def borough_traffic(star: Star) -> DataFrame:
    """Share is of all traffic, stations known or not."""
    per_station = star.ridership.groupBy("station_id").agg(
        F.sum("total_traffic").alias("traffic"), F.count("total_traffic").alias("counted")
    )
    marked = replace(star, stations=star.stations.withColumn("_known", F.lit(True)))
    total = F.sum("total_traffic").over(Window.partitionBy())
    return (
        marked.attach(per_station, "stations", ["borough", "_known"])
        .groupBy("borough", "_known")
        .agg(
            F.count("station_id").alias("station_count"),
            F.sum("traffic").alias("total_traffic"),
            F.sum("counted").alias("counted"),
        )
        .withColumn("_all", total)
        .filter("_known")
        .select(
            "borough",
            "station_count",
            "total_traffic",
            rounded_ratio(F.col("total_traffic"), F.col("_all"), 2, 100).alias("traffic_share_pct"),
            ratio(F.col("total_traffic"), F.col("counted")).alias("avg_traffic_per_record"),
        )
        .orderBy(F.col("total_traffic").desc_nulls_first())
    )


def time_period_performance(star: Star, mode: str = "literal") -> DataFrame:
    """Delays and ridership by period of the day; the rate is per 10,000 ridership records."""
    periods = star.times.select("time_key", "time_period")
    rides = Fact(star.ridership, {"entries": F.sum("entries")}, {"rides": F.count("ridership_id")})
    delays = Fact(
        star.delays,
        {"minutes": F.sum("delay_duration_minutes"), "timed": F.count("delay_duration_minutes")},
        {"delays": F.count("delay_id")},
    )
    joined = fan_out(periods, "time_key", {"ridership": rides, "delays": delays}, mode)
    delay_count, ride_count = F.coalesce(F.sum("delays"), F.lit(0)), F.coalesce(F.sum("rides"), F.lit(0))
    position = F
    for i, period in enumerate(PERIOD_ORDER):
        position = position.when(F.col("time_period") == period, i)
    return (
        joined.groupBy("time_period")
        .agg(
            delay_count.alias("delay_count"),
            fanout.mean("minutes", "timed").alias("avg_delay_minutes"),
            fanout.whole("entries").alias("total_entries"),
            rounded_ratio(delay_count, ride_count, 2, 10000).alias("delays_per_10k_entries"),
        )
        .orderBy(position.asc_nulls_last())
    )


# --- KPI cards --------------------------------------------------------------------------------------------------


def _on_day(star: Star, rows: DataFrame, as_of: Day) -> DataFrame:
    day = cal.as_of_date(as_of)
    return star.attach(rows.filter(F.col("date_key") == cal.date_key(day)), "dates", ["full_date"], "inner")


def ridership_on(star: Star, as_of: Day = None) -> DataFrame:
    """Entries plus exits of one day; a record with either missing is left out."""
    rows = _on_day(star, star.ridership, as_of)
    return rows.agg(F.sum(F.col("entries").cast("long") + F.col("exits")).alias("total_ridership"))


def recent_on_time(star: Star, as_of: Day = None, days: int = 30) -> DataFrame:
    first = cal.date_key(F.date_sub(cal.as_of_date(as_of), days))
    rows = star.performance.filter(F.col("date_key") >= first)
    otp = rounded_mean(F.sum(exact("on_time_percentage")), F.count("on_time_percentage"), 1, decimals=2)
    return rows.agg(otp.alias("avg_otp"))


def delays_in_month(star: Star, as_of: Day = None) -> DataFrame:
    day = cal.as_of_date(as_of)
    first, last = F.trunc(day, "month"), F.last_day(day)
    rows = star.delays.filter(F.col("date_key").between(cal.date_key(first), cal.date_key(last)))
    return star.attach(rows, "dates", ["full_date"], "inner").agg(F.count(F.lit(1)).alias("monthly_delays"))


def busiest_station_on(star: Star, as_of: Day = None) -> DataFrame:
    rows = _on_day(star, star.ridership, as_of)
    named = star.attach_station(rows, [], ["station_name"], {"traffic": F.sum("total_traffic")}, how="inner")
    named = named.groupBy("station_name").agg(F.sum("traffic").alias("traffic"))
    return named.orderBy(F.col("traffic").desc_nulls_first(), "station_name").limit(1)


# --- Queries over the views -------------------------------------------------------------------------------------


def top_stations_by_entries(star: Star, k: int = 10) -> DataFrame:
    return (
        daily_ridership(star)
        .groupBy("station_name")
        .agg(F.sum("total_entries").alias("total_entries"))
        .orderBy(F.col("total_entries").desc_nulls_first(), F.col("station_name").asc_nulls_last())
        .limit(k)
    )


def avg_delay_by_line(star: Star) -> DataFrame:
    """Mean over the delay view, summed per line id before the line is named."""
    per_line = star.attach(star.delays, "dates", ["full_date"], "inner").groupBy("line_id").agg(
        F.sum("delay_duration_minutes").alias("minutes"), F.count("delay_duration_minutes").alias("timed")
    )
    return (
        star.attach(per_line, "lines", ["line_name"])
        .groupBy("line_name")
        .agg(ratio(F.sum("minutes"), F.sum("timed")).alias("avg_delay"))
        .orderBy(F.col("avg_delay").desc_nulls_first())
    )


def avg_otp_by_line(star: Star) -> DataFrame:
    rows = star.attach(star.performance, "dates", ["full_date"], "inner")
    return (
        star.attach(rows, "lines", ["line_name"], "inner")
        .groupBy("line_name")
        .agg(percent_mean("on_time_percentage").alias("otp"))
        .orderBy(F.col("otp").desc_nulls_first())
    )
