"""Console reports over clean or sample frames, before they are loaded into a star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmart.functions.numbers import ratio
from railmart.operators.lookup import fits_broadcast, lookup, unique_by

# Hours of the report's rush splits, first and last hour included.
MORNING, EVENING = (7, 9), (17, 19)


def top_stations_report(ridership: DataFrame, k: int = 10) -> DataFrame:
    return (
        ridership.filter(F.col("station_name").isNotNull())
        .groupBy("station_name")
        .agg(F.sum("entries").alias("entries"))
        .orderBy(F.col("entries").desc(), "station_name")
        .limit(k)
    )


def borough_report(ridership: DataFrame, stations: DataFrame) -> DataFrame:
    """Entries per borough and their share of all entries; a repeated station name counts once."""
    boroughs = unique_by(stations.filter(F.col("station_name").isNotNull()).select("station_name", "borough"), "station_name", "borough")
    per_station = ridership.groupBy("station_name").agg(F.sum("entries").alias("entries"))
    total = per_station.agg(F.sum("entries")).scalar()
    named = lookup(per_station, boroughs, "station_name", small=fits_broadcast(stations))
    return (
        named.filter(F.col("borough").isNotNull())
        .groupBy("borough")
        .agg(F.sum("entries").alias("entries"))
        .withColumn("pct", ratio(F.col("entries") * 100, total))
    )


def peak_report(ridership: DataFrame) -> DataFrame:
    """Morning, evening and off-peak entries, in three rows."""
    hour, entries = F.col("hour"), F.col("entries")
    rows = ridership.filter(hour.isNotNull())
    totals = rows.agg(
        F.coalesce(F.sum(F.when(hour.between(*MORNING), entries)), F.lit(0)).alias("morning"),
        F.coalesce(F.sum(F.when(hour.between(*EVENING), entries)), F.lit(0)).alias("evening"),
        F.coalesce(F.sum(entries), F.lit(0)).alias("total"),
    )

    def part(name: str, value) -> object:
        return F.struct(F.lit(name).alias("period"), value.alias("entries"))

    off = F.col("total") - F.col("morning") - F.col("evening")
    parts = F.array(part("Morning Rush", F.col("morning")), part("Evening Rush", F.col("evening")), part("Off-Peak", off))
    return totals.select("total", F.inline(parts)).select(
        "period", "entries", ratio(F.col("entries") * 100, F.col("total")).alias("pct")
    )


def on_time_report(performance: DataFrame, k: int = 10) -> DataFrame:
    """Lines with the best mean on-time percentage and a mark at 85 and 75."""
    otp = F.col("avg_otp")
    return (
        performance.filter(F.col("line_name").isNotNull())
        .groupBy("line_name")
        .agg(F.avg("on_time_percentage").alias("avg_otp"))
        .withColumn("status", F.when(otp >= 85, "good").when(otp >= 75, "fair").otherwise("poor"))
        .orderBy(otp.desc_nulls_last(), "line_name")
        .limit(k)
    )


def _delay_counts(delays: DataFrame, by: str, k: int) -> DataFrame:
    minutes = F.col("delay_duration_minutes")
    return (
        delays.filter(F.col(by).isNotNull())
        .groupBy(by)
        .agg(F.count(minutes).alias("incidents"), ratio(F.sum(minutes), F.count(minutes)).alias("avg_minutes"))
        .orderBy(F.col("incidents").desc(), by)
        .limit(k)
    )


def causes_report(delays: DataFrame, k: int = 8) -> DataFrame:
    return _delay_counts(delays, "delay_reason", k)


def line_delays_report(delays: DataFrame, k: int = 10) -> DataFrame:
    return _delay_counts(delays, "line_name", k)


def weekend_report(ridership: DataFrame) -> DataFrame:
    """Entries per day on weekdays and weekends and how far the weekend falls behind, in percent.

    Summed per day first, so counting days needs no second look at the rows.
    """
    days = ridership.groupBy(F.to_date("date").alias("date")).agg(F.sum("entries").alias("entries"))
    weekend = F.weekday("date") >= 5

    def per_day(is_kind) -> object:
        return ratio(F.sum(F.when(is_kind, F.col("entries"))), F.count(F.when(is_kind, F.col("date"))))

    averages = days.agg(per_day(~weekend).alias("weekday_avg"), per_day(weekend).alias("weekend_avg"))
    return averages.withColumn("weekend_drop_pct", (1 - ratio(F.col("weekend_avg"), F.col("weekday_avg"))) * 100)


def summary_report(
    stations: DataFrame, ridership: DataFrame, delays: DataFrame, performance: DataFrame
) -> DataFrame:
    """Row counts, date range and totals of the four data sets in one row."""

    def rows(df: DataFrame):
        return df.agg(F.count(F.lit(1))).scalar()

    totals = ridership.agg(
        F.count(F.lit(1)).alias("ridership_records"),
        F.min(F.to_date("date")).alias("first_date"),
        F.max(F.to_date("date")).alias("last_date"),
        F.sum("entries").alias("total_entries"),
        F.sum("exits").alias("total_exits"),
    )
    return totals.withColumns(
        {"stations": rows(stations), "delay_incidents": rows(delays), "performance_records": rows(performance)}
    )
