"""Results kept by month, brought up to date from the ledgers of the loaded tables.

A kept result has one part for each month and remembers up to which version of each source it was made. A refresh asks the ledgers which
months were loaded since, reads the facts of these months only and replaces their parts; the switch of the manifest is the commit, so a
refresh that stops leaves the earlier result readable. Where a result holds columns of a dimension, a change of that dimension renews all
months.

``station_months``, ``hour_months`` and ``active_days`` are states: sums and the bits of distinct days or stations. Totals, ranks and distinct
counts over any months come from them without a look at the facts. ``daily_kpis`` is the finished result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart import full_load
from railmart.functions.numbers import ratio, rounded_ratio
from railmart.operators.distinct import count_ids, day_bits, days_in, id_bitmaps, month_key
from railmart.plans import marts
from railmart.plans.star import Star
from railmart.schemas import Schema, conform, ddl
from railmart.sources.parts import PartTable

HOUR_COLUMNS = ["hour", "time_period", "is_peak_hour", "am_pm"]
FACTS = {"ridership": "fact_ridership", "delays": "fact_delays", "performance": "fact_performance"}


# --- What is kept -----------------------------------------------------------------------------------------------


def station_months(star: Star) -> DataFrame:
    """Sums and days of each station and month."""
    return star.ridership.groupBy(month_key().alias("month"), "station_id").agg(
        F.sum("entries").alias("entries"),
        F.sum("exits").alias("exits"),
        F.sum("total_traffic").alias("traffic"),
        F.count("entries").alias("counted"),
        F.max("entries").alias("peak"),
        day_bits().alias("days"),
    )


def hour_months(star: Star) -> DataFrame:
    """Sums and days of each hour, weekday, line, borough and month."""
    timed = star.attach(star.ridership, "times", HOUR_COLUMNS, "inner")
    totals = {"entries": F.sum("entries"), "exits": F.sum("exits"), "counted": F.count("entries")}
    per_day = star.attach_station(timed, [*HOUR_COLUMNS, "date_key", "line_id"], ["borough"], totals)
    named = star.attach(per_day, "dates", ["day_name", "is_weekend"], "inner")
    return named.groupBy(month_key().alias("month"), *HOUR_COLUMNS, "day_name", "is_weekend", "line_id", "borough").agg(
        *marts.sums("entries", "exits", "counted"), day_bits().alias("days")
    )


def active_days(star: Star) -> DataFrame:
    """The stations with a ridership record, as bitmaps by day."""
    return id_bitmaps(star.ridership, [month_key().alias("month"), "date_key"], "station_id")


def daily_kpis(star: Star) -> DataFrame:
    return marts.daily_kpis(star).withColumn("month", F.col("year") * 100 + F.col("month_number"))


@dataclass(frozen=True)
class Kept:
    """``build`` makes the rows of the months its star holds. ``calendar`` says that days without facts have rows too."""

    build: Callable[[Star], DataFrame]
    schema: Schema
    facts: tuple[str, ...] = ("fact_ridership",)
    dims: tuple[str, ...] = ()
    calendar: bool = False


RESULTS = {
    "station_months": Kept(
        station_months,
        ddl("month INT, station_id BIGINT, entries BIGINT, exits BIGINT, traffic BIGINT, counted BIGINT, peak INT, days BIGINT"),
    ),
    "hour_months": Kept(
        hour_months,
        ddl(
            "month INT, hour INT, time_period STRING, is_peak_hour BOOLEAN, am_pm STRING, day_name STRING, is_weekend BOOLEAN, "
            "line_id BIGINT, borough STRING, entries BIGINT, exits BIGINT, counted BIGINT, days BIGINT"
        ),
        dims=("dim_stations",),
    ),
    "active_days": Kept(active_days, ddl("month INT, date_key INT, bucket BIGINT, ids BINARY")),
    "daily_kpis": Kept(
        daily_kpis,
        ddl(
            "month INT, full_date DATE, year INT, month_number INT, day_name STRING, is_weekend BOOLEAN, total_entries DECIMAL(38,0), "
            "total_exits DECIMAL(38,0), active_stations BIGINT, delay_count BIGINT, avg_delay_minutes DOUBLE, system_avg_otp DOUBLE"
        ),
        facts=tuple(FACTS.values()),
        calendar=True,
    ),
}


def kept_table(spark: SparkSession, root: str, name: str) -> PartTable:
    return PartTable(spark, f"{root}/{name}", RESULTS[name].schema, F.col("month"))


def loaded_star(spark: SparkSession, folder: str, months: Sequence[int] | None = None) -> Star:
    """The star that a load wrote below ``folder``; with ``months`` only the files of these are read."""
    dates = spark.read.parquet(f"{folder}/dim_date")
    return Star.of(
        lines=spark.read.parquet(f"{folder}/dim_subway_lines"),
        stations=full_load.read_table(spark, folder, "dim_stations"),
        dates=dates if months is None else dates.filter(month_key().isin(list(months))),
        times=spark.read.parquet(f"{folder}/dim_time"),
        **{fact: full_load.table_at(spark, folder, table).read(months) for fact, table in FACTS.items()},
    )


# --- Refresh ----------------------------------------------------------------------------------------------------


def made_from(target: PartTable) -> dict[str, int]:
    """Versions of the sources at the last refresh, which is named after them."""
    batches = target.manifest().batches
    pairs = (entry.split("@") for entry in batches[-1].batch.split(",")) if batches else ()
    return {source: int(version) for source, version in pairs}


def refresh_one(spark: SparkSession, folder: str, root: str, name: str) -> list[int]:
    """Renew the months of one result that its sources changed; returns them."""
    result, target = RESULTS[name], kept_table(spark, root, name)
    before = made_from(target)
    tables = {t: full_load.table_at(spark, folder, t) for t in (*result.facts, *result.dims)}
    # Versions are taken before the rows: what a load adds in between is read now and once more by the next refresh.
    manifests = {t: table.manifest() for t, table in tables.items()}
    now = {t: m.version for t, m in manifests.items()}
    if any(now[d] != before.get(d) for d in result.dims):
        stale = {p.key for f in result.facts for p in manifests[f].parts}
    else:
        stale = {k for f in result.facts for k in tables[f].changed_since(before.get(f, 0))}
    if result.calendar:
        per_month = spark.read.parquet(f"{folder}/dim_date").groupBy(month_key().alias("month")).agg(F.count(F.lit(1)).alias("n"))
        days = {r["month"]: r["n"] for r in per_month.collect()}
        held = {p.key: p.rows for p in target.manifest().parts}
        stale = (stale & days.keys()) | {m for m, n in days.items() if held.get(m) != n}
        now["dim_date"] = sum(days.values())
    months = sorted(stale)
    if now != before:
        rows = conform(result.build(loaded_star(spark, folder, months)), result.schema)
        target.replace(rows, months, ",".join(f"{t}@{v}" for t, v in now.items()))
    return months


def refresh(spark: SparkSession, folder: str, root: str, names: Sequence[str] | None = None) -> dict[str, list[int]]:
    """Bring the results below ``root`` up to date with the tables below ``folder``; returns the months renewed of each."""
    return {name: refresh_one(spark, folder, root, name) for name in names or RESULTS}


# --- Answers from states ----------------------------------------------------------------------------------------


def station_performance(star: Star, states: DataFrame, nulls: str = "first") -> DataFrame:
    """Totals and ranks of every station, from ``station_months``."""
    per_station = states.groupBy("station_id").agg(
        F.sum(days_in("days")).alias("days_with_data"),
        F.sum("entries").alias("total_entries"),
        F.sum("exits").alias("total_exits"),
        F.sum("traffic").alias("total_traffic"),
        ratio(F.sum("entries"), F.sum("counted")).alias("avg_daily_entries"),
        F.max("peak").alias("peak_entries"),
    )
    return marts.ranked_stations(star, per_station, nulls)


def top_stations(star: Star, states: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` stations with most traffic, from ``station_months``; stations of one name share their days."""
    by = ["station_name", "borough", "lines_served"]
    per_month = (
        star.attach(states, "stations", by, "inner")
        .groupBy(*by, "month")
        .agg(*marts.sums("traffic", "entries", "exits"), F.bit_or("days").alias("days"))
    )
    days = F.sum(days_in("days"))
    return (
        per_month.groupBy(*by)
        .agg(
            F.sum("traffic").alias("total_traffic"),
            F.sum("entries").alias("total_entries"),
            F.sum("exits").alias("total_exits"),
            days.alias("days_with_service"),
            rounded_ratio(F.sum("traffic"), days, 0).alias("avg_daily_traffic"),
        )
        .orderBy(F.col("total_traffic").desc_nulls_first(), *by)
        .limit(k)
    )


def hourly_ridership(star: Star, states: DataFrame) -> DataFrame:
    """Hourly pattern by weekday, line and borough, from ``hour_months``."""
    by = [*HOUR_COLUMNS, "day_name", "is_weekend", "line_name", "line_color", "borough"]
    per_month = (
        star.attach(states, "lines", ["line_name", "line_color"])
        .groupBy(*by, "month")
        .agg(*marts.sums("entries", "exits", "counted"), F.bit_or("days").alias("days"))
    )
    return per_month.groupBy(*by).agg(
        F.sum("entries").alias("total_entries"),
        F.sum("exits").alias("total_exits"),
        ratio(F.sum("entries"), F.sum("counted")).alias("avg_entries_per_record"),
        F.sum(days_in("days")).alias("days_count"),
    )


def peak_hours(states: DataFrame) -> DataFrame:
    """Hours by entries, from ``hour_months``; a day counts once however many lines and boroughs had it."""
    by = ["hour", "time_period", "am_pm"]
    per_month = states.groupBy(*by, "month").agg(*marts.sums("entries", "exits", "counted"), F.bit_or("days").alias("days"))
    days = F.sum(days_in("days"))
    return (
        per_month.groupBy(*by)
        .agg(
            F.sum("entries").alias("total_entries"),
            F.sum("exits").alias("total_exits"),
            ratio(F.sum("entries"), F.sum("counted")).alias("avg_entries"),
            days.alias("days_measured"),
            rounded_ratio(F.sum("entries"), days, 0).alias("avg_hourly_entries"),
        )
        .orderBy(F.col("total_entries").desc_nulls_first())
    )


def active_stations(star: Star, states: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct stations with ridership by columns of the calendar, such as year and month, from ``active_days``."""
    return count_ids(star.attach(states, "dates", by, "inner"), by, "active_stations")
