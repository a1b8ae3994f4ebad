"""Date, time and line dimensions, and inserting rows that are absent."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart.functions import calendar as cal
from railmart.schemas import DIM_DATE, DIM_LINES, DIM_TIME, conform

# The line dimension's seed rows (name, colour, group, route type, service pattern).
SEED_LINES = [
    ("1", "#EE352E", "Broadway-7th Avenue", "Subway", "Local"),
    ("2", "#EE352E", "Broadway-7th Avenue", "Subway", "Express"),
    ("3", "#EE352E", "Broadway-7th Avenue", "Subway", "Express"),
    ("4", "#00933C", "Lexington Avenue", "Subway", "Express"),
    ("5", "#00933C", "Lexington Avenue", "Subway", "Express"),
    ("6", "#00933C", "Lexington Avenue", "Subway", "Local"),
    ("7", "#B933AD", "Flushing", "Subway", "Local"),
    ("A", "#0039A6", "8th Avenue", "Subway", "Express"),
    ("B", "#FF6319", "6th Avenue", "Subway", "Express"),
    ("C", "#0039A6", "8th Avenue", "Subway", "Local"),
    ("D", "#FF6319", "6th Avenue", "Subway", "Express"),
    ("E", "#0039A6", "8th Avenue", "Subway", "Express"),
    ("F", "#FF6319", "6th Avenue", "Subway", "Local"),
    ("G", "#6CBE45", "Crosstown", "Subway", "Local"),
    ("J", "#996633", "Nassau Street", "Subway", "Local"),
    ("L", "#A7A9AC", "Canarsie", "Subway", "Local"),
    ("M", "#FF6319", "6th Avenue", "Subway", "Local"),
    ("N", "#FCCC0A", "Broadway", "Subway", "Express"),
    ("Q", "#FCCC0A", "Broadway", "Subway", "Express"),
    ("R", "#FCCC0A", "Broadway", "Subway", "Local"),
    ("S", "#808183", "Shuttle", "Subway", "Shuttle"),
    ("W", "#FCCC0A", "Broadway", "Subway", "Local"),
    ("Z", "#996633", "Nassau Street", "Subway", "Express"),
]

# Hours of the named periods, first and last hour included.
TIME_PERIODS = [("Morning Rush", 7, 9), ("Midday", 10, 15), ("Evening Rush", 16, 19), ("Night", 20, 23)]
OTHER_PERIOD = "Late Night"
PERIOD_ORDER = ["Late Night", "Morning Rush", "Midday", "Evening Rush", "Night"]
PEAKS = [("Morning", 7, 9), ("Evening", 16, 19)]
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def date_attributes(days: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Date dimension rows for a column ``full_date`` of distinct days.

    ``holidays`` (full_date, holiday_name) marks holidays; without it no day is one.
    """
    d = F.col("full_date")
    if holidays is None:
        named = days.withColumn("holiday_name", F.lit(None).cast("string"))
        holiday = F.lit(False)
    else:
        named = days.join(holidays.select("full_date", "holiday_name"), "full_date", "left")
        holiday = F.col("holiday_name").isNotNull()
    return named.select(
        cal.date_key(d).alias("date_key"),
        d,
        (F.dayofweek(d) - 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        cal.is_weekend(d).alias("is_weekend"),
        holiday.alias("is_holiday"),
        F.col("holiday_name"),
        cal.fiscal_year(d).alias("fiscal_year"),
        cal.fiscal_quarter(d).alias("fiscal_quarter"),
    )


def date_dimension(
    spark: SparkSession, start: dt.date, end: dt.date, holidays: DataFrame | None = None
) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("full_date")
    )
    return conform(date_attributes(days, holidays), DIM_DATE)


def hour_attributes(h: Column) -> dict[str, Column]:
    """Everything the time dimension says about an hour."""
    period = F
    for label, first, last in TIME_PERIODS:
        period = period.when(h.between(first, last), F.lit(label))
    peak = F
    for label, first, last in PEAKS:
        peak = peak.when(h.between(first, last), F.lit(label))
    return {
        "hour_12": F.when(h % 12 == 0, 12).otherwise(h % 12).cast("int"),
        "am_pm": F.when(h < 12, "AM").otherwise("PM"),
        "time_period": period.otherwise(F.lit(OTHER_PERIOD)),
        "is_peak_hour": peak.isNotNull(),
        "peak_type": peak,
    }


def time_dimension(spark: SparkSession) -> DataFrame:
    """The 1,440 minutes of a day."""
    m = F.col("id")
    hour, minute = F.floor(m / 60).cast("int"), (m % 60).cast("int")
    rows = spark.range(0, 1440, 1, 1).select(
        cal.time_key(hour, minute).alias("time_key"),
        F.format_string("%02d:%02d:00", hour, minute).alias("full_time"),
        hour.alias("hour"),
        minute.alias("minute"),
        *[c.alias(a) for a, c in hour_attributes(hour).items()],
    )
    return conform(rows, DIM_TIME)


def line_dimension(spark: SparkSession) -> DataFrame:
    """The seeded lines, numbered in order."""
    rows = spark.createDataFrame(
        [(i, *line) for i, line in enumerate(SEED_LINES, 1)],
        "line_id BIGINT, line_name STRING, line_color STRING, line_group STRING, route_type STRING, service_pattern STRING",
    )
    now = F.current_timestamp()
    return conform(rows.withColumn("created_at", now).withColumn("updated_at", now), DIM_LINES)


def insert_absent(existing: DataFrame, new: DataFrame, keys: Sequence[str], order_by: str | None = None) -> DataFrame:
    """``existing`` plus the first ``new`` row of every key it lacks. Keys are primary keys, so never NULL."""
    keys = list(keys)
    first = keep_one(new, keys, order_by)
    return existing.unionByName(first.join(existing, keys, "left_anti"), allowMissingColumns=True)


def keep_one(
    df: DataFrame, keys: Sequence[str], order_by: str | None = None, last: bool = False, marks: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per key: the first (or last) by ``order_by``, else by the values of the whole row.

    NULL keys form one group. Works as an aggregate, so copies are dropped before the shuffle and a key that holds
    most of the rows never meets in one task, as it would in a window. ``marks`` adds aggregates over a key's rows.
    """
    whole_row = F.struct(*df.columns)
    order = F.col(order_by) if order_by else whole_row
    pick = F.max_by if last else F.min_by
    extra = [c.alias(a) for a, c in (marks or {}).items()]
    return df.groupBy(*keys).agg(pick(whole_row, order).alias("_row"), *extra).select("_row.*", *(marks or {}))
