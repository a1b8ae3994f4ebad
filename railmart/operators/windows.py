"""Comparisons over time, and shares of a total. Inputs of the former are sums per day or month, so their size is the length of the calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railmart.functions.numbers import divide_or_zero, rounded_ratio

SLOTS = 32


def change_from_previous_row(df: DataFrame, value: str, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Adds ``prev_<value>`` from the row before and its percent change (NULL without one or on 0)."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(f"prev_{value}", before).withColumn(
        "change_pct", rounded_ratio(F.col(value) - F.col(f"prev_{value}"), F.col(f"prev_{value}"), 2, 100)
    )


def change_from_month(df: DataFrame, value: str, month: str, months_back: int, by: Sequence[str] = ()) -> DataFrame:
    """Compares with the calendar month ``months_back`` earlier; a missing or zero month gives 0 percent.

    Differs from the row before wherever a month has no data.
    """
    by = list(by)
    previous = df.select(*by, F.add_months(month, months_back).alias(month), F.col(value).alias(f"prev_{value}"))
    keys = [*by, month]
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    joined = df.alias("l").join(previous.alias("r"), same, "left").select("l.*", f"r.prev_{value}")
    current, prior = F.col(value), F.col(f"prev_{value}")
    return joined.withColumn("change_pct", divide_or_zero((current - prior) * 100, prior))


def rolling_mean(df: DataFrame, value: str, day: str, days: int, alias: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the daily values in the last ``days`` calendar days; days without data are left out, not counted as 0."""
    number = F.unix_date(day)
    window = Window.partitionBy(*by).orderBy(number).rangeBetween(1 - days, 0)
    return df.withColumn(alias, F.avg(value).over(window))


def year_to_date(df: DataFrame, value: str, day: str, alias: str, by: Sequence[str] = ()) -> DataFrame:
    window = Window.partitionBy(*by, F.year(day)).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(alias, F.sum(value).over(window))


def trend_line(df: DataFrame, value: str, day: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line through daily values: slope per day and value at day number 0 (1970-01-01)."""
    x, y = F.unix_date(day), F.col(value)
    aggs = [F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.count(y).alias("points")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def with_total(df: DataFrame, value: str, alias: str, by: Sequence[str]) -> DataFrame:
    """Adds the sum of ``value`` over all rows to each, without reading the input twice and without a task that holds all rows.

    Rows are dealt to SLOTS slots by a hash of ``by``; the sum of each slot is then sent to all slots.
    """
    slot = Window.partitionBy("_slot")
    dealt = df.withColumn("_slot", F.pmod(F.xxhash64(*by), F.lit(SLOTS)).cast("int"))
    dealt = dealt.withColumn("_part", F.sum(value).over(slot)).withColumn("_nth", F.row_number().over(slot.orderBy(*by)))
    own, others = F.array(F.lit(None).cast("int")), F.sequence(F.lit(0), F.lit(SLOTS - 1))
    sent = dealt.withColumn("_to", F.explode(F.when(F.col("_nth") == 1, F.concat(own, others)).otherwise(own)))
    sent = sent.withColumn("_slot", F.coalesce("_to", "_slot")).withColumn("_part", F.when(F.col("_to").isNotNull(), F.col("_part")))
    summed = sent.withColumn(alias, F.sum("_part").over(slot)).filter("_to IS NULL")
    return summed.select(*[F.col(f"`{c}`") for c in df.columns], alias)
