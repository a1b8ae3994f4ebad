"""Keys, parsing and calendar rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month-first layouts read besides ISO text.
EXTRA_FORMATS = ("M/d/yyyy H:m:s", "M/d/yyyy H:m", "M/d/yyyy")


def to_datetime(c: Column, formats: tuple[str, ...] = EXTRA_FORMATS) -> Column:
    """Zone-free timestamp from text, date or timestamp; NULL where nothing fits."""
    text = c.cast("string")
    tries = [text.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def clock(c: Column) -> Column:
    return F.date_format(c, "HH:mm:ss")


def date_key(c: Column) -> Column:
    """YYYYMMDD as an int, by arithmetic (no text on the way)."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def time_key(hour: Column, minute: Column | int = 0) -> Column:
    return (hour * 100 + minute).cast("int")


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The reporting day; today when not given."""
    if as_of is None:
        return F.current_date()
    return F.lit(dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of)


def first_of_month(year: Column, month: Column) -> Column:
    text = F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"), F.lit("01"))
    return F.when(year.isNotNull() & month.isNotNull(), text.try_cast("date"))


def is_weekend(c: Column) -> Column:
    return F.weekday(c) >= 5


def sample_holiday(c: Column) -> Column:
    """The sample data's rule: 24, 25 and 31 December."""
    return (F.month(c) == 12) & F.dayofmonth(c).isin(24, 25, 31)


def fiscal_year(c: Column) -> Column:
    return F.when(F.month(c) >= 7, F.year(c) + 1).otherwise(F.year(c))


def fiscal_quarter(c: Column) -> Column:
    return F.floor(F.pmod(F.month(c) - 7, F.lit(12)) / 3).cast("int") + 1
