"""Exact distinct counts as states that merge.

Distinct counts of two months or two loads cannot be added: what both saw counts once. A state keeps what was seen as bits, so states merge
by OR and the facts behind them are not read again.

Days of one month fit in a whole number, bit d for day d. Ids go to bitmaps of 32,768 ids each, one row for each bitmap with an id in it;
this suits ids given in sequence, as those of the dimensions are. NULL counts nowhere, as in ``count(DISTINCT x)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_key(date_key: str = "date_key") -> Column:
    return F.floor(F.col(date_key) / 100).cast("int")


def day_bits(date_key: str = "date_key") -> Column:
    """Aggregate: the days that a group of rows of one month holds. NULL without rows or days."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col(date_key) % 100).cast("int")))


def days_in(bits: str) -> Column:
    return F.coalesce(F.bit_count(bits), F.lit(0))


def id_bitmaps(rows: DataFrame, by: Sequence[Column | str], id_column: str) -> DataFrame:
    """One row for each group and bitmap: ``bucket`` numbers the bitmap, ``ids`` holds its bits."""
    present = rows.filter(F.col(id_column).isNotNull())
    return present.groupBy(*by, F.bitmap_bucket_number(id_column).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_column)).alias("ids")
    )


def count_ids(states: DataFrame, by: Sequence[str], alias: str) -> DataFrame:
    """Distinct ids of each group of merged states; groups without an id are absent."""
    merged = states.groupBy(*by, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("ids")).alias(alias))
