"""The star schema as a bundle of lazy DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmart.operators.lookup import fits_broadcast, lookup

KEYS = {"lines": "line_id", "stations": "station_id", "dates": "date_key", "times": "time_key"}
ROW_IDS = {"ridership": "ridership_id", "delays": "delay_id"}


@dataclass(frozen=True)
class Star:
    """Four dimensions and three facts.

    ``small`` names the dimensions whose size was checked to fit a broadcast. Build with :meth:`of`, which checks.
    """

    lines: DataFrame
    stations: DataFrame
    dates: DataFrame
    times: DataFrame
    ridership: DataFrame
    delays: DataFrame
    performance: DataFrame
    small: frozenset[str] = frozenset()

    @classmethod
    def of(cls, sized_by: Mapping[str, DataFrame] | None = None, **frames: DataFrame) -> Star:
        """Check each dimension by Spark's size estimate.

        The estimate of a joined dimension multiplies its inputs; ``sized_by`` names the input that has its rows.
        """
        sized_by = sized_by or {}
        small = frozenset(d for d in KEYS if fits_broadcast(sized_by.get(d, frames[d])))
        return cls(**frames, small=small)

    def attach(
        self, rows: DataFrame, dim: str, columns: Sequence[str], how: str = "left", spread_by: str | None = None
    ) -> DataFrame:
        """Add ``columns`` of a dimension to ``rows``; see :func:`lookup` for ``spread_by``."""
        key = KEYS[dim]
        table = getattr(self, dim).select(key, *[c for c in columns if c != key])
        return lookup(rows, table, key, small=dim in self.small, how=how, spread_by=spread_by)

    def attach_station(
        self,
        rows: DataFrame,
        keys: Sequence[str],
        columns: Sequence[str],
        totals: Mapping[str, Column],
        how: str = "left",
    ) -> DataFrame:
        """Additive ``totals`` of raw fact ``rows`` with station ``columns``, as partial sums the caller adds up.

        Coarse columns of a small station table are attached by broadcast before the one grouping. Otherwise rows
        are summed per station id first: that groups by whole numbers, takes the weight out of a hot station and
        leaves only sums to meet a large station table.
        """
        aggs = [c.alias(a) for a, c in totals.items()]
        if "stations" in self.small and "station_name" not in columns:
            return self.attach(rows, "stations", columns, how).groupBy(*keys, *columns).agg(*aggs)
        return self.attach(rows.groupBy(*keys, "station_id").agg(*aggs), "stations", columns, how)
