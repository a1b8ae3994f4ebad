"""Cleaning of station, ridership, delay and performance feeds.

Each cleaner maps a raw DataFrame to a clean one and stays lazy. Column means, maxima and medians enter as scalar
subqueries, so no value passes through the driver. The order of the steps is part of the result: gaps are filled before
outliers are cut, bins are set before the median fill, copies are removed before incomplete rows are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmart.functions import bins
from railmart.functions import calendar as cal
from railmart.functions import numbers as num
from railmart.functions import text
from railmart.operators.dims import keep_one
from railmart.operators.ordered import median

# Column names the feeds use, in order of preference.
LATITUDE = ("latitude", "gtfs_latitude", "lat")
LONGITUDE = ("longitude", "gtfs_longitude", "lon", "long")
ENTRIES = ("entries", "total_entries", "entry_count", "entry")
EXITS = ("exits", "total_exits", "exit_count", "exit")
COUNTS = ("entries", "exits", "ridership", "count", "total_entries", "total_exits")
DELAY_END = ("end_date", "resolution_date")
DELAY_LINE = ("line", "subway_line", "route")
DELAY_REASON = ("reason", "cause", "delay_reason", "description")
PERFORMANCE_LINE = ("line", "subway_line", "indicator_line", "route")
PERCENTAGES = ("on_time_percentage", "otp", "on_time_rate", "wait_assessment", "customer_journey_time_performance")
TRIPS = ("scheduled_trips", "actual_trips", "on_time_trips", "late_trips", "canceled_trips")

# Bounding box of the city.
LATITUDE_RANGE = (40.4, 41.0)
LONGITUDE_RANGE = (-74.3, -73.7)

# The most precise time first. DATE_FIRST takes a bare date before a date with a clock time, which makes every
# such row midnight; kept for comparison with results computed that way.
RIDERSHIP_TIME = ("transit_timestamp", "datetime", "timestamp", "date")
RIDERSHIP_TIME_DATE_FIRST = ("transit_timestamp", "date", "datetime", "timestamp")
DELAY_TIME = ("start_date", "incident_datetime", "incident_date", "timestamp", "date")
DELAY_TIME_DATE_FIRST = ("start_date", "incident_date", "date", "timestamp")


# Columns of marked rows.
KEPT = "_kept"
MARKS = ("_copies", "_gaps", KEPT)


class CleaningStats:
    """Counters of one cleaning, computed when asked for; not metrics of the run, as a re-executed task would count twice.

    ``frame`` is a query of its own over the key columns. A job that stores what it cleans writes ``marked`` instead, the
    clean rows with their marks, and counts in what it wrote: the feed is then read and cleaned once.
    """

    def __init__(self) -> None:
        self.frame: DataFrame | None = None
        self.marked: DataFrame | None = None

    def of(self, df: DataFrame, keys: Sequence[str], filled: Sequence[Column] = (), required: str | None = None) -> None:
        """Set up the counters for ``df``, the rows just before copies are removed."""
        gaps = sum((F.count_if(c) for c in filled), F.lit(0))
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), gaps.alias("_gaps"))
        if not keys:
            per_key = per_key.withColumn("_groups", F.col("_rows"))
        groups = F.coalesce(F.sum("_groups"), F.lit(0)) if not keys else F.count(F.lit(1))
        complete = F.count_if(F.col(required).isNotNull()) if required else groups
        total = F.coalesce(F.sum("_rows"), F.lit(0))
        self.frame = per_key.agg(
            total.alias("total_records"),
            complete.alias("cleaned_records"),
            (groups - complete).alias("dropped_records"),
            F.coalesce(F.sum("_gaps"), F.lit(0)).alias("nulls_filled"),
            (total - groups).alias("duplicates_removed"),
        )

    def mark(self, df: DataFrame, keys: Sequence[str], order_by: str | None, last: bool, filled: Sequence[Column], required: str | None) -> None:
        """Set up ``marked``: how many rows each row stands for, the gaps filled in them, and whether it is kept."""
        if keys:
            gaps = sum((F.count_if(c) for c in filled), F.lit(0).cast("long"))
            rows = keep_one(df, keys, order_by, last, {"_copies": F.count(F.lit(1)), "_gaps": gaps})
        else:
            rows = df.withColumns({"_copies": F.lit(1).cast("long"), "_gaps": sum((c.cast("long") for c in filled), F.lit(0).cast("long"))})
        rows = rows.drop(*[c for c in rows.columns if c.startswith("_gap_") or c == "_gap"])
        self.marked = rows.withColumn(KEPT, F.col(required).isNotNull() if required else F.lit(True))

    def count(self, stored: DataFrame) -> None:
        """Take the counters from ``marked`` as it was written."""
        total, kept = F.coalesce(F.sum("_copies"), F.lit(0)), F.count_if(F.col(KEPT))
        self.frame = stored.agg(
            total.alias("total_records"),
            kept.alias("cleaned_records"),
            (F.count(F.lit(1)) - kept).alias("dropped_records"),
            F.coalesce(F.sum("_gaps"), F.lit(0)).alias("nulls_filled"),
            (total - F.count(F.lit(1))).alias("duplicates_removed"),
        )

    def get(self) -> dict[str, int]:
        return self.frame.first().asDict()


def finish(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str | None,
    stats: CleaningStats | None,
    filled: Sequence[Column] = (),
    required: str | None = None,
    last: bool = False,
) -> DataFrame:
    """Remove copies by the keys the frame has, then rows without ``required``."""
    keys = [k for k in keys if k in df.columns]
    required = required if required in df.columns else None
    if stats is not None:
        stats.of(df, keys, filled, required)
        stats.mark(df, keys, order_by, last, filled, required)
    if keys:
        df = keep_one(df, keys, order_by, last)
    return df.na.drop(subset=[required]) if required else df


# --- Steps ------------------------------------------------------------------------------------------------------


def normalise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower().replace(" ", "_").replace("-", "_") for c in df.columns])


def first_present(df: DataFrame, names: Sequence[str]) -> str | None:
    """The first of ``names`` the frame has; one column for all rows, not a row-wise choice."""
    return next((n for n in names if n in df.columns), None)


def derive(df: DataFrame, target: str, names: Sequence[str], rule) -> DataFrame:
    """Set ``target`` from the first present column; no change without one."""
    source = first_present(df, names)
    return df if source is None else df.withColumn(target, rule(F.col(source)))


def split_time(df: DataFrame, target: str, names: Sequence[str], hour: bool) -> DataFrame:
    """Parse the first present time column into ``target``, ``date``, ``time`` and, if asked, ``hour``."""
    source = first_present(df, names)
    if source is None:
        return df
    df = df.withColumn(target, cal.to_datetime(F.col(source)))
    parts = {"date": F.to_date(target), "time": cal.clock(F.col(target))}
    if hour:
        parts["hour"] = F.hour(target)
    return df.withColumns(parts)


def winsorise(df: DataFrame, columns: Sequence[str], sigmas: float = 3.0) -> DataFrame:
    """Cut values above mean + ``sigmas`` sample deviations down to that limit; constant columns stay."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    limits = df.agg(
        F.struct(
            *[
                F.when(F.stddev_samp(c) > 0, F.avg(c) + F.stddev_samp(c) * sigmas).alias(c)
                for c in columns
            ]
        ).alias("limits")
    ).scalar()
    return df.withColumns({c: F.least(F.col(c).cast("double"), limits.getField(c)) for c in columns})


def rescale_percentages(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns whose largest value is at most 1 are fractions and become percentages as a whole."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    df = df.withColumns({c: num.to_number(F.col(c)) for c in columns})
    top = df.agg(F.struct(*[F.max(c).alias(c) for c in columns]).alias("top")).scalar()
    return df.withColumns({c: F.when(top.getField(c) <= 1, F.col(c) * 100).otherwise(F.col(c)) for c in columns})


def fill_counts(c: Column) -> Column:
    """Gaps and numbers no count can hold become 0."""
    return F.coalesce(c.try_cast("long"), F.lit(0).cast("long"))


# --- Cleaners ---------------------------------------------------------------------------------------------------


def clean_stations(df: DataFrame, order_by: str | None = None, stats: CleaningStats | None = None) -> DataFrame:
    """Names, boroughs, coordinates and routes; one row per station name, the first by ``order_by``."""
    df = normalise_names(df)
    df = derive(df, "station_name", ("stop_name", "station_name"), text.clean_name)
    df = derive(df, "borough", ("borough",), text.borough_name)
    df = derive(df, "latitude", LATITUDE, lambda c: num.within(num.to_number(c), *LATITUDE_RANGE))
    df = derive(df, "longitude", LONGITUDE, lambda c: num.within(num.to_number(c), *LONGITUDE_RANGE))
    if "daytime_routes" in df.columns:
        df = df.withColumn("lines_served", text.route_list(F.col("daytime_routes")))
    elif "line" in df.columns:
        df = df.withColumn("lines_served", F.col("line"))
    return finish(df, ["station_name"], order_by, stats, required="station_name")


def clean_ridership(
    df: DataFrame,
    order_by: str | None = None,
    stats: CleaningStats | None = None,
    time_columns: Sequence[str] = RIDERSHIP_TIME,
) -> DataFrame:
    """Times, counts and names; outliers cut; one row per time, station and line; rows without a time dropped."""
    df = split_time(normalise_names(df), "datetime", time_columns, hour=True)
    numeric = [c for c in dict.fromkeys([*COUNTS, *ENTRIES, *EXITS]) if c in df.columns]
    df = df.withColumns({c: num.non_negative(num.to_number(F.col(c))) for c in numeric})
    df = derive(df, "entries", ENTRIES, lambda c: c)
    df = derive(df, "exits", EXITS, lambda c: c)
    filled = [c for c in ("entries", "exits") if c in df.columns]
    gaps = {f"_gap_{c}": F.col(c).isNull() for c in filled}
    df = df.withColumns({**gaps, **{c: fill_counts(F.col(c)) for c in filled}})
    df = derive(df, "station_name", ("station", "station_name"), text.clean_name)
    df = derive(df, "line_name", ("line", "line_name"), text.clean_code)
    df = winsorise(df, filled)
    keys = ["datetime", "station_name", "line_name"]
    return finish(df, keys, order_by, stats, [F.col(g) for g in gaps], required="datetime").drop(*gaps)


def delay_minutes(df: DataFrame) -> Column | None:
    """Minutes as given, else from the end time, never below 0 when computed."""
    source = first_present(df, ("delay_duration_minutes", "delay_minutes", "duration"))
    if source:
        return num.to_number(F.col(source))
    if {"incident_datetime", "resolution_datetime"} <= set(df.columns):
        span = F.timestamp_diff("MICROSECOND", F.col("incident_datetime"), F.col("resolution_datetime"))
        return F.when(span.isNotNull(), F.greatest(span / 60_000_000, F.lit(0.0)))
    return None


def clean_delays(
    df: DataFrame,
    order_by: str | None = None,
    stats: CleaningStats | None = None,
    time_columns: Sequence[str] = DELAY_TIME,
    profile: str = "cleaner",
) -> DataFrame:
    """Times, names and durations; bins from the durations as reported; gaps then take the median; copies removed."""
    df = split_time(normalise_names(df), "incident_datetime", time_columns, hour=False)
    df = derive(df, "resolution_datetime", DELAY_END, cal.to_datetime)
    df = derive(df, "line_name", DELAY_LINE, text.clean_code)
    df = derive(df, "delay_reason", DELAY_REASON, text.strip)
    minutes = delay_minutes(df)
    gaps = []
    if minutes is not None:
        df = df.withColumn("delay_duration_minutes", minutes)
        known = F.col("delay_duration_minutes")
        middle = median(df, "delay_duration_minutes", "middle").scalar()
        df = df.withColumns(
            {
                "delay_category": bins.delay_category(known),
                "severity_level": bins.delay_severity(known, profile),
                "_gap": known.isNull(),
                "delay_duration_minutes": F.coalesce(known, middle),
            }
        )
        gaps = [F.col("_gap")]
    return finish(df, ["incident_datetime", "line_name", "delay_reason"], order_by, stats, gaps).drop("_gap")


def clean_performance(
    df: DataFrame, order_by: str | None = None, stats: CleaningStats | None = None
) -> DataFrame:
    """Periods, names, percentages and trip counts; one row per date and line, the last by ``order_by``."""
    df = normalise_names(df)
    if {"period_year", "period_month"} <= set(df.columns):
        df = df.withColumn("date", cal.first_of_month(F.col("period_year"), F.col("period_month")))
    else:
        df = derive(df, "date", ("period", "date"), lambda c: F.to_date(cal.to_datetime(c)))
    df = derive(df, "line_name", PERFORMANCE_LINE, text.clean_code)
    df = rescale_percentages(df, PERCENTAGES)
    trips = [c for c in TRIPS if c in df.columns]
    numbers = {c: num.to_number(F.col(c)) for c in trips}
    gaps = {f"_gap_{c}": v.isNull() for c, v in numbers.items()}
    df = df.withColumns({**gaps, **{c: fill_counts(v) for c, v in numbers.items()}})
    return finish(df, ["date", "line_name"], order_by, stats, [F.col(g) for g in gaps], last=True).drop(*gaps)


CLEANERS = {
    "stations": clean_stations,
    "ridership": clean_ridership,
    "delays": clean_delays,
    "performance": clean_performance,
}


def clean_all(
    raw: dict[str, DataFrame],
    order_by: str | None = None,
    stats: dict[str, CleaningStats] | None = None,
) -> dict[str, DataFrame]:
    """Clean whichever of the four feeds are there. ``stats`` is filled with one counter set per feed."""
    out = {}
    for name, cleaner in CLEANERS.items():
        if name in raw:
            counters = None
            if stats is not None:
                counters = stats[name] = CleaningStats()
            out[name] = cleaner(raw[name], order_by, counters)
    return out
