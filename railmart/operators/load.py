"""Loading clean frames into the star: key lookups, defaults and upserts.

A load returns the rows of its target table; writing them is left to ``railmart.sources.sinks``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmart.functions import calendar as cal
from railmart.functions.bins import delay_category, delay_severity
from railmart.functions.numbers import nan_to_null
from railmart.operators.dims import keep_one
from railmart.operators.lookup import fits_broadcast, frequent_keys, lookup, unique_by
from railmart.schemas import (
    DIM_STATIONS,
    FACT_DAILY_RIDERSHIP,
    FACT_DELAYS,
    FACT_PERFORMANCE,
    FACT_RIDERSHIP,
    conform,
)

# Station columns taken from the feed, and those replaced on a match.
STATION_INPUT = (
    "station_name", "station_complex_id", "gtfs_stop_id", "borough", "latitude", "longitude", "structure_type",
    "ada_accessible", "lines_served", "division",
)
STATION_UPDATES = ("borough", "latitude", "longitude")
MOST_WHOLE = 2**31 - 1
PERFORMANCE_UPDATES = ("scheduled_trips", "actual_trips", "on_time_trips")


def present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def null_out_nan(df: DataFrame) -> DataFrame:
    floats = {c: nan_to_null(F.col(c)) for c, t in df.dtypes if t in ("double", "float")}
    return df.withColumns(floats) if floats else df


def column_or(df: DataFrame, name: str, default: Column) -> Column:
    """A column with a default for its NULLs, or just the default where the frame lacks it."""
    return F.coalesce(F.col(name), default) if name in df.columns else default


def whole_or_zero(df: DataFrame, name: str) -> Column:
    """A column as a whole number; 0 where it is missing, or is no number an integer can hold."""
    return F.coalesce(F.col(name).try_cast("int"), F.lit(0)) if name in df.columns else F.lit(0)


def with_serial(df: DataFrame, name: str, after: DataFrame | None = None) -> DataFrame:
    """Number new rows above the largest id in ``after``. Ids are unique, not dense, and set by the write itself."""
    start = F.lit(0) if after is None else F.coalesce(after.agg(F.max(name)).scalar(), F.lit(0))
    return df.withColumn(name, start + 1 + F.monotonically_increasing_id())


def aligned(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` in order; those ``df`` lacks become NULL."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in like.dtypes])


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    updates: Sequence[str],
    stamp: str | None = None,
    serial: str | None = None,
    recompute: dict[str, Column] | None = None,
    append: DataFrame | None = None,
    last_id: int | None = None,
) -> DataFrame:
    """Merge ``incoming`` (each key once, no NULL keys) into ``existing``.

    A match takes ``updates`` from the incoming row and keeps the rest; new keys are added with an id in ``serial``.
    Rows with a NULL key never match. New ones come in ``append``; they and stored ones skip the join, so they cannot
    pile up in one of its tasks. ``recompute`` holds stored generated columns, evaluated on the merged row. ``last_id`` is
    the largest id given so far, where ``existing`` is only a part of the table.
    """
    keys = list(keys)
    columns = existing.columns
    incoming = aligned(incoming.drop(serial) if serial else incoming, existing)
    has_keys = F.lit(True)
    for k in keys:
        has_keys = has_keys & F.col(k).isNotNull()
    old = existing.filter(has_keys).select(*keys, F.struct(*columns).alias("_old"))
    new = incoming.select(*keys, F.struct(*columns).alias("_new"))
    matched = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    merged = []
    for c in columns:
        before, after = F.col("_old").getField(c), F.col("_new").getField(c)
        if c in updates:
            value = F.when(F.col("_new").isNotNull(), after).otherwise(before)
        elif c == stamp:
            value = F.when(matched, F.current_timestamp()).when(F.col("_old").isNull(), after).otherwise(before)
        else:
            value = F.when(F.col("_old").isNull(), after).otherwise(before)
        merged.append(value.alias(c))
    out = old.join(new, keys, "full_outer").select(*merged).unionByName(existing.filter(~has_keys))
    if append is not None:
        out = out.unionByName(aligned(append.drop(serial) if serial else append, existing))
    if serial:
        # Numbered once, after the branches have met.
        start = F.coalesce(existing.agg(F.max(serial)).scalar(), F.lit(0)) if last_id is None else F.lit(last_id).cast("long")
        out = out.withColumn(serial, F.coalesce(F.col(serial), start + 1 + F.monotonically_increasing_id()))
    if recompute:
        kinds = dict(existing.dtypes)
        out = out.withColumns({c: expr.cast(kinds[c]) for c, expr in recompute.items()})
    return out


def laid_out(rows: DataFrame, serial: str, by: Sequence[str] = ("date_key", "time_key", "station_id")) -> DataFrame:
    """Order a fact for storage: each file holds a narrow range of days, so a date filter skips most files.

    The range is over several columns, so a day with most of the rows is still cut up. Ids are given after the shuffle,
    by the task that writes them: a repeated task cannot hand out an id another task has stored.
    """
    columns = rows.columns
    ordered = rows.drop(serial).repartitionByRange(*by).sortWithinPartitions(*by)
    return with_serial(ordered, serial).select(*columns)


# --- Stations ---------------------------------------------------------------------------------------------------


def load_stations(df: DataFrame, existing: DataFrame, order_by: str | None = None, last_id: int | None = None) -> DataFrame:
    """Insert stations by name; on a match borough, coordinates and ``updated_at`` change, nothing else."""
    named = df.filter(F.col("station_name").isNotNull())
    last = keep_one(named, ["station_name"], order_by, last=True)
    rows = null_out_nan(present(last, STATION_INPUT))
    now = F.current_timestamp()
    rows = rows.withColumn("ada_accessible", column_or(rows, "ada_accessible", F.lit(False)).cast("boolean"))
    rows = conform(rows.withColumns({"created_at": now, "updated_at": now}), DIM_STATIONS)
    return upsert(conform(existing, DIM_STATIONS), rows, ["station_name"], STATION_UPDATES, "updated_at", "station_id", last_id=last_id)


# --- Facts ------------------------------------------------------------------------------------------------------


def ids_by_name(dim: DataFrame, name: str, key: str) -> DataFrame:
    """Name → id, the smallest id where a name repeats."""
    return unique_by(dim.filter(F.col(name).isNotNull()).select(name, key), name, key)


def with_ids(
    df: DataFrame,
    lines: DataFrame,
    stations: DataFrame | None = None,
    row_id: str | None = None,
    small: frozenset[str] | None = None,
) -> DataFrame:
    """Add line and station ids by name, in place of ids the feed may carry; a name without an entry gives NULL.

    Tables of a checked size are broadcast; a larger station table is joined by shuffle with hot names spread out.
    """
    if small is None:
        small = frozenset(n for n, d in (("lines", lines), ("stations", stations)) if d is not None and fits_broadcast(d))
    df = df.drop("line_id", "station_id")
    df = df.withColumns({c: F.lit(None).cast("string") for c in ("line_name", "station_name") if c not in df.columns})
    keep = df
    if row_id is None:
        keep = df.withColumn("_row", F.xxhash64(*df.columns))
        row_id = "_row"
    dims = {"line_name": ("lines", lines, "line_id")}
    if stations is not None:
        dims["station_name"] = ("stations", stations, "station_id")
    # Both names are counted in one pass over the feed, before either join.
    hot = frequent_keys(keep, [name for name, (dim, _, _) in dims.items() if dim not in small])
    out = keep
    for name, (dim, table, key) in dims.items():
        out = lookup(out, ids_by_name(table, name, key), name, small=dim in small, spread_by=row_id, hot=hot.get(name))
    return out.drop("_row")


def dated(df: DataFrame) -> DataFrame:
    """Rows without a date cannot be keyed and are left out."""
    return df.filter(F.col("date").isNotNull()).withColumn("date_key", cal.date_key(F.to_date("date")))


def load_ridership(
    df: DataFrame, lines: DataFrame, stations: DataFrame, source: str = "api", row_id: str | None = None,
    existing: DataFrame | None = None, small: frozenset[str] | None = None,
) -> DataFrame:
    """Ridership rows of the star. The clock is hour and, where there is one, minute."""
    rows = with_ids(dated(df), lines, stations, row_id, small)
    hour, minute = column_or(rows, "hour", F.lit(0)), column_or(rows, "minute", F.lit(0))
    entries, exits = whole_or_zero(rows, "entries"), whole_or_zero(rows, "exits")
    out = rows.select(
        "date_key",
        cal.time_key(hour.try_cast("int"), minute.try_cast("int")).alias("time_key"),
        "station_id",
        "line_id",
        entries.alias("entries"),
        exits.alias("exits"),
        F.coalesce((entries.cast("long") + exits).try_cast("int"), F.lit(MOST_WHOLE)).alias("total_traffic"),
        F.lit(source).alias("data_source"),
        F.current_timestamp().alias("created_at"),
    )
    return conform(with_serial(out, "ridership_id", existing), FACT_RIDERSHIP)


def load_delays(
    df: DataFrame, lines: DataFrame, stations: DataFrame, row_id: str | None = None,
    existing: DataFrame | None = None, small: frozenset[str] | None = None,
) -> DataFrame:
    """Delay rows of the star, keyed to the full hour, with the stated defaults for what is missing."""
    rows = with_ids(dated(df), lines, stations, row_id, small)
    hours = []
    if "incident_datetime" in rows.columns:
        hours.append(F.hour("incident_datetime"))
    if "time" in rows.columns:
        hours.append(F.substring(F.col("time"), 1, 2).try_cast("int"))
    hour = F.coalesce(*hours, F.lit(0))
    minutes = whole_or_zero(rows, "delay_duration_minutes")
    carried = [c for c in ("affected_services", "is_resolved", "resolution_time_minutes") if c in rows.columns]
    out = rows.select(
        "date_key",
        cal.time_key(hour).alias("time_key"),
        "line_id",
        "station_id",
        minutes.alias("delay_duration_minutes"),
        column_or(rows, "delay_category", F.lit("Unknown")).alias("delay_category"),
        column_or(rows, "delay_reason", F.lit("")).alias("delay_reason"),
        column_or(rows, "severity_level", F.lit("Medium")).alias("severity_level"),
        whole_or_zero(rows, "passenger_impact_estimate").alias("passenger_impact_estimate"),
        F.current_timestamp().alias("created_at"),
        *carried,
    )
    if "is_resolved" not in carried:
        out = out.withColumn("is_resolved", F.lit(True))
    return conform(with_serial(out, "delay_id", existing), FACT_DELAYS)


def on_time_percentage() -> Column:
    """Share of scheduled trips on time, two places, 0 unless trips were scheduled."""
    scheduled, on_time = F.col("scheduled_trips"), F.col("on_time_trips")
    share = F.round(F.try_divide(on_time.cast("double") * 100, scheduled.cast("double")), 2)
    return F.when(scheduled > 0, share).otherwise(F.lit(0.0))


def load_performance(
    df: DataFrame, lines: DataFrame, existing: DataFrame, order_by: str | None = None, update: str = "listed",
    small: frozenset[str] | None = None, last_id: int | None = None,
) -> DataFrame:
    """Upsert by day and line; the last row of a key in the batch wins.

    On a match scheduled, actual and on-time trips change; ``update='all'`` changes every measure. Rows whose line is
    unknown never match and are all kept.
    """
    rows = with_ids(dated(df), lines, small=small)
    trips = ("scheduled_trips", "actual_trips", "on_time_trips", "late_trips", "canceled_trips")
    rates = ("mean_distance_between_failures", "wait_assessment", "customer_journey_time_performance")
    rows = rows.withColumns(
        {
            **{c: whole_or_zero(rows, c) for c in trips},
            **{c: F.coalesce(nan_to_null(F.col(c).cast("double")) if c in rows.columns else F.lit(None), F.lit(0.0)) for c in rates},
            "created_at": F.current_timestamp(),
        }
    )
    known = keep_one(rows.filter(F.col("line_id").isNotNull()), ["date_key", "line_id"], order_by, last=True)
    unknown = rows.filter(F.col("line_id").isNull())
    updates = (*trips, *rates) if update == "all" else PERFORMANCE_UPDATES
    return upsert(
        conform(existing, FACT_PERFORMANCE), conform(known, FACT_PERFORMANCE), ["date_key", "line_id"], updates,
        serial="performance_id", recompute={"on_time_percentage": on_time_percentage()},
        append=conform(unknown, FACT_PERFORMANCE), last_id=last_id,
    )


def daily_summary(ridership: DataFrame, times: DataFrame, source: str = "derived") -> DataFrame:
    """Daily totals per station and line with the peak split and the mean per hour that has records."""
    clock = times.select("time_key", "hour", "is_peak_hour")
    timed = lookup(ridership, clock, "time_key", small=fits_broadcast(clock))
    peak = F.coalesce(F.col("is_peak_hour"), F.lit(False))
    per_day = timed.groupBy("date_key", "station_id", "line_id").agg(
        F.sum("entries").alias("total_entries"),
        F.sum("exits").alias("total_exits"),
        F.coalesce(F.sum(F.when(peak, F.col("entries"))), F.lit(0)).alias("peak_hour_entries"),
        F.coalesce(F.sum(F.when(~peak, F.col("entries"))), F.lit(0)).alias("off_peak_entries"),
        F.countDistinct("hour").alias("hours"),
    )
    rows = per_day.withColumns(
        {
            "avg_entries_per_hour": F.round(F.try_divide(F.col("total_entries").cast("double"), F.col("hours").cast("double")), 2),
            "data_source": F.lit(source),
            "created_at": F.current_timestamp(),
        }
    )
    return conform(with_serial(rows, "daily_ridership_id"), FACT_DAILY_RIDERSHIP)


def rebin(delays: DataFrame, profile: str) -> DataFrame:
    """Category and severity of loaded delays under another severity profile."""
    minutes = F.col("delay_duration_minutes")
    return delays.withColumns({"delay_category": delay_category(minutes), "severity_level": delay_severity(minutes, profile)})


def check_lengths(df: DataFrame, limits: dict[str, int]) -> Column:
    """First text column longer than its table allows, as an error message; NULL for rows that fit."""
    tests = [F.when(F.length(c) > n, F.lit(f"{c} longer than {n}")) for c, n in limits.items() if c in df.columns]
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")


