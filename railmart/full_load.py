"""Extract, clean and load the four feeds, with an audit row at the start and at the end."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart.operators import load
from railmart.operators.clean import KEPT, MARKS, CleaningStats, clean_all
from railmart.operators.dims import date_dimension, line_dimension, time_dimension
from railmart.schemas import (
    DIM_STATIONS, ETL_LOG, FACT_DELAYS, FACT_PERFORMANCE, FACT_RIDERSHIP, QUARANTINE, conform, read_schema,
)
from railmart.sources import sinks
from railmart.sources.parts import PartTable

JOB, KIND = "transit_etl", "full_load"
DIM_START, DIM_END = dt.date(2024, 1, 1), dt.date(2026, 12, 31)
# Days that a feed may name; the calendar never grows beyond them, and rows of other days go to the quarantine.
BELIEVED = (dt.date(2000, 1, 1), dt.date(2049, 12, 31))
STATION_PARTS = 8

# Order matters: facts look up the stations loaded before them.
TARGETS = {
    "stations": "dim_stations",
    "ridership": "fact_ridership",
    "delays": "fact_delays",
    "performance": "fact_performance",
}


def table_at(spark: SparkSession, folder: str, name: str) -> PartTable:
    """One of the star's loaded tables below ``folder``, or its quarantine."""
    month = F.floor(F.col("date_key") / 100)
    bucket = F.pmod(F.xxhash64("station_name"), F.lit(STATION_PARTS))
    by_day = ("date_key", "time_key", "station_id")
    tables = {
        "dim_stations": (DIM_STATIONS, bucket, "station_id", ()),
        "fact_ridership": (FACT_RIDERSHIP, month, "ridership_id", by_day),
        "fact_delays": (FACT_DELAYS, month, "delay_id", by_day),
        "fact_performance": (FACT_PERFORMANCE, month, "performance_id", ("date_key", "line_id")),
        "quarantine": (QUARANTINE, F.lit(0), None, ()),
    }
    schema, key, serial, order = tables[name]
    return PartTable(spark, f"{folder}/{name}", schema, key, serial, order)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The committed rows of a table."""
    return table_at(spark, folder, name).read()


def content_name(df: DataFrame) -> str:
    """A batch's name from its rows, whatever their order; for feeds that come without one."""
    row = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    n, total, mixed = df.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(20,0)")), F.bit_xor(F.xxhash64(row, F.lit(1)))).first()
    return f"content-{n}-{total}-{mixed}"


def landed(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """A feed as it came, written once: its name, its limits and median and its rows are then read from files, not made again for each."""
    plain = df
    if any(t == "void" for _, t in df.dtypes):  # no file holds a column without a type
        plain = df.select(*[F.col(f"`{c}`").cast("string" if t == "void" else t).alias(c) for c, t in df.dtypes])
    plain.write.mode("overwrite").parquet(path)
    return spark.read.schema(plain.schema).parquet(path)


def gated(rows: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows with an ``_error`` where a key has no row in its dimension. Both dimensions have a bounded size."""
    days = dims["dim_date"].select(F.col("date_key").alias("_day"))
    out = rows.join(F.broadcast(days), F.col("date_key") == F.col("_day"), "left")
    errors = [F.when(F.col("_day").isNull(), F.lit("no calendar day"))]
    if "time_key" in rows.columns:
        times = dims["dim_time"].select(F.col("time_key").alias("_time"))
        out = out.join(F.broadcast(times), F.col("time_key") == F.col("_time"), "left")
        errors.append(F.when(F.col("time_key").isNotNull() & F.col("_time").isNull(), F.lit("no time of day")))
    return out.withColumn("_error", F.coalesce(*errors)).select(*rows.columns, "_error")


def undated(df: DataFrame, dataset: str) -> DataFrame:
    """Quarantine rows for records without a date."""
    return sinks.split_rejected(df, F.when(F.col("date").isNull(), F.lit("missing date")), dataset)[1]


def load_frames(
    spark: SparkSession,
    clean: Mapping[str, DataFrame],
    folder: str,
    dims: Mapping[str, DataFrame],
    batches: Mapping[str, str],
    existing: Mapping[str, str] | None = None,
    order_by: str | None = None,
    source: str = "api",
) -> tuple[dict[str, int], int]:
    """Load the star tables below ``folder`` in order; returns the rows written per feed and the rows quarantined.

    Each write is committed together with its batch's name, so a batch that comes again adds nothing and one that stopped
    midway is loaded as a whole, while equal rows of two batches all stay. Facts are appended. Stations and performance are
    merged into the buckets and months that the feed touches; other parts keep their files. ``existing`` names earlier
    tables (in parts, or plain Parquet) to start from. Rows without a date, or whose day or time is not in its dimension, go to the quarantine.
    """
    lines = dims["dim_subway_lines"]
    quarantine = table_at(spark, folder, "quarantine")
    counts: dict[str, int] = {}
    refused = 0
    for name, table in TARGETS.items():
        target = table_at(spark, folder, table)
        if existing and table in existing and not target.manifest().version:
            held = PartTable(spark, existing[table], target.schema, target.key)
            plain = spark.read.schema(read_schema(target.schema))
            earlier = held.read() if held.manifest().version else plain.parquet(existing[table])
            target.replace(conform(earlier, target.schema), [], "existing")
        if name not in clean:
            continue
        df, batch = clean[name], batches[name]
        if name == "stations":
            touched = target.keys_of(df.filter(F.col("station_name").isNotNull()))
            rows = load.load_stations(df, target.read(touched), order_by, last_id=target.manifest().last_id)
            counts[name] = target.replace(rows, touched, batch)
            continue
        stations = read_table(spark, folder, "dim_stations")
        if name == "performance":
            marked = sinks.stored(gated(load.dated(df), {"dim_date": dims["dim_date"]}), "performance-rows")
        elif name == "ridership":
            marked = sinks.stored(gated(load.load_ridership(df, lines, stations, source), dims), "ridership-rows")
        else:
            marked = sinks.stored(gated(load.load_delays(df, lines, stations), dims), "delay-rows")
        good, bad = parted(marked, name)
        refused += quarantine.append(bad.unionByName(undated(df, name)), f"{name}-{batch}")
        if name == "performance":
            touched = target.keys_of(good)
            good = load.load_performance(good, lines, target.read(touched), order_by, last_id=target.manifest().last_id)
            counts[name] = target.replace(good, touched, batch)
        else:
            counts[name] = target.append(good, batch)
    return counts, refused


def parted(marked: DataFrame, dataset: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and quarantine rows of those with an ``_error``."""
    good, bad = sinks.split_rejected(marked, F.col("_error"), dataset)
    return good.drop("_error"), bad


def days_of(frames: Mapping[str, DataFrame], start: dt.date, end: dt.date) -> tuple[dt.date, dt.date]:
    """The stated range, widened to the believable days the frames hold."""
    for df in frames.values():
        if "date" in df.columns:
            day = F.to_date("date")
            believed = F.when(day.between(*map(F.lit, BELIEVED)), day)
            first, last = df.agg(F.min(believed), F.max(believed)).first()
            if first is not None:
                start, end = min(start, first), max(end, last)
    return start, end


def build_dimensions(
    spark: SparkSession, folder: str, start: dt.date = DIM_START, end: dt.date = DIM_END, holidays: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Write the date, time and line dimensions and read them back."""
    frames = {
        "dim_date": date_dimension(spark, start, end, holidays),
        "dim_time": time_dimension(spark),
        "dim_subway_lines": line_dimension(spark),
    }
    paths = sinks.write_frames(frames, folder, fmt="parquet")
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    folder: str,
    existing: Mapping[str, str] | None = None,
    order_by: str | None = None,
    source: str = "api",
    batch: str | None = None,
) -> dict[str, Any]:
    """The whole job. ``batch`` names what is loaded, such as a landed folder or a day of delivery; without it each feed's rows do.

    A feed whose table has the batch is left out before it is cleaned. Feeds are stored before they are named and cleaned, and cleaned frames
    before they are loaded, so each feed is made once and a lost executor repeats one step only.
    """
    started = dt.datetime.now()
    log = f"{folder}/etl_log"

    def audit(**kwargs: Any) -> None:
        row = sinks.audit_row(spark, JOB, KIND, started, **kwargs)
        row.coalesce(1).write.mode("append").parquet(log)

    audit()
    try:
        stats: dict[str, CleaningStats] = {}
        batches, todo = {}, {}
        for name, df in raw.items():
            table = table_at(spark, folder, TARGETS[name])
            if batch and table.has(batch):
                batches[name] = batch
                continue
            held = landed(spark, df, f"{folder}/raw/{name}")
            batches[name] = batch or content_name(held)
            if not table.has(batches[name]):
                todo[name] = held
        clean_all(todo, order_by, stats)
        clean = {}
        for name, counters in stats.items():
            # Kept and dropped rows side by side: the counters come from the one write, the load reads the kept ones.
            path = f"{folder}/processed/{name}_cleaned"
            counters.marked.write.mode("overwrite").partitionBy(KEPT).parquet(path)
            written = spark.read.schema(counters.marked.schema).parquet(path)
            counters.count(written)
            clean[name] = written.filter(KEPT).drop(*MARKS)
        cleaning = {name: s.get() for name, s in stats.items()}
        held = f"{folder}/dim_date"
        known = {"held": spark.read.parquet(held).select(F.col("full_date").alias("date"))} if sinks.path_exists(spark, held) else {}
        dims = build_dimensions(spark, folder, *days_of({**clean, **known}, DIM_START, DIM_END))
        counts, refused = load_frames(spark, clean, folder, dims, batches, existing, order_by, source)
        counts = {name: counts.get(name, 0) for name in TARGETS if name in raw}
        processed = sum(s["total_records"] for s in cleaning.values())
        result = {"status": "completed", "tables_loaded": counts, "quarantined": refused, "cleaning": cleaning}
        audit(end=dt.datetime.now(), status="completed", processed=processed, inserted=sum(counts.values()), failed=refused, details=result)
        return result
    except Exception as error:
        audit(end=dt.datetime.now(), status="failed", error=str(error))
        return {"status": "failed", "errors": [str(error)]}


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(read_schema(ETL_LOG)).parquet(f"{folder}/etl_log")


