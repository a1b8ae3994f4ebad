"""Landed CSV, JSON and Parquet data sets."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart import schemas
from railmart.functions.calendar import as_of_date, to_datetime
from railmart.schemas import Schema, read_schema

MINIMUM_ROWS = 1000
WINDOW_DAYS = 365
INGEST_SEQ = "ingest_seq"
MONTH = "landed_month"


@dataclass(frozen=True)
class Dataset:
    """A landing folder, its schema and the column its extract window applies to."""

    folder: str
    schema: Schema
    time_column: str | None = None
    year_column: str | None = None


CATALOG = {
    "subway_stations": Dataset("subway_stations", schemas.PORTAL_STATIONS),
    "subway_ridership": Dataset("subway_ridership", schemas.PORTAL_RIDERSHIP, "transit_timestamp"),
    "hourly_ridership": Dataset("hourly_ridership", schemas.PORTAL_RIDERSHIP, "transit_timestamp"),
    "performance_subway": Dataset("performance_subway", schemas.PORTAL_PERFORMANCE, year_column="period_year"),
    "subway_delays": Dataset("subway_delays", schemas.PORTAL_DELAYS, "start_date"),
    "turnstile_usage": Dataset("turnstile_usage", schemas.PORTAL_TURNSTILE, "date"),
}

# Which data set feeds which cleaner.
FEEDS = {
    "stations": "subway_stations",
    "ridership": "subway_ridership",
    "performance": "performance_subway",
    "delays": "subway_delays",
}

SAMPLE_FILES = {
    "stations": schemas.SAMPLE_STATIONS,
    "ridership": schemas.SAMPLE_RIDERSHIP,
    "delays": schemas.SAMPLE_DELAYS,
    "performance": schemas.SAMPLE_PERFORMANCE,
}


def with_ingest_seq(df: DataFrame) -> DataFrame:
    """Position of each row in its files: name, block, row. The same however Spark packs blocks into tasks."""
    return df.withColumn(
        INGEST_SEQ,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def read_csv(spark: SparkSession, path: str, schema: Schema, positions: bool = False) -> DataFrame:
    """CSV with a header line and a fixed schema; no inference pass. Files here never hold line breaks in values."""
    df = spark.read.schema(read_schema(schema)).option("header", True).csv(path)
    return with_ingest_seq(df) if positions else df


def read_sample_files(spark: SparkSession, folder: str, positions: bool = False) -> dict[str, DataFrame]:
    """The four CSV data sets: stations, ridership, delays and performance."""
    return {n: read_csv(spark, f"{folder}/{n}.csv", s, positions) for n, s in SAMPLE_FILES.items()}


def read_json(spark: SparkSession, path: str, schema: Schema, positions: bool = False) -> DataFrame:
    """Landed pages, one record per line; every value arrives as text."""
    df = spark.read.schema(read_schema(schema)).json(path)
    return with_ingest_seq(df) if positions else df


def land(df: DataFrame, root: str, name: str) -> str:
    """Store pages of a catalog data set as JSON lines, in folders by the month of its time column; returns the path.

    Rows whose time cannot be read go to the folder of NULL. The month is a copy for the reader; the pages stay as they are.
    """
    dataset = CATALOG[name]
    path = f"{root}/{dataset.folder}"
    if not dataset.time_column:
        df.write.mode("append").json(path)
        return path
    month = F.date_format(to_datetime(F.col(dataset.time_column)), "yyyyMM").cast("int")
    df.withColumn(MONTH, month).write.mode("append").partitionBy(MONTH).json(path)
    return path


def in_months(df: DataFrame, start: dt.date | str | None, end: dt.date | str | None) -> DataFrame:
    """Leave out folders of months before ``start`` or after ``end``, where the pages were landed by month."""
    if MONTH not in df.columns or start is None:
        return df
    df = df.filter(F.col(MONTH) >= int(str(start)[:7].replace("-", "")))
    return df if end is None else df.filter(F.col(MONTH) <= int(str(end)[:7].replace("-", "")))


def read_dataset(
    spark: SparkSession,
    root: str,
    name: str,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    year: int | None = None,
    max_records: int | None = None,
    positions: bool = False,
) -> DataFrame:
    """One data set of the catalog, cut to a window on its time column or to a year."""
    dataset = CATALOG[name]
    df = read_json(spark, f"{root}/{dataset.folder}", dataset.schema, positions)
    df = between(in_months(df, start, end), dataset.time_column, start, end) if dataset.time_column else df
    df = df.drop(MONTH)
    if year is not None and dataset.year_column:
        df = df.filter(F.col(dataset.year_column).try_cast("int") == year)
    return df if max_records is None else first_rows(df, max_records)


def between(df: DataFrame, column: str, start: dt.date | str | None = None, end: dt.date | str | None = None) -> DataFrame:
    """``start <= column [<= end]``. Without a start there is no window. A bare end date means its midnight."""
    if start is None:
        return df
    kind = dict(df.dtypes)[column]
    at = to_datetime(F.col(column)) if kind == "string" else F.col(column)
    df = df.filter(at >= F.lit(str(start)).cast("timestamp_ntz"))
    return df if end is None else df.filter(at <= F.lit(str(end)).cast("timestamp_ntz"))


def first_rows(df: DataFrame, n: int, order_by: list[str] | None = None) -> DataFrame:
    """A record cap that always keeps the same rows: sorted by all columns unless told otherwise."""
    return df.orderBy(*(order_by or df.columns)).limit(n)


def extract_window(
    start: dt.date | str | None = None, end: dt.date | str | None = None, as_of: dt.date | None = None
) -> tuple[dt.date | str, dt.date | str]:
    """The last 365 days up to ``as_of`` unless both ends are given."""
    today = as_of or dt.date.today()
    return start or today - dt.timedelta(days=WINDOW_DAYS), end or today


def in_window(df: DataFrame, column: str, as_of: dt.date | str | None = None, days: int = WINDOW_DAYS) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``, both ends included; a plain comparison, so it reaches the scan."""
    last = as_of_date(as_of)
    return df.filter((F.col(column) >= F.date_sub(last, days)) & (F.col(column) < F.date_add(last, 1)))


def enough_rows(frames: dict[str, DataFrame], minimum: int = MINIMUM_ROWS) -> bool:
    """Whether all inputs together hold ``minimum`` rows; no input is read further than that. The rows stay as they are."""
    found = 0
    for df in frames.values():
        found += df.limit(minimum - found).count()
        if found >= minimum:
            return True
    return False


def require_rows(frames: dict[str, DataFrame], minimum: int = MINIMUM_ROWS) -> dict[str, DataFrame]:
    """The inputs, unchanged; an error where they are too thin. Which data to take instead is the caller's choice."""
    if not frames or not enough_rows(frames, minimum):
        raise ValueError(f"fewer than {minimum} rows in {sorted(frames)}")
    return frames
