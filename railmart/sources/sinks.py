"""Writing frames, tables, audit rows and refreshable results."""

from __future__ import annotations

import datetime as dt
import json
import re
import tempfile
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart.operators.dims import keep_one
from railmart.schemas import ETL_LOG, QUARANTINE, conform, read_schema

NULL_TEXT = "\\N"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor sees.

    Only a session whose tasks all run in the driver (master ``local``) may go without it; elsewhere it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="railmart-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result and read it back: computed once, and still there when an executor is lost."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession, path: str) -> None:
    """Remove a stored intermediate once nothing reads it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def create_tables(
    spark: SparkSession, tables: Mapping[str, Mapping[str, str]], database: str = "default"
) -> list[str]:
    """Create the empty catalog tables that do not exist yet; returns their names. Temp views do not count."""
    missing = [t for t in tables if not spark.catalog.tableExists(f"{database}.{t}")]
    for table in missing:
        empty = spark.createDataFrame([], read_schema(dict(tables[table])))
        empty.write.saveAsTable(f"{database}.{table}")
    return missing


def write_frames(frames: Mapping[str, DataFrame], folder: str, suffix: str = "", fmt: str = "csv") -> dict[str, str]:
    """One folder per frame; returns name → path."""
    paths = {}
    for name, df in frames.items():
        path = f"{folder}/{name}{suffix}"
        writer = df.write.mode("overwrite")
        writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path)
        paths[name] = path
    return paths


def export_results(results: Mapping[str, DataFrame], folder: str) -> list[str]:
    """CSV per result set; empty ones are skipped. Returns the names written.

    Each result is computed and written once; a written set without rows is removed again.
    """
    written = []
    for name, result in results.items():
        path = f"{folder}/{name}"
        result.write.mode("overwrite").option("header", True).csv(path)
        if result.sparkSession.read.schema(result.schema).option("header", True).csv(path).isEmpty():
            drop_stored(result.sparkSession, path)
        else:
            written.append(name)
    return written


def append_rows(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> None:
    """Append to a catalog table by column name; columns left out become NULL."""
    rows = df.select(*columns) if columns else df
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        rows.write.saveAsTable(table)
        return
    target = dict(spark.table(table).dtypes)
    conform(rows, target).write.mode("append").insertInto(table)


def insert_ignoring(df: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Append rows whose key the table lacks, one per key."""
    existing = df.sparkSession.table(table).select(*keys)
    append_rows(keep_one(df, keys).join(existing, list(keys), "left_anti"), table)


def write_delimited(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Tab-separated text without header, NULL as ``\\N``: the form bulk loaders read."""
    rows = df.select(*columns) if columns else df
    rows.write.mode("overwrite").option("sep", "\t").option("header", False).option("nullValue", NULL_TEXT).csv(path)


def read_delimited(spark: SparkSession, path: str, schema: Mapping[str, str]) -> DataFrame:
    return (
        spark.read.schema(read_schema(dict(schema))).option("sep", "\t").option("nullValue", NULL_TEXT).csv(path)
    )


def run_query(spark: SparkSession, query: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """A parameterised query, ``:name`` for each argument."""
    return spark.sql(query, args=dict(args or {}))


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def table_row_count(spark: SparkSession, table: str) -> int:
    return spark.table(table).count()


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of records."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name).alias("table_name"), "record_count")
        for name, df in frames.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


# --- Staging ----------------------------------------------------------------------------------------------------


def split_rejected(df: DataFrame, error: Column, dataset: str) -> tuple[DataFrame, DataFrame]:
    """Rows without an error, and the rest as staging rows with their payload and message."""
    marked = df.withColumn("_error", error)
    good = marked.filter(F.col("_error").isNull()).drop("_error")
    payload = F.to_json(F.struct(*df.columns))
    rejected = marked.filter(F.col("_error").isNotNull()).select(
        F.lit(dataset).alias("dataset"),
        payload.alias("raw_data"),
        F.lit(False).alias("processed"),
        F.col("_error").alias("error_message"),
        F.current_timestamp().alias("created_at"),
    )
    return good, conform(rejected, QUARANTINE)


def required_error(columns: Sequence[str]) -> Column:
    """Message for the first missing required value."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in columns])


# --- Audit ------------------------------------------------------------------------------------------------------


def audit_row(
    spark: SparkSession,
    job: str,
    kind: str,
    start: dt.datetime,
    end: dt.datetime | None = None,
    status: str = "running",
    processed: int = 0,
    inserted: int = 0,
    failed: int = 0,
    error: str | None = None,
    details: Mapping[str, Any] | None = None,
) -> DataFrame:
    """One row of the job log; details are kept as JSON."""
    text = json.dumps(dict(details or {}), default=str)
    row = [(job, kind, start, end, status, processed, inserted, 0, failed, error, text)]
    return spark.createDataFrame(row, read_schema(ETL_LOG))


# --- Refreshable results ----------------------------------------------------------------------------------------


def refresh_table(df: DataFrame, table: str) -> None:
    """Replace a stored result."""
    df.write.mode("overwrite").saveAsTable(table)


def refresh_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions ``df`` holds rows for, e.g. the current month of a daily result.

    Rows of a partition are brought together in few files; a partition too large for one task is split over several.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
