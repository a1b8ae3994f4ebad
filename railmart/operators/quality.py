"""Data-quality report."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIGH_NULL_PERCENT = 50


def is_missing(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    c = F.col(f"`{column}`")
    return c.isNull() | F.isnan(c) if kind in ("double", "float") else c.isNull()


def null_rates(df: DataFrame) -> DataFrame:
    """One row per column: missing values, rows and the missing share in percent (unrounded)."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.count_if(is_missing(df, c)).alias("nulls"))
                for c in df.columns
            ]
        ).alias("columns"),
    )
    return counts.select("rows", F.inline("columns")).select(
        "column_name",
        "rows",
        "nulls",
        F.when(F.col("rows") > 0, F.col("nulls") * 100 / F.col("rows")).otherwise(F.lit(0.0)).alias("null_pct"),
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column; copies are dropped before the shuffle."""
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg((F.count(F.lit(1)) - 1).alias("extra")).agg(
        F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_count")
    )


def quality_report(df: DataFrame, required: Sequence[str] = ()) -> tuple[bool, dict[str, Any]]:
    """Run the checks. Only one row per column reaches the driver. Duplicates are reported, not an issue."""
    missing = [c for c in required if c not in df.columns]
    issues = [f"Missing required column: {c}" for c in missing]
    rates = null_rates(df).collect()
    percentages = {}
    for row in rates:
        if row.null_pct > 0:
            percentages[row.column_name] = round(row.null_pct, 2)
            if row.null_pct > HIGH_NULL_PERCENT:
                issues.append(f"High null rate ({row.null_pct:.1f}%) in column: {row.column_name}")
    report = {
        "total_records": rates[0].rows if rates else 0,
        "total_columns": len(df.columns),
        "missing_required_cols": missing,
        "null_percentages": percentages,
        "duplicate_count": duplicate_count(df).first().duplicate_count,
        "issues": issues,
    }
    return not issues, report
