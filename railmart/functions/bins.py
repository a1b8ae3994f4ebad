"""Duration bins, open on the left and closed on the right; 0, negative and NULL fall in none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper edges in minutes and the labels below them.
CATEGORY_BINS = [(5, "Minor"), (15, "Moderate"), (30, "Significant"), (60, "Major"), (None, "Severe")]
SEVERITY_BINS = [(10, "Low"), (30, "Medium"), (None, "High")]
SAMPLE_SEVERITY_BINS = [(5, "Low"), (30, "Medium"), (None, "High")]

SEVERITY_PROFILES = {"cleaner": SEVERITY_BINS, "sample": SAMPLE_SEVERITY_BINS}

PERFORMANCE_BANDS = [(90, "Excellent"), (80, "Good"), (70, "Fair")]
LOWEST_BAND = "Needs Improvement"


def right_closed(c: Column, bins: list[tuple[float | None, str]]) -> Column:
    out = F.when(~(c > 0), F.lit(None).cast("string"))
    for edge, label in bins:
        out = out.when(c > 0 if edge is None else c <= edge, F.lit(label))
    return out


def delay_category(minutes: Column) -> Column:
    return right_closed(minutes, CATEGORY_BINS)


def delay_severity(minutes: Column, profile: str = "cleaner") -> Column:
    """``cleaner`` splits at 10 and 30 minutes, ``sample`` at 5 and 30 and counts 0 as Low."""
    if profile == "sample":
        return F.when(minutes <= 5, "Low").when(minutes <= 30, "Medium").when(minutes > 30, "High")
    return right_closed(minutes, SEVERITY_PROFILES[profile])


def performance_band(pct: Column) -> Column:
    """NULL falls in the lowest band."""
    out = F.when(F.lit(False), F.lit(LOWEST_BAND))
    for floor, label in PERFORMANCE_BANDS:
        out = out.when(pct >= floor, F.lit(label))
    return out.otherwise(F.lit(LOWEST_BAND))
