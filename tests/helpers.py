"""Small helpers for literal-row tests."""

from __future__ import annotations


def rows(df):
    return [tuple(r) for r in df.collect()]


def bag(df):
    return sorted(rows(df), key=repr)


def values(df, column="v"):
    return [r[0] for r in df.select(column).collect()]


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
