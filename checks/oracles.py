"""All oracle texts by query name."""

from __future__ import annotations

from checks import oracle_kept, oracle_marts, oracle_rest


# Totals of joins that repeat rows are decimals in the results, and doubles where they are compared.
WIDE = {
    **dict.fromkeys(("daily_kpis", "daily_kpis_independent", "refreshed_daily_kpis", "kept_daily_kpis"), ("total_entries", "total_exits")),
    **dict.fromkeys(
        ("station_summary", "station_summary_large", "station_totals", "sql_station_summary"), ("total_entries", "total_exits", "delay_count")
    ),
    **dict.fromkeys(("time_period_performance", "time_period_performance_independent"), ("total_entries",)),
}


def texts() -> dict[str, str]:
    out = {**oracle_marts.texts(), **oracle_rest.texts(), **oracle_kept.texts()}
    for name, columns in WIDE.items():
        casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
        out[name] = f"SELECT * REPLACE ({casts}) FROM ({out[name]}) wide"
    return out
