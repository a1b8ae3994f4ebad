"""Oracle texts of kept results, of sorted marts and of exports and reports: from the whole tables, without months, states or batches."""

from __future__ import annotations

from checks import oracle_marts, oracle_rest
from checks.oracle_parts import half_up, with_parts
from checks.registry import ORDERS

LATE = "(date_key >= 20000101 OR date_key % 100 = 31)"

_TEXTS = {
    "kept_station_performance": """
WITH t AS (SELECT station_id, count(DISTINCT date_key) AS days_with_data, CAST(sum(entries) AS BIGINT) AS total_entries,
    CAST(sum(exits) AS BIGINT) AS total_exits, CAST(sum(entries + exits) AS BIGINT) AS total_traffic, avg(entries) AS avg_daily_entries,
    max(entries) AS peak_entries
  FROM fact_ridership_long GROUP BY 1),
a AS (SELECT s.station_id, s.station_name, s.borough, CAST(s.latitude AS DOUBLE) AS latitude, CAST(s.longitude AS DOUBLE) AS longitude,
    s.lines_served, s.ada_accessible, t.* EXCLUDE (station_id)
  FROM dim_stations s LEFT JOIN t ON t.station_id = s.station_id)
SELECT * REPLACE (coalesce(days_with_data, 0) AS days_with_data),
  CAST(rank() OVER (ORDER BY total_traffic DESC NULLS FIRST) AS INT) AS traffic_rank,
  CAST(rank() OVER (PARTITION BY borough ORDER BY total_traffic DESC NULLS FIRST) AS INT) AS borough_rank
FROM a""",
    "kept_top_stations": f"""
SELECT s.station_name, s.borough, s.lines_served, CAST(sum(r.entries + r.exits) AS BIGINT) AS total_traffic,
  CAST(sum(r.entries) AS BIGINT) AS total_entries, CAST(sum(r.exits) AS BIGINT) AS total_exits,
  count(DISTINCT r.date_key) AS days_with_service, {half_up('sum(r.entries + r.exits)', 'count(DISTINCT r.date_key)', 0)} AS avg_daily_traffic
FROM fact_ridership_long r JOIN dim_stations s ON s.station_id = r.station_id
GROUP BY 1, 2, 3
ORDER BY total_traffic DESC NULLS FIRST, 1, 2, 3
LIMIT 10""",
    "kept_active_by_month": """
SELECT year, month_number, count(DISTINCT station_id) AS active_stations
FROM fact_ridership_long JOIN dim_date USING (date_key) GROUP BY 1, 2""",
    "kept_active_by_weekday": """
SELECT day_name, count(DISTINCT station_id) AS active_stations FROM fact_ridership_long JOIN dim_date USING (date_key) GROUP BY 1""",
    "kept_refreshes": f"""
SELECT CAST(date_key // 100 AS INT) AS month, count(DISTINCT station_id) AS stations, CAST(sum(entries) AS BIGINT) AS entries
FROM fact_ridership_long
WHERE date_key // 100 IN (SELECT date_key // 100 FROM fact_ridership_long WHERE {LATE})
GROUP BY 1""",
}

_TEXTS["nan_balances"] = "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer"
_TEXTS["quality_verdict"] = """
WITH f AS (SELECT * FROM feed_ridership UNION ALL SELECT * FROM feed_ridership WHERE line LIKE 'c%')
SELECT 'passed' AS what, 'false' AS value
UNION ALL SELECT 'issue', 'Missing required column: fare'
UNION ALL SELECT 'issue', printf('High null rate (%.1f%%) in column: station', 100e0 * count(*) FILTER (ingest_seq % 3 <> 0) / count(*)) FROM f
UNION ALL SELECT 'total_records', CAST(count(*) AS VARCHAR) FROM f
UNION ALL SELECT 'total_columns', '6'
UNION ALL SELECT 'duplicate_count', CAST(count(*) - count(DISTINCT ingest_seq) AS VARCHAR) FROM f"""


def texts() -> dict[str, str]:
    marts, rest = oracle_marts.texts(), oracle_rest.texts()
    out = {name: with_parts(text) for name, text in _TEXTS.items()}
    out |= {"kept_hourly_ridership": marts["hourly_ridership"], "kept_peak_hours": marts["peak_hours"]}
    out["kept_daily_kpis"] = f"SELECT * FROM ({marts['daily_kpis']}) days WHERE year = 2024"
    sets = ("ridership_summary", "delay_analysis", "stations", "subway_lines")
    counts = [f"SELECT '{n}' AS table_name, count(*) AS record_count FROM ({rest[f'export_{n}']}) t" for n in sets]
    out["exported_sets"] = "\nUNION ALL ".join(counts)
    out["station_stamps"] = f"""
SELECT station_name, station_name NOT IN (SELECT concat('Customer#', lpad(CAST(s_suppkey * 3 AS VARCHAR), 9, '0')) FROM supplier) AS created,
  station_name IN (SELECT station_name FROM ({rest["clean_stations"]}) c) AS stamped
FROM ({rest["load_stations"]}) t"""
    for name, keys in ORDERS.items():
        order = ", ".join(f"{column} {how}" for column, how in keys)
        out[f"ordered_{name}"] = f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({marts[name]}) sorted"
    return out
