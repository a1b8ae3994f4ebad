"""Oracle texts of the marts, in plain row-by-row SQL."""

from __future__ import annotations

from checks.oracle_parts import half_up, with_parts




def total(column: str, alias: str) -> str:
    return f"CAST(sum({column}) AS BIGINT) AS {alias}"


def mean_pct(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / count({column})"


def mean2(column: str, scale: int = 2) -> str:
    return half_up(f"sum({column})", f"count({column})", scale)


def mean2_pct(column: str, scale: int = 2) -> str:
    return half_up(f"sum({column}) * 100", f"(count({column}) * 100)", scale)


DAY = "d.full_date, d.day_name, d.day_of_week, d.month_name, d.month_number, d.quarter, d.year, d.is_weekend, d.is_holiday"

DAILY = f"""
SELECT {DAY}, s.station_name, s.borough, CAST(s.latitude AS DOUBLE) AS latitude, CAST(s.longitude AS DOUBLE) AS longitude, l.line_name, l.line_color, l.line_group,
  {total('r.entries', 'total_entries')}, {total('r.exits', 'total_exits')}, {total('r.total_traffic', 'total_traffic')},
  avg(r.entries) AS avg_entries, count(*) AS record_count
FROM fact_ridership r
JOIN dim_date d USING (date_key)
LEFT JOIN dim_stations s USING (station_id)
LEFT JOIN dim_lines l USING (line_id)
GROUP BY ALL"""

DELAY_DETAIL = """
SELECT d.full_date, d.day_name, d.month_name, d.year, d.is_weekend, t.hour, t.time_period, t.is_peak_hour,
  l.line_name, l.line_color, l.line_group, s.station_name, s.borough, x.delay_category, x.severity_level, x.delay_reason,
  x.delay_duration_minutes, x.passenger_impact_estimate, x.resolution_time_minutes
FROM fact_delays x
JOIN dim_date d USING (date_key)
LEFT JOIN dim_time t USING (time_key)
LEFT JOIN dim_lines l USING (line_id)
LEFT JOIN dim_stations s USING (station_id)"""

STATION_ORACLE = """
SELECT s.station_id, s.station_name, s.borough, CAST(s.latitude AS DOUBLE) AS latitude, CAST(s.longitude AS DOUBLE) AS longitude, s.lines_served, s.ada_accessible,
  count(DISTINCT r.date_key) AS days_with_data, CAST(sum(r.entries) AS BIGINT) AS total_entries,
  CAST(sum(r.exits) AS BIGINT) AS total_exits, CAST(sum(r.total_traffic) AS BIGINT) AS total_traffic,
  avg(r.entries) AS avg_daily_entries, max(r.entries) AS peak_entries,
  CAST(rank() OVER (ORDER BY sum(r.total_traffic) DESC NULLS {nulls}) AS INT) AS traffic_rank,
  CAST(rank() OVER (PARTITION BY s.borough ORDER BY sum(r.total_traffic) DESC NULLS {nulls}) AS INT) AS borough_rank
FROM dim_stations s LEFT JOIN fact_ridership r ON r.station_id = s.station_id
GROUP BY s.station_id, s.station_name, s.borough, s.latitude, s.longitude, s.lines_served, s.ada_accessible"""

MONTHLY = f"""
WITH m AS (
  SELECT d.year, d.month_number, d.month_name, {total('r.entries', 'total_entries')}, {total('r.exits', 'total_exits')},
    avg(r.entries) AS avg_daily_entries
  FROM {{fact}} r JOIN dim_date d USING (date_key)
  GROUP BY ALL),
p AS (SELECT *, lag(total_entries) OVER (ORDER BY year, month_number) AS prev_month_entries FROM m)
SELECT *, {half_up('total_entries - prev_month_entries', 'prev_month_entries', 2, 100)} AS mom_change_pct FROM p"""

KPI_LITERAL = f"""
SELECT d.full_date, d.year, d.month_number, d.day_name, d.is_weekend, {total('r.entries', 'total_entries')},
  {total('r.exits', 'total_exits')}, count(DISTINCT r.station_id) AS active_stations,
  count(DISTINCT x.delay_id) AS delay_count, coalesce(avg(x.delay_duration_minutes), 0) AS avg_delay_minutes,
  coalesce({mean_pct('p.on_time_percentage')}, 0) AS system_avg_otp
FROM dim_date d
LEFT JOIN fact_ridership r ON r.date_key = d.date_key
LEFT JOIN fact_delays x ON x.date_key = d.date_key
LEFT JOIN fact_performance p ON p.date_key = d.date_key
GROUP BY d.full_date, d.year, d.month_number, d.day_name, d.is_weekend"""

KPI_INDEPENDENT = f"""
WITH r AS (SELECT date_key, {total('entries', 'total_entries')}, {total('exits', 'total_exits')},
    count(DISTINCT station_id) AS active_stations FROM fact_ridership GROUP BY 1),
x AS (SELECT date_key, count(*) AS delay_count, avg(delay_duration_minutes) AS minutes FROM fact_delays GROUP BY 1),
p AS (SELECT date_key, {mean_pct('on_time_percentage')} AS otp FROM fact_performance GROUP BY 1)
SELECT d.full_date, d.year, d.month_number, d.day_name, d.is_weekend, total_entries, total_exits,
  coalesce(active_stations, 0) AS active_stations, coalesce(delay_count, 0) AS delay_count,
  coalesce(minutes, 0) AS avg_delay_minutes, coalesce(otp, 0) AS system_avg_otp
FROM dim_date d LEFT JOIN r USING (date_key) LEFT JOIN x USING (date_key) LEFT JOIN p USING (date_key)"""

PERIODS_LITERAL = f"""
SELECT t.time_period, count(DISTINCT x.delay_id) AS delay_count, avg(x.delay_duration_minutes) AS avg_delay_minutes,
  {total('r.entries', 'total_entries')},
  {half_up('count(DISTINCT x.delay_id)', 'count(DISTINCT r.ridership_id)', 2, 10000)} AS delays_per_10k_entries
FROM dim_time t
LEFT JOIN fact_ridership r ON r.time_key = t.time_key
LEFT JOIN fact_delays x ON x.time_key = t.time_key
GROUP BY t.time_period"""

PERIODS_INDEPENDENT = f"""
WITH r AS (SELECT t.time_period, {total('entries', 'total_entries')}, count(*) AS n FROM fact_ridership JOIN dim_time t USING (time_key) GROUP BY 1),
x AS (SELECT t.time_period, count(*) AS n, avg(delay_duration_minutes) AS minutes FROM fact_delays JOIN dim_time t USING (time_key) GROUP BY 1)
SELECT p.time_period, coalesce(x.n, 0) AS delay_count, x.minutes AS avg_delay_minutes, r.total_entries,
  {half_up('coalesce(x.n, 0)', 'coalesce(r.n, 0)', 2, 10000)} AS delays_per_10k_entries
FROM (SELECT DISTINCT time_period FROM dim_time) p LEFT JOIN r USING (time_period) LEFT JOIN x USING (time_period)"""

STATION_SEARCH = f"""
SELECT s.station_name, s.borough, CAST(coalesce(sum(r.entries), 0) AS BIGINT) AS total_entries,
  CAST(coalesce(sum(r.exits), 0) AS BIGINT) AS total_exits, {mean2('r.entries')} AS avg_daily_entries,
  count(x.delay_id) AS delay_count, coalesce({mean2('x.delay_duration_minutes')}, 0) AS avg_delay_minutes
FROM dim_stations s
LEFT JOIN fact_ridership r ON r.station_id = s.station_id
LEFT JOIN fact_delays x ON x.station_id = s.station_id
{{where}}
GROUP BY s.station_name, s.borough"""

LINE_DAYS = """
SELECT l.line_name, d.full_date AS date_val, p.scheduled_trips, p.on_time_trips,
  CAST(p.on_time_percentage AS DOUBLE) AS on_time_pct, count(x.delay_id) AS delay_count
FROM dim_lines l
JOIN fact_performance p USING (line_id)
JOIN dim_date d ON d.date_key = p.date_key
LEFT JOIN fact_delays x ON x.line_id = l.line_id AND x.date_key = p.date_key
{where}
GROUP BY ALL"""

_TEXTS = {
    "daily_ridership": DAILY,
    "hourly_ridership": f"""
SELECT t.hour, t.time_period, t.is_peak_hour, t.am_pm, d.day_name, d.is_weekend, l.line_name, l.line_color, s.borough,
  {total('r.entries', 'total_entries')}, {total('r.exits', 'total_exits')}, avg(r.entries) AS avg_entries_per_record,
  count(DISTINCT d.full_date) AS days_count
FROM fact_ridership r JOIN dim_time t USING (time_key) JOIN dim_date d USING (date_key)
LEFT JOIN dim_lines l USING (line_id) LEFT JOIN dim_stations s USING (station_id)
GROUP BY ALL""",
    "station_performance": STATION_ORACLE.format(nulls="FIRST"),
    "station_performance_nulls_last": STATION_ORACLE.format(nulls="LAST"),
    "line_performance": """
SELECT d.full_date, d.day_name, d.month_name, d.year, d.is_weekend, l.line_name, l.line_color, l.line_group,
  l.service_pattern, p.scheduled_trips, p.actual_trips, p.on_time_trips, p.late_trips, p.canceled_trips,
  CAST(p.on_time_percentage AS DOUBLE) AS on_time_percentage, CAST(NULL AS DOUBLE) AS wait_assessment,
  CAST(NULL AS DOUBLE) AS customer_journey_time_performance,
  CASE WHEN p.on_time_percentage >= 90 THEN 'Excellent' WHEN p.on_time_percentage >= 80 THEN 'Good'
    WHEN p.on_time_percentage >= 70 THEN 'Fair' ELSE 'Needs Improvement' END AS performance_category
FROM fact_performance p JOIN dim_date d USING (date_key) JOIN dim_lines l USING (line_id)""",
    "delay_analysis": DELAY_DETAIL,
    "delay_summary_by_line": f"""
SELECT l.line_name, l.line_color, l.line_group, count(*) AS total_delays,
  avg(x.delay_duration_minutes) AS avg_delay_minutes, max(x.delay_duration_minutes) AS max_delay_minutes,
  {total('x.passenger_impact_estimate', 'total_passengers_affected')},
  count(*) FILTER (WHERE x.severity_level = 'High') AS severe_delays,
  count(*) FILTER (WHERE t.is_peak_hour) AS peak_hour_delays,
  {half_up('count(*) FILTER (WHERE t.is_peak_hour)', 'count(*)', 2, 100)} AS peak_hour_delay_pct
FROM fact_delays x LEFT JOIN dim_lines l USING (line_id) LEFT JOIN dim_time t USING (time_key)
GROUP BY l.line_name, l.line_color, l.line_group""",
    "monthly_trends": MONTHLY.format(fact="fact_ridership"),
    "monthly_trends_seven_years": MONTHLY.format(fact="fact_ridership_long"),
    "daily_kpis": KPI_LITERAL,
    "daily_kpis_independent": KPI_INDEPENDENT,
    "station_summary": STATION_SEARCH.format(where="WHERE s.station_name ILIKE '%' || 'CUSTOMER#00000_1' || '%'"),
    "station_totals": STATION_SEARCH.format(where=""),
    "line_days": LINE_DAYS.format(where=""),
    "line_performance_between": LINE_DAYS.format(
        where="WHERE l.line_name = 'NATION_3' AND d.full_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'"
    ),
    "avg_delays_per_line": f"""
SELECT l.line_name, l.line_color, count(*) AS delay_count, {mean2('x.delay_duration_minutes')} AS avg_delay_minutes,
  round(stddev_samp(x.delay_duration_minutes), 2) AS stddev_delay, min(x.delay_duration_minutes) AS min_delay,
  max(x.delay_duration_minutes) AS max_delay, quantile_cont(x.delay_duration_minutes, 0.5) AS median_delay
FROM fact_delays x JOIN dim_lines l USING (line_id)
GROUP BY l.line_name, l.line_color""",
    "peak_hours": f"""
SELECT t.hour, t.time_period, t.am_pm, {total('r.entries', 'total_entries')}, {total('r.exits', 'total_exits')},
  avg(r.entries) AS avg_entries, count(DISTINCT d.full_date) AS days_measured,
  {half_up('sum(r.entries)', 'count(DISTINCT d.full_date)', 0)} AS avg_hourly_entries
FROM fact_ridership r JOIN dim_time t USING (time_key) JOIN dim_date d USING (date_key)
GROUP BY t.hour, t.time_period, t.am_pm""",
    "on_time_by_line": f"""
SELECT l.line_name, l.line_group, l.service_pattern, count(*) AS days_measured,
  {mean2_pct('p.on_time_percentage')} AS avg_otp, CAST(min(p.on_time_percentage) AS DOUBLE) AS min_otp,
  CAST(max(p.on_time_percentage) AS DOUBLE) AS max_otp, CAST(NULL AS DOUBLE) AS avg_wait_assessment,
  CAST(NULL AS DOUBLE) AS avg_cjtp
FROM fact_performance p JOIN dim_lines l USING (line_id)
GROUP BY l.line_name, l.line_group, l.service_pattern""",
    "top_stations": f"""
SELECT s.station_name, s.borough, s.lines_served, {total('r.total_traffic', 'total_traffic')},
  {total('r.entries', 'total_entries')}, {total('r.exits', 'total_exits')},
  count(DISTINCT r.date_key) AS days_with_service,
  {half_up('sum(r.total_traffic)', 'count(DISTINCT r.date_key)', 0)} AS avg_daily_traffic
FROM dim_stations s JOIN fact_ridership r USING (station_id)
GROUP BY s.station_name, s.borough, s.lines_served
ORDER BY total_traffic DESC NULLS FIRST, s.station_name, s.borough, s.lines_served
LIMIT 10""",
    "delay_causes": f"""
SELECT delay_reason, count(*) AS incident_count, {mean2('delay_duration_minutes')} AS avg_duration,
  {total('passenger_impact_estimate', 'total_passengers_affected')},
  {half_up('count(*)', '(SELECT count(*) FROM fact_delays)', 2, 100)} AS pct_of_all_delays
FROM fact_delays GROUP BY delay_reason""",
    "weekend_vs_weekday": f"""
SELECT CASE WHEN d.is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type, {total('r.entries', 'total_entries')},
  avg(r.entries) AS avg_entries, {mean_pct('p.on_time_percentage')} AS avg_otp
FROM fact_ridership r JOIN dim_date d USING (date_key)
LEFT JOIN fact_performance p ON p.date_key = r.date_key AND p.line_id = r.line_id
GROUP BY d.is_weekend""",
    "borough_traffic": f"""
SELECT s.borough, count(DISTINCT s.station_id) AS station_count, {total('r.total_traffic', 'total_traffic')},
  {half_up('sum(r.total_traffic)', '(SELECT sum(total_traffic) FROM fact_ridership)', 2, 100)} AS traffic_share_pct,
  avg(r.total_traffic) AS avg_traffic_per_record
FROM dim_stations s JOIN fact_ridership r USING (station_id)
GROUP BY s.borough""",
    "time_period_performance": PERIODS_LITERAL,
    "time_period_performance_independent": PERIODS_INDEPENDENT,
    "ridership_on": f"""
SELECT {total('entries + exits', 'total_ridership')} FROM fact_ridership JOIN dim_date d USING (date_key)
WHERE d.full_date = DATE '2024-01-30'""",
    "recent_on_time": f"""
SELECT {mean2_pct('on_time_percentage', 1)} AS avg_otp FROM fact_performance
WHERE date_key >= (SELECT date_key FROM dim_date WHERE full_date = DATE '2024-02-10' - INTERVAL 30 DAY)""",
    "delays_in_month": """
SELECT count(*) AS monthly_delays FROM fact_delays JOIN dim_date d USING (date_key)
WHERE d.year = 2024 AND d.month_number = 1""",
    "busiest_station_on": f"""
SELECT s.station_name, {total('r.total_traffic', 'traffic')}
FROM fact_ridership r JOIN dim_stations s USING (station_id) JOIN dim_date d USING (date_key)
WHERE d.full_date = DATE '2024-01-30'
GROUP BY s.station_name ORDER BY traffic DESC NULLS FIRST, s.station_name LIMIT 1""",
    "top_stations_by_entries": f"""
SELECT station_name, {total('total_entries', 'total_entries')} FROM ({DAILY}) v
GROUP BY station_name ORDER BY 2 DESC NULLS FIRST, station_name NULLS LAST LIMIT 10""",
    "avg_delay_by_line": f"""
SELECT line_name, avg(delay_duration_minutes) AS avg_delay FROM ({DELAY_DETAIL}) v GROUP BY line_name""",
    "avg_otp_by_line": f"""
SELECT l.line_name, {mean_pct('p.on_time_percentage')} AS otp
FROM fact_performance p JOIN dim_date d USING (date_key) JOIN dim_lines l USING (line_id) GROUP BY l.line_name""",
}


def texts() -> dict[str, str]:
    out = {name: with_parts(text) for name, text in _TEXTS.items()}
    large = (
        "daily_ridership", "hourly_ridership", "station_performance", "delay_analysis", "top_stations", "borough_traffic", "station_summary",
    )
    return out | {f"{name}_large": out[name] for name in large}
