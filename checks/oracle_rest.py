"""Oracle texts of measures, exports, cleaning, loads, stores and reports."""

from __future__ import annotations

from checks.oracle_marts import KPI_LITERAL, LINE_DAYS, STATION_SEARCH, mean_pct, total
from checks.oracle_parts import plain, with_parts
from railmart.adapters import EXISTING

# --- Measures ---------------------------------------------------------------------------------------------------

RIDES = """
SELECT r.*, d.* EXCLUDE (date_key), t.hour, t.time_period, t.is_peak_hour, t.peak_type, l.line_name, l.line_group,
  s.station_name, s.borough
FROM {fact} r
LEFT JOIN dim_date d USING (date_key)
LEFT JOIN dim_time t USING (time_key)
LEFT JOIN dim_lines l USING (line_id)
LEFT JOIN dim_stations s USING (station_id)"""

RIDES_LONG = """
SELECT r.*, d.* EXCLUDE (date_key), s.borough
FROM fact_ridership_long r LEFT JOIN dim_date d USING (date_key) LEFT JOIN dim_stations s USING (station_id)"""

PERFORMANCE = """
SELECT p.*, d.* EXCLUDE (date_key), l.line_name, l.line_group
FROM fact_performance p LEFT JOIN dim_date d USING (date_key) LEFT JOIN dim_lines l USING (line_id)"""

OTP = "coalesce(CAST(sum(on_time_trips) AS DOUBLE) / nullif(CAST(sum(scheduled_trips) AS DOUBLE), 0), 0.0) * 100"
BAND = "CASE WHEN {0} >= 90 THEN 'Excellent' WHEN {0} >= 80 THEN 'Good' WHEN {0} >= 70 THEN 'Fair' ELSE 'Needs Improvement' END"

MEASURE_PARTS = {
    "rides": RIDES.format(fact="fact_ridership"),
    "late": RIDES.format(fact="fact_delays"),
    "rides_long": RIDES_LONG,
    "perf": PERFORMANCE,
    "days_long": f"SELECT full_date, {total('entries', 'entries')} FROM rides_long GROUP BY 1",
    "days_long_borough": f"SELECT borough, full_date, {total('entries', 'entries')} FROM rides_long GROUP BY 1, 2",
    "days_borough": f"SELECT borough, full_date, {total('entries', 'entries')} FROM rides GROUP BY 1, 2",
    "months_long": "SELECT CAST(date_trunc('month', full_date) AS DATE) AS month, CAST(sum(entries) AS BIGINT) AS entries FROM days_long GROUP BY 1",
    "months_long_borough": "SELECT borough, CAST(date_trunc('month', full_date) AS DATE) AS month, CAST(sum(entries) AS BIGINT) AS entries FROM days_long_borough GROUP BY 1, 2",
}

WEEKDAYS = "NOT is_weekend AND line_name IN ('NATION_1', 'NATION_2', 'NATION_3') AND full_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-28'"


def trend(rows: str, by: str) -> str:
    return f"""
WITH p AS (SELECT {by}, {total('entries', 'total_entries')} FROM {rows} GROUP BY ALL)
SELECT *, (SELECT CAST(sum(total_entries) AS DOUBLE) / count(total_entries) FROM p) AS average_line FROM p"""


MEASURES = {
    "ridership_measures_by_borough": f"""
SELECT borough, CAST(sum(entries) + sum(exits) AS BIGINT) AS total_ridership, {total('entries', 'total_entries')},
  {total('exits', 'total_exits')}, {total('total_traffic', 'total_traffic')}, count(DISTINCT station_id) AS active_stations,
  CAST(sum(entries) FILTER (WHERE is_peak_hour) AS BIGINT) AS peak_hour_ridership,
  coalesce(CAST(sum(entries) FILTER (WHERE is_peak_hour) AS DOUBLE) / CAST(sum(entries) AS DOUBLE), 0.0) * 100 AS peak_hour_pct,
  CAST(sum(entries) FILTER (WHERE peak_type = 'Morning') AS BIGINT) AS morning_rush_riders,
  CAST(sum(entries) FILTER (WHERE peak_type = 'Evening') AS BIGINT) AS evening_rush_riders
FROM rides GROUP BY borough""",
    "delay_measures_by_line": f"""
SELECT line_name, count(delay_id) AS total_delays, avg(delay_duration_minutes) AS avg_delay_minutes,
  count(*) FILTER (WHERE severity_level = 'High') AS severe_delays, count(*) FILTER (WHERE is_peak_hour) AS peak_hour_delays,
  {total('passenger_impact_estimate', 'passengers_affected')}, avg(resolution_time_minutes) AS avg_resolution_minutes
FROM late GROUP BY line_name""",
    "performance_measures_by_group": f"""
SELECT line_group, {OTP} AS otp_rate, {OTP} - 85 AS otp_vs_target, {BAND.format(OTP)} AS otp_status,
  {mean_pct('on_time_percentage')} AS avg_otp
FROM perf GROUP BY line_group""",
    "measures_across_facts": f"""
WITH a AS (SELECT line_name, CAST(sum(entries) + sum(exits) AS BIGINT) AS total_ridership FROM rides WHERE {WEEKDAYS} GROUP BY 1),
b AS (SELECT line_name, count(delay_id) AS total_delays FROM late WHERE {WEEKDAYS} GROUP BY 1),
c AS (SELECT line_name, {OTP} AS otp_rate, {BAND.format(OTP)} AS otp_status FROM perf WHERE {WEEKDAYS} GROUP BY 1)
SELECT line_name, total_ridership, total_delays, otp_rate, otp_status
FROM a FULL JOIN b USING (line_name) FULL JOIN c USING (line_name)""",
    "measures_in_total": f"""
SELECT (SELECT CAST(sum(entries) + sum(exits) AS BIGINT) FROM rides) AS total_ridership,
  (SELECT avg(delay_duration_minutes) FROM late) AS avg_delay_minutes, (SELECT {OTP} - 85 FROM perf) AS otp_vs_target""",
    "rush_hour_slice": f"""
SELECT line_group, hour, {total('entries', 'total_entries')}, count(DISTINCT station_id) AS active_stations FROM rides
WHERE borough IN ('ASIA', 'EUROPE') AND time_period IN ('Morning Rush', 'Evening Rush') GROUP BY 1, 2""",
    "severity_slice": f"""
SELECT borough, count(delay_id) AS total_delays, {total('passenger_impact_estimate', 'passengers_affected')} FROM late
WHERE severity_level = 'High' GROUP BY 1""",
    "avg_daily_ridership": "SELECT borough, avg(entries) AS avg_daily_ridership FROM days_borough GROUP BY 1",
    "rolling_seven_days": """
SELECT a.full_date, a.entries, avg(b.entries) AS rolling_7day_avg
FROM days_long a JOIN days_long b ON b.full_date BETWEEN a.full_date - 6 AND a.full_date GROUP BY 1, 2""",
    "rolling_seven_days_by_borough": """
SELECT a.borough, a.full_date, a.entries, avg(b.entries) AS rolling_7day_avg
FROM days_borough a JOIN days_borough b ON b.borough = a.borough AND b.full_date BETWEEN a.full_date - 6 AND a.full_date
GROUP BY 1, 2, 3""",
    "year_to_date": """
SELECT a.full_date, a.entries, CAST(sum(b.entries) AS BIGINT) AS ytd_entries
FROM days_long a JOIN days_long b ON year(b.full_date) = year(a.full_date) AND b.full_date <= a.full_date GROUP BY 1, 2""",
    "month_over_month": """
SELECT a.month, a.entries, b.entries AS prev_entries,
  coalesce(CAST((a.entries - b.entries) * 100 AS DOUBLE) / b.entries, 0.0) AS change_pct
FROM months_long a LEFT JOIN months_long b ON b.month + INTERVAL 1 MONTH = a.month""",
    "year_over_year": """
SELECT a.borough, a.month, a.entries, b.entries AS prev_entries,
  coalesce(CAST((a.entries - b.entries) * 100 AS DOUBLE) / b.entries, 0.0) AS change_pct
FROM months_long_borough a LEFT JOIN months_long_borough b ON b.borough = a.borough AND b.month + INTERVAL 12 MONTH = a.month""",
    "entries_trend": """
SELECT borough, round(regr_slope(entries, full_date - DATE '1970-01-01'), 4) AS slope,
  round(regr_intercept(entries, full_date - DATE '1970-01-01'), 4) AS intercept, count(*) AS points
FROM days_long_borough GROUP BY 1""",
    "delays_by_line_and_severity": """
SELECT line_name, '#' || lpad(CAST(line_id AS VARCHAR), 6, '0') AS line_color, severity_level,
  count(*) AS total_delays, avg(delay_duration_minutes) AS avg_delay_minutes
FROM (SELECT * REPLACE (CASE WHEN line_name IS NOT NULL THEN line_id END AS line_id) FROM late) GROUP BY line_name, line_id, severity_level""",
    "ridership_trend_by_month": trend("rides_long", "year, quarter, month_number"),
    "ridership_trend_by_quarter": trend("rides_long", "year, quarter, borough"),
    "ridership_trend_by_year": trend("rides_long", "year"),
    "ridership_trend_by_day": trend("rides", "year, quarter, month_number, full_date, borough"),
    "station_map": f"""
SELECT s.station_name, s.borough, CAST(s.latitude AS DOUBLE) AS latitude, CAST(s.longitude AS DOUBLE) AS longitude,
  {total('r.total_traffic', 'total_traffic')}
FROM fact_ridership r LEFT JOIN dim_stations s USING (station_id) GROUP BY ALL""",
    "borough_by_weekday": "SELECT borough, "
    + ", ".join(
        f"CAST(sum(entries) FILTER (WHERE day_name = '{d}') AS BIGINT) AS {d}"
        for d in ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
    )
    + " FROM rides GROUP BY borough",
    "kpi_cards": f"""
SELECT *, 85.0::DOUBLE AS otp_target, avg_otp - 85 AS otp_gap FROM (
  SELECT (SELECT CAST(sum(entries) AS BIGINT) FROM fact_ridership) AS total_entries,
    (SELECT {mean_pct('on_time_percentage')} FROM fact_performance) AS avg_otp,
    (SELECT count(*) FROM fact_delays) AS total_delays,
    (SELECT count(DISTINCT station_id) FROM fact_ridership) AS active_stations)""",
    "ridership_by_hour": f"SELECT hour, time_period, {total('entries', 'total_entries')} FROM rides GROUP BY 1, 2",
    "delay_scatter": f"""
SELECT full_date, line_name, delay_duration_minutes, {total('passenger_impact_estimate', 'passenger_impact')},
  count(*) AS delay_count FROM late GROUP BY 1, 2, 3""",
    "line_delay_profile": f"""
SELECT line_name, avg(delay_duration_minutes) AS avg_delay_minutes,
  {total('passenger_impact_estimate', 'passengers_affected')}, count(*) AS total_delays FROM late GROUP BY 1""",
}

# --- Exports ----------------------------------------------------------------------------------------------------

EXPORTS = {
    "export_ridership_summary": f"""
SELECT full_date, day_name, month_name, year, is_weekend, station_name, borough, line_name,
  CASE WHEN line_name IS NOT NULL THEN concat('#', lpad(CAST(line_id AS VARCHAR), 6, '0')) END AS line_color,
  {total('entries', 'total_entries')}, {total('exits', 'total_exits')}, {total('total_traffic', 'total_traffic')}
FROM rides WHERE full_date IS NOT NULL GROUP BY ALL""",
    "export_delay_analysis": """
SELECT d.full_date, d.day_name, d.month_name, t.time_period, t.is_peak_hour, l.line_name, l.line_color, x.delay_category,
  x.severity_level, x.delay_reason, x.delay_duration_minutes, x.passenger_impact_estimate
FROM fact_delays x JOIN dim_date d USING (date_key) LEFT JOIN dim_time t USING (time_key) LEFT JOIN dim_lines l USING (line_id)""",
    "export_performance_trends": """
SELECT d.full_date, d.month_name, d.year, d.is_weekend, l.line_name, l.line_color, l.line_group, p.scheduled_trips,
  p.actual_trips, p.on_time_trips, p.late_trips, p.canceled_trips, CAST(p.on_time_percentage AS DOUBLE) AS on_time_percentage,
  CAST(NULL AS DOUBLE) AS wait_assessment, CAST(NULL AS DOUBLE) AS customer_journey_time_performance
FROM fact_performance p JOIN dim_date d USING (date_key) LEFT JOIN dim_lines l USING (line_id)""",
    "export_stations": """
SELECT station_id, station_name, borough, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
  CAST(NULL AS VARCHAR) AS structure_type, ada_accessible, lines_served, CAST(NULL AS VARCHAR) AS division
FROM dim_stations""",
    "export_subway_lines": "SELECT * FROM dim_lines",
    "sql_station_summary": STATION_SEARCH.format(where="WHERE s.station_name ILIKE '%mer#0000001%'"),
    "sql_line_performance": LINE_DAYS.format(
        where="WHERE l.line_name = 'NATION_7' AND d.full_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"
    ),
    "sql_view": f"""
SELECT {BAND.format('p.on_time_percentage')} AS performance_category, count(*) AS days
FROM fact_performance p JOIN dim_date USING (date_key) JOIN dim_lines USING (line_id) GROUP BY 1""",
}

# --- Cleaning ---------------------------------------------------------------------------------------------------


def number(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def title(c: str) -> str:
    pieces = f"regexp_extract_all(lower(trim({c})), '[a-z]+|[^a-z]+')"
    return f"array_to_string(list_transform({pieces}, lambda w: upper(w[1]) || w[2:]), '')"


CLOCK = "strftime({0}, '%H:%M:%S')"

CLEAN_PARTS = {
    "c_stations": f"""
SELECT ingest_seq, station_name, CASE b WHEN 'M' THEN 'Manhattan' WHEN 'Bk' THEN 'Brooklyn' WHEN 'Bx' THEN 'Bronx'
    WHEN 'Q' THEN 'Queens' WHEN 'Si' THEN 'Staten Island' ELSE b END AS borough,
  CASE WHEN lat BETWEEN 40.4 AND 41.0 THEN lat END AS latitude,
  CASE WHEN lon BETWEEN -74.3 AND -73.7 THEN lon END AS longitude, replace(routes, ' ', ',') AS lines_served
FROM (SELECT *, row_number() OVER (PARTITION BY station_name ORDER BY ingest_seq) AS nth FROM (
  SELECT ingest_seq, {title('"Stop Name"')} AS station_name, {title('"Borough"')} AS b, {number('"GTFS-Latitude"')} AS lat,
    {number('"GTFS-Longitude"')} AS lon, "Daytime Routes" AS routes FROM feed_stations))
WHERE nth = 1 AND station_name IS NOT NULL""",
    "n_ridership": f"""
SELECT ingest_seq, TRY_CAST(transit_timestamp AS TIMESTAMP) AS datetime, {title('station')} AS station_name,
  upper(trim(line)) AS line_name, CASE WHEN {number('entries')} >= 0 THEN floor({number('entries')}) ELSE 0 END AS e,
  CASE WHEN {number('exits')} >= 0 THEN floor({number('exits')}) ELSE 0 END AS x
FROM feed_ridership""",
    "c_ridership": f"""
SELECT ingest_seq, datetime, CAST(datetime AS DATE) AS date, {CLOCK.format('datetime')} AS "time",
  CAST(hour(datetime) AS INT) AS hour, station_name, line_name, least(e, el) AS entries, least(x, xl) AS exits
FROM (SELECT *, row_number() OVER (PARTITION BY datetime, station_name, line_name ORDER BY ingest_seq) AS nth FROM n_ridership)
CROSS JOIN (SELECT avg(e) + 3 * stddev_samp(e) AS el, avg(x) + 3 * stddev_samp(x) AS xl FROM n_ridership)
WHERE nth = 1 AND datetime IS NOT NULL""",
    "n_delays": f"""
SELECT ingest_seq, TRY_CAST(start_date AS TIMESTAMP) AS incident_datetime, upper(trim(route)) AS line_name, station_name,
  trim(cause) AS delay_reason, {number('delay_minutes')} AS m, passenger_impact_estimate FROM feed_delays""",
    "c_delays": f"""
SELECT ingest_seq, incident_datetime, CAST(incident_datetime AS DATE) AS date, {CLOCK.format('incident_datetime')} AS "time",
  line_name, station_name, delay_reason, coalesce(m, (SELECT median(m) FROM n_delays)) AS delay_duration_minutes,
  CASE WHEN m <= 0 THEN NULL WHEN m <= 5 THEN 'Minor' WHEN m <= 15 THEN 'Moderate' WHEN m <= 30 THEN 'Significant'
    WHEN m <= 60 THEN 'Major' WHEN m > 60 THEN 'Severe' END AS delay_category,
  CASE WHEN m <= 0 THEN NULL WHEN m <= 10 THEN 'Low' WHEN m <= 30 THEN 'Medium' WHEN m > 30 THEN 'High' END AS severity_level,
  passenger_impact_estimate
FROM (SELECT *, row_number() OVER (PARTITION BY incident_datetime, line_name, delay_reason ORDER BY ingest_seq) AS nth FROM n_delays)
WHERE nth = 1""",
    "n_performance": f"""
SELECT ingest_seq, CAST(period_year || '-' || lpad(period_month, 2, '0') || '-01' AS DATE) AS date,
  upper(trim(subway_line)) AS line_name, {number('on_time_percentage')} AS p, {number('wait_assessment')} AS w,
  CAST(coalesce({number('scheduled_trips')}, 0) AS BIGINT) AS scheduled_trips,
  CAST(coalesce({number('on_time_trips')}, 0) AS BIGINT) AS on_time_trips FROM feed_performance""",
    "c_performance": """
SELECT ingest_seq, date, line_name, CASE WHEN (SELECT max(p) FROM n_performance) <= 1 THEN p * 100 ELSE p END AS on_time_percentage,
  CASE WHEN (SELECT max(w) FROM n_performance) <= 1 THEN w * 100 ELSE w END AS wait_assessment, scheduled_trips, on_time_trips
FROM (SELECT *, row_number() OVER (PARTITION BY date, line_name ORDER BY ingest_seq DESC) AS nth FROM n_performance)
WHERE nth = 1""",
}

DELAY_COLUMNS = (
    "ingest_seq", "incident_datetime", "date", "time", "line_name", "station_name", "delay_reason",
    "delay_duration_minutes", "delay_category", "severity_level", "passenger_impact_estimate",
)

CLEANING = {
    "clean_stations": "SELECT * FROM c_stations",
    "clean_ridership": "SELECT * REPLACE (round(entries, 4) AS entries, round(exits, 4) AS exits) FROM c_ridership",
    "clean_delays": "SELECT * FROM c_delays",
    "clean_performance": "SELECT * FROM c_performance",
    "null_rates": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count("{c}") AS nulls,
        (count(*) - count("{c}")) * 100 / count(*) AS null_pct FROM c_delays"""
        for c in DELAY_COLUMNS
    ),
    "duplicate_rows": """
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_count
FROM (SELECT transit_timestamp, station, line, entries, exits, count(*) AS n FROM feed_ridership GROUP BY ALL)""",
    "duration_from_times": """
SELECT event_id AS ingest_seq, CAST(floor(value) AS DOUBLE) AS delay_duration_minutes FROM events WHERE event_type = 'error'""",
}

# --- Loads ------------------------------------------------------------------------------------------------------

KEY = "CAST(year(date)*10000+month(date)*100+day(date) AS INT)"
PERCENT = "CASE WHEN scheduled_trips > 0 THEN floor((20000.0::DOUBLE * on_time_trips + scheduled_trips) / (2 * scheduled_trips)) / 100.0::DOUBLE ELSE 0.0::DOUBLE END"


def merged_performance(everything: bool) -> str:
    late = "CASE WHEN n.date_key IS NOT NULL THEN 0 ELSE o.late_trips END" if everything else "coalesce(o.late_trips, 0)"
    canceled = late.replace("late_trips", "canceled_trips")
    return f"""
WITH n AS (SELECT {KEY} AS date_key, l.line_id, CAST(scheduled_trips AS INT) AS scheduled_trips, 0 AS actual_trips,
    CAST(on_time_trips AS INT) AS on_time_trips FROM c_performance c LEFT JOIN dim_lines l USING (line_name)),
m AS (SELECT coalesce(n.date_key, o.date_key) AS date_key, CAST(coalesce(n.line_id, o.line_id) AS BIGINT) AS line_id,
    CASE WHEN n.date_key IS NOT NULL THEN n.scheduled_trips ELSE o.scheduled_trips END AS scheduled_trips,
    CASE WHEN n.date_key IS NOT NULL THEN n.actual_trips ELSE o.actual_trips END AS actual_trips,
    CASE WHEN n.date_key IS NOT NULL THEN n.on_time_trips ELSE o.on_time_trips END AS on_time_trips,
    CAST({late} AS INT) AS late_trips, CAST({canceled} AS INT) AS canceled_trips
  FROM n FULL JOIN old_performance o ON o.date_key = n.date_key AND o.line_id = n.line_id)
SELECT *, {PERCENT} AS on_time_percentage FROM m"""


LOAD_PARTS = {
    "old_performance": plain(EXISTING["performance"]),
    "old_stations": plain(EXISTING["stations"]),
}

LOADS = {
    "load_stations": """
SELECT o.station_id AS kept_id, coalesce(o.station_name, n.station_name) AS station_name,
  CASE WHEN n.station_name IS NOT NULL THEN n.borough ELSE o.borough END AS borough,
  CAST(CAST(n.latitude AS DECIMAL(10,8)) AS DOUBLE) AS latitude, CAST(CAST(n.longitude AS DECIMAL(11,8)) AS DOUBLE) AS longitude,
  CASE WHEN o.station_name IS NOT NULL THEN o.lines_served ELSE n.lines_served END AS lines_served, o.division
FROM c_stations n FULL JOIN old_stations o ON o.station_name = n.station_name""",
    "load_ridership": f"""
SELECT {KEY} AS date_key, CAST(hour * 100 AS INT) AS time_key, s.station_id, CAST(l.line_id AS BIGINT) AS line_id,
  CAST(floor(entries) AS INT) AS entries, CAST(floor(exits) AS INT) AS exits,
  CAST(floor(entries) AS INT) + CAST(floor(exits) AS INT) AS total_traffic, 'api' AS data_source
FROM c_ridership LEFT JOIN dim_lines l USING (line_name) LEFT JOIN dim_stations s USING (station_name)""",
    "load_delays": f"""
SELECT {KEY} AS date_key, CAST(hour(incident_datetime) * 100 AS INT) AS time_key, CAST(l.line_id AS BIGINT) AS line_id,
  s.station_id, CAST(floor(delay_duration_minutes) AS INT) AS delay_duration_minutes,
  coalesce(delay_category, 'Unknown') AS delay_category, coalesce(delay_reason, '') AS delay_reason, TRUE AS is_resolved,
  passenger_impact_estimate, coalesce(severity_level, 'Medium') AS severity_level
FROM c_delays LEFT JOIN dim_lines l USING (line_name) LEFT JOIN dim_stations s USING (station_name)""",
    "full_load_two_days": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {KEY} AS date_key, count(*) AS records, count(*) AS ids FROM {rows} WHERE date IS NOT NULL GROUP BY 1, 2"
        for table, rows in (("fact_ridership", "c_ridership"), ("fact_delays", "c_delays"))
    ),
    # Each batch is cleaned by itself, with its own limits, median and first rows.
    "full_load_split_day": f"""
SELECT 'fact_ridership' AS table_name, {KEY} AS date_key, count(*) AS records, count(*) AS ids,
  CAST(sum(floor(least(e, el)) + floor(least(x, xl))) AS BIGINT) AS total
FROM (SELECT *, CAST(datetime AS DATE) AS date, ingest_seq % 2 AS half,
    row_number() OVER (PARTITION BY ingest_seq % 2, datetime, station_name, line_name ORDER BY ingest_seq) AS nth FROM n_ridership)
JOIN (SELECT ingest_seq % 2 AS half, avg(e) + 3 * stddev_samp(e) AS el, avg(x) + 3 * stddev_samp(x) AS xl FROM n_ridership GROUP BY 1) USING (half)
WHERE nth = 1 AND date IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'fact_delays', {KEY}, count(*), count(*), CAST(sum(floor(coalesce(m, middle))) AS BIGINT)
FROM (SELECT *, CAST(incident_datetime AS DATE) AS date, ingest_seq % 2 AS half,
    row_number() OVER (PARTITION BY ingest_seq % 2, incident_datetime, line_name, delay_reason ORDER BY ingest_seq) AS nth FROM n_delays)
JOIN (SELECT ingest_seq % 2 AS half, median(m) AS middle FROM n_delays GROUP BY 1) USING (half)
WHERE nth = 1 AND date IS NOT NULL GROUP BY 2""",
    "full_load_quarantine": """
SELECT what, count(*) AS records
FROM (SELECT DISTINCT CASE WHEN ingest_seq % 7 < 2 THEN 'no calendar day' WHEN ingest_seq % 7 = 2 THEN 'missing date' ELSE 'loaded' END AS what,
    CASE WHEN ingest_seq % 7 < 2 THEN CAST(ingest_seq % 7 AS VARCHAR) WHEN ingest_seq % 7 > 2 THEN CAST(incident_datetime AS VARCHAR) END AS day,
    line_name, delay_reason FROM n_delays) GROUP BY 1
UNION ALL SELECT 'calendar', DATE '2026-12-31' - DATE '2024-01-01' + 1""",
    "load_audit": """
SELECT 'transit_etl' AS job_name, 'running' AS status, CAST(0 AS BIGINT) AS records_processed, CAST(0 AS BIGINT) AS records_inserted,
  CAST(0 AS BIGINT) AS records_failed FROM generate_series(1, 2)
UNION ALL SELECT 'transit_etl', 'completed', 0, 0, 0
UNION ALL SELECT 'transit_etl', 'completed', (SELECT count(*) FROM feed_delays), count(date), count(*) - count(date) FROM c_delays""",
    "sample_severity": """
SELECT CASE WHEN delay_duration_minutes <= 5 THEN 'Low' WHEN delay_duration_minutes <= 30 THEN 'Medium'
  WHEN delay_duration_minutes > 30 THEN 'High' END AS severity_level,
  count(*) AS delays, min(delay_duration_minutes) AS least, max(delay_duration_minutes) AS most FROM fact_delays GROUP BY 1""",
    **dict.fromkeys(("cleaning_counts", "load_counts"), """
SELECT total_records, cleaned_records, CAST(0 AS BIGINT) AS dropped_records, total_records - cleaned_records AS duplicates_removed,
  (SELECT count(*) FROM n_delays WHERE m IS NULL) AS nulls_filled
FROM (SELECT (SELECT count(*) FROM feed_delays) AS total_records, (SELECT count(*) FROM c_delays) AS cleaned_records)"""),
    "load_performance": merged_performance(False),
    "load_performance_all_columns": merged_performance(True),
    "daily_summary": f"""
SELECT date_key, station_id, CAST(line_id AS BIGINT) AS line_id, {total('entries', 'total_entries')}, {total('exits', 'total_exits')},
  CAST(coalesce(sum(entries) FILTER (WHERE is_peak_hour), 0) AS BIGINT) AS peak_hour_entries,
  CAST(coalesce(sum(entries) FILTER (WHERE NOT is_peak_hour), 0) AS BIGINT) AS off_peak_entries,
  CAST((200 * sum(entries) + count(DISTINCT hour)) // (2 * count(DISTINCT hour)) AS DOUBLE) / 100.0 AS avg_entries_per_hour
FROM fact_ridership JOIN dim_time USING (time_key) GROUP BY date_key, station_id, line_id""",
    "date_dimension": "SELECT * FROM dim_date WHERE full_date IN (SELECT CAST(o_orderdate AS DATE) FROM orders)",
    "date_dimension_holidays": """
SELECT date_key, month_number = 12 AND day_of_month IN (24, 25, 31) AS is_holiday,
  CASE WHEN month_number = 12 AND day_of_month IN (24, 25, 31) THEN 'Year End' END AS holiday_name
FROM dim_date WHERE full_date IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
    "time_dimension": """
SELECT t.*, e.events FROM dim_time t
LEFT JOIN (SELECT hour(ts) * 100 + minute(ts) AS time_key, count(*) AS events FROM events GROUP BY 1) e USING (time_key)""",
    "insert_absent": """
SELECT full_date, min(origin) AS origin FROM (
  SELECT CAST(o_orderdate AS DATE) AS full_date, 'order' AS origin FROM orders
  UNION ALL SELECT CAST(l_shipdate AS DATE), 'shipment' FROM lineitem) GROUP BY 1""",
    "text_keys": "SELECT c_name, upper(substr(md5(c_name), 1, 8)) AS text_key FROM customer",
    "row_counts": """
SELECT 'dim_subway_lines' AS table_name, count(*) AS record_count FROM dim_lines
UNION ALL SELECT 'dim_stations', count(*) FROM dim_stations UNION ALL SELECT 'dim_date', count(*) FROM dim_date
UNION ALL SELECT 'dim_time', count(*) FROM dim_time UNION ALL SELECT 'fact_ridership', count(*) FROM fact_ridership
UNION ALL SELECT 'fact_delays', count(*) FROM fact_delays UNION ALL SELECT 'fact_performance', count(*) FROM fact_performance""",
}

# --- Stores -----------------------------------------------------------------------------------------------------

STORES = {
    "landed_window": """
SELECT station, count(*) AS records, max(transit_timestamp) AS latest FROM feed_ridership
WHERE TRY_CAST(transit_timestamp AS TIMESTAMP) BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' GROUP BY 1""",
    "landed_cap": """
SELECT period_year, period_month, CAST(NULL AS VARCHAR) AS line, on_time_percentage, wait_assessment, scheduled_trips
FROM feed_performance WHERE period_year = '1997'
ORDER BY period_year, period_month, on_time_percentage NULLS FIRST, wait_assessment NULLS FIRST, scheduled_trips NULLS FIRST
LIMIT 500""",
    "csv_round_trip": "SELECT * EXCLUDE (ingest_seq, incident_datetime) FROM c_delays",
    "delimited_round_trip": "SELECT delay_id, line_id, delay_category, delay_reason FROM fact_delays",
    "quarantine": """
SELECT 'ridership' AS dataset, FALSE AS processed,
  CASE WHEN TRY_CAST(transit_timestamp AS TIMESTAMP) IS NULL THEN 'missing datetime' ELSE 'missing exits' END AS error_message,
  line, count(*) AS records
FROM feed_ridership WHERE TRY_CAST(transit_timestamp AS TIMESTAMP) IS NULL OR exits IS NULL GROUP BY 3, 4""",
    "refreshed_months": """
SELECT d.year, d.month_number, CAST(sum(entries) * CASE WHEN d.year >= 2000 THEN 2 ELSE 1 END AS BIGINT) AS total_entries
FROM fact_ridership_long JOIN dim_date d USING (date_key) GROUP BY d.year, d.month_number""",
    "refreshed_daily_kpis": KPI_LITERAL,
    "parameterised": """
SELECT delay_reason, count(*) AS delays FROM fact_delays WHERE delay_duration_minutes >= 30 GROUP BY 1""",
    "last_year": """
SELECT o_orderstatus, count(*) AS orders, min(o_orderdate) AS first FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2000-12-31' - 365 AND DATE '2000-12-31' GROUP BY 1""",
}

# --- Reports ----------------------------------------------------------------------------------------------------

REPORT_PARTS = {
    "whole_rides": "SELECT * REPLACE (CAST(floor(entries) AS BIGINT) AS entries, CAST(floor(exits) AS BIGINT) AS exits) FROM c_ridership",
}


def delay_report(by: str, k: int) -> str:
    return f"""
SELECT {by}, count(*) AS incidents, round(avg(delay_duration_minutes), 9) AS avg_minutes FROM c_delays
WHERE {by} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {k}"""


REPORTS = {
    "report_top_stations": f"""
SELECT station_name, {total('entries', 'entries')} FROM whole_rides GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "report_boroughs": f"""
SELECT borough, {total('r.entries', 'entries')},
  CAST(sum(r.entries) * 100 AS DOUBLE) / (SELECT sum(entries) FROM whole_rides) AS pct
FROM whole_rides r JOIN c_stations USING (station_name) GROUP BY 1""",
    "report_peaks": """
WITH p AS (SELECT CASE WHEN hour IN (7, 8, 9) THEN 'Morning Rush' WHEN hour IN (17, 18, 19) THEN 'Evening Rush' ELSE 'Off-Peak' END AS period,
  CAST(sum(entries) AS BIGINT) AS entries FROM whole_rides GROUP BY 1)
SELECT period, entries, CAST(entries * 100 AS DOUBLE) / (SELECT sum(entries) FROM p) AS pct FROM p""",
    "report_on_time": """
SELECT line_name, round(avg_otp, 6) AS avg_otp, CASE WHEN avg_otp >= 85 THEN 'good' WHEN avg_otp >= 75 THEN 'fair' ELSE 'poor' END AS status
FROM (SELECT line_name, avg(on_time_percentage) AS avg_otp FROM c_performance GROUP BY 1) ORDER BY avg_otp DESC NULLS LAST, line_name LIMIT 10""",
    "report_causes": delay_report("delay_reason", 8),
    "report_line_delays": delay_report("line_name", 10),
    "report_weekend": """
SELECT weekday_avg, weekend_avg, (1 - weekend_avg / weekday_avg) * 100 AS weekend_drop_pct FROM (
  SELECT CAST(sum(entries) FILTER (WHERE NOT w) AS DOUBLE) / count(DISTINCT date) FILTER (WHERE NOT w) AS weekday_avg,
    CAST(sum(entries) FILTER (WHERE w) AS DOUBLE) / count(DISTINCT date) FILTER (WHERE w) AS weekend_avg
  FROM (SELECT *, dayofweek(date) IN (0, 6) AS w FROM whole_rides))""",
    "report_summary": f"""
SELECT count(*) AS ridership_records, min(date) AS first_date, max(date) AS last_date, {total('entries', 'total_entries')},
  {total('exits', 'total_exits')}, (SELECT count(*) FROM c_stations) AS stations, (SELECT count(*) FROM c_delays) AS delay_incidents,
  (SELECT count(*) FROM c_performance) AS performance_records FROM whole_rides""",
}


# More rounds than the adapters' points need until the centres stand still; further ones change nothing.
LLOYD_ROUNDS = 40


def clusters(points: str, features: list[str], k: int, rounds: int) -> str:
    """The clusters by Lloyd's steps written out: bands of the summed z-scores, then means and nearest means, `rounds` times."""
    z = [f"z{i}" for i in range(len(features))]
    scores = ", ".join(
        f"(CAST({f} AS DOUBLE) - (SELECT avg({f}) FROM p)) / coalesce(nullif((SELECT stddev_samp({f}) FROM p), 0), 1) AS {x}" for f, x in zip(features, z)
    )
    present = " AND ".join(f"{f} IS NOT NULL" for f in features)
    cuts = " + ".join(
        f"CAST(total > (SELECT total FROM t WHERE place = (SELECT ceil(count(*) * {i / k!r}) FROM t)) AS INTEGER)" for i in range(1, k)
    )
    steps = [
        f"p AS MATERIALIZED (SELECT *, row_number() OVER () AS point FROM ({points}) x WHERE {present})",
        f"z AS MATERIALIZED (SELECT point, {scores} FROM p)",
        f"t AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY total) AS place FROM (SELECT *, {' + '.join(z)} AS total FROM z) y)",
        f"l0 AS MATERIALIZED (SELECT point, {', '.join(z)}, {cuts} AS label FROM t)",
    ]
    means = ", ".join(f"avg({x}) AS m{x}" for x in z)
    apart = " + ".join(f"({x} - m{x}) * ({x} - m{x})" for x in z)
    for r in range(rounds):
        steps.append(
            f"c{r} AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY {', '.join('m' + x for x in z)}) - 1 AS centre"
            f" FROM (SELECT {means} FROM l{r} GROUP BY label) y)"
        )
        steps.append(
            f"l{r + 1} AS MATERIALIZED (SELECT point, {', '.join(z)}, centre AS label FROM z, c{r}"
            f" QUALIFY row_number() OVER (PARTITION BY point ORDER BY {apart}, centre) = 1)"
        )
    return f"WITH {', '.join(steps)} SELECT p.* EXCLUDE (point), CAST(label AS INTEGER) AS cluster FROM p JOIN l{rounds} USING (point)"


def texts() -> dict[str, str]:
    extra = {**MEASURE_PARTS, **CLEAN_PARTS, **LOAD_PARTS, **REPORT_PARTS}
    groups = (MEASURES, EXPORTS, CLEANING, LOADS, STORES, REPORTS)
    out = {name: with_parts(text, extra) for group in groups for name, text in group.items()}
    for name, points in (("delay_cluster_checks", "line_delay_profile"), ("delay_scatter_cluster_checks", "delay_scatter")):
        out[name] = f"SELECT count(*) AS points, CAST(0 AS BIGINT) AS misplaced, CAST(0 AS BIGINT) AS unplaced FROM ({out[points]}) p"
    profile = ["avg_delay_minutes", "passengers_affected", "total_delays"]
    out["delay_clusters"] = clusters(out["line_delay_profile"], profile, 3, LLOYD_ROUNDS)
    scatter = ["delay_duration_minutes", "passenger_impact", "delay_count"]
    out["delay_scatter_clusters"] = clusters(out["delay_scatter"], scatter, 4, LLOYD_ROUNDS)
    large = ("load_ridership", "load_delays", "ridership_measures_by_borough")
    return out | {f"{name}_large": out[name] for name in large}
