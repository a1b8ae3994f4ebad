"""Views of order and event tables as transit data.

The texts run unchanged in Spark SQL and in DuckDB. ``STAR`` gives star tables, ``FEEDS`` raw feeds with the flaws the
cleaners look for. Names in braces are the tables they read.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart.functions.bins import delay_category, delay_severity
from railmart.operators.dims import date_dimension, time_dimension
from railmart.plans.star import Star

# Given, so that opening a table does not start a job to look for its schema.
SOURCES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

FIRST_DAY, LAST_DAY = dt.date(1995, 1, 1), dt.date(2024, 12, 31)

DAY_KEY = "CAST(year({0})*10000+month({0})*100+day({0}) AS INT)"
EVENT_LINE = "CASE WHEN event_id % 27 < 25 THEN CAST(event_id % 27 AS INT) END"

STAR = {
    "dim_lines": """
SELECT n_nationkey AS line_id, n_name AS line_name, concat('#', lpad(CAST(n_nationkey AS STRING),6,'0')) AS line_color,
  r_name AS line_group, CASE n_nationkey % 3 WHEN 0 THEN 'Local' WHEN 1 THEN 'Express' ELSE 'Shuttle' END AS service_pattern
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "dim_stations": """
SELECT c_custkey AS station_id, c_name AS station_name, r_name AS borough, n_name AS lines_served,
  c_custkey % 4 = 0 AS ada_accessible,
  CAST(40.4 + (c_custkey % 601) / 1000e0 AS DECIMAL(10,8)) AS latitude,
  CAST(-74.3 + (c_custkey % 599) / 1000e0 AS DECIMAL(11,8)) AS longitude
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "fact_ridership": f"""
SELECT event_id AS ridership_id, {DAY_KEY.format('ts')} AS date_key, CAST(hour(ts)*100+minute(ts) AS INT) AS time_key,
  user_id AS station_id, {EVENT_LINE} AS line_id, CAST(floor(value*10) AS INT) AS entries,
  CAST(floor(value*9) AS INT) AS exits, CAST(floor(value*10)+floor(value*9) AS INT) AS total_traffic
FROM {{events}}
WHERE event_type <> 'error'""",
    "fact_delays_raw": f"""
SELECT event_id AS delay_id, {DAY_KEY.format('ts')} AS date_key, CAST(hour(ts)*100 AS INT) AS time_key,
  {EVENT_LINE} AS line_id, user_id AS station_id, CAST(floor(least(value,120.0)) AS INT) AS delay_duration_minutes,
  concat('reason ', CAST(event_id % 18 AS STRING)) AS delay_reason,
  CAST(floor(value) AS INT)*100 AS passenger_impact_estimate,
  CAST(floor(least(value,120.0)) AS INT) + 5 AS resolution_time_minutes
FROM {{events}}
WHERE event_type = 'error'""",
    "fact_performance": f"""
SELECT date_key, line_id, scheduled_trips, scheduled_trips - canceled_trips AS actual_trips,
  scheduled_trips - canceled_trips - late_trips AS on_time_trips, late_trips, canceled_trips,
  CAST(CASE WHEN scheduled_trips > 0
    THEN floor((20000e0 * (scheduled_trips - canceled_trips - late_trips) + scheduled_trips) / (2e0 * scheduled_trips)) / 100e0
    ELSE 0e0 END AS DECIMAL(5,2)) AS on_time_percentage
FROM (SELECT {DAY_KEY.format('ts')} AS date_key, CAST(event_id % 25 AS INT) AS line_id, count(*) AS scheduled_trips,
    count(CASE WHEN event_type = 'error' THEN 1 END) AS canceled_trips,
    count(CASE WHEN event_type <> 'error' AND value >= 100 THEN 1 END) AS late_trips
  FROM {{events}}
  GROUP BY 1, 2) t""",
    "fact_ridership_long": f"""
SELECT {DAY_KEY.format('l_shipdate')} AS date_key, l_suppkey AS station_id, CAST(l_partkey % 25 AS INT) AS line_id,
  CAST(l_quantity AS INT) AS entries, CAST(floor(l_quantity*(1-l_discount)) AS INT) AS exits
FROM {{lineitem}}""",
}

FEEDS = {
    "stations": """
SELECT c_custkey AS ingest_seq, concat('  ', lower(c_name), CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE '' END) AS "Stop Name",
  CASE n_regionkey WHEN 0 THEN ' m' WHEN 1 THEN 'BK' WHEN 2 THEN 'bx ' WHEN 3 THEN 'q' ELSE 'si' END AS "Borough",
  CASE WHEN c_acctbal < 0 THEN 'unknown' ELSE CAST(40.3 + (c_custkey % 800) / 1000e0 AS STRING) END AS "GTFS-Latitude",
  CAST(-74.4 + (c_custkey % 800) / 1000e0 AS STRING) AS "GTFS-Longitude", 'A C E' AS "Daytime Routes"
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL
SELECT 1000000000 + s_suppkey, concat('Customer#', lpad(CAST(s_suppkey AS STRING), 9, '0'), ' '), 'Manhattan',
  '40.5', '-74', 'B D'
FROM {supplier}""",
    "ridership": """
SELECT event_id AS ingest_seq, CASE WHEN value < 2 THEN 'not a time' ELSE CAST(date_trunc('hour', ts) AS STRING) END AS transit_timestamp,
  concat(' ', lower(c_name), ' ') AS station, concat(lower(n_name), ' ') AS line,
  CASE WHEN event_type = 'view' AND value < 20 THEN 'x' WHEN event_type = 'click' AND value < 20 THEN '-3'
    ELSE CAST(CAST(floor(value*10) AS INT) AS STRING) END AS entries,
  CASE WHEN value < 10 THEN NULL ELSE CAST(CAST(floor(value*9) AS INT) AS STRING) END AS exits
FROM {events} JOIN {customer} ON user_id = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
WHERE event_type <> 'error'""",
    "delays": """
SELECT event_id AS ingest_seq, CAST(date_trunc('day', ts) AS STRING) AS start_date, ' ' || lower(n_name) AS route,
  concat(' reason ', CAST(event_id % 18 AS STRING), ' ') AS cause,
  CASE WHEN value < 3 THEN 'n/a' WHEN value < 10 THEN '0' ELSE CAST(CAST(floor(least(value,120.0)) AS INT) AS STRING) END AS delay_minutes,
  CAST(floor(value) AS INT)*100 AS passenger_impact_estimate, c_name AS station_name
FROM {events} JOIN {customer} ON user_id = c_custkey LEFT JOIN {nation} ON event_id % 27 = n_nationkey
WHERE event_type = 'error'""",
    "performance": """
SELECT o_orderkey AS ingest_seq, CAST(year(o_orderdate) AS STRING) AS period_year, CAST(month(o_orderdate) AS STRING) AS period_month,
  concat(lower(n_name), ' ') AS subway_line,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(CAST(floor(o_totalprice) % 1001 AS INT) / 1000e0 AS STRING) END AS on_time_percentage,
  CAST(CAST(floor(o_totalprice) % 101 AS INT) AS STRING) AS wait_assessment,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'none' ELSE CAST(CAST(floor(o_totalprice) % 400 AS INT) + 100 AS STRING) END AS scheduled_trips,
  CAST(CAST(floor(o_totalprice) % 100 AS INT) AS STRING) AS on_time_trips
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
}

# Earlier versions of the upserted tables.
EXISTING = {
    "stations": """
SELECT s_suppkey AS station_id, concat('Customer#', lpad(CAST(s_suppkey * 3 AS STRING), 9, '0')) AS station_name,
  'Old' AS borough, 'X' AS lines_served, 'IND' AS division
FROM {supplier}""",
    "performance": """
SELECT min(o_orderkey) AS performance_id, CAST(year(o_orderdate)*10000+month(o_orderdate)*100+1 AS INT) AS date_key,
  CAST(c_nationkey AS BIGINT) AS line_id, CAST(count(*) AS INT) AS scheduled_trips, CAST(count(*) AS INT) AS actual_trips,
  0 AS on_time_trips, 1 AS late_trips, 2 AS canceled_trips
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
WHERE o_orderstatus = 'F'
GROUP BY 2, 3""",
}


def tables_in(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCES[name]).parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run one of the texts on the Parquet tables below ``sf_dir``."""
    tables = {t: table(spark, sf_dir, t) for t in tables_in(text)}
    return spark.sql(text.replace('"', "`"), **tables)


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return view(spark, sf_dir, FEEDS[name])


def star(spark: SparkSession, sf_dir: str, *, long: bool = False) -> Star:
    """The star over the event tables; ``long`` takes ridership from ``lineitem``, which covers seven years."""
    delays = view(spark, sf_dir, STAR["fact_delays_raw"])
    minutes = F.col("delay_duration_minutes")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation")
    return Star.of(
        sized_by={"stations": customer, "lines": nation},
        lines=view(spark, sf_dir, STAR["dim_lines"]),
        stations=view(spark, sf_dir, STAR["dim_stations"]),
        dates=date_dimension(spark, FIRST_DAY, LAST_DAY),
        times=time_dimension(spark),
        ridership=view(spark, sf_dir, STAR["fact_ridership_long" if long else "fact_ridership"]),
        delays=delays.withColumns({"delay_category": delay_category(minutes), "severity_level": delay_severity(minutes)}),
        performance=view(spark, sf_dir, STAR["fact_performance"]),
    )
