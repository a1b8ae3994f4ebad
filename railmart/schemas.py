"""Explicit schemas of landed files and star tables, as column name → Spark SQL type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Schema = dict[str, str]


def ddl(text: str) -> Schema:
    return dict(field.rsplit(" ", 1) for field in text.split(", "))


def all_text(*names: str) -> Schema:
    """Portal pages may carry every value as text; cleaning casts later."""
    return {n: "STRING" for n in names}


def read_schema(schema: Schema) -> str:
    """The form ``spark.read.schema`` takes."""
    return ", ".join(f"`{name}` {kind}" for name, kind in schema.items())


# CSV layouts written by the sample data set.
SAMPLE_STATIONS = ddl(
    "station_id STRING, station_name STRING, station_complex_id STRING, gtfs_stop_id STRING, borough STRING, "
    "latitude DOUBLE, longitude DOUBLE, structure_type STRING, ada_accessible BOOLEAN, lines_served STRING, division STRING"
)
SAMPLE_RIDERSHIP = ddl(
    "date DATE, time STRING, hour INT, station_id STRING, station_name STRING, line_name STRING, "
    "entries INT, exits INT, is_weekend BOOLEAN, is_peak_hour BOOLEAN, datetime TIMESTAMP_NTZ"
)
SAMPLE_DELAYS = ddl(
    "date DATE, time STRING, incident_datetime TIMESTAMP_NTZ, line_name STRING, station_name STRING, "
    "delay_duration_minutes INT, delay_category STRING, delay_reason STRING, severity_level STRING, "
    "passenger_impact_estimate INT, is_resolved BOOLEAN, resolution_time_minutes INT"
)
SAMPLE_PERFORMANCE = ddl(
    "date DATE, line_name STRING, scheduled_trips INT, actual_trips INT, on_time_trips INT, late_trips INT, "
    "canceled_trips INT, on_time_percentage DOUBLE, mean_distance_between_failures DOUBLE, wait_assessment DOUBLE, "
    "customer_journey_time_performance DOUBLE"
)

# JSON pages of the open-data portal.
PORTAL_STATIONS = all_text(
    "station_id", "complex_id", "gtfs_stop_id", "stop_name", "borough", "daytime_routes", "structure", "division",
    "gtfs_latitude", "gtfs_longitude", "ada", "ada_notes",
)
PORTAL_RIDERSHIP = all_text(
    "transit_timestamp", "station_complex_id", "station_complex", "station", "borough", "line", "entries", "exits",
    "ridership", "latitude", "longitude",
)
PORTAL_TURNSTILE = all_text("date", "time", "station", "line", "division", "entries", "exits")
PORTAL_PERFORMANCE = all_text(
    "period_year", "period_month", "period", "line", "on_time_percentage", "wait_assessment",
    "customer_journey_time_performance", "scheduled_trips", "actual_trips", "on_time_trips", "late_trips",
    "canceled_trips", "mean_distance_between_failures",
)
PORTAL_DELAYS = all_text(
    "start_date", "end_date", "line", "station_name", "reason", "delay_minutes", "passenger_impact_estimate",
)

# Star tables.
DIM_LINES = ddl(
    "line_id BIGINT, line_name STRING, line_color STRING, line_group STRING, route_type STRING, service_pattern STRING, "
    "created_at TIMESTAMP, updated_at TIMESTAMP"
)
DIM_STATIONS = ddl(
    "station_id BIGINT, station_name STRING, station_complex_id STRING, gtfs_stop_id STRING, borough STRING, "
    "latitude DECIMAL(10,8), longitude DECIMAL(11,8), structure_type STRING, ada_accessible BOOLEAN, ada_notes STRING, "
    "lines_served STRING, division STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
)
DIM_DATE = ddl(
    "date_key INT, full_date DATE, day_of_week INT, day_name STRING, day_of_month INT, day_of_year INT, "
    "week_of_year INT, month_number INT, month_name STRING, quarter INT, year INT, is_weekend BOOLEAN, "
    "is_holiday BOOLEAN, holiday_name STRING, fiscal_year INT, fiscal_quarter INT"
)
DIM_TIME = ddl(
    "time_key INT, full_time STRING, hour INT, minute INT, hour_12 INT, am_pm STRING, time_period STRING, "
    "is_peak_hour BOOLEAN, peak_type STRING"
)
FACT_RIDERSHIP = ddl(
    "ridership_id BIGINT, date_key INT, time_key INT, station_id BIGINT, line_id BIGINT, entries INT, exits INT, "
    "total_traffic INT, data_source STRING, created_at TIMESTAMP"
)
FACT_DAILY_RIDERSHIP = ddl(
    "daily_ridership_id BIGINT, date_key INT, station_id BIGINT, line_id BIGINT, total_entries BIGINT, "
    "total_exits BIGINT, peak_hour_entries BIGINT, off_peak_entries BIGINT, avg_entries_per_hour DECIMAL(20,2), "
    "data_source STRING, created_at TIMESTAMP"
)
FACT_DELAYS = ddl(
    "delay_id BIGINT, date_key INT, time_key INT, line_id BIGINT, station_id BIGINT, delay_duration_minutes INT, "
    "delay_category STRING, delay_reason STRING, affected_services STRING, is_resolved BOOLEAN, "
    "resolution_time_minutes INT, passenger_impact_estimate INT, severity_level STRING, created_at TIMESTAMP"
)
FACT_PERFORMANCE = ddl(
    "performance_id BIGINT, date_key INT, line_id BIGINT, scheduled_trips INT, actual_trips INT, on_time_trips INT, "
    "late_trips INT, canceled_trips INT, on_time_percentage DECIMAL(5,2), "
    "mean_distance_between_failures DECIMAL(10,2), wait_assessment DECIMAL(5,2), "
    "customer_journey_time_performance DECIMAL(5,2), created_at TIMESTAMP"
)
FACT_SERVICE_ALERTS = ddl(
    "alert_id BIGINT, date_key INT, start_time TIMESTAMP, end_time TIMESTAMP, line_id BIGINT, alert_type STRING, "
    "header_text STRING, description_text STRING, affected_stations ARRAY<STRING>, is_planned BOOLEAN, cause STRING, "
    "effect STRING, created_at TIMESTAMP"
)
QUARANTINE = ddl("dataset STRING, raw_data STRING, processed BOOLEAN, error_message STRING, created_at TIMESTAMP")
ETL_LOG = ddl(
    "job_name STRING, job_type STRING, start_time TIMESTAMP, end_time TIMESTAMP, status STRING, "
    "records_processed BIGINT, records_inserted BIGINT, records_updated BIGINT, records_failed BIGINT, "
    "error_message STRING, execution_details STRING"
)

STAR_TABLES = {
    "dim_subway_lines": DIM_LINES,
    "dim_stations": DIM_STATIONS,
    "dim_date": DIM_DATE,
    "dim_time": DIM_TIME,
    "fact_ridership": FACT_RIDERSHIP,
    "fact_daily_ridership": FACT_DAILY_RIDERSHIP,
    "fact_delays": FACT_DELAYS,
    "fact_performance": FACT_PERFORMANCE,
    "fact_service_alerts": FACT_SERVICE_ALERTS,
    "etl_log": ETL_LOG,
}


def conform(df: DataFrame, schema: Schema) -> DataFrame:
    """Select and cast ``df`` to a schema; columns it lacks become NULL."""
    have = set(df.columns)
    return df.select(*[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in schema.items()])
