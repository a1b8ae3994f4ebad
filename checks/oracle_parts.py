"""Common table expressions the oracle texts build on."""

from __future__ import annotations

import re

from railmart.adapters import FEEDS, STAR

PLAIN = re.compile(r"\{(\w+)\}")


def plain(text: str) -> str:
    return PLAIN.sub(r"\1", text)


DIM_DATE = """
SELECT CAST(year(d)*10000+month(d)*100+day(d) AS INT) AS date_key, CAST(d AS DATE) AS full_date,
  CAST(dayofweek(d) AS INT) AS day_of_week, dayname(d) AS day_name, CAST(day(d) AS INT) AS day_of_month,
  CAST(dayofyear(d) AS INT) AS day_of_year, CAST(weekofyear(d) AS INT) AS week_of_year,
  CAST(month(d) AS INT) AS month_number, monthname(d) AS month_name, CAST(quarter(d) AS INT) AS quarter,
  CAST(year(d) AS INT) AS year, dayofweek(d) IN (0, 6) AS is_weekend, FALSE AS is_holiday,
  CAST(NULL AS VARCHAR) AS holiday_name,
  CAST(CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS INT) AS fiscal_year,
  CAST(CASE WHEN month(d) IN (7, 8, 9) THEN 1 WHEN month(d) IN (10, 11, 12) THEN 2 WHEN month(d) IN (1, 2, 3) THEN 3 ELSE 4 END AS INT) AS fiscal_quarter
FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2024-12-31', INTERVAL 1 DAY)) AS d)"""

DIM_TIME = """
SELECT CAST(h*100+m AS INT) AS time_key, concat(lpad(CAST(h AS VARCHAR),2,'0'), ':', lpad(CAST(m AS VARCHAR),2,'0'), ':00') AS full_time,
  CAST(h AS INT) AS hour, CAST(m AS INT) AS minute,
  CAST(CASE WHEN h = 0 THEN 12 WHEN h > 12 THEN h - 12 ELSE h END AS INT) AS hour_12,
  CASE WHEN h < 12 THEN 'AM' ELSE 'PM' END AS am_pm,
  CASE WHEN h BETWEEN 7 AND 9 THEN 'Morning Rush' WHEN h BETWEEN 10 AND 15 THEN 'Midday'
    WHEN h BETWEEN 16 AND 19 THEN 'Evening Rush' WHEN h BETWEEN 20 AND 23 THEN 'Night' ELSE 'Late Night' END AS time_period,
  (h BETWEEN 7 AND 9) OR (h BETWEEN 16 AND 19) AS is_peak_hour,
  CASE WHEN h BETWEEN 7 AND 9 THEN 'Morning' WHEN h BETWEEN 16 AND 19 THEN 'Evening' END AS peak_type
FROM (SELECT i // 60 AS h, i % 60 AS m FROM range(1440) t(i))"""

FACT_DELAYS = """
SELECT *, CASE WHEN delay_duration_minutes <= 0 THEN NULL WHEN delay_duration_minutes <= 5 THEN 'Minor'
    WHEN delay_duration_minutes <= 15 THEN 'Moderate' WHEN delay_duration_minutes <= 30 THEN 'Significant'
    WHEN delay_duration_minutes <= 60 THEN 'Major' WHEN delay_duration_minutes > 60 THEN 'Severe' END AS delay_category,
  CASE WHEN delay_duration_minutes <= 0 THEN NULL WHEN delay_duration_minutes <= 10 THEN 'Low'
    WHEN delay_duration_minutes <= 30 THEN 'Medium' WHEN delay_duration_minutes > 30 THEN 'High' END AS severity_level
FROM fact_delays_raw"""

PARTS = {
    **{name: plain(text) for name, text in STAR.items()},
    "dim_date": DIM_DATE,
    "dim_time": DIM_TIME,
    "fact_delays": FACT_DELAYS,
    **{f"feed_{name}": plain(text) for name, text in FEEDS.items()},
}


def with_parts(query: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``query`` with the table expressions it names, directly or through others."""
    parts = {**PARTS, **(extra or {})}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in parts:
            if name not in order and re.search(rf"\b{name}\b", text):
                visit(parts[name])
                if name not in order:
                    order.append(name)

    visit(query)
    if not order:
        return query
    head = "WITH " + ",\n".join(f"{n} AS ({parts[n]})" for n in order)
    body = query.lstrip()
    return f"{head},\n{body[5:]}" if body.startswith("WITH ") else f"{head}\n{body}"


def half_up(num: str, den: str, scale: int, times: int = 1) -> str:
    """num / den * times rounded half away from zero in whole-number arithmetic, as a double."""
    k = times * 10**scale
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    rounded = f"(2 * {k} * abs({n}) + {d}) // (2 * {d})"
    return f"CASE WHEN ({den}) > 0 THEN sign({n}) * CAST({rounded} AS DOUBLE) / {10**scale}.0 END"
