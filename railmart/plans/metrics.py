"""Measures that work in any grouping and filter, and the visual queries built on them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmart.functions.bins import performance_band
from railmart.functions.numbers import divide_or_zero, ratio
from railmart.operators import windows
from railmart.operators.dims import DAY_NAMES
from railmart.plans.marts import exact, optional
from railmart.plans.star import ROW_IDS, Star
from railmart.sources.sinks import stored

OTP_TARGET = 85

DIM_COLUMNS = {
    "dates": (
        "full_date", "day_name", "day_of_week", "day_of_month", "day_of_year", "week_of_year", "month_number",
        "month_name", "quarter", "year", "is_weekend", "is_holiday", "fiscal_year", "fiscal_quarter",
    ),
    "times": ("hour", "minute", "hour_12", "am_pm", "time_period", "is_peak_hour", "peak_type"),
    "lines": ("line_name", "line_color", "line_group", "service_pattern"),
    "stations": ("station_name", "borough", "latitude", "longitude", "lines_served", "ada_accessible"),
}
FACT_DIMS = {
    "ridership": ("dates", "times", "lines", "stations"),
    "delays": ("dates", "times", "lines", "stations"),
    "performance": ("dates", "lines"),
}
GRAINS = {
    "year": ["year"],
    "quarter": ["year", "quarter"],
    "month": ["year", "quarter", "month_number"],
    "day": ["year", "quarter", "month_number", "full_date"],
}


@dataclass(frozen=True)
class Slice:
    """Dashboard slicers; what is not set does not filter."""

    start: dt.date | str | None = None
    end: dt.date | str | None = None
    boroughs: Sequence[str] = ()
    lines: Sequence[str] = ()
    time_periods: Sequence[str] = ()
    weekend: bool | None = None
    severities: Sequence[str] = ()

    def conditions(self, available: Iterable[str]) -> dict[str, Column]:
        """Filter per column. A slicer whose column the fact cannot reach does not apply to it."""
        out: dict[str, Column] = {}
        if self.start is not None:
            out["full_date"] = F.col("full_date") >= F.lit(str(self.start)).cast("date")
        if self.end is not None:
            last = F.col("full_date") <= F.lit(str(self.end)).cast("date")
            out["full_date"] = out["full_date"] & last if "full_date" in out else last
        lists = {
            "borough": self.boroughs,
            "line_name": self.lines,
            "time_period": self.time_periods,
            "severity_level": self.severities,
        }
        out.update({c: F.col(c).isin(list(values)) for c, values in lists.items() if values})
        if self.weekend is not None:
            out["is_weekend"] = F.col("is_weekend") == F.lit(self.weekend)
        available = set(available)
        return {c: cond for c, cond in out.items() if c in available}


ALL = Slice()


@dataclass(frozen=True)
class Part:
    """A value per fact row whose sum a measure is made of, and the dimension columns it looks at."""

    value: Callable[[], Column]
    needs: tuple[str, ...] = ()


def when_true(condition: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.when(condition(), 1).otherwise(0)


def counted(column: str) -> Callable[[], Column]:
    return when_true(lambda: F.col(column).isNotNull())


def entries_when(condition: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.when(condition(), F.col("entries"))


PARTS: dict[str, Part] = {
    "entries": Part(lambda: F.col("entries")),
    "exits": Part(lambda: F.col("exits")),
    "traffic": Part(lambda: F.col("total_traffic")),
    "peak_entries": Part(entries_when(lambda: F.col("is_peak_hour")), ("is_peak_hour",)),
    "morning_entries": Part(entries_when(lambda: F.col("peak_type") == "Morning"), ("peak_type",)),
    "evening_entries": Part(entries_when(lambda: F.col("peak_type") == "Evening"), ("peak_type",)),
    "delays": Part(counted("delay_id")),
    "minutes": Part(lambda: F.col("delay_duration_minutes")),
    "timed": Part(counted("delay_duration_minutes")),
    "severe": Part(when_true(lambda: F.col("severity_level") == "High")),
    "peak_delays": Part(when_true(lambda: F.col("is_peak_hour")), ("is_peak_hour",)),
    "affected": Part(lambda: F.col("passenger_impact_estimate")),
    "resolution": Part(lambda: F.col("resolution_time_minutes")),
    "resolved": Part(counted("resolution_time_minutes")),
    "on_time": Part(lambda: F.col("on_time_trips")),
    "scheduled": Part(lambda: F.col("scheduled_trips")),
    "otp": Part(lambda: exact("on_time_percentage")),
    "rated": Part(counted("on_time_percentage")),
}


@dataclass(frozen=True)
class Measure:
    """A measure of one fact: the parts it sums and the expression over those sums.

    Sums of sums are the same sums, so the rows may be reduced by any finer key first. ``distinct`` names fact keys
    the measure counts; a first reduction keeps them.
    """

    fact: str
    parts: tuple[str, ...]
    column: Callable[[], Column]
    distinct: tuple[str, ...] = ()


def part_sum(part: str) -> Column:
    return F.sum(f"_{part}")


def part_count(part: str) -> Column:
    return F.coalesce(part_sum(part), F.lit(0))


def otp_rate() -> Column:
    return divide_or_zero(part_sum("on_time"), part_sum("scheduled")) * 100


def rides(part: str) -> Measure:
    return Measure("ridership", (part,), lambda: part_sum(part))


def delay_count(part: str) -> Measure:
    return Measure("delays", (part,), lambda: part_count(part))


TRIPS = ("on_time", "scheduled")

MEASURES: dict[str, Measure] = {
    "total_ridership": Measure("ridership", ("entries", "exits"), lambda: part_sum("entries") + part_sum("exits")),
    "total_entries": rides("entries"),
    "total_exits": rides("exits"),
    "total_traffic": rides("traffic"),
    "active_stations": Measure("ridership", (), lambda: F.countDistinct("station_id"), ("station_id",)),
    "peak_hour_ridership": rides("peak_entries"),
    "peak_hour_pct": Measure(
        "ridership",
        ("peak_entries", "entries"),
        lambda: divide_or_zero(part_sum("peak_entries"), part_sum("entries")) * 100,
    ),
    "morning_rush_riders": rides("morning_entries"),
    "evening_rush_riders": rides("evening_entries"),
    "total_delays": delay_count("delays"),
    "avg_delay_minutes": Measure("delays", ("minutes", "timed"), lambda: ratio(part_sum("minutes"), part_sum("timed"))),
    "severe_delays": delay_count("severe"),
    "peak_hour_delays": delay_count("peak_delays"),
    "passengers_affected": Measure("delays", ("affected",), lambda: part_sum("affected")),
    "avg_resolution_minutes": Measure(
        "delays", ("resolution", "resolved"), lambda: ratio(part_sum("resolution"), part_sum("resolved"))
    ),
    "otp_rate": Measure("performance", TRIPS, otp_rate),
    "otp_vs_target": Measure("performance", TRIPS, lambda: otp_rate() - OTP_TARGET),
    "otp_status": Measure("performance", TRIPS, lambda: performance_band(otp_rate())),
    "avg_otp": Measure("performance", ("otp", "rated"), lambda: ratio(part_sum("otp"), part_sum("rated"))),
}


def fact_rows(star: Star, fact: str, columns: Iterable[str], where: Slice = ALL) -> DataFrame:
    """Fact rows with just the dimension columns asked for, filtered by the slicers that reach the fact.

    Only dimensions in use are joined. All relationships are many-to-one and keep rows without a match.
    """
    rows = in_days(getattr(star, fact), where.start, where.end)
    if fact == "delays":
        rows = optional(rows, {"resolution_time_minutes": "int"})
    reach = {c: d for d in FACT_DIMS[fact] for c in DIM_COLUMNS[d]}
    conditions = where.conditions([*reach, *rows.columns])
    wanted = dict.fromkeys([*columns, *conditions])
    unknown = [c for c in wanted if c not in reach and c not in rows.columns]
    if unknown:
        raise ValueError(f"{fact} has no column {', '.join(unknown)}")
    for dim in FACT_DIMS[fact]:
        extra = [c for c in wanted if reach.get(c) == dim and c not in rows.columns]
        if extra:
            rows = star.attach(rows, dim, extra, spread_by=ROW_IDS.get(fact))
    for condition in conditions.values():
        rows = rows.filter(condition)
    return rows


def in_days(rows: DataFrame, start: dt.date | str | None, end: dt.date | str | None) -> DataFrame:
    """Cut fact rows by their own date key, so the bound reaches the scan and prunes its partitions."""
    if start is not None:
        rows = rows.filter(F.col("date_key") >= int(str(start).replace("-", "")))
    if end is not None:
        rows = rows.filter(F.col("date_key") <= int(str(end).replace("-", "")))
    return rows


def fact_measures(star: Star, fact: str, names: Sequence[str], by: Sequence[str], where: Slice) -> DataFrame:
    """Measures of one fact. With a large station table the rows are summed per station id before they meet it."""
    own = [MEASURES[n] for n in names]
    parts = list(dict.fromkeys(p for m in own for p in m.parts))
    distinct = list(dict.fromkeys(c for m in own for c in m.distinct))
    needs = [c for p in parts for c in PARTS[p].needs]
    values = {f"_{p}": PARTS[p].value() for p in parts}
    final = [MEASURES[n].column().alias(n) for n in names]

    def grouped(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*by).agg(*final) if by else rows.agg(*final)

    station = [c for c in by if c in DIM_COLUMNS["stations"]]
    late = where.boroughs and "stations" in FACT_DIMS[fact]
    if "stations" in star.small or not (station or late) or "stations" not in FACT_DIMS[fact]:
        return grouped(fact_rows(star, fact, [*by, *needs], where).withColumns(values))

    early = [c for c in by if c not in station]
    rows = fact_rows(star, fact, [*early, *needs], replace(where, boroughs=())).withColumns(values)
    keys = list(dict.fromkeys([*early, "station_id", *distinct]))
    sums = [F.sum(v).alias(v) for v in values] or [F.count(F.lit(1)).alias("_rows")]
    columns = list(dict.fromkeys([*station, *(["borough"] if late else [])]))
    rows = star.attach(rows.groupBy(*keys).agg(*sums), "stations", columns)
    return grouped(rows.filter(F.col("borough").isin(list(where.boroughs))) if late else rows)


def measure(star: Star, names: Sequence[str], by: Sequence[str] = (), where: Slice = ALL) -> DataFrame:
    """The named measures by any dimension columns.

    Measures of different facts meet on the group: each fact is aggregated on its own, the small results are stacked
    and folded into one row per group, so NULL groups line up and no facts are joined.
    """
    by = list(by)
    per_fact: dict[str, list[str]] = {}
    for name in names:
        per_fact.setdefault(MEASURES[name].fact, []).append(name)
    results = [fact_measures(star, fact, own, by, where) for fact, own in per_fact.items()]
    if len(results) == 1:
        return results[0].select(*by, *names)
    stacked = results[0]
    for result in results[1:]:
        stacked = stacked.unionByName(result, allowMissingColumns=True)
    folded = [F.max(n).alias(n) for n in names]
    return stacked.groupBy(*by).agg(*folded) if by else stacked.agg(*folded)


# --- Daily series -----------------------------------------------------------------------------------------------


def daily_entries(star: Star, by: Sequence[str] = (), where: Slice = ALL) -> DataFrame:
    """Entries per day, on days with ridership only."""
    days = measure(star, ["total_entries"], [*by, "full_date"], where).filter(F.col("full_date").isNotNull())
    return days.withColumnRenamed("total_entries", "entries")


def avg_daily_ridership(star: Star, by: Sequence[str] = (), where: Slice = ALL) -> DataFrame:
    """Mean of the daily sums."""
    days = daily_entries(star, by, where)
    mean = ratio(F.sum("entries"), F.count("entries")).alias("avg_daily_ridership")
    return days.groupBy(*by).agg(mean) if by else days.agg(mean)


def rolling_seven_days(star: Star, by: Sequence[str] = (), where: Slice = ALL) -> DataFrame:
    return windows.rolling_mean(daily_entries(star, by, where), "entries", "full_date", 7, "rolling_7day_avg", by)


def year_to_date(star: Star, by: Sequence[str] = (), where: Slice = ALL) -> DataFrame:
    return windows.year_to_date(daily_entries(star, by, where), "entries", "full_date", "ytd_entries", by)


def monthly_entries(star: Star, by: Sequence[str] = (), where: Slice = ALL) -> DataFrame:
    days = daily_entries(star, by, where)
    return days.groupBy(*by, F.trunc("full_date", "month").alias("month")).agg(F.sum("entries").alias("entries"))


def month_over_month(star: Star, by: Sequence[str] = (), where: Slice = ALL) -> DataFrame:
    """Percent change from the calendar month before; 0 where that month is missing."""
    return windows.change_from_month(monthly_entries(star, by, where), "entries", "month", 1, by)


def year_over_year(star: Star, by: Sequence[str] = (), where: Slice = ALL) -> DataFrame:
    return windows.change_from_month(monthly_entries(star, by, where), "entries", "month", 12, by)


def entries_trend(star: Star, by: Sequence[str] = (), where: Slice = ALL) -> DataFrame:
    return windows.trend_line(daily_entries(star, by, where), "entries", "full_date", by)


# --- Visuals ----------------------------------------------------------------------------------------------------


def delays_by_line_and_severity(star: Star, where: Slice = ALL) -> DataFrame:
    by = ["line_name", "line_color", "severity_level"]
    counts = measure(star, ["total_delays", "avg_delay_minutes"], by, where)
    return counts.orderBy(F.col("total_delays").desc(), *by)


def ridership_trend(star: Star, grain: str = "month", by: Sequence[str] = (), where: Slice = ALL) -> DataFrame:
    """Entries per year, quarter, month or day with the mean of the shown points as reference line."""
    series = measure(star, ["total_entries"], [*GRAINS[grain], *by], where)
    total = series.agg(ratio(F.sum("total_entries"), F.count("total_entries"))).scalar()
    return series.withColumn("average_line", total)


def station_map(star: Star, where: Slice = ALL) -> DataFrame:
    """Traffic per station with its position: summed per station id first."""
    conditions = where.conditions(["full_date", "borough", "line_name", "time_period", "is_weekend"])
    plain = [c for c in conditions if c != "borough"]
    rows = fact_rows(star, "ridership", plain, Slice(**{**vars(where), "boroughs": ()}))
    about = ["station_name", "borough", "latitude", "longitude"]
    parts = star.attach_station(rows, [], about, {"traffic": F.sum("total_traffic")})
    out = parts.groupBy(*about).agg(F.sum("traffic").alias("total_traffic"))
    return out.filter(conditions["borough"]) if "borough" in conditions else out


def borough_by_weekday(star: Star, where: Slice = ALL) -> DataFrame:
    """One row per borough, one column per weekday. The names are fixed, so no pass collects them."""
    cells = measure(star, ["total_entries"], ["borough", "day_name"], where)
    return cells.groupBy("borough").pivot("day_name", DAY_NAMES).agg(F.sum("total_entries"))


def kpi_cards(star: Star, where: Slice = ALL) -> DataFrame:
    """Totals of the KPI page and the gauge against its target."""
    cards = measure(star, ["total_entries", "avg_otp", "total_delays", "active_stations"], (), where)
    return cards.withColumns(
        {"otp_target": F.lit(float(OTP_TARGET)), "otp_gap": F.col("avg_otp") - OTP_TARGET}
    )


def ridership_by_hour(star: Star, where: Slice = ALL) -> DataFrame:
    return measure(star, ["total_entries"], ["hour", "time_period"], where)


def delay_scatter(star: Star, where: Slice = ALL) -> DataFrame:
    """Points of duration against passenger impact, per line and day."""
    rows = fact_rows(star, "delays", ["line_name", "full_date"], where)
    return rows.groupBy("full_date", "line_name", "delay_duration_minutes").agg(
        F.sum("passenger_impact_estimate").alias("passenger_impact"), F.count("delay_id").alias("delay_count")
    )


def line_delay_profile(star: Star, where: Slice = ALL) -> DataFrame:
    """Mean duration, impact and number of delays per line."""
    return measure(star, ["avg_delay_minutes", "passengers_affected", "total_delays"], ["line_name"], where)


def cluster_points(star: Star, per: str = "line", where: Slice = ALL) -> tuple[DataFrame, list[str]]:
    """The points to cluster, without those that have gaps, and their feature columns."""
    if per == "line":
        points, features = line_delay_profile(star, where), ["avg_delay_minutes", "passengers_affected", "total_delays"]
    else:
        points = delay_scatter(star, where)
        features = ["delay_duration_minutes", "passenger_impact", "delay_count"]
    return points.na.drop(subset=features), features


def delay_clusters(
    star: Star, k: int = 3, per: str = "line", where: Slice = ALL, tolerance: float = 1e-9, most_rounds: int = 1_000
) -> DataFrame:
    """K-means over lines or scatter points on standardised features; adds ``cluster``, numbered by the first feature of the centres.

    The start is fixed: points are cut into ``k`` equal bands by the sum of their features, and band means are the first
    centres. Equal distances go to the lower number. Every round is one aggregate over the points; only the ``k`` centres
    return to the driver. Centres that still move after ``most_rounds`` are an error.
    """
    points, features = cluster_points(star, per, where)
    points = stored(points, "cluster_points")
    about = points.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("d")).alias(c) for c in features]).first()
    z = {c: (F.col(c).cast("double") - F.lit(about[c].m)) / F.lit(about[c].d or 1.0) for c in features if about[c].m is not None}
    if not z:
        return points.withColumn("cluster", F.lit(None).cast("int"))
    total = sum(z.values(), F.lit(0.0))
    cuts = points.agg(F.percentile_approx(total, [i / k for i in range(1, k)], 10_000)).first()[0]
    label = sum((F.when(total > F.lit(cut), 1).otherwise(0) for cut in cuts), F.lit(0))

    def nearest(centres: list[tuple[float, ...]]) -> Column:
        apart = [F.struct(sum(((v - F.lit(x)) ** 2 for v, x in zip(z.values(), c, strict=True)), F.lit(0.0)), F.lit(i)) for i, c in enumerate(centres)]
        return F.array_min(F.array(*apart)).getField("col2")

    centres: list[tuple[float, ...]] = []
    for _ in range(most_rounds):
        means = points.groupBy(label.alias("cluster")).agg(*[F.avg(v).alias(c) for c, v in z.items()]).collect()
        new = sorted(tuple(r[c] for c in z) for r in means)
        if len(new) == len(centres) and all(abs(x - y) <= tolerance for a, b in zip(new, centres, strict=True) for x, y in zip(a, b, strict=True)):
            return points.withColumn("cluster", label.cast("int"))
        centres, label = new, nearest(new)
    raise ValueError(f"centres still move after {most_rounds} rounds")


def cluster_checks(star: Star, k: int = 3, per: str = "line", where: Slice = ALL) -> DataFrame:
    """How many points there are, how many do not lie nearest to their own cluster's mean, and how many have no cluster."""
    _, features = cluster_points(star, per, where)
    points = stored(delay_clusters(star, k, per, where), "clusters")
    spread = points.agg(*[F.coalesce(F.nullif(F.stddev_samp(c), F.lit(0.0)), F.lit(1.0)).alias(f"_{c}") for c in features])
    means = points.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in features])
    centres = means.agg(F.sort_array(F.collect_list(F.struct("cluster", *features))).alias("_centres"))
    near = points
    for frame, columns in ((spread, [f"_{c}" for c in features]), (centres, ["_centres"])):
        near = near.withColumns({c: frame.select(c).scalar() for c in columns})

    def apart(c: Column) -> Column:
        return sum((((F.col(f) - c[f]) / F.col(f"_{f}")) ** 2 for f in features), F.lit(0.0))

    own = F.element_at(F.filter("_centres", lambda c: c["cluster"] == F.col("cluster")), 1)
    least = F.array_min(F.transform("_centres", apart))
    return near.agg(
        F.count(F.lit(1)).alias("points"),
        F.count_if(apart(own) > least + 1e-6).alias("misplaced"),
        F.count_if(F.col("cluster").isNull()).alias("unplaced"),
    )
