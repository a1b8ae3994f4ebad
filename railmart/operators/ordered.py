"""Ranks, exact medians and positions over sets of any size.

A window without partitions puts its whole input in one task. Here values are first reduced to one row per distinct
value and then sorted by sample: splitters taken from the data cut them into ordered buckets of about equal numbers of
values, wherever the values lie. The bucket totals (BUCKETS at most per group) are accumulated in one small window, and
each bucket is ordered on its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railmart.operators.lookup import hot_keys, lookup
from railmart.sources.sinks import stored

BUCKETS = 256
STRIDE = 16
SAMPLE = 4096


def splitters(values: DataFrame, value: str) -> DataFrame:
    """One row with the ordered splitters of a column, fewer than BUCKETS: about SAMPLE values, drawn by hash, thinned out.

    The draw depends on the values alone, so every evaluation, also one repeated by another executor, gives the same.
    """
    rows = values.agg(F.count(F.lit(1))).scalar()
    drawn = values.filter(F.pmod(F.xxhash64(value), F.lit(1 << 30)) * rows < F.lit(SAMPLE << 30))
    found = drawn.agg(F.array_sort(F.collect_set(value)).alias("_all"))
    return found.select(F.expr(f"filter(_all, (x, i) -> i % (1 + size(_all) div {BUCKETS}) = 0)").alias("_splitters"))


def bucket(v: Column, of: Column) -> Column:
    """How many splitters are not above the value, found in two steps; larger values never land in a smaller bucket."""
    coarse = F.filter(of, lambda x, i: (i % STRIDE == STRIDE - 1) & (x <= v))
    fine = F.filter(F.slice(of, F.size(coarse) * STRIDE + 1, F.lit(STRIDE)), lambda x: x <= v)
    return F.when(v.isNotNull(), F.size(coarse) * STRIDE + F.size(fine))


def running_counts(values: DataFrame, value: str, n: str, by: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """For distinct ``value`` rows with a count ``n``: ``before`` = how many rows of the group sort ahead of it."""
    by = list(by)
    cut = values.withColumn("_splitters", splitters(values, value).scalar())
    cut = cut.withColumn("_bucket", bucket(F.col(value), F.col("_splitters"))).drop("_splitters")

    def order(name: str) -> Column:
        return F.col(name).desc_nulls_first() if descending else F.col(name).asc_nulls_last()

    ahead = Window.partitionBy(*by).orderBy(order("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*by, "_bucket").orderBy(order(value)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*by, "_bucket").agg(F.sum(n).alias("_in_bucket")).withColumn("_ahead", F.sum("_in_bucket").over(ahead))
    )
    keys = [*by, "_bucket"]
    left = cut.withColumn("_inside", F.sum(n).over(inside)).alias("l")
    right = offsets.select(*keys, "_ahead").alias("r")
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    return left.join(right, same).select(
        *[F.col(f"l.{c}") for c in values.columns],
        (F.coalesce("l._inside", F.lit(0)) + F.coalesce("r._ahead", F.lit(0))).alias("before"),
    )


def rank_table(df: DataFrame, value: str, alias: str, by: Sequence[str] = (), nulls: str = "first") -> DataFrame:
    """Rank of every distinct value: ``_rank_key`` (group and value), the rank and how many rows share it."""
    by = list(by)
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    if nulls == "first":
        ranks = running_counts(counts, value, "_n", by, descending=True)
    else:
        present = running_counts(counts.filter(F.col(value).isNotNull()), value, "_n", by, descending=True)
        known = F.coalesce(F.sum(F.when(F.col(value).isNotNull(), F.col("_n"))), F.lit(0))
        ahead = counts.groupBy(*by).agg(known.alias("before"))
        ranks = present.unionByName(with_group_value(counts.filter(F.col(value).isNull()), ahead, "before", by))
    return ranks.select(F.struct(*by, value).alias("_rank_key"), (F.col("before") + 1).cast("int").alias(alias), "_n")


def with_group_value(df: DataFrame, per_group: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Add a column of a one-row-per-group frame; NULL groups match."""
    if not by:
        return df.withColumn(column, per_group.select(column).scalar())
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in by]
    return df.alias("l").join(per_group.alias("r"), same).select("l.*", f"r.{column}")


def rank_desc(
    df: DataFrame,
    value: str,
    ranks: Mapping[str, Sequence[str]],
    *,
    row_id: str,
    nulls: str = "first",
    one_task: bool = False,
) -> DataFrame:
    """RANK by ``value`` descending, gaps kept: one column per entry of ``ranks``, alias → columns to rank within.

    ``nulls='first'`` ranks missing values 1, ``'last'`` ranks them last. ``one_task`` allows a plain window where
    the number of rows is known to be small.
    """
    out = df
    for alias, by in ranks.items():
        if one_task:
            ordering = F.col(value).desc_nulls_first() if nulls == "first" else F.col(value).desc_nulls_last()
            out = out.withColumn(alias, F.rank().over(Window.partitionBy(*by).orderBy(ordering)))
            continue
        table = rank_table(df, value, alias, by, nulls)
        out = lookup(
            out.withColumn("_rank_key", F.struct(*by, value)),
            table.select("_rank_key", alias),
            "_rank_key",
            small=False,
            spread_by=row_id,
            hot=hot_keys(table, "_rank_key", "_n"),
        ).drop("_rank_key")
    return out


def median_of_counts(counts: DataFrame, value: str, n: str, alias: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact continuous median per group from distinct non-null values and their counts."""
    by = list(by)
    totals = counts.groupBy(*by).agg(F.sum(n).alias("_total"))
    placed = with_group_value(running_counts(counts, value, n, by), totals, "_total", by)

    def covers(position: Column) -> Column:
        return (F.col("before") <= position) & (position < F.col("before") + F.col(n))

    low = F.floor((F.col("_total") - 1) / 2)
    high = F.floor(F.col("_total") / 2)
    middle = placed.filter(covers(low) | covers(high))
    out = ((F.min(value).cast("double") + F.max(value).cast("double")) / 2).alias(alias)
    return middle.groupBy(*by).agg(out) if by else middle.agg(out)


def median(df: DataFrame, value: str, alias: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact continuous median of the non-null values per group; groups without values are absent."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    return median_of_counts(counts, value, "_n", alias, by)


def with_positions(df: DataFrame, order: Sequence[Column], alias: str = "position") -> DataFrame:
    """Every row with its place in a total order, from 1, so that a sorted result keeps its order wherever it is stored.

    Rows are sorted once, by ranges over all tasks, and written with their place inside their range; the lengths of the ranges, one row for
    each task, give the offsets. Rows that are equal in ``order`` get consecutive places in no stated order.
    """
    placed = stored(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "positions")
    marked = placed.withColumn("_range", F.shiftrightunsigned("_at", 33))
    lengths = marked.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lengths.select("_range", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return marked.join(F.broadcast(offsets), "_range").select(*df.columns, (F.col("_ahead") + inside + 1).alias(alias))
