"""Joining rows to a dimension that holds each key once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 * 1024 * 1024
HOT_SHARE = 0.001
# Keys that a sketch of frequent keys follows; its counts are off by less than a fifth of HOT_SHARE.
TRACKED = 20_000


def plan_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a plan; for file scans it is the size on disk of the columns read."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the estimate is known and small. A remote client does not see it, so nothing counts as small there."""
    return hasattr(df, "_jdf") and plan_bytes(df) <= limit


def unique_by(dim: DataFrame, key: str, order_by: str) -> DataFrame:
    """One row per key, the one with the smallest ``order_by``."""
    return dim.groupBy(key).agg(F.min_by(F.struct(*dim.columns), F.col(order_by)).alias("_row")).select("_row.*")


def hot_keys(counts: DataFrame, key: str, n: str) -> DataFrame:
    """Keys with more than ``HOT_SHARE`` of all rows. There can be no more than ``1 / HOT_SHARE`` of them."""
    return counts.filter(F.col(n) > counts.agg(F.sum(n)).scalar() * F.lit(HOT_SHARE)).select(key)


def frequent_keys(rows: DataFrame, keys: Sequence[str]) -> dict[str, DataFrame]:
    """For each of several key columns the keys with more than about ``HOT_SHARE`` of all rows, from one pass over ``rows``.

    Counts come from a sketch, so a key near the limit may be in or out. Nothing may depend on it but where rows go.
    """
    tops = [F.call_function("approx_top_k", F.col(k), F.lit(int(1 / HOT_SHARE)), F.lit(TRACKED)).alias(f"_{i}") for i, k in enumerate(keys)]
    found = rows.agg(F.struct(F.count(F.lit(1)).alias("_rows"), *tops).alias("_tops")).scalar()
    one = rows.sparkSession.range(1).select(found.alias("_tops"))
    out = {}
    for i, k in enumerate(keys):
        top = one.select(F.explode(F.col(f"_tops._{i}")).alias("_top"), (F.col("_tops._rows") * HOT_SHARE).alias("_least"))
        out[k] = top.filter((F.col("_top.count") > F.col("_least")) & F.col("_top.item").isNotNull()).select(F.col("_top.item").alias(k))
    return out


def lookup(
    rows: DataFrame,
    dim: DataFrame,
    key: str,
    *,
    small: bool,
    how: str = "left",
    spread_by: str | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` to ``dim`` on ``key``; ``how`` is ``left`` or ``inner``.

    ``small`` says that the size of ``dim`` was checked: it is then broadcast and ``rows`` stay where they are.
    A large ``dim`` is joined by a shuffle. Rows already grouped by the key shuffle evenly as they are. Raw rows
    pass ``spread_by``, an id that differs from row to row: keys with more than ``HOT_SHARE`` of all rows (so at
    most ``1 / HOT_SHARE`` of them) get their dimension row by broadcast, and they and NULL keys are spread over
    all tasks instead of meeting in one. ``hot`` hands in those keys where the caller has counted already; which keys
    it names decides only how rows travel, never the result.
    """
    if small:
        return rows.join(F.broadcast(dim), key, how)
    if spread_by is None:
        return rows.join(dim, key, how)

    extra = [c for c in dim.columns if c != key]
    packed = dim.select(F.col(key).alias("_key"), F.struct(F.lit(True).alias("_hit"), *extra).alias("_dim"))
    if hot is None:
        hot = frequent_keys(rows, [key])[key]
    hot_dim = packed.join(F.broadcast(hot), F.col("_key") == F.col(key), "left_semi").select(
        F.col("_key").alias(key), F.col("_dim").alias("_hot")
    )
    marked = rows.join(F.broadcast(hot_dim), key, "left")
    parked = F.col("_hot").isNotNull() | F.col(key).isNull()
    # Rows meet their dimension row by key and by a hash of the key; parked rows have no key left and a hash of their own.
    marked = marked.withColumns(
        {"_key": F.when(~parked, F.col(key)), "_slot": F.when(parked, F.xxhash64(F.lit(1), spread_by)).otherwise(F.xxhash64(key))}
    )
    packed = packed.withColumn("_slot", F.xxhash64("_key"))
    joined = marked.join(packed, ["_key", "_slot"], "left").withColumn("_dim", F.coalesce("_hot", "_dim"))
    if how == "inner":
        joined = joined.filter(F.col("_dim").isNotNull())
    return joined.select(*rows.columns, *[F.col("_dim").getField(c).alias(c) for c in extra])
