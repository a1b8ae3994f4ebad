from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from railmart.operators.lookup import frequent_keys, lookup
from railmart.operators.ordered import bucket, median, rank_desc, splitters
from tests.helpers import bag, final_plan, planned


@pytest.fixture(scope="module")
def scores(spark):
    rng = random.Random(3)
    data = []
    for i in range(600):
        v = rng.choice([None, 500, 500, 500, rng.randrange(0, 40), rng.randrange(0, 10**12)])
        data.append((i, rng.choice(["a", "b", None]), v))
    return spark.createDataFrame(data, "id BIGINT, grp STRING, v BIGINT").repartition(5)


@pytest.mark.parametrize("nulls", ["first", "last"])
@pytest.mark.parametrize("by", [[], ["grp"]])
def test_bucketed_rank_equals_plain_window(scores, nulls, by):
    ordering = F.col("v").desc_nulls_first() if nulls == "first" else F.col("v").desc_nulls_last()
    plain = scores.withColumn("r", F.rank().over(Window.partitionBy(*by).orderBy(ordering)))
    assert bag(rank_desc(scores, "v", {"r": by}, row_id="id", nulls=nulls)) == bag(plain)
    assert bag(rank_desc(scores, "v", {"r": by}, row_id="id", nulls=nulls, one_task=True)) == bag(plain)


def test_rank_has_no_window_over_the_rows(scores):
    plan = planned(rank_desc(scores, "v", {"r": []}, row_id="id"))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows
    # The only window without partitions runs over the bucket totals.
    assert all("_in_bucket" in line or "_bucket" in line for line in windows)


def test_median_is_exact(spark):
    rng = random.Random(5)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, rng.uniform(-50, 50), float(rng.randrange(4))])) for _ in range(501)]
    df = spark.createDataFrame(data, "grp STRING, v DOUBLE").repartition(4)
    groups = {}
    for g, v in data:
        if v is not None:
            groups.setdefault(g, []).append(v)
    got = {r.grp: r.m for r in median(df, "v", "m", ["grp"]).collect()}
    assert got == pytest.approx({g: statistics.median(vs) for g, vs in groups.items()})
    everything = [v for vs in groups.values() for v in vs]
    assert median(df, "v", "m").first().m == pytest.approx(statistics.median(everything))


def test_median_of_nothing(spark):
    empty = spark.createDataFrame([(None,), (None,)], "v DOUBLE")
    assert median(empty, "v", "m").collect()[0].m is None


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a third without a key, the rest spread out."""
    df = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 900).alias("k"),
    )
    dim = spark.range(800).select(F.col("id").alias("k"), F.concat(F.lit("name "), "id").alias("name"))
    return df, dim


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_lookup_equals_plain_join(skewed, how):
    df, dim = skewed
    plain = df.join(dim, "k", how).select("id", "k", "name")
    assert bag(lookup(df, dim, "k", small=False, how=how, spread_by="id").select("id", "k", "name")) == bag(plain)
    assert bag(lookup(df, dim, "k", small=True, how=how).select("id", "k", "name")) == bag(plain)


def test_spread_lookup_balances_hot_and_missing_keys(spark, skewed):
    df, dim = skewed
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = lookup(df, dim, "k", small=False, spread_by="id")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 3000
        assert max(sizes) < 3000 / 16 * 1.6
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_frequent_keys_of_two_columns_come_from_one_pass(spark, skewed):
    df = skewed[0].withColumn("name", F.when(F.col("id") < 1500, "x").otherwise(F.concat(F.lit("n"), "id")))
    found = frequent_keys(df, ["k", "name"])
    counts = df.filter("k IS NOT NULL").groupBy("k").count().filter(f"count > 0.001 * {df.count()}")
    assert bag(found["k"]) == bag(counts.select("k")) and (7,) in bag(found["k"]) and bag(found["name"]) == [("x",)]
    both = found["k"].join(found["name"])
    assert planned(both).count("ReusedSubquery") >= 1 or final_plan(both).count("ReusedSubquery") >= 1
    assert frequent_keys(df.filter("false"), ["k"])["k"].count() == 0
    assert frequent_keys(df.select(F.lit(None).cast("string").alias("k")), ["k"])["k"].count() == 0


def test_which_keys_count_as_hot_never_changes_the_result(skewed):
    df, dim = skewed
    plain = bag(df.join(dim, "k", "left").select("id", "k", "name"))
    for hot in (dim.select("k"), dim.select("k").filter("false"), dim.select("k").filter("k % 2 = 0")):
        assert bag(lookup(df, dim, "k", small=False, spread_by="id", hot=hot).select("id", "k", "name")) == plain


def test_extreme_values_keep_their_order(spark):
    values = [float("inf"), float("-inf"), 1.7e308, -1.7e308, 0.0, 5e-324]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    assert median(df, "v", "m").first().m == pytest.approx(0.0)


@pytest.mark.parametrize("low", [10**9, 0, -(10**15)])
def test_buckets_hold_equal_shares_wherever_values_lie(spark, low):
    values = spark.range(50_000).select((F.col("id") * 3 + low).alias("v"))
    placed = values.withColumn("s", splitters(values, "v").scalar()).withColumn("b", bucket(F.col("v"), F.col("s")))
    sizes = placed.groupBy("b").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("b").collect()
    assert len(sizes) > 100 and max(r.n for r in sizes) < 8 * 50_000 / len(sizes)
    assert all(a.hi < b.lo for a, b in zip(sizes, sizes[1:]))
    ranked = rank_desc(values.withColumn("id", F.col("v")), "v", {"r": []}, row_id="id")
    assert ranked.filter((F.lit(low + 150_000 - 3) - F.col("v")) / 3 + 1 != F.col("r")).count() == 0
    assert median(values, "v", "m").first().m == low + 3 * 49_999 / 2


def test_splitters_of_few_missing_and_no_values(spark):
    few = spark.createDataFrame([(5,), (None,), (7,)], "v INT")
    cut = few.withColumn("s", splitters(few, "v").scalar()).withColumn("b", bucket(F.col("v"), F.col("s")))
    assert bag(cut.select("v", "b")) == [(5, 1), (7, 2), (None, None)]
    assert median(few.filter("false"), "v", "m").first().m is None
