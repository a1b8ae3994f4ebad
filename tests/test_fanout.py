from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from railmart.operators.fanout import Fact, fan_out, mean, whole
from tests.helpers import bag, planned


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(11)

    def table(n):
        data = [(i, rng.choice([None, *range(8)]), rng.choice([None, *range(20)])) for i in range(n)]
        return spark.createDataFrame(data, "id BIGINT, k INT, v INT")

    dim = spark.createDataFrame([(k, "even" if k % 2 == 0 else "odd") for k in range(12)], "k INT, name STRING")
    return dim, table(60), table(25), table(9)


def wanted(df, prefix):
    return Fact(df, {f"{prefix}_sum": F.sum("v"), f"{prefix}_n": F.count("v")}, {f"{prefix}_ids": F.count("id")})


@pytest.mark.parametrize("group", ["k", "name"])
def test_literal_equals_the_row_by_row_join(facts, group):
    dim, a, b, c = facts
    product = dim
    for p, df in (("a", a), ("b", b), ("c", c)):
        product = product.join(df.select("k", F.col("id").alias(f"{p}_id"), F.col("v").alias(f"{p}_v")), "k", "left")
    plain = product.groupBy(group).agg(
        F.sum("a_v").alias("sum_a"),
        F.avg("b_v").alias("avg_b"),
        F.sum("c_v").alias("sum_c"),
        F.countDistinct("b_id").alias("ids_b"),
    )
    joined = fan_out(dim, "k", {"a": wanted(a, "a"), "b": wanted(b, "b"), "c": wanted(c, "c")})
    got = joined.groupBy(group).agg(
        whole("a_sum").alias("sum_a"),
        mean("b_sum", "b_n").alias("avg_b"),
        whole("c_sum").alias("sum_c"),
        F.coalesce(F.sum("b_ids"), F.lit(0)).alias("ids_b"),
    )
    for x, y in zip(bag(got), bag(plain), strict=True):
        assert x == pytest.approx(y)


def test_independent_gives_each_facts_own_totals(facts):
    dim, a, b, _ = facts
    joined = fan_out(dim, "k", {"a": wanted(a, "a"), "b": wanted(b, "b")}, mode="independent")
    own = dim.join(a.groupBy("k").agg(F.sum("v").alias("s")), "k", "left").select("k", "s")
    assert bag(joined.select("k", F.col("a_sum").alias("s"))) == bag(own)


def test_unknown_mode(facts):
    with pytest.raises(ValueError, match="mode"):
        fan_out(facts[0], "k", {}, mode="other")


def test_no_product_in_the_plan(facts):
    dim, a, b, c = facts
    plan = planned(fan_out(dim, "k", {"a": wanted(a, "a"), "b": wanted(b, "b"), "c": wanted(c, "c")}))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_totals_beyond_a_bigint_stay_exact(spark):
    dim = spark.createDataFrame([(1,)], "k INT")
    big = spark.range(4).select(F.lit(1).alias("k"), F.lit(4 * 10**18).alias("v"))
    other = spark.range(10).select(F.lit(1).alias("k"), F.lit(3).alias("v"))
    # Sums of the fact itself already have to fit; the multiples need not.
    facts = {"a": Fact(big.limit(2), {"s": F.sum("v"), "n": F.count("v")}), "b": Fact(other, {"t": F.sum("v")})}
    joined = fan_out(dim, "k", facts)
    assert joined.agg(mean("s", "n")).first()[0] == pytest.approx(4e18)
    assert joined.agg(whole("s")).first()[0] == 8 * 10**19


def test_three_facts_whose_product_outgrows_a_bigint(spark):
    dim = spark.createDataFrame([(1,)], "k INT")
    a = spark.createDataFrame([(1, 2**31 - 1)] * 3, "k INT, v INT")
    many = [spark.range(70_000).select(F.lit(1).alias("k"), F.lit(1).alias(c)) for c in ("w", "x")]
    facts = {"a": Fact(a, {"s": F.sum("v")}), "b": Fact(many[0], {"t": F.sum("w")}), "c": Fact(many[1], {"u": F.sum("x")})}
    assert fan_out(dim, "k", facts).agg(whole("s")).first()[0] == 3 * (2**31 - 1) * 70_000**2
