"""Mixing sources to target weights.

Tokens are summed per source; from them and the targets comes a repetition rate per source; each document is emitted floor(rate) times
and once more with probability equal to the fraction, decided by a hash of seed and doc_id, so reruns agree.

Defined cases: a null text has size 0; a null source is a source of its own, ranked last; a null doc_id draws as an empty id; equal rows
draw alike; an empty table gives an empty mix; a source without tokens has target 0 and is not taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmart.llm import common

WEIGHTS = (3, 1, 2)
SEED = "mix-1"
BROADCAST_SOURCES = 100_000


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(common.WORD)), F.lit(0)).cast("long")


def draw(seed: str = SEED, doc_id: str = "doc_id") -> Column:
    """A number in [0, 1) from the first 32 bits of md5(seed:doc_id)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def ranked_sources(sized: DataFrame) -> DataFrame:
    """source, source_size and the position of the source by code point, null last.

    Positions come from a range partitioning and the row counts of its partitions, so any number of sources is ranked without one task
    seeing all of them."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    parts = common.stored(
        sums.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources"
    )
    counts = sorted((r["part"], r["n"]) for r in parts.groupBy("part").agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for part, n in counts:
        starts += [(part, before)]
        before += n
    offsets = sums.sparkSession.createDataFrame(starts, "part int, start long")
    within = F.expr("row_number() OVER (PARTITION BY part ORDER BY source ASC NULLS LAST)")
    return (
        parts.withColumn("within", within)
        .join(F.broadcast(offsets), "part")
        .select("source", "source_size", (F.col("start") + F.col("within") - 1).alias("position"))
    )


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Adds weight and target: share of all tokens, dealt by weight, no source above `most` times its size; the excess is dealt again.

    The level (tokens per weight) only rises while sources reach their bound, so the rounds end when no further source does; each round
    is one aggregate over the table of sources."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    dealt = common.stored(sources.withColumn("weight", weight), "weights").withColumn("bound", F.col("source_size") * most)
    total = dealt.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        is_full = F.col("weight") * F.lit(level) >= F.col("bound") if full >= 0 else F.lit(False)
        now, bounds, open_weight = dealt.agg(
            F.count_if(is_full), F.sum(F.when(is_full, F.col("bound"))), F.sum(F.when(~is_full, F.col("weight")))
        ).first()
        if now == full or not open_weight:
            break
        full, level = now, max(0.0, share * total - (bounds or 0.0)) / open_weight
    return dealt.withColumn("target", F.least(F.col("weight") * F.lit(level), F.col("bound"))).drop("bound", "position")


def with_copies(docs: DataFrame, weights: Sequence[float] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """The documents with size, source_size, target and copies: how often the mix takes each."""
    sized = docs.withColumn("size", size_of())
    sources = common.stored(targets(ranked_sources(sized), weights), "targets").select(
        F.col("source").alias("of"), "source_size", "target"
    )
    side = common.broadcast_up_to(sources, BROADCAST_SOURCES)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (
        sized.join(side, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("rate", rate)
        .withColumn("copies", (F.floor("rate") + (draw(seed) < F.col("rate") - F.floor("rate")).cast("long")).cast("long"))
        .drop("of", "rate")
    )


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """The mix itself: the columns of docs, each document as often as it is taken."""
    own = ("doc_id", "source", "text")
    taken = with_copies(common.packed(docs, *own), weights, seed).filter("copies > 0")
    copies = taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return common.unpacked(copies, docs.columns, *own)


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return with_copies(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), dealt AS (
  SELECT *, source_size * 2.0::DOUBLE AS bound,
         [3.0::DOUBLE, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sources
), steps AS (
  SELECT *, coalesce(sum(bound) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
         sum(weight) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
         sum(source_size) OVER () * 1.5::DOUBLE AS total
  FROM dealt
), level AS (
  SELECT coalesce(max((total - below) / open_weight) FILTER (WHERE (total - below) / open_weight * weight < bound), 0) AS level FROM steps
), aims AS (
  SELECT source, source_size, least(weight * level, bound) AS target FROM dealt, level
), taken AS (
  SELECT s.doc_id, s.size, a.source_size, a.target, CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0 END AS rate,
         CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(s.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS draw
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, size, source_size, target, CAST(floor(rate) AS BIGINT) + CAST(draw < rate - floor(rate) AS BIGINT) AS copies,
       (CAST(floor(rate) AS BIGINT) + CAST(draw < rate - floor(rate) AS BIGINT)) * size AS taken
FROM taken
"""
