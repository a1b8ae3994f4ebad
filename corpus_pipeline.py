"""The corpus pipeline: toxicity, n-gram Jaccard join, suffix-array dedup, mixing, packing, each over all that the stage before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of `documents`. Each result is written to
the shared folder and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from railmart.llm import common, mixing, ngram_join, packing, suffix_dedup, toxicity

REPEAT = 256


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold. The labels of sf_dir teach, but for held-out rows."""
    common.ship(spark)
    return toxicity.kept(docs, toxicity.trained_on(spark, docs, sf_dir))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    common.ship(spark)
    return ngram_join.kept(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of REPEAT bytes, about 50 words, that occur elsewhere too."""
    common.ship(spark)
    return suffix_dedup.cleaned(docs, REPEAT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    common.ship(spark)
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their token ids."""
    common.ship(spark)
    return packing.packed(docs, packing.default_tokenizer(), cached_words=150_000)


STAGES = [
    ("toxicity", not_toxic),
    ("ngram_join", one_of_each_group),
    ("suffix_dedup", without_repeats),
    ("mixing", mixed),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.ship(spark)
    docs = common.table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = common.stored(docs, f"stage-{name}")
    return docs
