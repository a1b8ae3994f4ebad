"""Toxicity by weak supervision.

Many voters look at a text: words of a lexicon and patterns (words that start with a given stem), found from how often they occur in
labelled toxic and clean texts, besides a short fixed lexicon. A generative label model estimates by EM how often each voter fires on
toxic and on clean texts; correlations of voters given the label are estimated from the posterior, and each voter's weight is divided by
how much it shares with others. A gold label is one more voter of fixed accuracy. A linear classifier (logistic regression over the
voters' hits and their density) is trained on the posterior labels and scores every text.

Learning reads a bounded sample of documents: at most SAMPLE_TOXIC and SAMPLE_CLEAN labelled ones and SAMPLE_OPEN others, picked by hash
(parameters). Words and stems are counted by Spark over the sample; MOST_VOTERS of them are kept. Every text is scored whole.

Defined cases: a null or empty text gets the score of a text without hits; a label that is null teaches nothing; without any toxic
label only the fixed lexicon votes; several labels of one document count as their largest; repeated rows are scored alike; a null doc_id
joins no label; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railmart.llm import common

SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_OPEN = 6_000, 12_000, 3_000
STEMS = (4, 5, 6)
MOST_VOTERS = 400
MIN_TOXIC_DOCS = 4
ROUNDS = 30
GOLD_ACCURACY = 0.98
THRESHOLD = 0.3
#: Fixed lexicon, in lower case.
LEXICON = ("idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "dumb", "freak")
TOKEN = re.compile(r"[^\W\d_]+")


def tokens_of(text: str | None) -> Counter:
    """Voter names in a text, with how often each hits: `=word` and `^stem`."""
    words = Counter(TOKEN.findall((text or "").lower()))
    out: Counter = Counter()
    for word, n in words.items():
        out["=" + word] += n
        for k in STEMS:
            if len(word) >= k:
                out["^" + word[:k]] += n
    return out


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic (null: not labelled), is_learner rows of docs only; sizes are bounded by picking under a hash bound."""
    marks = labels.filter("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    base = docs.select("doc_id").join(marks, "doc_id", "left")
    sizes = {r["toxic"]: r["n"] for r in base.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("doc_id")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    bounds = {1: SAMPLE_TOXIC, 0: SAMPLE_CLEAN, None: SAMPLE_OPEN}
    share = F.lit(0.0)
    for kind, most in bounds.items():
        is_kind = F.col("toxic").eqNullSafe(F.lit(kind).cast("int"))
        share = F.when(is_kind, F.lit(min(1.0, 0.9 * most / max(sizes.get(kind, 0), 1)))).otherwise(share)
    return base.filter(draw < share).dropDuplicates(["doc_id"])


def voters(texts: DataFrame) -> list[str]:
    """The words and stems that speak most for a toxic label, by signed log-likelihood ratio; texts: text and toxic, labelled rows only."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for name in tokens_of(text):
                    found.setdefault(name, [0, 0])[toxic] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), *(pa.array([v[i] for v in found.values()], pa.int64()) for i in (0, 1))],
            names=["name", "clean", "toxic"],
        )

    sums = texts.mapInArrow(counted, "name string, clean long, toxic long").groupBy("name").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    clean, toxic = (texts.filter(F.col("toxic") == k).count() for k in (0, 1))
    if not toxic:
        return []
    rate_t, rate_c = (F.col("t") + 0.5) / (toxic + 1.0), (F.col("c") + 0.5) / (clean + 1.0)
    gain = F.col("t") * F.log(rate_t / rate_c)
    top = sums.filter(F.col("t") >= MIN_TOXIC_DOCS).filter(rate_t > 3 * rate_c).orderBy(gain.desc(), "name").limit(MOST_VOTERS)
    return [r["name"] for r in top.collect()]


class Finder:
    """Counts voter hits in texts with one automaton over all words and stems."""

    def __init__(self, names: list[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        by_text: dict[str, list[int]] = {}
        for i, name in enumerate(names):
            by_text.setdefault(name[1:], []).append(i)
        for text, ids in by_text.items():
            self.automaton.add_word(text, (len(text), [(i, names[i][0] == "=") for i in ids]))
        self.width, self.empty = len(names), not names
        if names:
            self.automaton.make_automaton()

    def hits(self, text: str | None) -> dict[int, int]:
        low, out = (text or "").lower(), {}
        if self.empty:
            return out
        for end, (n, ids) in self.automaton.iter(low):
            begin = end + 1 - n
            if begin and low[begin - 1].isalpha():
                continue
            for i, whole in ids:
                if not whole or end + 1 == len(low) or not low[end + 1].isalpha():
                    out[i] = out.get(i, 0) + 1
        return out


def label_model(votes: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of label 1 for each row, firing rates of the voters on labels 0 and 1, and their weights after correlation.

    votes: rows x voters, 0 or 1; gold: 0, 1, or -1 for none."""
    n, width = votes.shape
    known = gold >= 0
    prior = (gold[known].sum() + 1) / (known.sum() + 2)
    posterior = np.where(known, np.where(gold == 1, GOLD_ACCURACY, 1 - GOLD_ACCURACY), prior).astype(np.float64)
    weight = np.ones(width)
    rates = np.full((2, width), 0.5)
    for _ in range(ROUNDS):
        for y, p in enumerate((1 - posterior, posterior)):
            rates[y] = (p @ votes + 0.05) / (p.sum() + 1.0)
        centred = votes - (posterior[:, None] * rates[1] + (1 - posterior)[:, None] * rates[0])
        spread = np.sqrt((centred**2).sum(axis=0) + 1e-9)
        together = np.clip((centred.T @ centred) / spread[:, None] / spread, 0, 1)
        weight = 1 / np.maximum(together.sum(axis=1), 1.0)
        odds = math.log(prior / (1 - prior)) + votes @ (weight * np.log(rates[1] / rates[0]))
        odds += (1 - votes) @ (weight * np.log((1 - rates[1]) / (1 - rates[0])))
        odds += np.where(known, np.where(gold == 1, 1.0, -1.0), 0.0) * math.log(GOLD_ACCURACY / (1 - GOLD_ACCURACY))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - posterior).max() < 1e-4:
            break
        posterior = new
    return posterior, rates, weight


def features(hits: dict[int, int], words: int, width: int) -> np.ndarray:
    """By voter: 1 if it hits; then the log of all hits, of hit voters, and hits by 100 words."""
    x = np.zeros(width + 3)
    if hits:
        x[list(hits)] = 1
        total = sum(hits.values())
        x[width:] = math.log1p(total), math.log1p(len(hits)), min(5.0, 100 * total / max(words, 1))
    return x


def linear(x: np.ndarray, target: np.ndarray, steps: int = 300, decay: float = 1e-3) -> np.ndarray:
    """Logistic regression on soft targets by Newton steps with a ridge; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), decay * len(x))
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target) + ridge * w
        move = np.linalg.solve((x.T * np.maximum(p * (1 - p), 1e-4)) @ x + np.diag(ridge), slope)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return w


class Model:
    def __init__(self, names: list[str], weights: np.ndarray):
        self.names, self.weights = names, weights

    def scores(self, finder: Finder, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), self.weights[-1])
        for i, text in enumerate(texts):
            hits = finder.hits(text)
            if hits:
                out[i] += features(hits, (text or "").count(" ") + 1, len(self.names)) @ self.weights[:-1]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """docs: doc_id and text of the rows to learn from; labels: doc_id and toxic."""
    picked = F.broadcast(common.stored(sample(docs, labels), "toxicity-sample").repartition(1))
    texts = common.stored(docs.select("doc_id", "text").join(picked, "doc_id").select("text", "toxic"), "toxicity-texts")
    names = list(dict.fromkeys(["=" + w for w in LEXICON] + voters(texts.filter("toxic IS NOT NULL"))))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(names)
        for batch in batches:
            rows = [features(finder.hits(t), (t or "").count(" ") + 1, len(names)).astype(np.float32).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.binary())], names=["toxic", "x"])

    got = texts.mapInArrow(vote, "toxic int, x binary").collect()
    if not got:
        return Model(names, np.append(np.full(len(names) + 3, 1.0), -3.0))
    x = np.array([np.frombuffer(r["x"], np.float32) for r in got], np.float64)
    gold = np.array([-1 if r["toxic"] is None else r["toxic"] for r in got])
    if not (gold == 1).any():
        return Model(names, np.append(np.full(len(names) + 3, 1.0), -3.0))
    posterior, _, _ = label_model(x[:, : len(names)], gold)
    return Model(names, linear(x, posterior))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of docs, with score; docs must not have a column of that name."""
    kept = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(kept.value.names)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(kept.value.scores(finder, batch.column(at).to_pylist()))], names=[*batch.schema.names, "score"]
            )

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def kept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs whose score is under the threshold."""
    own = ("doc_id", "text")
    return common.unpacked(scored(common.packed(docs, *own), model).filter(F.col("score") < THRESHOLD), docs.columns, *own)


def trained_on(spark, docs: DataFrame, sf_dir: str) -> Model:
    return train(docs.filter(~common.held_out()), common.table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~common.held_out()))


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, trained_on(spark, docs, sf_dir))
    return out.select("doc_id", common.held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
