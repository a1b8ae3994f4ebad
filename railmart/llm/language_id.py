"""Language identification with a string kernel.

A text is the set of its blended n-grams (one to three UTF-8 bytes, ASCII letters in lower case, runs of other ASCII as one blank). The
kernel of two texts is the number of common n-grams over the root of the product of their set sizes. LANDMARKS training texts of each
language span the Nyström approximation; one-versus-rest kernel ridge regression is solved in it. Because the kernel is linear in n-gram
presence, the whole model folds into one weight for each n-gram and language, and a batch of texts is scored by one matrix product.

Training reads at most PER_LANGUAGE texts of each language (of MOST_LANGUAGES with most documents), picked by hash, none longer than
LONGEST bytes; these bounds are parameters. Every text is scored whole.

Defined cases: a null text or one without a letter is `und` with score 0; with nothing to learn from, every text is; a null lang teaches
nothing; repeated rows get equal results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmart.llm import common

PER_LANGUAGE = 300
LANDMARKS = 60
SAMPLE = 24_000
MIN_EACH = 4
RIDGE = 1e-2
SHARPNESS = 8.0
SPACE = (1 << 24) + (1 << 16) + (1 << 8)
ROWS = 64


def _letters() -> np.ndarray:
    to = np.full(256, 32, np.uint8)
    to[128:] = np.arange(128, 256)
    to[97:123] = to[65:91] = np.arange(97, 123)
    return to


LETTERS = _letters()


def grams(data: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of one text, in order of size and place."""
    c = LETTERS[data].astype(np.int32)
    if len(c):
        c = c[np.append(True, (c[1:] != 32) | (c[:-1] != 32))]
    two = (c[:-1] << 8) | c[1:]
    return np.concatenate([(two[:-1] << 8) | c[2:], two + (1 << 24), c + (1 << 24) + (1 << 16)])


class Model:
    """weights: for each n-gram of the landmarks and language; codes: their n-grams, in order."""

    def __init__(self, languages: list[str], codes: np.ndarray, weights: np.ndarray):
        self.languages, self.codes, self.weights = languages, codes, weights

    def margins(self, texts: list[np.ndarray], at: np.ndarray, last: np.ndarray) -> np.ndarray:
        """at: place of each code among the landmarks' or -1; last: scratch, one entry for each code."""
        rows, found, size = [], [], np.ones(len(texts))
        for i, data in enumerate(texts):
            code = grams(data)
            place = np.arange(len(code), dtype=np.int32)
            last[code] = place
            code = code[last[code] == place]
            size[i] = max(len(code), 1)
            hit = at[code]
            hit = hit[hit >= 0]
            found.append(hit)
            rows.append(np.full(len(hit), i))
        present = np.zeros((len(texts), len(self.codes)), np.float32)
        present[np.concatenate(rows), np.concatenate(found)] = 1
        return (present @ self.weights) / np.sqrt(size)[:, None]


def fitted(sets: list[np.ndarray], labels: list[str]) -> Model:
    """Nyström kernel ridge regression on n-gram sets; the first LANDMARKS sets of each language are the landmarks."""
    languages = sorted(set(labels))
    marks = [i for name in languages for i in [j for j, x in enumerate(labels) if x == name][:LANDMARKS]]
    codes = np.unique(np.concatenate([sets[i] for i in marks]))
    size = np.sqrt(np.array([max(len(s), 1) for s in sets], np.float64))
    place = np.full(SPACE, -1, np.int32)
    place[codes] = np.arange(len(codes))
    basis = np.zeros((len(codes), len(marks)), np.float32)
    for k, i in enumerate(marks):
        basis[place[sets[i]], k] = 1 / size[i]
    kernel = np.zeros((len(sets), len(marks)))
    for i, s in enumerate(sets):
        hit = place[s]
        kernel[i] = basis[hit[hit >= 0]].sum(axis=0) / size[i]
    among = kernel[marks]
    goal = np.array([[1.0 if x == name else -1.0 for name in languages] for x in labels])
    weigh = np.array([1 / labels.count(x) for x in labels])[:, None] * len(labels) / len(languages)
    left = kernel.T @ (weigh * kernel) + RIDGE * len(sets) * among / len(marks) + 1e-6 * len(sets) * np.eye(len(marks))
    alpha = np.linalg.solve(left, kernel.T @ (weigh * goal))
    return Model(languages, codes, (basis @ alpha).astype(np.float32))


def train(docs: DataFrame) -> Model | None:
    """docs: text and lang of the rows to learn from, and doc_id, which only picks the sample."""
    key = F.xxhash64(F.lit("language"), F.col("doc_id").cast("string"))
    usable = docs.filter("lang IS NOT NULL AND text <> ''")
    known = common.stored(usable.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    each = max(MIN_EACH, min(PER_LANGUAGE, SAMPLE // max(1, known.count())))
    share = common.broadcast_up_to(known.select("lang", (F.lit(3.0 * each) / F.col("n")).alias("share")), SAMPLE)
    drawn = usable.join(share, "lang").filter((F.pmod(key, F.lit(1 << 30)) / F.lit(float(1 << 30))) < F.col("share"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = common.raw_text(batch.column(2))
            codes = [np.unique(grams(data[bounds[i] : bounds[i + 1]])).tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.binary())], names=["lang", "key", "codes"])

    picked = drawn.select("lang", key.alias("key"), "text").mapInArrow(sets, "lang string, key long, codes binary")
    ordered = picked.withColumn("at", F.expr("row_number() OVER (PARTITION BY lang ORDER BY key, codes)"))
    got = sorted(ordered.filter(F.col("at") <= each).collect(), key=lambda r: (r["lang"], r["at"]))
    if not got:
        return None
    return fitted([np.frombuffer(r["codes"], np.int32) for r in got], [r["lang"] for r in got])


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score (the softmax of the margins, for the best one)."""
    kept = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        letter, model = regex.compile(r"\p{L}"), kept.value
        if model is not None:
            at = np.full(SPACE, -1, np.int32)
            at[model.codes] = np.arange(len(model.codes))
            last = np.zeros(SPACE, np.int32)
        for batch in batches:
            lang, best = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            data, bounds = common.raw_text(batch.column(1))
            for lo in range(0, batch.num_rows if model is not None else 0, ROWS):
                hi = min(lo + ROWS, batch.num_rows)
                margin = model.margins([data[bounds[i] : bounds[i + 1]] for i in range(lo, hi)], at, last)
                power = np.exp(SHARPNESS * (margin - margin.max(axis=1, keepdims=True)))
                share = power / power.sum(axis=1, keepdims=True)
                for i in range(lo, hi):
                    if letter.search(data[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8", "replace")):
                        k = int(share[i - lo].argmax())
                        lang[i], best[i] = model.languages[k], share[i - lo, k]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(best)], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, lang_pred string, score double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.filter(~common.held_out()))
    return identified(docs, model).select("doc_id", common.held_out().alias("held_out"), "lang_pred", "score")
