"""Periodic runs of words by suffix trees: Lyndon roots extended both ways by constant-time common prefixes.

A run is a stretch of words with smallest period q, at least twice as long as q and LEAST words long, that can't be extended keeping q.
A run's root occurs in it as a Lyndon word, for one of the two orders of the words as the longest Lyndon word at its place: the stretch up to
the next smaller (or next larger) suffix. So each place has two candidates. From the order of suffixes in the tree of a stretch come the
candidates; common prefixes in that tree and in the tree of the reversed stretch extend each to the right and to the left.

Trees are built only where runs can be. In a run of LEAST words each word lies in some HALF consecutive words that occur again in the run, HALF
being LEAST / 2: if q <= HALF, at least LEAST - q >= HALF words in a row are equal to those q further on; else q are. So stretches of words
covered by windows of HALF words that occur twice in the text hold every run, and a run that is maximal there is so in the text, as its
words are all covered. Windows are found by 64-bit hashes; a false match only makes a stretch longer.

Memory is that of one text and of the trees of its longest such stretch. No row is shuffled.

Defined cases: a null text is empty and has no runs; words are compared byte by byte; repeated rows and null ids are rows of their own; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmart.llm import common
from railmart.llm.suffix_tree import CommonPrefixes

LEAST = 12
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
Words = list[bytes]


def next_smaller(rank: list[int]) -> np.ndarray:
    """For each place the next one of smaller rank; the length where there is none."""
    out = np.full(len(rank), len(rank), np.int64)
    open_places: list[int] = []
    for i, r in enumerate(rank):
        while open_places and rank[open_places[-1]] > r:
            out[open_places.pop()] = i
        open_places.append(i)
    return out


def runs_of(s: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """start, length and period of the runs of a sequence of numbers from 1, by start and period."""
    n = len(s)
    forward, backward = CommonPrefixes([*s, 0]), CommonPrefixes([*s[::-1], 0])
    rank = forward.rank.tolist()
    place = np.arange(n)
    ends = [next_smaller(rank)[:n], next_smaller([-r for r in rank])[:n]]
    ends[1][ends[1] > n] = 0  # none: the word would take in the end mark
    at = np.concatenate([place[e > place] for e in ends])
    period = np.concatenate([(e - place)[e > place] for e in ends])
    right = forward(at, at + period)
    left = np.zeros(len(at), np.int64)
    inner = at > 0
    left[inner] = backward(n - at[inner], n - at[inner] - period[inner])
    length = period + left + right
    good = (length >= 2 * period) & (length >= least)
    return sorted(set(zip((at - left)[good].tolist(), length[good].tolist(), period[good].tolist(), strict=True)))


def stretches(hashes: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Bounds of the stretches covered by windows of least / 2 words that occur twice or more."""
    half = least // 2
    if len(hashes) < least:
        return []
    windows, inside = common.window_hashes(hashes, np.array([0, len(hashes)]), half)
    windows = windows[inside]
    order = np.argsort(windows)
    same = windows[order[1:]] == windows[order[:-1]]
    cover = np.zeros(len(hashes) + 1, np.int64)
    twice = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    cover[twice] += 1
    cover[twice + half] -= 1
    covered = np.cumsum(cover) > 0
    edges = np.flatnonzero(covered[1:] != covered[:-1]) + 1
    edges = np.append(0, edges) if covered[0] else edges
    return [(a, b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= least]


def runs_in(words: Words, hashes: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """The runs of a text's words, whose hashes may be given in another order of memory than the words."""
    out = []
    for a, b in stretches(hashes, least):
        numbers: dict[bytes, int] = {}
        out += [(a + s, n, q) for s, n, q in runs_of([numbers.setdefault(w, len(numbers) + 1) for w in words[a:b]], least)]
    return out


def collapsed(words: Words, runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    dropped = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def with_runs(docs: DataFrame, least: int = LEAST, places: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """doc_id, runs (by start, then period) and the text without its repeated periods for each row.

    places: gives, for an id and a number of words, which words make up the text to be read, or None for the words as they are."""

    @common.trimmed
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi, data, bounds in common.parts(batch):
                hashes, first = common.word_hashes(data, bounds)
                raw, found, texts = data.tobytes(), [], []
                for k in range(hi - lo):
                    words, own = raw[bounds[k] : bounds[k + 1]].split(), hashes[first[k] : first[k + 1]]
                    moved = places(ids[lo + k], len(words)) if places else None
                    if moved is not None:
                        words, own = [words[i] for i in moved.tolist()], own[moved]
                    runs = runs_in(words, own, least)
                    found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                    texts.append(collapsed(words, runs).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(found, RUNS), pa.array(texts, pa.string())], names=["doc_id", "runs", "collapsed"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(find, ddl)


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's changed texts: one in ten, by the crc32 of its id, goes on with a period from a place on. A null id changes nothing."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % period
    return at


def digest(rows: DataFrame) -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period) and hashes of the runs and of the collapsed text."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    rows = rows.select("doc_id", "runs", "collapsed", longest.alias("best"))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"), F.floor(F.expr("-1000 * best.less div best.period")).alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return digest(with_runs(common.table(spark, sf_dir, "documents").select("doc_id", "text"), places=planted))
