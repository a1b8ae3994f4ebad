"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

1. Vocabulary. Runs of letters are counted in each task and summed by Spark.
2. Windows. Two words of which the longer has m letters are one edit apart if they agree but for one place; the place is in the first or in
   the second half of m. So each word goes to the list of words with the same second half, and to that with the same first half, for m being
   its length and one more. A list of more than LIST words is cut further: the window in which the edit lies is halved, so a word goes to two
   lists of words that agree in more letters. A window of one letter holds no more words than there are letters, so every list ends up
   short, whatever the words; no pair is left out.
3. Scan. A list is sorted, what its words share at both sides is left out, and its words are met in order. The rows of the edit matrix of a
   word (band of three columns) against all later words of the list are kept by depth; the next word goes on from the row at its common
   prefix with this one. A row holds only words that are still within one edit, and where none is left, all words that share the prefix are
   skipped. A pair counts in the one list whose window holds its first different letter.
4. Forms. A word's numbers are summed over its lists, and forms are followed by joins until none changes; each step at least multiplies the
   occurrences by RATIO, so few steps lead to the root.

Defined cases: a null text has no words; repeated rows count again; a null id counts as empty text in `typos`; words without near words are
their own root; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmart.llm import common

SHORTEST, RAREST, RATIO = 6, 5, 5
LIST = 512
HELD_WORDS = 300_000
LISTS_IN_MEMORY = 500_000
FIELDS = "word string, near long, best_n long, best string"


def runs_of(text: str, shortest: int) -> list[bytes]:
    """Runs of at least so many letters A-Z, a-z, U+00C0 to U+00FF, one byte a letter, with A-Z lower-cased."""
    return re.findall(rb"[a-z\xc0-\xff]{%d,}" % shortest, text.encode("latin-1", "replace").lower())


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, rarest: int = RAREST, typos: int | None = None) -> DataFrame:
    """word and n of all words with so many letters and occurrences.

    typos: a run whose crc32 with its row's id is divisible by this number loses one letter first."""

    @common.trimmed
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def rows() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                runs = runs_of(text.as_py() or "", shortest)
                if typos:
                    own = zlib.crc32(f"{'' if doc_id.as_py() is None else doc_id.as_py()}:".encode())
                    runs = [changed(r, own, typos) for r in runs]
                held.update(runs)
                if len(held) >= HELD_WORDS:
                    yield rows()
                    held.clear()
        yield rows()

    def changed(run: bytes, own: int, rate: int) -> bytes:
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), own)
        if h % rate:
            return run
        at = h % len(run)
        return run[:at] + run[at + 1 :]

    counted = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(count, "word string, n long")
    return counted.filter(F.length("word") >= shortest).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= rarest)


def halves(words: DataFrame) -> DataFrame:
    """Each word in its lists: word, n, m (letters of the longer word of a pair), window [a, b), list (hash of m, window and shared letters)."""
    window = [(F.lit(0), F.floor(F.col("m") / 2).cast("int")), (F.floor(F.col("m") / 2).cast("int"), F.col("m"))]
    rows = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("m"))
    rows = rows.select("word", "n", "m", F.explode(F.array(*[F.struct(a.alias("a"), b.alias("b")) for a, b in window])).alias("w"))
    return keyed(rows.select("word", "n", "m", "w.a", "w.b"))


def keyed(rows: DataFrame) -> DataFrame:
    shared = [F.expr("substring(word, 1, a)"), F.when(F.col("m") > F.col("b"), F.expr("right(word, m - b)")).otherwise("")]
    return rows.select("word", "n", "m", "a", "b", F.xxhash64("m", "a", "b", *shared).alias("list"))


def lists(words: DataFrame, most: int = LIST) -> DataFrame:
    """The rows of `halves` in lists of at most `most` words, or with a window of one letter."""
    rows, done = common.stored(halves(words), "windows"), None
    while True:
        sizes = rows.groupBy("list").agg(F.count("*").alias("size"), F.max(F.col("b") - F.col("a")).alias("width"))
        large = common.stored(sizes.filter((F.col("size") > most) & (F.col("width") > 1)).select("list"), "large-lists")
        large = common.broadcast_up_to(large, LISTS_IN_MEMORY)
        small = rows.join(large, "list", "left_anti")
        done = small if done is None else done.unionByName(small)
        middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
        parts = F.array(F.struct(F.col("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b")))
        cut = rows.join(large, "list", "left_semi").select("word", "n", "m", F.explode(parts).alias("w"))
        rows = common.stored(keyed(cut.select("word", "n", "m", "w.a", "w.b")), "windows")
        if rows.isEmpty():
            return done


def near_pairs(cores: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For the strings of a sorted list those later ones that are one edit apart, and where they first differ."""
    size, width = len(cores), max(map(len, cores))
    letters = np.zeros((size, width + 2), np.uint16)  # a margin on both sides; 0 is no letter
    lengths = np.array([len(c) for c in cores])
    for k, c in enumerate(cores):
        letters[k, 1 : len(c) + 1] = np.frombuffer(c.encode("utf-16-le"), np.uint16)
    equal = letters[1:, 1:] == letters[:-1, 1:]
    equal[:, -1] = False
    shared = np.append(np.argmin(equal, axis=1), -1).tolist()  # common prefix of a string with the next one
    for k in range(size - 1):
        shared[k] = min(shared[k], len(cores[k]), len(cores[k + 1]))
    before = np.array([[2, 0, 1]], np.int8).repeat(size, axis=0)  # the empty prefix against no and one letter
    stack = [(np.arange(size), before)]
    skip = None
    for k, core in enumerate(cores):
        if k:
            common_prefix = shared[k - 1]
            if skip is not None and common_prefix >= skip:
                continue
            del stack[common_prefix + 1 :]
            skip = None
        for depth in range(len(stack) - 1, len(core)):
            later, row = stack[-1]
            if later[0] <= k:
                at = int(np.searchsorted(later, k, side="right"))
                later, row = later[at:], row[at:]
            new = row + (letters[later, depth : depth + 3] != letters[k, depth + 1])
            np.minimum(new[:, :2], row[:, 1:] + 1, out=new[:, :2])
            np.minimum(new[:, 1], new[:, 0] + 1, out=new[:, 1])
            np.minimum(new[:, 2], new[:, 1] + 1, out=new[:, 2])
            alive = new.min(axis=1, initial=2) <= 1
            later, row = later[alive], new[alive]
            if not len(later):
                skip = depth + 1
                break
            stack.append((later, row))
        else:
            later, row = stack[-1]
            beyond = lengths[later] - len(core)
            near = (later > k) & (np.abs(beyond) <= 1)
            near[near] = row[near, beyond[near] + 1] == 1
            if near.any():
                found = later[near]
                yield k, found, np.argmin(letters[found, 1:] == letters[k, 1:], axis=1)


def scanned(list_of: list[tuple[str, int]], m: int, a: int, b: int) -> list[tuple[str, int, int, str]]:
    """word, number of near words, the most frequent one's n and itself, for the words (and n) of a list with a near word in it."""
    cut = m - b
    cores = [w[a : len(w) - cut] for w, _ in list_of]
    order = sorted(range(len(cores)), key=cores.__getitem__)
    found: dict[int, list] = {}
    for k, others, at in near_pairs([cores[i] for i in order]):
        i = order[k]
        for o, p in zip(others.tolist(), at.tolist(), strict=True):
            j = order[o]
            left, right = list_of[i][0], list_of[j][0]
            if max(len(left), len(right)) != m:
                continue
            p += a
            while left[p : p + 1] == right[p : p + 1]:  # what was left out may go on with equal letters
                p += 1
            if p >= b:
                continue
            for x, y in ((i, j), (j, i)):
                word, n = list_of[y]
                mine = found.setdefault(x, [0, -n, word])
                mine[0] += 1
                mine[1:] = min(mine[1:], [-n, word])
    return [(list_of[i][0], count, -less, word) for i, (count, less, word) in found.items()]


def near_words(listed: DataFrame) -> DataFrame:
    """word, near, best_n, best from each list; lists come to a task one after the other."""

    @common.trimmed
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def results(table: pa.Table, last: bool) -> tuple[list[tuple], pa.Table]:
            key = table["list"].to_numpy()
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), *([len(key)] if last else [])]
            words, n, m, a, b = (table[c].to_pylist() for c in ("word", "n", "m", "a", "b"))
            out = []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if hi - lo > 1:
                    out += scanned(list(zip(words[lo:hi], n[lo:hi], strict=True)), m[lo], a[lo], b[lo])
            return out, table.slice(cuts[-1])

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [()] * 4
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["word", "near", "best_n", "best"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            found, rest = results(pa.concat_tables([rest, table]) if rest is not None else table, last=False)
            yield batch_of(found)
        if rest is not None and rest.num_rows:
            yield batch_of(results(rest, last=True)[0])

    rows = listed.select("list", "word", "n", "m", "a", "b")
    return rows.repartition("list").sortWithinPartitions("list", "word").mapInArrow(scan, FIELDS)


def roots(forms: DataFrame) -> DataFrame:
    """word and root for words with a form: forms are followed, twice as far in each round, until none changes. forms: word, form."""
    now = common.stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        new = now.join(ahead, now["root"] == ahead["at"], "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        new = common.stored(new, "roots")
        now = new.select("word", "root")
        if not new.filter("moved").limit(1).count():
            return now


def variants(words: DataFrame, ratio: int = RATIO, most: int = LIST) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of a vocabulary (word, n; each word once)."""
    words = common.stored(words.select("word", "n"), "vocabulary")
    better = F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))
    near = near_words(lists(words, most)).groupBy("word").agg(F.sum("near").alias("n_near"), F.min(better).alias("top"))
    joined = words.join(near, "word", "left")
    strong = -F.col("top.less") >= ratio * F.col("n")
    joined = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(strong, F.col("top.best")).alias("form"),
        F.when(strong, -F.col("top.less")).alias("form_n"),
    )
    joined = common.stored(joined, "forms")
    found = roots(joined.filter("form IS NOT NULL").select("word", "form"))
    out = joined.join(found, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    return variants(vocabulary(common.table(spark, sf_dir, "documents").select("doc_id", "text"), typos=199))
