"""Quality rules: base counts of a text, and how far its character classes and common words lie from those of a language.

References come from all documents: for each language the share of each character class and of its COMMON most frequent words (all other
words are one more class). A document is compared with every language by Jensen-Shannon distance (base 2, from 0 to 1) and keeps the
smallest; its own language column is not used. Too short texts are not judged by a histogram they cannot fill (MIN_CHARS, MIN_WORDS).

Defined cases: a null or empty text has zero counts and fails the base rules; documents without a language count for no reference; with
no reference at all, only the base rules decide; repeated rows are judged alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmart.llm import common

COMMON = 50
MIN_WORDS = 50
MIN_CHARS = 200
MOST_CHAR_DISTANCE = 0.35
MOST_WORD_DISTANCE = 0.48
FLUSH = 1 << 21
SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "symbol", "other", "control", "two", "three", "four")


def _classes() -> np.ndarray:
    kind = np.full(256, CLASSES.index("other"), dtype=np.uint8)
    kind[:32] = kind[127] = CLASSES.index("control")
    kind[[32, 9]], kind[[10, 13]] = CLASSES.index("space"), CLASSES.index("line")
    kind[97:123], kind[65:91], kind[48:58] = CLASSES.index("lower"), CLASSES.index("upper"), CLASSES.index("digit")
    kind[list(b".,;:!?'\"-()")] = CLASSES.index("stop")
    kind[list(SYMBOLS)] = CLASSES.index("symbol")
    kind[192:224], kind[224:240], kind[240:] = CLASSES.index("two"), CLASSES.index("three"), CLASSES.index("four")
    kind[128:192] = len(CLASSES)
    return kind


KIND = _classes()


def class_counts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Characters of each class by row; following bytes of a character don't count."""
    width = len(CLASSES) + 1
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    flat = np.bincount(row * width + KIND[data], minlength=(len(bounds) - 1) * width)
    return flat.reshape(-1, width)[:, :-1]


def sums_by_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeated_words(words: np.ndarray, first: np.ndarray, n: int = 5) -> np.ndarray:
    """By row: words in windows of n words that the row has twice or more."""
    hashes, inside = common.window_hashes(words, first, n)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(inside)
    keys = common.mix(hashes[at] + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(words), bool)
    again[at[order[1:][same]]] = True
    again[at[order[:-1][same]]] = True
    covered = again.copy()
    for j in range(1, n):
        covered[j:] |= again[:-j]
    return sums_by_row(covered, first)


def base_counts(data: np.ndarray, bounds: np.ndarray, words: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    raw = data.tobytes()
    dup_lines = np.zeros(len(bounds) - 1, np.int64)
    for i in range(len(bounds) - 1):
        lines = [x for x in raw[bounds[i] : bounds[i + 1]].split(b"\n") if x.strip()]
        dup_lines[i] = len(lines) - len(set(lines))
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    return {
        "n_words": np.diff(first),
        "word_chars": sums_by_row(~common.BLANK[data] & ((data & 0xC0) != 0x80), bounds),
        "n_symbols": sums_by_row(symbol[data], bounds),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeated_words(words, first),
    }


def divergence(shares: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row to the reference."""
    middle = (shares + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(shares > 0, shares * np.log2(shares / middle), 0.0).sum(axis=1)
        right = np.where(reference > 0, reference * np.log2(reference / middle), 0.0).sum(axis=1)
    return np.sqrt(np.clip((left + right) / 2, 0.0, 1.0))


def references(docs: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By language: shares of the character classes, hashes of the common words, their shares (the last one: all others).

    Every document counts and every language with a word has a reference. Tasks send counts by language and word; only the leading words of
    each language and its sums reach the driver, COMMON + 13 rows a language."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def rows() -> pa.RecordBatch:
            lang, key, n = merged(held) if held else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
            held.clear()
            by = np.array([*names, ""], dtype=object)
            return pa.RecordBatch.from_arrays(
                [pa.array(by[lang], pa.string()), pa.nulls(len(key), pa.int32()), pa.array(key.view(np.int64)), pa.array(n)],
                names=["lang", "kind", "word", "n"],
            )

        classes: dict[int, np.ndarray] = {}
        for batch in batches:
            lang = [None if x is None else names.setdefault(x, len(names)) for x in batch.column(0).to_pylist()]
            for lo, hi, data, bounds in common.parts(batch):
                words, first = common.word_hashes(data, bounds)
                chars = class_counts(data, bounds)
                code = np.array([-1 if x is None else x for x in lang[lo:hi]], np.int64)
                for c in np.unique(code[code >= 0]):
                    classes[c] = classes.get(c, 0) + chars[code == c].sum(axis=0)
                of = np.repeat(code, np.diff(first))
                held.append(merged([(of[of >= 0], words[of >= 0], np.ones((of >= 0).sum(), np.int64))]))
                if sum(len(x[0]) for x in held) > FLUSH:
                    held[:] = [merged(held)]
                    if len(held[0][0]) > FLUSH // 2:
                        yield rows()
        yield rows()
        by = [*names]
        flat = [(by[c], k, 0, int(n)) for c, counts in classes.items() for k, n in enumerate(counts)]
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("lang", "kind", "word", "n"), x, strict=True)) for x in flat],
            schema=pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("word", pa.int64()), ("n", pa.int64())]),
        )

    sums = docs.select("lang", "text").mapInArrow(counted, "lang string, kind int, word long, n long")
    sums = common.stored(sums.groupBy("lang", "kind", "word").agg(F.sum("n").alias("n")), "word-counts")
    words = sums.filter("kind IS NULL").select("lang", "word", "n")
    total = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    chars: dict[str, np.ndarray] = {}
    for r in sums.filter("kind IS NOT NULL").collect():
        chars.setdefault(r["lang"], np.zeros(len(CLASSES)))[r["kind"]] = r["n"]
    top: dict[str, list] = {}
    ranked = words.withColumn("place", F.expr("row_number() OVER (PARTITION BY lang ORDER BY n DESC, word)"))
    for r in ranked.filter(F.col("place") <= COMMON).collect():
        top.setdefault(r["lang"], []).append((r["word"], r["n"]))
    out = {}
    for lang, n in sorted(total.items()):
        keys = np.array([w for w, _ in top[lang]], np.int64).view(np.uint64)
        share = np.array([m for _, m in top[lang]], np.float64) / n
        order = np.argsort(keys)
        out[lang] = (chars[lang] / chars[lang].sum(), keys[order], np.append(share[order], max(0.0, 1 - share.sum())))
    return out


def merged(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal (language, word) pairs once, with their counts summed."""
    lang, key, n = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((key, lang))
    lang, key, n = lang[order], key[order], n[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (lang[1:] != lang[:-1])
    return lang[new], key[new], np.add.reduceat(n, np.flatnonzero(new)) if len(n) else n


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, and the distances to the nearest language (null where the text is too short)."""
    known = docs.sparkSession.sparkContext.broadcast(references(docs))
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in common.parts(batch):
                words, first = common.word_hashes(data, bounds)
                counts = base_counts(data, bounds, words, first)
                n = counts["n_words"]
                chars = class_counts(data, bounds)
                size = chars.sum(axis=1)
                best = np.full(hi - lo, np.inf)
                by_char, by_word = np.full(hi - lo, np.nan), np.full(hi - lo, np.nan)
                row = np.repeat(np.arange(hi - lo), n)
                for class_share, keys, word_share in known.value.values():
                    c = divergence(chars / np.maximum(size, 1)[:, None], class_share)
                    at = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
                    at = np.where(keys[at] == words, at, len(keys))
                    seen = np.bincount(row * (len(keys) + 1) + at, minlength=(hi - lo) * (len(keys) + 1)).reshape(hi - lo, -1)
                    w = divergence(seen / np.maximum(n, 1)[:, None], word_share)
                    nearer = c / MOST_CHAR_DISTANCE + w / MOST_WORD_DISTANCE < best
                    best = np.where(nearer, c / MOST_CHAR_DISTANCE + w / MOST_WORD_DISTANCE, best)
                    by_char, by_word = np.where(nearer, c, by_char), np.where(nearer, w, by_word)
                by_char[size < MIN_CHARS] = np.nan
                by_word[n < MIN_WORDS] = np.nan
                failed = (n < 10) | (100 * counts["n_repeat_words"] > 20 * n)
                kept = ~failed & ~(by_char > MOST_CHAR_DISTANCE) & ~(by_word > MOST_WORD_DISTANCE)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *(pa.array(counts[k].astype(np.int64)) for k in longs), pa.array(failed), pa.array(kept),
                     pa.array(by_char, mask=np.isnan(by_char)), pa.array(by_word, mask=np.isnan(by_word))],
                    names=["doc_id", *longs, "base_failed", "kept", "char_distance", "word_distance"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, {', '.join(f'{k} long' for k in longs)}, base_failed boolean, kept boolean, char_distance double, word_distance double"
    return docs.select("doc_id", "text").mapInArrow(judge, ddl)


def query(spark, sf_dir: str) -> DataFrame:
    return judged(common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
