"""Removal of byte strings of LENGTH bytes that also start anywhere else, by suffix order.

1. Anchors. Every start of a string is dealt to the string's least GRAM-byte gram (leftmost of equals), so equal strings have equal grams
   at equal places. Neighbouring starts with one anchor form a context, about a third of which are starts. Only hashes are shuffled.
   An anchor that occurs once in the corpus ends here; equal contexts are repeats as a whole, whatever their number.
2. Cores. Contexts that differ under one anchor are read again and cut, at fixed distances from the anchor, into pieces of up to
   WIDTHS[0] starts. The bytes that all strings of a piece share are its core; pieces are then sorted out by core as contexts were by
   anchor. A core whose pieces alone exceed a shard is dealt on further bytes: its pieces are cut again to the next of WIDTHS starts, so
   that their cores are longer, and sorted out by these. A piece of one start is its own core, so the last cut leaves no core too large.
3. Suffixes. Pieces that differ under one core are dealt to shards of about SHARD bytes, and each shard's suffixes are put in order by
   external induced sorting (`induced`). Starts whose common prefix with a neighbour reaches LENGTH are repeats.
4. Removal. Repeats become byte ranges by text, joined with the documents.

Texts are named by their md5, so rows with equal texts share one result and count as repeats of each other. Anchors, contexts and texts
with more than HOT_SHARE of all rows are looked up by broadcast, and their rows are spread over all tasks.

Defined cases: a null text is empty; texts under LENGTH bytes stay whole; matches never cross rows; repeated rows remove each other; a
null doc_id is kept as it is; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railmart.llm import common, induced

LENGTH = 400
GRAM = 32
WIDTHS = (32, 8, 2, 1)
SHARD = 2 << 20
HOT_SHARE = 0.001
BETWEEN = 0xFF
PART = 1 << 16


def gram_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n bytes from each place on; n is a power of two."""
    out, width, base = common.TABLES[False][data], 1, 0x9E3779B97F4A7C15
    while width < n:
        out = out[:-width] * np.uint64(base) + out[width:]
        base, width = base * base & (2**64 - 1), width * 2
    return common.mix(out)


def sliding_least(values: np.ndarray, n: int) -> np.ndarray:
    """The least of the n values from each place on."""
    out, width = values, 1
    while width * 2 <= n:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    rest = n - width
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def contexts(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Of each context of the texts that lie one after another: which text, anchor, context hash, first and last start, and distance from
    the first start to the anchor."""
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    grams = gram_hashes(data, GRAM)
    order = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    at = (sliding_least(order, length - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(at)]
    start = np.flatnonzero(np.arange(length, len(data) + 1) <= bounds[row + 1])
    at, row = at[start], row[start]
    new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (row[1:] != row[:-1]))[: len(at)])
    lo, hi, row = start[new], start[np.append(new[1:], len(at)) - 1] if len(new) else start, row[new]
    place = at[new] - lo
    whole = common.mix(common.span_hashes(data, lo, hi + length) + place.astype(np.uint64))
    return row, grams[at[new]].view(np.int64), whole.view(np.int64), lo - bounds[row], hi - bounds[row], place


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, key, anchor, context, lo, hi, place; a task writes those of a text once."""

    @common.trimmed
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            keys = batch.column(2).to_pylist()
            for first, end, data, bounds in common.parts(batch, size=PART):
                once = np.zeros(end - first, bool)
                for i in np.flatnonzero(np.diff(bounds) >= length).tolist():
                    once[i] = keys[first + i] not in seen
                    seen.add(keys[first + i])
                if not once.any():
                    continue
                row, *columns = contexts(data, bounds, length)
                own = once[row]
                take = pa.array(row[own] + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(2).take(take), *[pa.array(c[own]) for c in columns]],
                    names=["doc_id", "key", "anchor", "context", "lo", "hi", "place"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", common.text_key().alias("key")).mapInArrow(
        find, f"doc_id {kind}, key binary, anchor long, context long, lo long, hi long, place long"
    )


NAMES = ["anchor", "context", "key", "lo", "hi", "place", "data"]
DDL = "anchor long, context long, key binary, lo long, hi long, place long, data binary"


def spread_join(rows: DataFrame, facts: DataFrame, hot: DataFrame, keys: list[str], value: str, *spread_by: str) -> DataFrame:
    """rows with the value that facts, one row a key, hold for their keys, or null. The keys of hot, at most 1 / HOT_SHARE of them, are
    broadcast, and their rows travel by a hash of spread_by."""
    hot = hot.select(*[F.col(k).alias(f"hot_{k}") for k in keys], F.col(value).alias("hot_value"))
    facts = facts.select(*[F.col(k).alias(f"of_{k}") for k in keys], F.col(value).alias("of_value"), F.xxhash64(*keys).alias("of_slot"))
    marked = rows.join(F.broadcast(hot), [F.col(k) == F.col(f"hot_{k}") for k in keys], "left")
    own = F.when(F.col("hot_value").isNotNull(), F.xxhash64(F.lit(1), *spread_by)).otherwise(F.xxhash64(*keys))
    same = [F.col(k) == F.col(f"of_{k}") for k in keys] + [F.col("slot") == F.col("of_slot")]
    joined = marked.withColumn("slot", own).join(facts, same, "left")
    return joined.select(*rows.columns, F.coalesce("hot_value", "of_value").alias(value))


def sorted_out(found: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Ranges (key, first, end) that are repeats as a whole, and one row for each (anchor, context) of the anchors with several contexts."""
    hot = F.col("n") > found.count() * HOT_SHARE
    often = found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("context").alias("a"), F.max("context").alias("b"))
    often = often.filter("n > 1").withColumn("differ", F.col("a") != F.col("b"))
    shared = spread_join(found, often, often.filter(hot), ["anchor"], "differ", "key", "lo").filter("differ IS NOT NULL")
    shared = common.stored(shared, "shared")
    differ = shared.filter("differ").drop("differ")
    rest = [c for c in differ.columns if c not in ("anchor", "context")]
    one = differ.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min_by(F.struct(*rest), "key").alias("row"))
    one = common.stored(one, "contexts")
    twice = one.filter("n > 1").select("anchor", "context", "n", F.lit(True).alias("again"))
    equal = spread_join(differ, twice, twice.filter(hot), ["anchor", "context"], "again", "key", "lo").filter("again").drop("again")
    whole = shared.filter("NOT differ").drop("differ").union(equal)
    return whole.select("key", F.col("lo").alias("first"), (F.col("hi") + length).alias("end")), one.select("anchor", "context", "row.*")


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column and the bounds of its rows in them."""
    binary = column.cast(pa.large_binary())
    offsets = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
    return np.frombuffer(binary.buffers()[2] or b"", np.uint8), offsets


def cut_out(length: int):
    """For rows (key, bytes, where they begin, wanted): the bytes of each wanted stretch."""

    @common.trimmed
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            binary, offsets = bytes_of(batch.column(1))
            want = pa.RecordBatch.from_struct_array(batch.column(3).flatten())
            row = np.repeat(np.arange(batch.num_rows), batch.column(3).value_lengths().to_numpy())
            shift = (offsets[:-1] - batch.column(2).to_numpy())[row]
            for begin in range(0, want.num_rows, 2_000):
                some, by = want.slice(begin, 2_000), slice(begin, begin + 2_000)
                first, end = some["lo"].to_numpy() + shift[by], some["hi"].to_numpy() + shift[by] + length
                data = pa.array([binary[a:b].tobytes() for a, b in zip(first.tolist(), end.tolist(), strict=True)], pa.binary())
                names = {"key": batch.column(0).take(pa.array(row[by])), "data": data}
                yield pa.RecordBatch.from_arrays([names[n] if n in names else some[n] for n in NAMES], names=NAMES)

    return cut


def read_again(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted contexts with their bytes, from the documents."""
    want = F.collect_list(F.struct("anchor", "context", "lo", "hi", "place")).alias("want")
    by_text = wanted.groupBy("doc_id", "key").agg(want).select(F.col("doc_id").alias("id"), F.col("key").alias("of"), "want")
    own = docs.select("doc_id", F.col("text").cast("binary").alias("text"), common.text_key().alias("key"))
    found = own.join(by_text, (F.col("key") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")))
    return found.select("key", "text", F.lit(0).cast("long").alias("at"), "want").mapInArrow(cut_out(length), DDL)


def pieces(texts: DataFrame, length: int, width: int) -> DataFrame:
    """The pieces of up to `width` starts of contexts: anchor (of the core), context (hash of the piece), key, lo, hi, place, and the context they are from."""

    @common.trimmed
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, context, lo, place = (batch.column(i).to_numpy() for i in (0, 1, 3, 5))
            data, offsets = bytes_of(batch.column(6))
            starts = np.diff(offsets) - length + 1
            high, low = place // width, (place - starts + 1) // width
            count = high - low + 1
            row = np.repeat(np.arange(len(count)), count)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            far = (high[row] - nth) * width
            last = place[row] - far
            first = last - width + 1
            core = common.span_hashes(data, offsets[row] + last, offsets[row] + first + length)
            a, b = np.maximum(first, 0), np.minimum(last, starts[row] - 1)
            whole = common.span_hashes(data, offsets[row] + a, offsets[row] + b + length)
            core = common.mix(core + anchor[row].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + far.astype(np.uint64))
            whole = common.mix(whole + (a - first).astype(np.uint64) * np.uint64(width) + (last - b).astype(np.uint64))
            columns = [core.view(np.int64), whole.view(np.int64), None, lo[row] + a, lo[row] + b, place[row] - a, anchor[row], context[row]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2).take(pa.array(row)) if c is None else pa.array(c) for c in columns], names=[*NAMES[:6], "from_anchor", "from_context"]
            )

    return texts.mapInArrow(split, "anchor long, context long, key binary, lo long, hi long, place long, from_anchor long, from_context long")


def piece_bytes(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted pieces with their bytes, from the contexts."""
    want = F.collect_list(F.struct("anchor", "context", "lo", "hi", "place")).alias("want")
    by_context = wanted.groupBy("from_anchor", "from_context").agg(want)
    same = (F.col("anchor") == F.col("from_anchor")) & (F.col("context") == F.col("from_context"))
    return texts.join(by_context, same).select("key", "data", F.col("lo").alias("at"), "want").mapInArrow(cut_out(length), DDL)


def ranges_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of True."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def repeated_starts(rows: list[bytes], length: int, memory: int = induced.MEMORY) -> list[np.ndarray]:
    """For each byte string, which of its strings of `length` bytes occur in another place of the rows; by suffix order."""
    joined = np.frombuffer(bytes([BETWEEN]).join(rows), np.uint8)
    size = np.array([len(r) for r in rows], np.int64)
    begin = np.append(0, np.cumsum(size[:-1] + 1))
    valid = np.zeros(len(joined) + 1, np.int8)
    np.add.at(valid, begin, 1)
    np.add.at(valid, begin + np.maximum(size - length + 1, 0), -1)
    valid = np.cumsum(valid, dtype=np.int8)[:-1] > 0
    order, prefix = induced.suffix_order(joined, 256, length, memory)
    starts = valid[order]
    group = np.cumsum(prefix < length, dtype=order.dtype)[starts]
    order = order[starts]
    del prefix, starts
    equal = np.concatenate([[False], group[1:] == group[:-1], [False]])
    again = np.zeros(len(joined), bool)
    again[order[equal[:-1] | equal[1:]] if len(order) else order] = True
    return [again[b : b + max(n - length + 1, 0)] for b, n in zip(begin, size, strict=True)]


def by_suffixes(texts: DataFrame, shards: int, length: int) -> DataFrame:
    """key, first, end: byte ranges of repeats in contexts that share an anchor."""

    def sort(_: tuple, table: pa.Table) -> pa.Table:
        ids = list(zip(table["anchor"].to_pylist(), table["context"].to_pylist(), strict=True))
        once = list({x: i for i, x in enumerate(ids)}.values())
        table = table.take(pa.array(once))
        flags = repeated_starts(table["data"].to_pylist(), length)
        key, first, end = [], [], []
        for k, lo, f in zip(table["key"].to_pylist(), table["lo"].to_pylist(), flags, strict=True):
            a, b = ranges_of(f)
            key += [k] * len(a)
            first += (a + lo).tolist()
            end += (b + lo + length).tolist()
        return pa.table({"key": pa.array(key, pa.binary()), "first": pa.array(first, pa.int64()), "end": pa.array(end, pa.int64())})

    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
    return texts.withColumn("shard", shard).groupBy("shard").applyInArrow(sort, "key binary, first long, end long")


def copied(docs: DataFrame, length: int) -> DataFrame:
    """key, n, end of the texts of at least `length` bytes that n > 1 rows hold."""
    copies = docs.groupBy(common.text_key().alias("key")).agg(F.count("*").alias("n"), F.max(F.octet_length("text")).cast("long").alias("end"))
    return common.stored(copies.filter((F.col("n") > 1) & (F.col("end") >= length)), "copies")


def in_suffix_order(texts: DataFrame, length: int) -> DataFrame:
    """key, first, end: byte ranges of repeats in contexts that differ under one anchor."""
    found = []
    for width in WIDTHS:
        whole, wanted = sorted_out(common.stored(pieces(texts, length, width), "pieces"), length)
        most = max(1, SHARD // (length + width))
        crowd = common.stored(wanted.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > most), "crowded-cores")
        few, none_crowded = wanted, crowd.isEmpty()
        if not none_crowded:
            hot = crowd.filter(F.col("n") > wanted.count() * HOT_SHARE)
            wanted = common.stored(spread_join(wanted, crowd, hot, ["anchor"], "n", "key", "lo"), "wanted")
            few = wanted.filter("n IS NULL").drop("n")
        total = few.agg(F.sum(F.col("hi") - F.col("lo") + length)).first()[0] or 0
        data = common.stored(piece_bytes(texts, few, length), "piece-bytes")
        found += [whole, by_suffixes(data, max(1, -(-total // SHARD)), length)]
        if none_crowded:
            break
        texts = common.stored(piece_bytes(texts, wanted.filter("n IS NOT NULL").drop("n"), length), "crowded-bytes")
    return reduce(DataFrame.union, found)


def repeats(docs: DataFrame, copies: DataFrame, length: int = LENGTH) -> DataFrame:
    """key, ranges: for each text with repeats the byte ranges of the repeated strings; they may overlap. Copies are from `copied`."""
    whole, wanted = sorted_out(common.stored(anchors(docs, length), "anchors"), length)
    texts = common.stored(read_again(docs, wanted, length), "context-bytes")
    every = whole.union(in_suffix_order(texts, length)).union(copies.select("key", F.lit(0).cast("long").alias("first"), "end"))
    every = every.groupBy("key", "first").agg(F.max("end").alias("end"))
    return common.stored(every.groupBy("key").agg(F.collect_list(F.struct("first", "end")).alias("ranges")), "repeats")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, the rest of the columns in a struct, the text left over (null stays null), n_bytes, n_removed, n_spans, kept_sha256.

    What is left may not be valid UTF-8 where a range cuts a character; such bytes are dropped from the text, not from the hash."""
    copies = copied(docs, length)
    often = copies.filter(F.col("n") > docs.count() * HOT_SHARE)
    often = often.select("key", F.array(F.struct(F.lit(0).cast("long").alias("first"), "end")).alias("ranges"))
    own = ["doc_id", "rest"]
    mine = common.packed(docs, "doc_id", "text")
    joined = spread_join(mine.withColumn("key", common.text_key()), repeats(docs, copies, length), often, ["key"], "ranges", "doc_id")
    joined = joined.select(*own, F.col("text").cast("binary").alias("text"), "ranges")

    @common.trimmed
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, out, facts = batch.column(len(own)).to_pylist(), [], []
            for raw, ranges in zip(texts, batch.column(len(own) + 1), strict=True):
                text, spans = raw or b"", []
                if ranges.is_valid:
                    first, end = (x.to_numpy() for x in ranges.values.flatten())
                    order = np.argsort(first, kind="stable")
                    first, reach = first[order], np.maximum.accumulate(end[order])
                    new = np.append(True, first[1:] > reach[:-1])
                    spans = list(zip(first[new].tolist(), reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)].tolist(), strict=True))
                left, at = [], 0
                for a, b in spans:
                    left.append(text[at:a])
                    at = b
                left = b"".join([*left, text[at:]])
                facts.append((len(text), len(text) - len(left), len(spans), hashlib.sha256(left).hexdigest()))
                out.append(None if raw is None else left.decode("utf-8", "ignore"))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = zip(*facts, strict=True) if facts else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(own)], pa.array(out, pa.string()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=[*own, "text", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    longs = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    texts = [T.StructField(n, T.StringType()) for n in ("text", "kept_sha256")]
    return joined.mapInArrow(remove, T.StructType([mine.schema["doc_id"], mine.schema["rest"], texts[0], *longs, texts[1]]))


def cleaned(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The columns of docs; text is what is left, and n_chars, if there, its length. Every row stays."""
    left = common.unpacked(without_repeats(docs, length), docs.columns, "doc_id", "text")
    if "n_chars" in docs.columns:
        changed = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
        left = left.withColumn("n_chars", F.when(F.col("n_chars").isNull(), F.col("n_chars")).otherwise(changed))
    return left


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
