"""Shared helpers: tables, tables cut from their lineage in the shared folder, and word hashing over Arrow batches.

Word hashes are 64-bit: a polynomial over random per-byte values modulo 2^64, mixed afterwards. They are the same in every process, so
tasks may be retried anywhere.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
_SECTION = 1 << 19
_BASE = 0x9E3779B97F4A7C15


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, once for each application, as they need it for the functions they run."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="railmart-"), "railmart.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(package)))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where it is unset, a new temporary one if all tasks run in the driver, else an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        java = spark._jsc.sc().getCheckpointDir()
        at = java.get() if java.isDefined() else None
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = f"file://{tempfile.mkdtemp(prefix='railmart-')}"
        spark.sparkContext.setCheckpointDir(at)
    return at


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again, so later steps don't depend on executors that made them.

    The files go when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/railmart-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    java = spark._jvm.org.apache.hadoop.fs.Path(path)
    java.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(java)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_up_to(df: DataFrame, rows: int, count: int | None = None) -> DataFrame:
    """A broadcast hint if the rows were counted and are few enough; else a plain join side, which Spark shuffles."""
    n = df.limit(rows + 1).count() if count is None else count
    return F.broadcast(df) if n <= rows else df


def packed(docs: DataFrame, *own: str) -> DataFrame:
    """The own columns, and all others in one struct `rest`, so names that a step adds can't clash with them."""
    return docs.select(*own, F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`") for c in docs.columns if c not in own]).alias("rest"))


def unpacked(df: DataFrame, columns: list[str], *own: str) -> DataFrame:
    """The columns again as they were before `packed`."""
    return df.select(*[F.col(c) if c in own else F.col("rest").getField(c).alias(c) for c in columns])


def held_out(doc_id: str = "doc_id"):
    """True for rows whose crc32(doc_id as text) mod 4 is 2; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def text_key():
    """md5 of the text, which names equal texts; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finish, on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def trimmed(function):
    """For functions of Arrow batches: gives the memory that a task has freed back to the system, as workers live on for other tasks."""

    @wraps(function)
    def run(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def _bytes_table(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    if lower:
        values[65:91] = values[97:123]
    return values


TABLES = {lower: _bytes_table(lower) for lower in (False, True)}
BLANK = np.zeros(256, dtype=bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[int, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the base modulo 2^64, or of its inverse."""
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        have = np.full(max(n, 1024), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[inverse] = have
    return have[:n]


def raw_text(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the bounds of its rows in them; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def parts(batch: pa.RecordBatch, name: str = "text", size: int = _SECTION) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """A batch in runs of rows of about `size` bytes of text: first row, end row, bytes, bounds. A longer row comes alone."""
    data, bounds = raw_text(batch.column(batch.schema.get_field_index(name)))
    at, n = 0, len(bounds) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, side="right")) - 1)
        yield at, end, data[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at]
        at = end


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in all rows."""
    solid = ~BLANK[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    begins[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the byte spans, which must be in order and must not overlap; works in sections, whatever the length."""
    out = np.empty(len(starts), np.uint64)
    values, i = TABLES[lower], 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _SECTION, side="right")))
        lo, hi = starts[i], ends[j - 1]
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.multiply(values[data[lo:hi]], powers(hi - lo), out=sums[1:])
        np.cumsum(sums, out=sums)
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * powers(hi - lo, True)[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def word_hashes(data: np.ndarray, bounds: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, and for each row the index of its first word (one more entry at the end)."""
    starts, ends = word_spans(data, bounds)
    return span_hashes(data, starts, ends, lower), np.searchsorted(starts, bounds)


def window_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words at every word, and which of them lie within one row."""
    if len(words) < n:
        return np.zeros(len(words), np.uint64), np.zeros(len(words), bool)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        total += words[j : len(words) - n + 1 + j] * np.uint64((_BASE * (2 * j + 3) + 2 * j) & (2**64 - 1) | 1)
    out = np.zeros(len(words), np.uint64)
    out[: len(total)] = mix(total)
    row_end = np.repeat(first[1:], np.diff(first))
    return out, np.arange(len(words)) + n <= row_end
