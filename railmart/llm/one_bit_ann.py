"""Nearest neighbours by randomly rotated one-bit codes.

Index: every vector is reduced by the nearest of a few centroids (k-means on a bounded sample), rotated by one random orthogonal matrix and
kept as the signs of its coordinates, packed, with two numbers: the length of the reduced vector and its inner product with its code's
direction. Codes and originals are stored, one row a vector.

Search: query vectors are rotated; their inner products with the signs of all codes of a batch are one matrix product, and with the two
numbers give a distance and an error bound that fails rarely (CONFIDENCE). A vector is compared exactly when its lower bound is not above
the k-th smallest upper bound of the vectors beside it or the k-th distance found so far; where many of a batch are left, one matrix product
over the originals drops those that rounding can't make near enough. What remains is measured in double precision.

Every vector meets every query: vectors are dealt to parts and queries to groups of at most HELD bytes, and each part meets each group in one
task, which holds the queries and reads the vectors in batches. So no side is broadcast or collected, and memory does not grow with
either; tasks hand on k rows for each query.

Defined cases: vectors that are null, zero or hold null or non-finite components take no part; only vectors of one length are compared;
rows with the query's own id are no candidates; ties go to the smaller id; ids that are null take no part; equal vectors all count; with
fewer than k candidates all are returned; query rows with equal id and vector are one query, and different vectors of one id are queries of
their own, each with its ranks from 1; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railmart.llm import common

K = 10
BLOCK = 512
TILE = 512
CENTROIDS = 16
SAMPLE_ROWS, SAMPLE_BYTES = 10_000, 16 << 20
CONFIDENCE = 3.0
HELD = 64 << 20
PAIRS = 1 << 28
COMPONENTS = 1 << 20
SEED = 7
#: Shares of a batch's pairs: above MANY they are measured by one product; above CROWDED the bounds are lowered first.
MANY, CROWDED = 1 / 200, 1 / 50
ROUNDING = {np.float32: 1e-5, np.float64: 1e-12}


def usable(vectors: DataFrame) -> DataFrame:
    """id and v (floats where they come as such, else doubles) of the vectors that take part."""
    kind = "float" if isinstance(vectors.schema["v"].dataType.elementType, T.FloatType) else "double"
    v = F.col("v").cast(f"array<{kind}>")
    low, high = F.array_min(v), F.array_max(v)  # NaN is above infinity
    ok = ~F.exists(v, lambda x: x.isNull()) & (low > F.lit(float("-inf"))) & (high < F.lit(float("inf"))) & ((low != 0) | (high != 0))
    return vectors.select(F.col("id").cast("long").alias("id"), v.alias("v")).filter("id IS NOT NULL").filter(F.coalesce(ok, F.lit(False)))


@cache
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def centroids(vectors: DataFrame) -> dict[int, np.ndarray]:
    """k-means centres by vector length, from a sample of at most SAMPLE_ROWS vectors and SAMPLE_BYTES of each length, drawn by hash."""
    sized = vectors.withColumn("dim", F.size("v"))
    out = {}
    for dim, n in sorted((r["dim"], r["n"]) for r in sized.groupBy("dim").agg(F.count("*").alias("n")).collect()):
        most = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
        draw = F.pmod(F.xxhash64(F.lit("centres"), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        drawn = sized.filter((F.col("dim") == dim) & (draw <= min(1.0, 0.9 * most / n))).orderBy(F.xxhash64("id"), "id").limit(most)
        rows = np.array([r["v"] for r in drawn.select("v").collect()], np.float64).reshape(-1, dim)
        rng = np.random.default_rng(SEED)
        centre = rows[rng.permutation(len(rows))[:CENTROIDS]] if len(rows) else np.zeros((1, dim))
        for _ in range(10 if len(rows) else 0):
            near = ((rows**2).sum(1)[:, None] - 2 * rows @ centre.T + (centre**2).sum(1)).argmin(axis=1)
            centre = np.array([rows[near == k].mean(axis=0) if (near == k).any() else centre[k] for k in range(len(centre))])
        out[dim] = centre
    return out


def packed_bits(signs: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    pad = -signs.shape[1] % 64
    return np.packbits(np.pad(signs, ((0, 0), (0, pad))), axis=1, bitorder="little").view(np.uint64)


def coded(rows: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cell, code words, length of the reduced vector, and inner product of its direction with the code's."""
    near = ((rows**2).sum(1)[:, None] - 2 * rows @ centre.T + (centre**2).sum(1)).argmin(axis=1)
    reduced = (rows - centre[near]) @ rotation(rows.shape[1])
    length = np.sqrt((reduced**2).sum(axis=1))
    inner = np.abs(reduced).sum(axis=1) / np.sqrt(rows.shape[1]) / np.maximum(length, 1e-300)
    return near.astype(np.int64), packed_bits(reduced > 0), length, np.where(length > 0, inner, 1.0)


def hashed(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def as_binary(rows: np.ndarray) -> pa.Array:
    """The bytes of each row of an array."""
    data = np.ascontiguousarray(rows)
    bounds = np.arange(len(data) + 1, dtype=np.int32) * np.int32(data.shape[1] * data.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def as_rows(column: pa.Array, kind: type | None = None, width: int = 0) -> np.ndarray:
    """The array again from equally long bytes; floats or doubles, as `width` of them fill a row, where no kind is given."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    kind = kind or (np.float32 if len(data) == 4 * width * len(column) else np.float64)
    return np.frombuffer(data.tobytes(), kind).reshape(len(column), -1)


def runs(sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each length and where it is, at most COMPONENTS numbers at a time."""
    for dim in np.unique(sizes).tolist():
        on = np.flatnonzero(sizes == dim)
        for at in range(0, len(on), step := max(BLOCK, COMPONENTS // dim)):
            yield dim, on[at : at + step]


def laid(vectors: DataFrame, more: Callable[[np.ndarray], list[pa.Array]], ddl: str) -> DataFrame:
    """dim, place (a number of its own), id, v (bytes), and the columns that `more` makes of vectors of one length."""

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            sizes = lists.value_lengths().to_numpy()
            for dim, on in runs(sizes):
                values = lists.take(pa.array(on)).flatten().to_numpy(zero_copy_only=False).reshape(len(on), dim)
                columns = [pa.array(np.full(len(on), dim, np.int32)), pa.array(place + np.arange(len(on))), ids.take(pa.array(on)), as_binary(values), *more(values)]
                place += len(on)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [x.split()[0] for x in f"dim int, place long, id long, v binary, {ddl}".split(", ")]
    return vectors.select("id", "v").mapInArrow(lay, f"dim int, place long, id long, v binary, {ddl}")


def indexed(vectors: DataFrame) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """The index, stored: vectors with cells, codes, lengths and inner products; and the centres it was made with."""
    centres = centroids(vectors)
    kept = vectors.sparkSession.sparkContext.broadcast(centres)

    def code(values: np.ndarray) -> list[pa.Array]:
        cell, words, length, inner = coded(values.astype(np.float64), kept.value[values.shape[1]])
        return [pa.array(cell.astype(np.int32)), as_binary(words), pa.array(length), pa.array(inner)]

    return common.stored(laid(vectors, code, "cell int, code binary, length double, inner double"), "one-bit-index"), centres


def sides(code: np.ndarray, length: np.ndarray, inner: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """What rotated and reduced queries with their squared length and 1 are multiplied with, to give squared distances to the vectors of one
    cell; and the error bounds for queries of length 1."""
    signs = np.unpackbits(code.view(np.uint8), axis=1, count=dim, bitorder="little") * 2.0 - 1
    spread = np.sqrt(np.maximum(1 - inner**2, 0)) / inner / np.sqrt(max(dim - 1, 1))
    return np.vstack([(signs * (-2 * length / inner / np.sqrt(dim))[:, None]).T, np.ones(len(code)), length**2]), 2 * length * CONFIDENCE * spread


def estimated(query: np.ndarray, centre: np.ndarray, code: np.ndarray, length: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances (queries x vectors of one cell) from the codes' signs, and their error bounds."""
    z = (query - centre) @ rotation(query.shape[1])
    far = (z**2).sum(axis=1)
    right, error = sides(code, length, inner, query.shape[1])
    return np.column_stack([z, far, np.ones(len(z))]) @ right, np.sqrt(far)[:, None] * error


def places(marks: np.ndarray, total: int) -> np.ndarray:
    """Where the first `total` marks are set; eight at a time, as few are. The last marks of the array are spare."""
    marks[total : total + 8] = False
    words = marks[: -(-total // 8) * 8].view(np.uint64)
    eights = np.flatnonzero(words)
    row, column = np.nonzero(words[eights].view(bool).reshape(-1, 8))
    return eights[row] * 8 + column


class Held:
    """The queries of one group, and the k nearest of each that were found so far."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, v: np.ndarray, k: int):
        self.ids, self.keys, self.v, self.k = ids, keys, v, k
        self.near, self.score = np.full((len(ids), k), np.iinfo(np.int64).max), np.full((len(ids), k), np.inf)
        self.scale = [f(np.abs(v).max(axis=1)) for f in (np.min, np.max)]

    def rows(self) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.ids), BLOCK * 16):
            on = slice(at, at + BLOCK * 16)
            q, key, v, s = np.repeat(self.ids[on], self.k), np.repeat(self.keys[on], self.k), self.near[on].ravel(), self.score[on].ravel()
            real = np.isfinite(s)
            yield pa.RecordBatch.from_arrays([pa.array(x[real]) for x in (q, key, v, s)], names=["query_id", "query_key", "vec_id", "score"])

    def add(self, row: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        """The k nearest of those so far and these, ties to the smaller id."""
        own = np.unique(row)
        rows = np.concatenate([row, np.repeat(own, self.k)])
        near, scores = np.concatenate([vec, self.near[own].ravel()]), np.concatenate([score, self.score[own].ravel()])
        order = np.lexsort((near, scores, rows))
        first = np.searchsorted(rows[order], own)
        order = order[(first[:, None] + np.arange(self.k)).ravel()].reshape(-1, self.k)
        self.near[own], self.score[own] = near[order], scores[order]

    def meet(self, ids: np.ndarray, v: np.ndarray, cell: np.ndarray, code: np.ndarray, length: np.ndarray, inner: np.ndarray, centre: np.ndarray) -> None:
        """Compares vectors with all queries."""
        dim, turn = v.shape[1], rotation(v.shape[1])
        size = np.abs(v).max(axis=1)
        plain = self.v.dtype == v.dtype == np.float32 and min(self.scale[0], size.min()) > 1e-12 and max(self.scale[1], size.max()) < 1e12
        kind = np.float32 if plain else np.float64
        room = ROUNDING[kind]
        order, cells = np.argsort(cell, kind="stable"), []
        for on in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
            right, error = sides(code[on], length[on], inner[on], dim)
            right[-1] *= 1 - room
            x = v[on].astype(np.float64)
            square = (x**2).sum(axis=1)
            exact = np.vstack([-2 * x.T, np.ones(len(on)), square * (1 - room)])
            cells.append((on, centre[cell[on[0]]] @ turn, np.vstack([right, -error]).astype(kind), error.astype(kind), exact.astype(kind), square.max()))
        wide = max(len(c[0]) for c in cells)
        buffers = [np.empty(TILE * wide + 8, x) for x in (kind, kind, bool, bool)]
        for at in range(0, len(self.ids), TILE):
            mine = self.ids[at : at + TILE]
            query = self.v[at : at + TILE].astype(np.float64)
            turned, square = query @ turn, (query**2).sum(axis=1)
            ones = np.ones(len(mine))
            found, waiting = [], 0
            for on, middle, right, error, exact, largest in cells:
                total = len(mine) * len(on)
                low, apart, seen, close = (b[:total].reshape(len(mine), len(on)) for b in buffers)
                z = turned - middle
                far = (z**2).sum(axis=1)
                bound = self.score[at : at + TILE, -1] ** 2
                if len(on) > self.k and np.isinf(bound).any():
                    np.matmul(np.column_stack([z, far, ones, -np.sqrt(far)]).astype(kind), right, out=apart)
                    apart[mine[:, None] == ids[on]] = np.inf
                    bound = np.minimum(bound, np.partition(apart, self.k - 1, axis=1)[:, self.k - 1] + 4 * room * (far + length[on].max() ** 2))
                np.matmul(np.column_stack([z, far * (1 - room) - bound, ones, np.sqrt(far)]).astype(kind), right, out=low)
                np.less_equal(low, 0, out=seen)
                if np.count_nonzero(seen) > MANY * total:
                    np.matmul(np.column_stack([query, square * (1 - room) - bound, ones]).astype(kind), exact, out=apart)
                    np.logical_and(seen, np.less_equal(apart, 0, out=close), out=seen)
                    if len(on) > self.k and np.count_nonzero(seen) > CROWDED * total:
                        np.matmul(np.column_stack([query, square, ones]).astype(kind), exact, out=apart)
                        apart[mine[:, None] == ids[on]] = np.inf
                        bound = np.minimum(bound, np.partition(apart, self.k - 1, axis=1)[:, self.k - 1] + 4 * room * (square + largest))
                        np.logical_and(seen, np.less_equal(apart, bound[:, None], out=close), out=seen)
                flat = places(buffers[2], total)
                row, column = np.divmod(flat, len(on))
                other = mine[row] != ids[on][column]
                for part in np.array_split(np.flatnonzero(other), other.sum() * dim // (1 << 22) + 1):
                    r, c = row[part], on[column[part]]
                    found.append((at + r, ids[c], np.sqrt(((v[c].astype(np.float64) - query[r]) ** 2).sum(axis=1))))
                    waiting += len(r)
                if waiting > len(mine):
                    self.add(*(np.concatenate(x) for x in zip(*found, strict=True)))
                    found, waiting = [], 0
            if waiting:
                self.add(*(np.concatenate(x) for x in zip(*found, strict=True)))


def nearest(index: DataFrame, centres: dict[int, np.ndarray], queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest by Euclidean distance that the bounds let through, exact, ties to the smaller id."""
    spark = index.sparkSession
    kept = spark.sparkContext.broadcast(centres)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def keyed(values: np.ndarray) -> list[pa.Array]:
        return [pa.array([hashed(v.tobytes()) for v in values], pa.int64())]

    @common.trimmed
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, held = None, [], None
        for batch in batches:
            task, side = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(task) | np.diff(side)) + 1).tolist(), len(task)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if task[i] != at:
                    if held:
                        yield from held.rows()
                    at, waiting, held = task[i], [], None
                one = {name: batch.column(name).slice(i, j - i) for name in batch.schema.names}
                dim = one["dim"][0].as_py()
                ids, v = one["id"].to_numpy(), as_rows(one["v"], width=dim)
                if side[i] == 0:
                    waiting.append((ids, one["key"].to_numpy(), v))
                    continue
                if waiting:
                    held, waiting = Held(*(np.concatenate(x) for x in zip(*waiting, strict=True)), k), []
                own = v, one["cell"].to_numpy(), as_rows(one["code"], np.uint64), one["length"].to_numpy(), one["inner"].to_numpy()
                for _, on in runs(np.full(len(ids), dim)) if held else ():
                    held.meet(ids[on], *(x[on] for x in own), kept.value[dim])
        if held:
            yield from held.rows()

    asked = common.stored(laid(queries.select("id", "v").distinct(), keyed, "key long"), "one-bit-queries")
    counts = index.groupBy("dim").agg(F.count("*").alias("n")).join(asked.groupBy("dim").agg(F.count("*").alias("m"), F.sum(F.length("v")).alias("size")), "dim")
    dealt, total = {"dim": [], "groups": [], "parts": [], "first": []}, 0
    for dim, n, m, size in sorted(counts.select("dim", "n", "m", "size").collect()):
        groups = -(-size // HELD)
        parts = max(1, min(n // BLOCK, max(16, 8 * n // (k * m)), max(least, n * m // groups // PAIRS)))
        for name, value in zip(dealt, (dim, groups, parts, total), strict=True):
            dealt[name].append(value)
        total += groups * parts
    dealt = F.broadcast(spark.createDataFrame(pa.table(dealt, schema=pa.schema([(name, pa.int64()) for name in dealt]))))
    group, part = (F.pmod(F.xxhash64("place"), F.col(x)) for x in ("groups", "parts"))
    left = asked.join(dealt, "dim").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("group", group)
    right = index.join(dealt, "dim").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).withColumn("part", part)
    task = F.expr("cast(first + group * parts + part AS int)").alias("task")
    left = left.select(task, F.lit(0).alias("side"), "dim", "id", "v", "key", F.lit(0).alias("cell"), F.lit(b"").alias("code"), F.lit(0.0).alias("length"), F.lit(0.0).alias("inner"))
    right = right.select(task, F.lit(1).alias("side"), "dim", "id", "v", F.lit(0).cast("long").alias("key"), "cell", "code", "length", "inner")
    met = left.unionByName(right).repartitionById(max(1, total), "task").sortWithinPartitions("task", "side")
    found = met.mapInArrow(search, "query_id long, query_key long, vec_id long, score double")
    rank = F.expr("row_number() OVER (PARTITION BY query_id, query_key ORDER BY score, vec_id)")
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    vectors = usable(common.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")))
    index, centres = indexed(vectors)
    return nearest(index, centres, vectors.filter(F.col("id") % 100 == 0))
