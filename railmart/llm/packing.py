"""Hierarchical packing into windows of several sizes.

A document is its token ids and the end id. Full windows of the largest size are cut off; what is left of a document is routed to the
smallest size that holds it. Each size is packed from the largest down: a piece opens a window, the largest shorter pieces that fit go
into its gap, and what still is open is filled with part of a shorter piece. Windows are full, so nothing is padded but one sequence for
each group of MERGED partitions. Step groups hold windows of one size and the same number of tokens: windows of a size are numbered over
all partitions, by the counts of the partitions before, and STEP_TOKENS of them in a row are one group.

A task packs its own partition in blocks of BLOCK tokens, so memory does not grow with the input and no row is shuffled; what a partition
cannot fill (less than one window of each size) is written with its ids, and packed again for MERGED partitions at a time.

Defined cases: a null or empty text has only the end id; a null doc_id stays null; repeated rows are documents of their own; an empty
table gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmart.llm import common

WINDOWS = (256, 512, 1024, 2048)
END = 1
BLOCK = 1 << 19
MERGED = 256
STEP_TOKENS = 8 * WINDOWS[-1]
PARTS_IN_MEMORY = 500_000
CACHED_WORDS = 1_000_000
FIELDS = [
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("window", pa.int32()), ("nth", pa.int64()), ("ids", pa.binary()),
    ("part", pa.int32()), ("packer", pa.int64()),
]
DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window int, nth long, "
    "ids binary, part int, packer long"
)


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step_group", "ids"]


class WordIds(dict):
    """Little-endian ids by word. The vocabulary's rules never look across white space, so words are encoded one by one and kept.

    A full table becomes the old one, from which words still met move on, so frequent words stay and memory is bounded."""

    def __init__(self, path: str, most: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.old: dict[bytes, bytes] = {}
        self.most = most

    def __missing__(self, word: bytes) -> bytes:
        packed = self.old.get(word)
        if packed is None:
            packed = self.encoded(word)
        if len(word) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[word] = packed
        return packed

    def encoded(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def of(self, text: bytes | None) -> bytes:
        return b"".join(map(self.__getitem__, (text or b"").split()))


_known: dict[tuple[str, int], WordIds] = {}


def word_ids(path: str, most: int) -> WordIds:
    if (path, most) not in _known:
        _known[path, most] = WordIds(path, most)
    return _known[path, most]


class Packer:
    """Packs pieces (doc_id, start, ids, doc_tokens) into full windows; a piece may be cut anywhere."""

    def __init__(self, first: int, keep_ids: bool):
        self.waiting: list[list[tuple]] = [[] for _ in WINDOWS]
        self.tokens, self.next, self.keep_ids = 0, first, keep_ids
        self.made = dict.fromkeys(WINDOWS, 0)
        self.first, self.out = first, []

    def add(self, piece: tuple) -> None:
        n = len(piece[2]) // 4
        bisect.insort(self.waiting[bisect.bisect_left(WINDOWS, n)], piece, key=lambda p: len(p[2]))
        self.tokens += n

    def document(self, doc_id, ids: bytes) -> None:
        largest, total = WINDOWS[-1] * 4, len(ids) // 4
        whole = len(ids) // largest * largest
        for at in range(0, whole, largest):
            self.close(WINDOWS[-1], [(doc_id, at // 4, ids[at : at + largest], total)])
        if len(ids) > whole:
            self.add((doc_id, whole // 4, ids[whole:], total))

    def close(self, window: int, pieces: list[tuple]) -> None:
        nth, offset = self.made[window], 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            kept = ids if self.keep_ids else None
            self.out.append((doc_id, start, n, zlib.crc32(ids), total, self.next, offset, window, nth, kept, None, self.first))
            offset += n
        self.made[window] += 1
        self.next += 1

    def take(self, gap: int, kind: int) -> tuple:
        """The longest waiting piece of WINDOWS[kind] or a smaller size that fits; else the start of the shortest one."""
        for row in reversed(self.waiting[: kind + 1]):
            at = bisect.bisect_right(row, gap * 4, key=lambda p: len(p[2]))
            if at:
                piece = row.pop(at - 1)
                self.tokens -= len(piece[2]) // 4
                return piece
        doc_id, start, ids, total = next(row for row in self.waiting[: kind + 1] if row).pop(0)
        self.tokens -= len(ids) // 4
        self.add((doc_id, start + gap, ids[gap * 4 :], total))
        return doc_id, start, ids[: gap * 4], total

    def pack(self) -> None:
        """Closes every window that the waiting pieces can fill."""
        for kind in range(len(WINDOWS) - 1, -1, -1):
            window = WINDOWS[kind]
            while self.waiting[kind] and self.under(kind, window):
                piece = self.waiting[kind].pop()
                self.tokens -= len(piece[2]) // 4
                pieces, gap = [piece], window - len(piece[2]) // 4
                while gap:
                    piece = self.take(gap, kind)
                    pieces.append(piece)
                    gap -= len(piece[2]) // 4
                self.close(window, pieces)

    def under(self, kind: int, needed: int) -> bool:
        """Whether pieces of this size and the shorter ones hold a whole window."""
        have = 0
        for row in self.waiting[: kind + 1]:
            for p in row:
                have += len(p[2]) // 4
                if have >= needed:
                    return True
        return False

    def finish(self) -> None:
        """The last pieces: windows of each size from the largest down, then one shorter sequence."""
        rest = [p for row in reversed(self.waiting) for p in reversed(row)]
        self.waiting, self.tokens = [[] for _ in WINDOWS], 0
        left = sum(len(p[2]) // 4 for p in rest)
        for window in reversed(WINDOWS):
            while left >= window or (window == WINDOWS[0] and left):
                pieces, gap = [], window
                while gap and rest:
                    doc_id, start, ids, total = rest.pop(0)
                    if len(ids) // 4 > gap:
                        rest.insert(0, (doc_id, start + gap, ids[gap * 4 :], total))
                        ids = ids[: gap * 4]
                    pieces.append((doc_id, start, ids, total))
                    gap -= len(ids) // 4
                left -= window - gap
                self.close(window, pieces)

    def rows(self, last: int | None = None) -> pa.RecordBatch:
        """What is packed so far; with `last`, also the waiting pieces, marked by that partition number."""
        if last is not None:
            for row in self.waiting:
                self.out += [(d, s, len(i) // 4, zlib.crc32(i), t, None, None, None, None, i, last, None) for d, s, i, t in row]
        columns = list(zip(*self.out, strict=True)) or [()] * len(FIELDS)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, FIELDS, strict=True)], names=[n for n, _ in FIELDS])


def packed(docs: DataFrame, tokenizer: str, keep_ids: bool = True, cached_words: int = CACHED_WORDS) -> DataFrame:
    """The pieces of all documents. keep_ids: with each piece's ids as little-endian unsigned 32-bit numbers.

    cached_words: how many words a worker keeps with their ids, twice at most; fewer take less memory and more time."""

    @common.trimmed
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known = TaskContext.get().partitionId(), word_ids(tokenizer, cached_words)
        packer = Packer(part << 32, keep_ids)
        end = END.to_bytes(4, "little")
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
                packer.document(doc_id, known.of(text.as_py()) + end)
                if packer.tokens >= BLOCK:
                    packer.pack()
                if len(packer.out) >= 20_000 or keep_ids and len(packer.out) >= 2_000:
                    yield packer.rows()
        packer.pack()
        yield packer.rows(part)

    def again(key: tuple, table: pa.Table) -> pa.Table:
        packer = Packer((1 << 62) + (key[0].as_py() << 32), keep_ids)
        for d, s, i, t in sorted(zip(*(table[c].to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")), strict=True), key=repr):
            packer.add((d, s, i, t))
        packer.pack()
        packer.finish()
        return pa.Table.from_batches([packer.rows()])

    level = common.stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(first, DDL), "packed")
    rest = level.filter("part IS NOT NULL").groupBy((F.col("part") / MERGED).cast("long").alias("of")).applyInArrow(again, DDL)
    return in_steps(level.filter("part IS NULL").unionByName(common.stored(rest, "packed-rest")).drop("part"))


def in_steps(rows: DataFrame) -> DataFrame:
    """The rows with step_group in place of packer and nth, the number of a window among those of its size and packer."""
    made = rows.groupBy("window", "packer").agg((F.max("nth") + 1).alias("made"))
    before = made.withColumn("before", F.expr("sum(made) OVER (PARTITION BY window ORDER BY packer) - made")).drop("made")
    side = common.broadcast_up_to(common.stored(before, "windows-before"), PARTS_IN_MEMORY)
    nth, size = F.col("before") + F.col("nth"), F.col("window").cast("long")
    step = F.floor(nth * size / F.lit(STEP_TOKENS)).cast("long")
    of_size = F.array_position(F.array(*[F.lit(w) for w in WINDOWS]), F.col("window")) - 1
    return rows.join(side, ["window", "packer"]).withColumn("step_group", step * len(WINDOWS) + of_size).select(*COLUMNS)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return packed(docs, default_tokenizer(), keep_ids=False).drop("ids")
