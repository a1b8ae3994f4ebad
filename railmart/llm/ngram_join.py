"""N-gram Jaccard self-join by parity sketches, and the groups of documents that its links connect.

A document is the set of its 64-bit shingle hashes. Documents with equal sets are one node. Shingles are dealt to parts by hash, and each
part's XOR is one word of the sketch: two sets of sizes a and b with Jaccard >= 0.8 differ in at most t = (a + b) / 9 shingles, and each
of them touches one part, so at most t words differ. Sizes are cut into bands; in a band the number of parts is chosen so that words stay
equal: either more than t parts (pigeonhole), or, for large sets, enough that a pair at the threshold keeps EQUAL_WORDS equal words on
average (all parts being touched then has a chance below e^-EQUAL_WORDS). A set whose partners may be larger also enters the next band.
Equal words are joined by one shuffle and a streaming pass over sorted rows.

1. Each node is compared with the node it meets in most words' groups as their smallest member; links give components. Once more, each
   node of a group that still holds several components is compared with the group's first or last one of another.
2. Groups that still hold several components are dealt to cells: the members outside a group's largest component meet each other and all
   members of that component, in blocks. In a cell, pairs in one component are skipped, as are pairs whose bit sketches' Hamming distance
   (a lower bound of the symmetric difference) is above t; members without a pair left leave the cell.
3. Members meet with their full sets: first in the cells that are the largest of any member; then each pair that still is open under the
   smallest word that both share. Pairs are verified there, nearest first, and joined at once, so a cell compares no two members that it
   has connected and writes only the links that join two components, fewer than it has members.
Pairs that the first step compares are verified on the full sets as well. Copies are never expanded into pairs.

Words that more than HOT_WORD nodes share are left out for a node in a band where fewer of its words are such than are sure to be equal in
any partner (parts that it touches, less t), so one in a smaller group is left to every link; else it keeps all words of that band.

Defined cases: null and empty texts have no shingles and link with nothing; repeated rows are one node; rows without doc_id take part but
are never the smallest id unless all are (then null); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmart.llm import common

SHINGLE = 5
EQUAL_WORDS = 30
HOT_WORD = 1_000
BLOCK = 256
STAR_ROUNDS = 2
KNOWN_PAIRS = 200_000
BROADCAST_ROWS = 500_000
BAND = 1.5
C1, C2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def most_different(a, b):
    """The largest symmetric difference of sets of these sizes with 100 * common >= 80 * union."""
    return (a + b) - 2 * -(-(4 * (a + b)) // 9)


@cache
def band_of(size: int) -> int:
    return 0 if size <= 8 else math.ceil(math.log(size / 8) / math.log(BAND) - 1e-9)


@cache
def parts_of(band: int) -> tuple[int, int]:
    """Number of parts, and t for two sets of the band's largest size."""
    size = math.floor(8 * BAND**band)
    t, n = most_different(size, size), 1
    while n < 2 * t + 4 and n * math.exp(-t / n) < EQUAL_WORDS:
        n += 1
    return n, t


def shingle_sets(data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """For each row its distinct shingle hashes, ascending."""
    words, first = common.word_hashes(data, bounds, lower=True)
    windows, _ = common.window_hashes(words, first, SHINGLE)
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        if hi - lo >= SHINGLE:
            yield np.unique(windows[lo : hi - SHINGLE + 1])
        elif hi > lo:
            short = np.full(1, hi - lo, np.uint64)
            for k in range(lo, hi):
                short = common.mix(short * C1 + words[k : k + 1])
            yield short
        else:
            yield words[:0]


def node_of(items: np.ndarray) -> int:
    """A 64-bit id of the set."""
    return int(common.mix(np.add.reduce(common.mix(items ^ C2), keepdims=True) + np.uint64(len(items))).view(np.int64)[0])


def words_of(items: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The keys of the set's sketch words in its bands, and for bands of even and odd number how many touched parts any partner has equal.

    Untouched parts have no word, unless so many are that pigeonhole needs them. A set has at most two bands, next to each other; the lowest
    bit of a key is the band's."""
    size, out, sure = len(items), [], [0, 0]
    if most_different(size, size * 5 // 4) <= 0:
        return np.zeros(0, np.int64), sure
    for band in range(band_of(size), band_of(size * 5 // 4) + 1):
        n, t = parts_of(band)
        part = ((items >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
        begins = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        xor, part = np.bitwise_xor.reduceat(items, begins), part[begins]
        sure[band & 1] = max(0, len(part) - t)
        if n - len(part) >= n - t > 0:
            empty = np.setdiff1d(np.arange(n, dtype=np.uint64), part)
            xor, part = np.append(xor, np.zeros(len(empty), np.uint64)), np.append(part, empty)
        of_band = np.uint64((band * int(C2)) & (2**64 - 1))
        key = common.mix(common.mix(xor + part * C1) + of_band)
        out.append(key & ~np.uint64(1) | np.uint64(band & 1))
    return np.concatenate(out).view(np.int64), sure


def bits_of(items: np.ndarray) -> bytes:
    """A parity sketch of 2^k >= 4 * size bits, by the low bits of the hashes; halves XORed give the sketch of 2^(k-1) bits."""
    m = 1 << max(6, (4 * len(items) - 1).bit_length())
    return np.packbits(np.bincount((items & np.uint64(m - 1)).astype(np.int64), minlength=m).astype(np.uint8) & 1).tobytes()


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, key, n, node, bits, words, sure (see `words_of`); a task writes the words of a set once."""

    @common.trimmed
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for lo, hi, data, bounds in common.parts(batch):
                n, node, bits, words, sure = [], [], [], [], []
                for items in shingle_sets(data, bounds):
                    n.append(len(items))
                    node.append(node_of(items) if len(items) else None)
                    new = len(items) and node[-1] not in seen
                    seen.add(node[-1])
                    bits.append(bits_of(items) if new else None)
                    found = words_of(items) if new else (np.zeros(0, np.int64), None)
                    words.append(found[0])
                    sure.append(found[1])
                offsets = np.append(0, np.cumsum([len(w) for w in words])).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(words)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(bits, pa.binary()), keys, pa.array(sure, pa.list_(pa.int32()))],
                    names=["doc_id", "key", "n", "node", "bits", "words", "sure"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, key binary, n long, node long, bits binary, words array<long>, sure array<int>"
    return docs.select("doc_id", "text", common.text_key().alias("key")).mapInArrow(sketch, ddl)


def meetings(nodes: DataFrame) -> DataFrame:
    """word, node, first: the members of all words that two nodes or more share, and the smallest of them."""

    @common.trimmed
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = first = last = None
        shared = False
        for batch in batches:
            word, node = (batch.column(i).to_numpy() for i in (0, 1))
            keep = np.append(True, (word[1:] != word[:-1]) | (node[1:] != node[:-1]))
            if len(word) and key == word[0] and last == node[0]:
                keep[0] = False
            word, node = word[keep], node[keep]
            if not len(word):
                continue
            begins = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            count = np.diff(np.append(begins, len(word)))
            least = node[begins].copy()
            several = count > 1
            early = []
            if key == word[0]:
                if not shared:
                    early = [(key, first, first)]
                least[0], several[0] = first, True
            emit, head = np.repeat(several, count), np.repeat(least, count)
            key, first, last, shared = word[-1], least[-1], node[-1], bool(several[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.array([x[i] for x in early], np.int64), y[emit]])) for i, y in enumerate((word, node, head))],
                names=["word", "node", "first"],
            )

    exploded = nodes.select(F.explode("words").alias("word"), "node").repartition("word").sortWithinPartitions("word", "node")
    return exploded.mapInArrow(runs, "word long, node long, first long")


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that links (x, y) connect it with; only nodes that have links.

    Labels are lowered along links and then along themselves until none changes; every round is written to the shared folder."""
    both = common.stored(links.select("x", "y").union(links.select("y", "x")).distinct(), "links")
    labels = common.stored(both.groupBy(F.col("x").alias("node")).agg(F.least("node", F.min("y")).alias("root")), "labels")
    while True:
        near = both.join(labels, both["y"] == labels["node"]).groupBy("x").agg(F.min("root").alias("near"))
        lower = labels.join(near, labels["node"] == near["x"], "left").select(
            "node", F.col("root").alias("was"), F.least("root", "near").alias("root")
        )
        lower = common.stored(lower, "lower")
        up = lower.select(F.col("node").alias("at"), F.col("root").alias("up"))
        new = common.stored(
            lower.join(up, lower["root"] == up["at"], "left").select("node", "was", F.least("root", F.coalesce("up", "root")).alias("root")), "labels"
        )
        labels = new.select("node", "root")
        if not new.filter("root <> was").limit(1).count():
            return labels


def sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, items: the sets of the wanted nodes, read again from one document of each."""

    @common.trimmed
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, bounds in common.parts(batch, size=1 << 19):
                found = [(node_of(s), s.tobytes()) for s in shingle_sets(data, bounds) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary())], names=["node", "items"]
                )

    ids = nodes.filter("size(words) > 0").join(wanted, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("id")).select("id").distinct()
    ids = common.stored(ids, "wanted-ids")
    side = common.broadcast_up_to(ids, BROADCAST_ROWS)
    found = docs.select("doc_id", "text").join(side, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select("text")
    return found.mapInArrow(sets, "node long, items binary").join(wanted, "node", "left_semi").dropDuplicates(["node"])


def link(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two ascending sets have 100 * common >= 80 * union."""
    if len(a) < len(b):
        a, b = b, a
    at = np.minimum(a.searchsorted(b), len(a) - 1)
    both = int(np.count_nonzero(a[at] == b))
    return 100 * both >= 80 * (len(a) + len(b) - both)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (x, y) whose sets link."""

    @common.trimmed
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2), batch.column(3), strict=True)
            good = [link(*(np.frombuffer(v.as_py(), np.uint64) for v in ab)) for ab in both]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("node").alias("x"), F.col("items").alias("a"))
    right = sets.select(F.col("node").alias("y"), F.col("items").alias("b"))
    return pairs.join(left, "x").join(right, "y").select("x", "y", "a", "b").mapInArrow(check, "x long, y long")


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The packed parity sketch of fewer bits, `size` bytes."""
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def near(bits_x: np.ndarray, bits_y: np.ndarray) -> int:
    """Hamming distance of two packed parity sketches, the longer folded to the shorter."""
    size = min(len(bits_x), len(bits_y))
    return int(np.bitwise_count(folded(bits_x, size) ^ folded(bits_y, size)).sum())


def plausible(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """The pairs whose sizes and bit sketches allow a link; facts: node, n, bits."""

    @common.trimmed
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, n, m, a, b = (batch.column(i).to_pylist() for i in range(6))
            good = [
                5 * min(p, q) >= 4 * max(p, q)
                and near(np.frombuffer(u, np.uint8), np.frombuffer(v, np.uint8)) <= most_different(p, q)
                for p, q, u, v in zip(n, m, a, b, strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    left = facts.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("bits").alias("a"))
    right = facts.select(F.col("node").alias("y"), F.col("n").alias("ny"), F.col("bits").alias("b"))
    return pairs.join(left, "x").join(right, "y").select("x", "y", "nx", "ny", "a", "b").mapInArrow(check, "x long, y long")


def dealt(members: DataFrame) -> DataFrame:
    """word, cell, side, node, root: the members (word, node, root) of open groups in the cells where they meet.

    Every two members of different components meet in one cell of the word. Members of a cell with one side, if it isn't -1, needn't be
    compared there: they meet in another or are in one component."""
    counts = members.groupBy("word", "root").agg(F.count("*").alias("n")).groupBy("word")
    counts = counts.agg(F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("most")).select("word", "size", "most.*")
    counts = counts.select("word", "size", F.col("root").alias("major"), F.col("n").alias("majors"))
    counts = common.stored(counts, "group-counts")
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    rows = members.join(counts, "word").select(
        "word", "node", "root", (F.col("size") <= BLOCK).alias("whole"), (F.col("root") != F.col("major")).alias("minor"),
        blocks(F.col("size") - F.col("majors")).alias("minors"), blocks(F.col("majors")).alias("majors"),
    )
    own = F.pmod(F.xxhash64("node"), F.when(F.col("minor"), F.col("minors")).otherwise(F.col("majors")).cast("long")).cast("int")
    rows = rows.withColumn("own", own)

    def cell(kind, i, j, side):
        return F.struct(F.xxhash64("word", F.lit(kind), i, j).alias("cell"), side.cast("int").alias("side"))

    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    one = F.array(cell(0, F.lit(0), F.lit(0), F.lit(-1)))
    mine = F.col("own")
    each_other = F.transform(upto("minors"), lambda j: cell(1, F.least(mine, j), F.greatest(mine, j), F.when(j == mine, -1).otherwise(mine)))
    with_major = F.transform(upto("majors"), lambda j: cell(2, mine, j, F.lit(0)))
    from_major = F.transform(upto("minors"), lambda i: cell(2, i, mine, F.lit(1)))
    cells = F.when(F.col("whole"), one).when(F.col("minor"), F.concat(each_other, with_major)).otherwise(from_major)
    return rows.select("word", "node", "root", F.explode(cells).alias("of")).select("word", "of.cell", "of.side", "node", "root")


class Cell:
    """The members of one cell, and which of them may link."""

    def __init__(self, side: np.ndarray, root: np.ndarray, size: np.ndarray, bits: list[np.ndarray]):
        self.side, self.root, self.size = side, root.copy(), size
        shortest = min(map(len, bits))
        self.bits = np.array([folded(b, shortest) for b in bits])

    def partners(self, i: int) -> np.ndarray:
        """Later members of other components that may link with member i, nearest first."""
        j = np.arange(i + 1, len(self.size))
        small, large = np.minimum(self.size[j], self.size[i]), np.maximum(self.size[j], self.size[i])
        j = j[(self.root[j] != self.root[i]) & ((self.side[j] != self.side[i]) | (self.side[j] < 0)) & (5 * small >= 4 * large)]
        if not len(j):
            return j
        apart = np.bitwise_count(self.bits[j] ^ self.bits[i]).sum(axis=1, dtype=np.int64)
        fits = apart <= most_different(self.size[j], self.size[i])
        return j[fits][np.argsort(apart[fits], kind="stable")]


def by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each cell of a sorted stream, for cells with two rows or more."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        cell = table["cell"].to_numpy()
        cuts = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist()]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi - lo > 1:
                yield table.slice(lo, hi - lo)
        held = table.slice(cuts[-1]).to_batches()
    if held and sum(b.num_rows for b in held) > 1:
        yield pa.Table.from_batches(held).combine_chunks()


def still_open(cells: DataFrame, facts: DataFrame, first_only: bool = False) -> DataFrame:
    """The rows (word, cell, side, node, root) of members that may link with another component's in their cell, stored.

    first_only: a pair counts only under the smallest word whose group holds both. Each word in which both may link names both, so that
    word is found from the rows themselves."""

    @common.trimmed
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_cell(batches):
            side, root, size = (table[c].to_numpy() for c in ("side", "root", "n"))
            cell = Cell(side, root, size, [np.frombuffer(v.as_py(), np.uint8) for v in table["bits"].combine_chunks()])
            word = table["word"][0].as_py()
            smaller = [{w for w in v.as_py() if w < word} for v in table["words"].combine_chunks()] if first_only else None
            may = np.zeros(len(size), bool)
            for i in range(len(size) - 1):
                j = cell.partners(i)
                if smaller and smaller[i]:
                    j = np.array([k for k in j.tolist() if smaller[i].isdisjoint(smaller[k])], np.int64)
                may[j] = True
                may[i] |= len(j) > 0
            if may.any():
                yield from table.select(names).filter(pa.array(may)).to_batches()

    names, more = ["word", "cell", "side", "node", "root"], ["n", "bits"]
    rows = cells.join(facts, "node")
    if first_only:
        rows, more = rows.join(cells.groupBy("node").agg(F.collect_set("word").alias("words")), "node"), [*more, "words"]
    rows = rows.select(*names, *more).repartition("cell").sortWithinPartitions("cell", "node")
    return common.stored(rows.mapInArrow(compare, "word long, cell long, side int, node long, root long"), "open-members")


def largest_cells(members: DataFrame) -> DataFrame:
    """The rows of the cells that are the largest one of any of their members."""
    sizes = common.stored(members.groupBy("cell").agg(F.count("*").alias("size")), "cell-sizes")
    best = members.join(sizes, "cell").groupBy("node").agg(F.max(F.struct("size", "cell")).alias("best")).select("best.cell").distinct()
    return members.join(best, "cell", "left_semi")


def joined_in_cells(open_cells: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (x, y) that connect, within each cell, all components that any of its pairs connects."""

    @common.trimmed
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, int], bool] = {}
        for table in by_cell(batches):
            items = [np.frombuffer(v.as_py(), np.uint64) for v in table["items"].combine_chunks()]
            node, side, root = (table[c].to_numpy() for c in ("node", "side", "root"))
            cell = Cell(side, root, np.array([len(s) for s in items]), [np.frombuffer(bits_of(s), np.uint8) for s in items])
            found = []
            for i in range(len(items) - 1):
                for j in cell.partners(i).tolist():
                    if cell.root[i] == cell.root[j]:
                        continue
                    pair = (min(node[i], node[j]), max(node[i], node[j]))
                    linked = known.get(pair)
                    if linked is None:
                        if len(known) >= KNOWN_PAIRS:
                            known.clear()
                        linked = known[pair] = link(items[i], items[j])
                    if linked:
                        cell.root[cell.root == cell.root[j]] = cell.root[i]
                        found.append(pair)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["x", "y"])

    rows = open_cells.select("cell", "side", "node", "root").join(sets, "node")
    return rows.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(join, "x long, y long").distinct()


def links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (x, y) between nodes that are enough to connect every component. nodes: a stored result of `sketched`."""
    met = common.stored(meetings(nodes.filter("size(words) > 0")), "meetings")
    groups = met.groupBy("word").agg(F.count("*").alias("size"))
    hot = groups.filter(F.col("size") > HOT_WORD).select(F.col("word").alias("hot"))
    marked = met.join(hot, met["word"] == hot["hot"], "left")
    odd = F.col("word").bitwiseAND(F.lit(1)).cast("int")
    busy = marked.filter("hot IS NOT NULL").groupBy("node", odd.alias("odd")).agg(F.count("*").alias("busy"))
    own = nodes.filter("size(words) > 0").select("node", "sure").dropDuplicates(["node"])
    spared = busy.join(own, "node").filter("busy < sure[odd]").select(F.col("node").alias("spared"), "odd")
    met = marked.join(spared, (marked["node"] == spared["spared"]) & (odd == spared["odd"]), "left").filter("hot IS NULL OR spared IS NULL")
    met = common.stored(met.select("word", "node", "first"), "kept-meetings")

    used = met.select("node").union(met.select("first")).distinct()
    facts = nodes.filter("bits IS NOT NULL").select("node", "n", "bits").join(used, "node", "left_semi")
    facts = common.stored(facts.dropDuplicates(["node"]), "facts")

    def linked(pairs: DataFrame) -> DataFrame:
        """The links among plausible pairs."""
        wanted = pairs.select(F.col("x").alias("node")).union(pairs.select("y")).distinct()
        return common.stored(verified(pairs, common.stored(sets_of(docs, nodes, wanted), "sets")), "links")

    def open_groups(found: DataFrame) -> DataFrame:
        """word, node, root of the groups with several components, and a node of the first and the last component."""
        at = met.select("word", "node").join(components(found), "node", "left").withColumn("root", F.coalesce("root", "node"))
        at = common.stored(at, "placed-meetings")
        ends = at.groupBy("word").agg(
            F.count("*").alias("size"), F.min(F.struct("root", "node")).alias("lo"), F.max(F.struct("root", "node")).alias("hi")
        )
        return at.join(ends.filter("lo.root <> hi.root"), "word")

    often = met.filter("node <> first").select("node", F.col("first").alias("partner"))
    found = tried = None
    for _ in range(STAR_ROUNDS):
        often = often.groupBy("node", "partner").agg(F.count("*").alias("times"))
        best = often.groupBy("node").agg(F.max_by("partner", F.struct("times", "partner")).alias("partner"))
        pairs = best.select(F.least("node", "partner").alias("x"), F.greatest("node", "partner").alias("y")).distinct()
        pairs = common.stored(plausible(pairs if tried is None else pairs.join(tried, ["x", "y"], "left_anti"), facts), "pairs")
        new = linked(pairs)
        found, tried = (new, pairs) if found is None else (found.union(new), tried.union(pairs))
        open_now = open_groups(found)
        often = open_now.select("node", F.when(F.col("root") != F.col("lo.root"), F.col("lo.node")).otherwise(F.col("hi.node")).alias("partner"))

    def joined(cells: DataFrame) -> DataFrame:
        sets = common.stored(sets_of(docs, nodes, cells.select("node").distinct()), "sets")
        return common.stored(joined_in_cells(cells, sets), "links")

    members = still_open(dealt(open_now.select("word", "node", "root")), facts)
    found = found.union(joined(common.stored(largest_cells(members), "largest-cells")))
    placed_now = members.drop("root").join(components(found), "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed_now = common.stored(placed_now.select(*members.columns), "placed-members")
    return found.union(joined(still_open(placed_now, facts, first_only=True)))


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), n, node and root (of its component; null without shingles) for each row, stored."""
    nodes = common.stored(sketched(docs), "sketches")
    roots = components(links(docs, nodes))
    rooted = nodes.select("doc_id", "key", "n", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return common.stored(rooted, "placed")


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for each row."""
    rows = placed(docs).select("doc_id", "n", "root")
    least = rows.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"), F.count("*").alias("members")).filter("members > 1")
    out = rows.join(common.broadcast_up_to(common.stored(least.drop("members"), "group-ids"), BROADCAST_ROWS), "root", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def kept(docs: DataFrame) -> DataFrame:
    """The rows of docs, of each group only the one with the smallest doc_id (then text key); rows without shingles all stay."""
    rows = placed(docs).filter("root IS NOT NULL")
    times = rows.groupBy("root", "doc_id", "key").agg(F.count("*").alias("times"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "times")
    best = common.stored(times.groupBy("root").agg(F.min(order).alias("best")).select("best.*"), "group-heads")
    best = best.select(F.col("doc_id").alias("id"), F.col("key").alias("of"), "times")
    own = ("doc_id", "text")
    mine = common.packed(docs, *own)
    heads = mine.withColumn("key", common.text_key()).join(best, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("of")))
    has_word = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    once, again = heads.filter("times = 1"), heads.filter("times > 1").dropDuplicates(["doc_id", "key"])
    columns = [*own, "rest"]
    return common.unpacked(once.select(*columns).union(again.select(*columns)).union(mine.filter(~has_word)), docs.columns, *own)


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return grouped(docs).select("doc_id", "n_shingles", "component_id")
