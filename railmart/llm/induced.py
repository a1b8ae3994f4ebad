"""Suffix order of one shard by external induced sorting, with common-prefix values.

Suffixes that start a descent-to-ascent turn (LMS) are named by an induced pass, ordered by recursion on their names, and then induce all
others: queues by first symbol hand out suffix tuples (position, common prefix with the one before) from the smallest symbol up for the
descending suffixes, and from the largest down for the ascending ones. A tuple that is taken out sends its left neighbour to a queue, with
a common prefix one longer than the least value since the queue's last entry. Queues beyond MEMORY bytes lie on disk in chunks, and one
chunk at a time is worked on, so a shard may be far larger than memory; the text itself may be a memory map.

Common prefixes are exact up to `cap` and stop there.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

MEMORY = 128 << 20
CHUNK = 1 << 20
PAIRS = 1 << 14
SMALL_ALPHABET = 2_000
BYTE_ENDS = np.uint64(1) << np.arange(8, 64, 8, dtype=np.uint64)


def place_kind(n: int) -> type:
    """The smallest integers that hold the places of a text of n symbols."""
    return np.int32 if n < 2**31 - 1 else np.int64


class Queues:
    """First-in-first-out queues of (position, common prefix) by symbol; what does not fit into `memory` bytes goes to one temporary file."""

    def __init__(self, memory: int = MEMORY):
        self.held: dict[int, list] = {}
        self.memory, self.used, self.file, self.kind = memory, 0, None, np.dtype(np.int64)

    def put(self, symbol: int, position: np.ndarray, prefix: np.ndarray) -> None:
        size = position.nbytes + prefix.nbytes
        if self.used + size > self.memory:
            self.file, self.kind = self.file or tempfile.TemporaryFile(), position.dtype
            at = self.file.seek(0, 2)
            self.file.write(position.tobytes() + prefix.tobytes())
            self.held.setdefault(symbol, []).append((at, len(position)))
        else:
            self.used += size
            self.held.setdefault(symbol, []).append((position, prefix))

    def take(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Chunks in order, with those that come in while it runs."""
        row = self.held.setdefault(symbol, [])
        while row:
            got, n = [], 0
            while row and n < CHUNK:
                a, b = row.pop(0)
                if isinstance(a, np.ndarray):
                    self.used -= a.nbytes + b.nbytes
                else:
                    self.file.seek(a)
                    raw = self.file.read(b * (self.kind.itemsize + 2))
                    a, b = np.frombuffer(raw, self.kind, b), np.frombuffer(raw, np.uint16, b, self.kind.itemsize * b)
                got.append((a, b))
                n += len(a)
            yield (np.concatenate([a for a, _ in got]), np.concatenate([b for _, b in got])) if len(got) > 1 else got[0]

    def close(self) -> None:
        if self.file:
            self.file.close()


def ascending(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the end is smaller than any symbol."""
    up = np.zeros(len(text), bool)
    np.less(text[:-1], text[1:], out=up[:-1])
    differs = np.ones(len(text), bool)
    np.not_equal(text[:-1], text[1:], out=differs[:-1])
    turns = np.flatnonzero(differs)
    return np.repeat(up[turns], np.diff(turns, prepend=-1))


def words_at(text: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place of a text of 8 bytes or more, the first as the lowest of a number; what lies behind the end is undefined."""
    last = len(text) - 8
    found = np.ndarray(last + 1, "<u8", text, strides=(1,))[np.minimum(place, last)]
    if place.max(initial=0) > last:
        found >>= (np.clip(place - last, 0, 7) * 8).astype(np.uint64)
    return found


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int | np.ndarray) -> np.ndarray:
    """Common prefixes of suffix pairs up to cap, one for all or one for each, some pairs after others.

    Bytes are compared 8, 16, 32 ... at a time as words, other symbols 4, 8, 16 ... at a time."""
    out, n = np.zeros(len(a), np.uint16), len(text)
    size = 8 if text.dtype == np.uint8 else 1
    if size == 8:
        text = np.ascontiguousarray(text) if n >= 8 else np.append(text, np.zeros(8, np.uint8))
    for at in range(0, len(a), PAIRS):
        i, j = a[at : at + PAIRS].astype(np.int64), b[at : at + PAIRS].astype(np.int64)
        most = np.minimum(cap if np.isscalar(cap) else cap[at : at + PAIRS], n - np.maximum(i, j))
        found = np.zeros(len(i), np.int64)
        live, width = np.flatnonzero(most > 0), 4 // size or 1
        while len(live):
            step = found[live][:, None] + np.arange(width) * size
            p, q = i[live][:, None] + step, j[live][:, None] + step
            apart = words_at(text, p) ^ words_at(text, q) if size == 8 else text[np.minimum(p, n - 1)] ^ text[np.minimum(q, n - 1)]
            column = (apart != 0).argmax(axis=1)
            first = apart[np.arange(len(live)), column]
            run = np.where(first != 0, column, width) * size
            if size == 8:
                run += np.where(first != 0, np.searchsorted(BYTE_ENDS, first & (~first + np.uint64(1)), side="right"), 0)
            found[live] = np.minimum(found[live] + run, most[live])
            live = live[(first == 0) & (found[live] < most[live])]
            width = min(width * 2, 64 // size)
        out[at : at + PAIRS] = found
    return out


def least_between(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(values[lo:hi]) for ranges that are not empty, by a sparse table."""
    out, width = np.empty(len(lo), values.dtype), hi - lo
    level, table = 0, values
    order = np.argsort(width, kind="stable")
    bound = np.searchsorted(width[order], 1 << np.arange(0, 64 - 2))
    while 1 << level <= (width[order[-1]] if len(order) else 0):
        at = order[bound[level] : bound[level + 1]]
        out[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << level)])
        half = 1 << level
        if len(table) <= half:
            break
        table = np.minimum(table[:-half], table[half:])
        level += 1
    return out


class Pass:
    """One scan: sends left neighbours of taken suffixes to the queues of their first symbols."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, symbols: int, cap: int, queues: Queues):
        self.text, self.wanted, self.cap, self.queues = text, wanted, cap, queues
        self.since = np.zeros(symbols, np.uint16)

    def send(self, position: np.ndarray, prefix: np.ndarray) -> None:
        """prefix[k]: common prefix with the suffix taken just before."""
        if not len(position):
            return
        before = position - 1
        ok = np.flatnonzero((before >= 0) & self.wanted[before])
        symbol = self.text[before[ok]].astype(np.int64)
        order = np.argsort(symbol.astype(np.uint8) if len(self.since) <= 256 else symbol, kind="stable")
        ok, symbol = ok[order], symbol[order]
        begins = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1])) if len(symbol) else np.zeros(0, np.int64)
        if not self.cap:
            value = np.zeros(len(ok), np.uint16)
        else:
            lo = np.empty(len(ok), np.int64)
            lo[1:] = ok[:-1] + 1
            if len(begins):
                lo[begins] = 0
            value = least_between(prefix, lo, ok + 1)
            if len(begins):
                value[begins] = np.minimum(value[begins], self.since[symbol[begins]])
            value = np.minimum(value + 1, self.cap).astype(np.uint16)
            self.since = np.minimum(self.since, prefix.min())
            if len(ok):
                ends = np.append(begins[1:], len(symbol)) - 1
                tail = ok[ends] + 1
                rest = np.full(len(ends), self.cap, np.uint16)
                inner = tail < len(prefix)
                rest[inner] = least_between(prefix, tail[inner], np.full(inner.sum(), len(prefix)))
                self.since[symbol[begins]] = rest
        for k, begin in enumerate(begins):
            end = begins[k + 1] if k + 1 < len(begins) else len(symbol)
            for at in range(begin, end, CHUNK):
                cut = slice(at, min(at + CHUNK, end))
                self.queues.put(int(symbol[begin]), before[ok[cut]], value[cut])


def induced(text: np.ndarray, symbols: int, up: np.ndarray, turns: np.ndarray, cap: int, memory: int) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in the order that the turns, given in order, induce, and the common prefix of each with the one before.

    With cap 0 no prefixes are kept."""
    turns = turns.astype(place_kind(len(text)), copy=False)
    first = text[turns]
    starts = np.searchsorted(first, np.arange(symbols + 1))
    turn_prefix = np.zeros(len(turns), np.uint16)
    if cap and len(turns):
        turn_prefix[1:] = common_prefix(text, turns[:-1], turns[1:], cap)
    queues = Queues(memory)
    scan = Pass(text, ~up, symbols, cap, queues)
    down: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(symbols)]
    edge = np.zeros(1, np.uint16)
    end = np.array([len(text)], turns.dtype)
    scan.send(end, edge)
    for c in range(symbols):
        last = None
        for position, prefix in queues.take(c):
            prefix = prefix if last is not None else np.append(edge, prefix[1:])
            down[c].append((position, prefix))
            scan.send(position, prefix)
            last = position[-1]
        lo, hi = starts[c], starts[c + 1]
        if hi > lo:
            prefix = turn_prefix[lo:hi].copy()
            prefix[0] = common_prefix(text, np.array([last]), turns[lo : lo + 1], cap)[0] if cap and last is not None else 0
            scan.send(turns[lo:hi], prefix)
    queues.close()

    queues = Queues(memory)
    scan = Pass(text, up, symbols, cap, queues)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for c in range(symbols - 1, -1, -1):
        last, mine = None, []
        for position, prefix in queues.take(c):
            prefix = prefix if last is not None else np.append(edge, prefix[1:])
            mine.append((position, prefix))
            scan.send(position, prefix)
            last = position[-1]
        for k, (position, prefix) in enumerate(reversed(down[c])):
            position = position[::-1]
            after = np.append(edge, prefix[:0:-1])
            if k:
                after[0] = carried
            elif cap and last is not None:
                after[0] = common_prefix(text, np.array([last]), position[:1], cap)[0]
            carried = prefix[0]
            mine.append((position, after))
            scan.send(position, after)
        down[c] = []
        out += mine
    queues.close()
    n = sum(len(p) for p, _ in out)
    position, after = np.empty(n, turns.dtype), np.empty(n + 1, np.uint16)
    after[:1] = edge
    while out:  # the last come first
        p, v = out.pop(0)
        position[n - len(p) : n], after[n - len(p) + 1 : n + 1] = p[::-1], v[::-1]
        n -= len(p)
    return position, after[:-1]


def names_of(text: np.ndarray, turns: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the turns' substrings by rank; turns: in the order of their substrings, place: in the order of the text."""
    length = np.empty(len(text) + 1, place_kind(len(text)))
    length[place] = np.diff(place, append=len(text)) + 1
    a, b = turns[:-1], turns[1:]
    same = length[a] == length[b]
    live = np.flatnonzero(same)
    found = common_prefix(text, a[live], b[live], np.minimum(length[a[live]], 1 << 15))
    same[live] = (found >= np.minimum(length[a[live]], 1 << 15)) & (length[a[live]] < 1 << 15) & (a[live] + length[a[live]] <= len(text))
    same[live] &= b[live] + length[b[live]] <= len(text)
    name = np.append(0, np.cumsum(~same))
    by_place = np.empty(len(text), length.dtype)
    by_place[turns] = name
    return by_place[place].astype(np.int64), int(name[-1]) + 1


def doubled(text: np.ndarray, reach: int) -> np.ndarray:
    """Order by the first `reach` symbols at least: ranks of 1, 2, 4 ... symbols. The base of the recursion.

    A rank is the place of the first suffix that equals so far, so only suffixes that still have equals are sorted again."""
    n, width = len(text), 1
    order = np.argsort(text, kind="stable")
    key = text[order].astype(np.int64)
    rank, at = np.zeros(n + 1, np.int64), np.arange(n)
    while True:
        new = np.append(True, key[1:] != key[:-1])
        begin = np.flatnonzero(new)
        rank[order[at]] = np.repeat(at[begin] + 1, np.diff(begin, append=len(at)))
        at = at[~(new & np.append(new[1:], True))]
        if not len(at) or width >= reach:
            return order
        some = order[at]
        key = rank[some] * (n + 1) + rank[np.minimum(some + width, n)]
        turn = np.argsort(key)
        order[at], key = some[turn], key[turn]
        width *= 2


def suffix_order(text: np.ndarray, symbols: int, cap: int, memory: int = MEMORY, reach: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of text (numbers under `symbols`) in order, and common prefixes with the one before, up to cap.

    Suffixes that agree on the first `reach` symbols (default: cap) may come in any order."""
    reach = cap if reach is None else reach
    if not len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.uint16)
    up = ascending(text)
    place = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    order = place[np.argsort(text[place], kind="stable")]
    if len(place) > 1:
        rough, _ = induced(text, symbols, up, order, 0, memory)
        is_turn = np.zeros(len(text), bool)
        is_turn[place] = True
        order = rough[is_turn[rough]]
        del rough, is_turn
        names, n = names_of(text, order, place)
        if n < len(place):
            if n <= SMALL_ALPHABET:
                inner, _ = suffix_order(names, n, 0, memory, reach)
            else:
                inner = doubled(names, reach)
            order = place[inner]
    return induced(text, symbols, up, order, cap, memory)
