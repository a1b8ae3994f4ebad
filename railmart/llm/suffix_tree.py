"""Suffix trees of number sequences, and the common-prefix lengths of their suffixes in constant time."""

from __future__ import annotations

import numpy as np


def edges_of(s: list[int]) -> tuple[np.ndarray, np.ndarray, list[int], list[int]]:
    """Ukkonen's tree of s, whose last number occurs nowhere else.

    Returns the keys of all edges (node * base + first number, base being the largest number + 1), the nodes that they lead to, and for each
    node the bounds of its edge's label in s."""
    n, base = len(s), max(s) + 1
    start, end, link = [0], [0], [0]
    edges: dict[int, int] = {}
    node = edge = length = left = 0
    for i, c in enumerate(s):
        left += 1
        inner = 0
        while left:
            if not length:
                edge = i
            key = node * base + s[edge]
            child = edges.get(key)
            if child is None:
                edges[key] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                if inner:
                    link[inner], inner = node, 0
            else:
                size = min(end[child], i + 1) - start[child]
                if length >= size:
                    edge, length, node = edge + size, length - size, child
                    continue
                middle = start[child] + length
                if s[middle] == c:
                    length += 1
                    if inner:
                        link[inner] = node
                    break
                fork = len(start)
                start += [start[child], i]
                end += [middle, n]
                link += [0, 0]
                start[child] = middle
                edges[key] = fork
                edges[fork * base + c] = fork + 1
                edges[fork * base + s[middle]] = child
                if inner:
                    link[inner] = fork
                inner = fork
            left -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - left + 1
    keys = np.fromiter(edges.keys(), np.int64, len(edges))
    children = np.fromiter(edges.values(), np.int64, len(edges))
    return keys, children, start, end


def tour(s: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The leaves of the tree by order of their suffixes, and between each leaf and the one before it the length of the label of their lowest
    common ancestor: an Euler tour of which only the shallowest node between two leaves is kept."""
    n = len(s)
    keys, children, start, end = edges_of(s)
    order = np.argsort(keys)
    of = keys[order] // (max(s) + 1)
    first = np.searchsorted(of, np.arange(len(start) + 1)).tolist()
    children = children[order].tolist()
    leaves, between = [], []
    lowest = 0
    stack = [(children[e], 0, e > 0) for e in range(first[1] - 1, -1, -1)]
    while stack:
        node, depth, again = stack.pop()
        if again:
            lowest = depth
        depth += end[node] - start[node]
        if first[node] == first[node + 1]:
            leaves.append(n - depth)
            between.append(lowest)
        else:
            stack += [(children[e], depth, e > first[node]) for e in range(first[node + 1] - 1, first[node] - 1, -1)]
    return np.array(leaves, np.int64), np.array(between, np.int32)


class CommonPrefixes:
    """Lengths of the common prefixes of suffixes of s: least values over ranges of the tour, from a table of all powers of two."""

    def __init__(self, s: list[int]):
        """s ends with a number that occurs nowhere else."""
        leaves, row = tour(s)
        self.rank = np.empty(len(s), np.int64)
        self.rank[leaves] = np.arange(len(s))
        self.rows = [row]
        while 2 << (len(self.rows) - 1) <= len(s):
            half = 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(self.rows[-1][:-half], self.rows[-1][half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The common-prefix lengths of the suffixes at i and at j, which must differ."""
        lo, hi = np.minimum(self.rank[i], self.rank[j]) + 1, np.maximum(self.rank[i], self.rank[j]) + 1
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.rows[k][lo[at]], self.rows[k][hi[at] - (1 << int(k))])
        return out
