"""A hierarchical index over fingerprints in Gray order, for groups of near ones.

Fingerprints that follow each other by Gray rank share many bits. A leaf covers a run of them,
an upper node a run of nodes below. A node keeps the bits all its fingerprints agree on, less
those its ancestors keep already. A search goes down with the number of differences found so far,
adds those of each node's own bits, and leaves a whole group as soon as there are too many.

Everything works on arrays: many indexes side by side, one per cell, and many searches at once.
"""

from __future__ import annotations

import numpy as np

LEAF = 16
FANOUT = 16
# Pairs of search and node looked at in one go.
PAIRS_AT_ONCE = 1 << 20


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each 64-bit code in the Gray sequence."""
    ranks = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        ranks = ranks ^ (ranks >> np.uint64(shift))
    return ranks


def gray_code(ranks: np.ndarray) -> np.ndarray:
    ranks = ranks.astype(np.uint64)
    return ranks ^ (ranks >> np.uint64(1))


class GrayForest:
    """Indexes of consecutive cells; ``starts`` are the first rows of the cells, ``codes`` their
    fingerprints in Gray order within each cell."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray) -> None:
        self.codes = codes
        stops = np.append(starts[1:], len(codes))
        self.cell_of_row = np.repeat(np.arange(len(starts)), stops - starts)
        # From the leaves up: for each level, nodes as (first child, child after the last, first
        # row after the node), bits agreed on, and their values.
        self.levels: list[tuple[np.ndarray, ...]] = []
        ones, zeros = codes, codes
        first, last = starts, stops
        rows_end = np.arange(1, len(codes) + 1)
        width = LEAF
        while True:
            counts = -(-(last - first) // width)
            begin = np.concatenate(([0], np.cumsum(counts)[:-1]))
            inner = np.arange(counts.sum()) - np.repeat(begin, counts)
            lo = np.repeat(first, counts) + inner * width
            hi = np.minimum(lo + width, np.repeat(last, counts))
            ones, zeros = np.bitwise_and.reduceat(ones, lo), np.bitwise_or.reduceat(zeros, lo)
            rows_end = rows_end[hi - 1]
            self.levels.append((lo, hi, rows_end, ~(ones ^ zeros), ones))
            first, last, width = begin, begin + counts, FANOUT
            if counts.max(initial=0) <= 1:
                break
        # Bits kept by a node and not by its parent; the leaves' rest is the rows' own.
        own = [level[3] for level in self.levels]
        self.rest = ~own[0]
        for below in range(len(self.levels) - 1):
            lo, hi = self.levels[below + 1][:2]
            own[below] = own[below] & ~np.repeat(self.levels[below + 1][3], hi - lo)
        self.own = own

    def near(self, queries: np.ndarray, most: int, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query row, later row of its cell) that differ in at most ``most`` bits.

        Pairs whose rows have the same label already are left out.
        """
        query = queries
        node = self.cell_of_row[queries]
        so_far = np.zeros(len(queries), np.uint8)
        for depth in range(len(self.levels) - 1, -1, -1):
            lo, hi, rows_end, _, values = self.levels[depth]
            so_far = so_far + np.bitwise_count(
                (self.codes[query] ^ values[node]) & self.own[depth][node]
            )
            kept = (so_far <= most) & (rows_end[node] > query + 1)
            query, node, so_far = query[kept], node[kept], so_far[kept]
            rest = self.rest[node] if depth == 0 else None
            counts = hi[node] - lo[node]
            child = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            child = child + np.repeat(lo[node], counts)
            query, so_far = np.repeat(query, counts), np.repeat(so_far, counts)
            if depth:
                node = child
            else:
                rest = np.repeat(rest, counts)
                new = (child > query) & (labels[child] != labels[query])
                query, child, so_far, rest = query[new], child[new], so_far[new], rest[new]
                total = so_far + np.bitwise_count((self.codes[query] ^ self.codes[child]) & rest)
                close = total <= most
                return query[close], child[close]
        raise AssertionError("an index has a level of leaves")


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Give joined rows the smallest label of their group."""
    while len(a):
        la, lb = labels[a], labels[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        if not len(a):
            break
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels = up
    return labels


def group_cells(codes: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
    """For each row, the first row of its group: rows of a cell linked by ``most`` or fewer bits.

    Links are found by search and not kept: a group of n rows needs n numbers, however many links
    it has.
    """
    labels = np.arange(len(codes))
    if not len(codes):
        return labels
    forest = GrayForest(codes, starts)
    sizes = np.diff(np.append(starts, len(codes)))
    later = np.repeat(starts + sizes, sizes) - np.arange(len(codes)) - 1
    queries = np.flatnonzero(later)
    work = np.cumsum(later[queries])
    at = 0
    while at < len(queries):
        base = work[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(work, base + PAIRS_AT_ONCE)))
        labels = _merge(labels, *forest.near(queries[at:to], most, labels))
        at = to
    return labels
