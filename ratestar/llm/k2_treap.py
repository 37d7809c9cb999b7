"""A K2-treap: a quadtree over a grid of weighted points that holds each cell's largest weight.

Each cell keeps its heaviest point, which then is in none of the cells below it, so
weights fall from a cell to its children and most points lie near the root. A
cell is a mask of its four children (a bit each, the row's bit before the column's), the
difference of its weight to its parent's, and the point's place within the cell; cells of a
level stand in the order of a space-filling curve, so children follow from the
masks alone.

`best` answers for sets of weighted rows at once: which columns have the largest
sums of weighted points. All rows of a set descend together over ranges of columns;
the ranges with the largest bounds are opened first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ratestar.llm import chunks

#: Ranges of a set that are opened in one step.
OPENED = 16

_ONES = np.array([bin(i).count("1") for i in range(16)], dtype=np.int64)


def _spread(x: np.ndarray) -> np.ndarray:
    """The lower 32 bits with a zero before each."""
    x = x.astype(np.uint64)
    for shift, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(keep)
    return x


@dataclass
class Level:
    """The cells of one level in curve order."""

    masks: np.ndarray
    weights: np.ndarray
    rows: np.ndarray  # of the points, within their cells
    cols: np.ndarray


def build(rows: np.ndarray, cols: np.ndarray, weights: np.ndarray, height: int) -> list[Level]:
    """Levels of the treap of distinct points on a grid of 2^height rows and columns; none without points."""
    curve = _spread(rows) << np.uint64(1) | _spread(cols)
    order = np.argsort(curve, kind="stable")
    curve, rows, cols, weights = curve[order], rows[order], cols[order], weights[order].astype(np.int64)
    levels: list[Level] = []
    parents = np.empty(0, dtype=np.uint64)
    for depth in range(height + 1):
        if not len(curve):
            break
        shift = height - depth
        cells = curve >> np.uint64(2 * shift)
        starts = chunks.group_starts(cells)
        numbers = cells[starts]
        if levels:
            parent = np.searchsorted(parents, numbers >> np.uint64(2))
            np.bitwise_or.at(levels[-1].masks, parent, (1 << (numbers & np.uint64(3)).astype(np.uint8)).astype(np.uint8))
        # The heaviest point of each cell, the first of equals.
        top = np.maximum.reduceat(weights << 32 | np.arange(len(curve), 0, -1), starts)
        place = len(curve) - (top & 0xFFFFFFFF)
        inside = (1 << shift) - 1
        levels.append(Level(np.zeros(len(starts), np.uint8), weights[place], rows[place] & inside, cols[place] & inside))
        left = np.ones(len(curve), dtype=bool)
        left[place] = False
        curve, rows, cols, weights, parents = curve[left], rows[left], cols[left], weights[left], numbers
    return levels


def pack(levels: list[Level]) -> list[bytes]:
    """Four compressed byte strings a level."""
    out, above = [], None
    for level in levels:
        below = level.weights if above is None else np.repeat(above.weights, _ONES[above.masks]) - level.weights
        out += [chunks.pack(x) for x in (level.masks, below, level.rows, level.cols)]
        above = level
    return out


def unpack(parts: list[bytes]) -> list[Level]:
    levels: list[Level] = []
    for at in range(0, len(parts), 4):
        masks, below, rows, cols = (chunks.unpack(part) for part in parts[at:at + 4])
        weights = below.astype(np.int64)
        if levels:
            weights = np.repeat(levels[-1].weights, _ONES[levels[-1].masks]) - weights
        levels.append(Level(masks.astype(np.uint8), weights, rows.astype(np.int64), cols.astype(np.int64)))
    return levels


class Treap:
    """Cells of all levels one after the other, the points' places on the whole grid."""

    def __init__(self, levels: list[Level], height: int) -> None:
        self.height = height
        sizes = [len(level.masks) for level in levels]
        before = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        join = lambda parts: np.concatenate([np.empty(0, np.int64), *parts])
        self.masks = join(level.masks.astype(np.int64) for level in levels)
        self.weights = join(level.weights for level in levels)
        self.first = join(before[i + 1] + np.cumsum(_ONES[level.masks]) - _ONES[level.masks] for i, level in enumerate(levels))
        rows, cols = [], []
        corner_rows = corner_cols = np.zeros(1, dtype=np.int64)
        for depth, level in enumerate(levels):
            rows.append(corner_rows + level.rows)
            cols.append(corner_cols + level.cols)
            half = 1 << height - depth >> 1
            bits = level.masks[:, None] >> np.arange(4, dtype=np.uint8) & 1
            cell, child = np.nonzero(bits)
            corner_rows = corner_rows[cell] + (child >> 1) * half
            corner_cols = corner_cols[cell] + (child & 1) * half
        self.rows, self.cols = join(rows), join(cols)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


class _Pool:
    """A growing table of integers."""

    def __init__(self, width: int) -> None:
        self.data, self.size = np.empty((1024, width), dtype=np.int64), 0

    def add(self, rows: np.ndarray) -> int:
        """Appends rows; the place of the first."""
        begin, self.size = self.size, self.size + len(rows)
        if self.size > len(self.data):
            self.data = np.concatenate([self.data[:begin], np.empty((self.size, self.data.shape[1]), np.int64)])
        self.data[begin:self.size] = rows
        return begin


def best(treap: Treap, cols: int, sets: int, of: np.ndarray, rows: np.ndarray, factors: np.ndarray, k: int,
         floors: np.ndarray, opened: int = OPENED) -> np.ndarray:
    """Sums over each set's rows of factor times weight, for each set and column, exact wherever one is among the k best.

    A set's entries are the places where `of` has its number; floors are sums that a set
    has reached elsewhere k times. A sum is exact if it is at least the larger of the set's floor and its
    k-th largest sum; others may be too small. Integers of 64 bits throughout.
    """
    width = max(1, (cols - 1).bit_length())
    sums = np.zeros((sets, 1 << width), dtype=np.int64)
    if not len(treap.masks) or not len(rows):
        return sums[:, :cols]
    floors = np.maximum(floors, 1)
    paths, nodes = _Pool(2), np.empty((0, 6), dtype=np.int64)  # (entry, cell); (bound, set, level, column, first path, paths)

    def enter(of_set: np.ndarray, level: np.ndarray, col: np.ndarray, counts: np.ndarray, entry: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """New ranges with their paths: adds the points met, and gives those still open with their bounds."""
        part = treap.weights[cell] * factors[entry]
        met = treap.rows[cell] == rows[entry]
        np.add.at(sums, (of[entry[met]], treap.cols[cell[met]]), part[met])
        bound = np.add.reduceat(part, np.cumsum(counts) - counts)
        for depth in np.unique(level):
            own = np.flatnonzero(level == depth)
            span = min(treap.height - int(depth), width)
            bound[own] += sums.reshape(sets, -1, 1 << span)[of_set[own], col[own]].max(axis=1)
        begin = paths.add(np.stack([entry, cell], axis=1))
        found = np.stack([bound, of_set, level, col, begin + np.cumsum(counts) - counts, counts], axis=1)
        return found[(level < treap.height) & (bound >= floors[of_set])]

    entries = np.argsort(of, kind="stable")
    starts = chunks.group_starts(of[entries])
    counts = np.diff(np.append(starts, len(entries)))
    zeros = np.zeros(len(starts), dtype=np.int64)
    nodes = enter(of[entries[starts]], zeros, zeros, counts, entries, np.zeros(len(entries), np.int64))
    while len(nodes):
        # The best few ranges of each set.
        nodes = nodes[np.lexsort((-nodes[:, 0], nodes[:, 1]))]
        starts = chunks.group_starts(nodes[:, 1])
        rank = np.arange(len(nodes)) - np.repeat(starts, np.diff(np.append(starts, len(nodes))))
        chosen, nodes = nodes[rank < opened], nodes[rank >= opened]
        path = paths.data[_ranges(chosen[:, 4], chosen[:, 5])]
        node = np.repeat(np.arange(len(chosen)), chosen[:, 5])
        entry, cell = path[:, 0], path[:, 1]
        upper = rows[entry] >> (treap.height - chosen[node, 2] - 1) & 1
        mask = treap.masks[cell]
        fresh = [nodes]
        for side in (0, 1):
            child = 2 * upper + side
            there = np.flatnonzero(mask >> child & 1)
            if not len(there):
                continue
            below = treap.first[cell[there]] + _ONES[mask[there] & (1 << child[there]) - 1]
            starts = chunks.group_starts(node[there])
            parent = chosen[node[there][starts]]
            counts = np.diff(np.append(starts, len(there)))
            fresh.append(enter(parent[:, 1], parent[:, 2] + 1, 2 * parent[:, 3] + side, counts, entry[there], below))
        nodes = np.concatenate(fresh)
        # What a set has reached k times bounds all that may still be left out.
        touched = np.unique(chosen[:, 1])
        if k <= cols:
            floors[touched] = np.maximum(floors[touched], np.partition(sums[touched, :cols], cols - k, axis=1)[:, cols - k])
        nodes = nodes[nodes[:, 0] >= floors[nodes[:, 1]]]
    return sums[:, :cols]
