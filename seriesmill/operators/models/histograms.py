"""Regression trees grown on histograms of binned features, all folds side by side.

A row is one byte for each feature. What a level of a tree needs of the rows are counts
and sums per fold, node, feature and bin, so they can be added up anywhere: in one
task, if the rows are few, or by one aggregation over all of them for each level. Targets are whole
numbers of a small unit, so sums are exact and the trees the same either way. A row
serves every fold that may learn from it; it is never copied.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bins of known values; one more stands for missing ones.
BINS = 64
#: Nodes whose cells travel as one row.
_NODES = 64
_POISSON = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880)])


@dataclass(frozen=True)
class Spec:
    """What to grow. ``boosted`` trees follow each other, others are independent on resampled rows."""

    trees: int
    depth: int
    min_leaf: int
    boosted: bool
    rate: float = 1.0
    max_leaves: int | None = None


@dataclass
class Trees:
    """Trees as heaps (root 1, children 2i and 2i + 1), an array row for each fold.

    ``feature`` is -1 at a leaf; a row goes left if its bin is at most ``cut``, or missing and ``left``.
    """

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def leaves(self, fold: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row; ``bins`` is (features, rows)."""
        node = np.ones(bins.shape[1], np.int64)
        at = np.arange(bins.shape[1])
        for _ in range(self.feature.shape[1].bit_length() - 2):
            f = self.feature[fold, node]
            inner = f >= 0
            if not inner.any():
                break
            x = bins[np.maximum(f, 0), at]
            go_left = np.where(x == BINS, self.left[fold, node], x <= self.cut[fold, node])
            node = np.where(inner, 2 * node + ~go_left, node)
        return node


def binned(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The bin of each value: the number of cuts below it; ``BINS`` where it is missing."""
    out = np.searchsorted(cuts, values, "left").astype(np.uint8)
    out[np.isnan(values)] = BINS
    return out


def _cells(bins: np.ndarray, row: np.ndarray, node: np.ndarray, weight: np.ndarray | None, value: np.ndarray, n: int) -> np.ndarray:
    """Counts and sums: (2, nodes, features, bins)."""
    wide = BINS + 1
    out = np.zeros((2, n, len(bins), wide), np.int64)
    base = node * wide
    for f in range(len(bins)):
        cell = base + bins[f, row]
        out[0, :, f] = np.bincount(cell, weight, n * wide).reshape(n, wide)
        out[1, :, f] = np.bincount(cell, value, n * wide).reshape(n, wide)
    return out


def _best(cells: np.ndarray, min_leaf: int) -> tuple[np.ndarray, ...]:
    """The best split of each node: gain, feature, cut, side of missing values, rows and sum on the left and in all."""
    counts, sums = cells.astype(float)
    below = [x[:, :, :BINS].cumsum(axis=2)[:, :, :-1] for x in (counts, sums)]
    lost = [x[:, :, BINS:] for x in (counts, sums)]
    all_rows, all_sum = (x.sum(axis=2, keepdims=True) for x in (counts, sums))
    gains = []
    for side in (0.0, 1.0):
        rows, total = below[0] + side * lost[0], below[1] + side * lost[1]
        other = all_rows - rows
        ok = (rows >= min_leaf) & (other >= min_leaf)
        apart = total**2 / np.maximum(rows, 1) + (all_sum - total) ** 2 / np.maximum(other, 1)
        gain = apart - all_sum**2 / np.maximum(all_rows, 1)
        gains.append(np.where(ok & (gain > 1e-10 * apart), gain, -1.0))
    gain = np.stack(gains, axis=-1)
    nodes, features, cuts = gain.shape[:3]
    flat = gain.reshape(nodes, -1)
    where = flat.argmax(axis=1)
    at = np.arange(nodes)
    feature, rest = np.divmod(where, cuts * 2)
    cut, side = np.divmod(rest, 2)
    rows = below[0][at, feature, cut] + side * lost[0][at, feature, 0]
    total = below[1][at, feature, cut] + side * lost[1][at, feature, 0]
    # Where nothing was missing, missing values go with the more rows.
    left = np.where(lost[0][at, feature, 0] > 0, side == 1, 2 * rows >= all_rows[at, feature, 0])
    return flat[at, where], feature, cut, left, rows, total, all_rows[:, 0, 0], all_sum[:, 0, 0]


class Growth:
    """Trees of all folds in the making: splits so far and the nodes that can still be split."""

    def __init__(self, folds: int, spec: Spec):
        size = 2 << spec.depth
        self.spec, self.depth = spec, 0
        self.feature, self.cut = np.full((folds, size), -1, np.int8), np.zeros((folds, size), np.uint8)
        self.left, self.gain = np.zeros((folds, size), bool), np.zeros((folds, size))
        self.rows, self.sums = np.zeros((folds, size)), np.zeros((folds, size))
        #: Fold and place of each active node.
        self.of, self.heap = np.arange(folds), np.ones(folds, np.int64)

    @property
    def done(self) -> bool:
        return self.depth >= self.spec.depth or not len(self.of)

    def number(self) -> np.ndarray:
        """(folds, nodes): the number of an active node, -1 for others."""
        out = np.full(self.feature.shape, -1)
        out[self.of, self.heap] = np.arange(len(self.of))
        return out

    def split(self, found: tuple[np.ndarray, ...]) -> None:
        """Takes the best split of each active node, as ``_best`` gives them, and goes a level down."""
        gain, f, c, side, n_left, s_left, all_rows, all_sum = found
        of, heap = self.of, self.heap
        if not self.depth:
            self.rows[of, heap], self.sums[of, heap] = all_rows, all_sum
        ok = gain > 0
        at = (of[ok], heap[ok])
        self.feature[at], self.cut[at], self.left[at], self.gain[at] = f[ok], c[ok], side[ok], gain[ok]
        down, right = (of[ok], 2 * heap[ok]), (of[ok], 2 * heap[ok] + 1)
        self.rows[down], self.sums[down] = n_left[ok], s_left[ok]
        self.rows[right], self.sums[right] = self.rows[at] - n_left[ok], self.sums[at] - s_left[ok]
        # Children that can be split go on.
        children = np.stack((2 * heap, 2 * heap + 1), axis=1)
        more = ok[:, None] & (self.rows[of[:, None], children] >= 2 * self.spec.min_leaf)
        self.of, self.heap = np.repeat(of, 2)[more.ravel()], children[more]
        self.depth += 1

    def trees(self) -> Trees:
        """As they are, with means for values."""
        return Trees(self.feature, self.cut, self.left, self.sums / np.maximum(self.rows, 1), self.gain)

    def finished(self, unit: np.ndarray) -> Trees:
        """Cut back to the leaves allowed, in the units of the targets."""
        trees = self.trees()
        for k in range(len(trees.feature)):
            _settle(trees, k, self.spec.max_leaves)
        trees.value /= unit[:, None]
        trees.gain /= unit[:, None] ** 2
        return trees


def grow(
    bins: np.ndarray, row: np.ndarray, fold: np.ndarray, value: np.ndarray, weight: np.ndarray | None, growth: Growth
) -> np.ndarray:
    """Grows one tree for each fold from rows at hand, and returns the node each entry ends in.

    An entry is a row (``row``, of ``bins``) that a fold learns from, with its whole-number ``value``.
    """
    node = np.ones(len(row), np.int64)
    held, index = np.arange(len(row)), fold
    while not growth.done:
        cells = _cells(bins, row[held], index, None if weight is None else weight[held], value[held], len(growth.of))
        found = _best(cells, growth.spec.min_leaf)
        growth.split(found)
        gain, f, c, side = found[:4]
        stays = gain[index] > 0
        held, index = held[stays], index[stays]
        x = bins[f[index], row[held]]
        node[held] = 2 * node[held] + ~np.where(x == BINS, side[index], x <= c[index])
        index = growth.number()[fold[held], node[held]]
        held, index = held[index >= 0], index[index >= 0]
    return node


def _settle(trees: Trees, k: int, max_leaves: int | None) -> None:
    """Keeps the splits that growing the best leaf first would make; nodes below take over its value."""
    feature, gain, value = trees.feature[k], trees.gain[k], trees.value[k]
    kept = np.zeros(len(feature), bool)
    queue = [(-gain[1], 1)] if feature[1] >= 0 else []
    leaves = 1
    while queue and (max_leaves is None or leaves < max_leaves):
        _, node = heapq.heappop(queue)
        kept[node] = True
        leaves += 1
        for child in (2 * node, 2 * node + 1):
            if feature[child] >= 0:
                heapq.heappush(queue, (-gain[child], child))
    feature[~kept] = -1
    gain[~kept] = 0.0
    for node in range(2, len(feature)):
        if not kept[node >> 1]:
            value[node] = value[node >> 1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _draws(key: np.ndarray, tree: int) -> np.ndarray:
    """How often a tree's sample has each row: Poisson numbers that depend on the row alone."""
    salt = np.uint64((tree + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    chance = (_mixed(key ^ _mixed(np.array([salt]))) >> np.uint64(11)).astype(float) / 2.0**53
    return np.searchsorted(_POISSON, chance, "right")


@dataclass(frozen=True)
class Task:
    """What every task needs to know: sizes, the columns of the bins that are features, and the trees so far.

    ``means`` and ``units`` are of each fold: the mean target, and the parts of one that sums are counted in.
    """

    spec: Spec
    columns: list[int]
    means: np.ndarray
    units: np.ndarray

    def entries(self, batches: list[pa.RecordBatch]) -> Entries:
        """Rows ``(key, since, y, bins)`` as one entry for each fold that learns from them."""
        join = lambda name, kind: np.concatenate([b.column(name).to_numpy(zero_copy_only=False) for b in batches] or [np.zeros(0, kind)])
        since, y = join("since", np.int32), join("y", float)
        raw = b"".join(x for b in batches for x in b.column("bins").to_pylist())
        bins = np.frombuffer(raw, np.uint8).reshape(len(y), -1)[:, self.columns].T.copy() if raw else np.zeros((len(self.columns), 0), np.uint8)
        served = np.maximum(len(self.means) - since, 0)
        row = np.repeat(np.arange(len(y)), served)
        fold = np.arange(len(row)) - np.repeat(np.cumsum(served) - served, served) + since[row]
        target = b"".join(x or b"" for b in batches for x in b.column("target").to_pylist())
        values = np.frombuffer(target, float).copy() if target else y[row] - self.means[fold]
        return Entries(bins, row, fold, values, join("key", np.int64).view(np.uint64))

    def whole(self, entries: Entries) -> np.ndarray:
        return np.rint(entries.target * self.units[entries.fold])


@dataclass
class Entries:
    bins: np.ndarray
    row: np.ndarray
    fold: np.ndarray
    target: np.ndarray
    key: np.ndarray

    def less(self, trees: list[Trees], rate: float) -> None:
        """Takes off the targets what trees say."""
        for t in trees:
            self.target -= rate * t.value[self.fold, t.leaves(self.fold, self.bins[:, self.row])]


_KINDS = {"feature": np.int8, "cut": np.uint8, "left": bool, "value": np.float64, "gain": np.float64}
FOREST = "tree int, " + ", ".join(f"{c} binary" for c in _KINDS)


def in_one_task(task: Task) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All trees from all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = task.entries([b for b in batches if b.num_rows])
        whole = task.whole(got)
        for number in range(task.spec.trees):
            growth = Growth(len(task.means), task.spec)
            if task.spec.boosted:
                node = grow(got.bins, got.row, got.fold, task.whole(got), None, growth)
                trees = growth.finished(task.units)
                got.target -= task.spec.rate * trees.value[got.fold, node]
            else:
                times = _draws(got.key, number)[got.row]
                some = np.flatnonzero(times)
                grow(got.bins, got.row[some], got.fold[some], whole[some] * times[some], times[some].astype(float), growth)
                trees = growth.finished(task.units)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), *[pa.array([getattr(trees, c).tobytes()], pa.binary()) for c in _KINDS]], ["tree", *_KINDS]
            )

    return run


CELLS = "tree int, part int, cells binary"


def level_cells(task: Task, growing: dict[int, Growth], before: list[Trees]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task's rows add to the next level of trees in the making, ``_NODES`` nodes a row."""
    state = {number: (g.trees(), g.number(), len(g.of)) for number, g in growing.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            got = task.entries([batch])
            got.less(before, task.spec.rate)
            whole = task.whole(got)
            for number, (trees, active, n) in state.items():
                node = trees.leaves(got.fold, got.bins[:, got.row])
                index = active[got.fold, node]
                if task.spec.boosted:
                    some, weight = np.flatnonzero(index >= 0), None
                    value = whole[some]
                else:
                    times = _draws(got.key, number)[got.row]
                    some = np.flatnonzero((index >= 0) & (times > 0))
                    weight = times[some].astype(float)
                    value = whole[some] * weight
                cells = _cells(got.bins, got.row[some], index[some], weight, value, n)
                sums[number] = sums[number] + cells if number in sums else cells
        for number, cells in sums.items():
            for part, lo in enumerate(range(0, cells.shape[1], _NODES)):
                blob = zlib.compress(np.ascontiguousarray(cells[:, lo : lo + _NODES]).tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([part], pa.int32()), pa.array([blob], pa.binary())], ["tree", "part", "cells"])

    return run


BEST = "tree int, part int, found binary"


def best_splits(spec: Spec, features: int) -> Callable[[pa.Table], pa.Table]:
    """Adds up the cells of one part and finds the best split of each of its nodes."""

    def run(table: pa.Table) -> pa.Table:
        total = None
        for blob in table["cells"]:
            cells = np.frombuffer(zlib.decompress(blob.as_py()), np.int64).reshape(2, -1, features, BINS + 1)
            total = cells if total is None else total + cells
        found = np.stack([np.asarray(x, float) for x in _best(total, spec.min_leaf)])
        return pa.table({"tree": table["tree"][:1], "part": table["part"][:1], "found": pa.array([found.tobytes()], pa.binary())})

    return run


def take_splits(growing: dict[int, Growth], rows: list) -> None:
    """A level down with what ``best_splits`` returned."""
    parts: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r.tree, r.part)):
        parts.setdefault(r.tree, []).append(np.frombuffer(r.found, float).reshape(8, -1))
    for number, growth in growing.items():
        gain, f, c, side, *sums = np.concatenate(parts[number], axis=1)
        growth.split((gain, f.astype(int), c.astype(int), side > 0, *sums))


def less_trees(task: Task, before: list[Trees]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same rows with what is left of their targets after some trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = task.entries([batch])
            got.less(before, task.spec.rate)
            ends = np.cumsum(np.bincount(got.row, minlength=batch.num_rows))
            left = [x.tobytes() for x in np.split(got.target, ends[:-1])] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("key", "since", "y", "bins")], pa.array(left, pa.binary())], ["key", "since", "y", "bins", "target"])

    return run


def read_trees(rows: list, folds: int) -> list[Trees]:
    """Trees in their order, from what ``in_one_task`` returned."""
    return [Trees(*(np.frombuffer(r[c], kind).reshape(folds, -1) for c, kind in _KINDS.items())) for r in sorted(rows, key=lambda r: r.tree)]


def predict(spec: Spec, means: np.ndarray, trees: list[Trees], fold: np.ndarray, bins: np.ndarray) -> np.ndarray:
    total = np.zeros(len(fold))
    for t in trees:
        total += t.value[fold, t.leaves(fold, bins)]
    return means[fold] + total * (spec.rate if spec.boosted else 1 / max(len(trees), 1))
