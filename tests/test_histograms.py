"""Trees on histograms against plain search over rows, and against themselves on several tasks."""

import numpy as np
import pytest

from seriesmill.operators.models import histograms as H
from seriesmill.operators.models.histograms import BINS, Growth, Spec, Trees, binned
from seriesmill.operators.models.histograms import grow as grow_on


def grow(bins, row, fold, value, weight, folds, spec):
    growth = Growth(folds, spec)
    node = grow_on(bins, row, fold, value, weight, growth)
    return growth.finished(np.ones(folds)), node


def rows_of(seed, n=300):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, 9, (3, n)).astype(np.uint8)
    bins[2, rng.random(n) < 0.3] = BINS
    value = np.rint(100 * (bins[0] > 4) + 30.0 * bins[1] + 80 * (bins[2] == BINS) + rng.normal(0, 9, n))
    return bins, value


def split_by_force(bins, value, weight, rows, min_leaf):
    """The best split by trying every cut and both sides for missing values."""
    best = (0.0, None)
    w, v = weight[rows], value[rows]
    for f in range(len(bins)):
        x = bins[f, rows]
        for cut in range(BINS - 1):
            for side in (False, True):
                left = np.where(x == BINS, side, x <= cut)
                n = (w[left].sum(), w[~left].sum())
                if min(n) >= min_leaf and min(n) > 0:
                    gain = v[left].sum() ** 2 / n[0] + v[~left].sum() ** 2 / n[1] - v.sum() ** 2 / w.sum()
                    if gain > best[0] * (1 + 1e-12) + 1e-9:
                        best = (gain, left)
    return best


def tree_by_force(bins, value, weight, rows, depth, min_leaf, out, node=1):
    out[node] = (rows, value[rows].sum() / max(weight[rows].sum(), 1))
    gain, left = split_by_force(bins, value, weight, rows, min_leaf) if depth and len(rows) else (0, None)
    if left is not None:
        out[node] += (gain,)
        tree_by_force(bins, value, weight, rows[left], depth - 1, min_leaf, out, 2 * node)
        tree_by_force(bins, value, weight, rows[~left], depth - 1, min_leaf, out, 2 * node + 1)
    return out


@pytest.mark.parametrize("weighted", [False, True])
def test_a_tree_is_the_best_of_all_splits(weighted):
    bins, value = rows_of(1)
    weight = np.random.default_rng(2).integers(1, 4, len(value)).astype(float) if weighted else np.ones(len(value))
    value = value * weight
    spec = Spec(1, 4, 7, boosted=False)
    # Two folds: all rows, and the first 200.
    row = np.concatenate((np.arange(300), np.arange(200)))
    fold = np.repeat([0, 1], [300, 200])
    trees, node = grow(bins, row, fold, value[row], weight[row] if weighted else None, 2, spec)
    for k, n in ((0, 300), (1, 200)):
        want = tree_by_force(bins, value, weight, np.arange(n), 4, 7, {})
        assert {h for h in range(1, 32) if trees.feature[k, h] >= 0} == {h for h, x in want.items() if len(x) == 3}
        for h, (rows, mean, *gain) in want.items():
            assert trees.value[k, h] == pytest.approx(mean)
            if gain:
                assert trees.gain[k, h] == pytest.approx(gain[0])
            else:
                assert (node[fold == k][rows] == h).all()
        assert (trees.leaves(np.full(n, k), bins[:, :n]) == node[fold == k]).all()


def test_fewer_leaves_keep_the_largest_gains():
    bins, value = rows_of(3)
    every = np.arange(300)
    whole, _ = grow(bins, every, 0 * every, value, None, 1, Spec(1, 5, 5, boosted=True))
    few, node = grow(bins, every, 0 * every, value, None, 1, Spec(1, 5, 5, boosted=True, max_leaves=6))
    open_, kept = [1], set()
    while len(kept) < 5:
        best = max((h for h in open_ if whole.feature[0, h] >= 0), key=lambda h: whole.gain[0, h])
        open_.remove(best)
        open_ += [2 * best, 2 * best + 1]
        kept.add(best)
    assert set(np.flatnonzero(few.feature[0] >= 0)) == kept
    leaf = few.leaves(0 * every, bins)
    assert set(leaf) == set(open_)
    assert few.value[0, node] == pytest.approx(few.value[0, leaf])
    assert few.value[0, leaf] == pytest.approx(np.array([value[leaf == h].mean() for h in leaf]))


def test_missing_values_unseen_in_training_go_with_the_more_rows():
    bins = np.array([[0] * 10 + [1] * 30], np.uint8)
    value = np.repeat([0.0, 100.0], [10, 30])
    every = np.arange(40)
    trees, _ = grow(bins, every, 0 * every, value, None, 1, Spec(1, 1, 1, boosted=True))
    assert trees.value[0, trees.leaves(np.array([0]), np.array([[BINS]], np.uint8))] == [100.0]


def test_bins_are_closed_above():
    assert binned(np.array([0.5, 1, 1.5, 2, 9, np.nan]), np.array([1.0, 2.0])).tolist() == [0, 0, 1, 1, 2, BINS]


def test_constant_targets_and_no_rows_make_one_leaf():
    bins, _ = rows_of(4)
    every = np.arange(300)
    trees, _ = grow(bins, every, 0 * every, np.full(300, 7.0), None, 1, Spec(1, 3, 1, boosted=True))
    assert (trees.feature < 0).all() and trees.value[0, 1] == 7.0
    none, _ = grow(bins[:, :0], every[:0], every[:0], np.zeros(0), None, 2, Spec(1, 3, 1, boosted=True))
    assert isinstance(none, Trees) and (none.feature < 0).all() and (none.value == 0).all()


def test_draws_are_poisson_and_depend_on_the_row_alone():
    key = np.random.default_rng(0).integers(0, 1 << 63, 20_000).astype(np.uint64)
    draws = H._draws(key, 5)
    assert abs(draws.mean() - 1) < 0.03 and abs(draws.var() - 1) < 0.05
    assert (H._draws(key[::-1], 5)[::-1] == draws).all() and (H._draws(key, 6) != draws).any()
