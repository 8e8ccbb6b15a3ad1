"""Top-k search in one shard: blocks against brute force, and the memory that a shard takes."""

import tracemalloc

import numpy as np
import pytest

from seriesmill.llm import search


def made(n, seed=3, most=120, groups=4):
    """Term vectors of documents that share their frequent terms within a group; every tenth is a copy."""
    rng = np.random.default_rng(seed)
    each = []
    for d in range(n):
        words = 40 * (d % groups) + np.minimum(rng.zipf(1.3, most), 39)
        each.append(each[d - 5] if d % 10 == 9 else np.unique(np.concatenate((words, 1000 + rng.integers(0, 20 * n, most)))))
    starts = np.concatenate(([0], np.cumsum([len(x) for x in each])))
    term = np.concatenate(each)
    count = rng.integers(1, 6, len(term)).astype(np.int32)
    for d in range(9, n, 10):
        count[starts[d] : starts[d + 1]] = count[starts[d - 5] : starts[d - 4]]
    known, df = np.unique(term, return_counts=True)
    words = np.add.reduceat(count, starts[:-1]).astype(np.int64)
    return rng.permutation(10 * n)[:n], words, term, count, starts, known, df, n, words.mean(), 1.2, 0.75


def shard_of(made):
    ids, words, term, count, starts, known, df, n, mean, k1, b = made
    return search.Shard(ids, words, term, count, starts, known[::-1].copy(), df[::-1].copy(), n, mean, k1, b)


@pytest.mark.parametrize("rows", [512, 7, 0])
def test_blocks_by_force(monkeypatch, rows):
    monkeypatch.setattr(search, "MOST_ROWS", rows)
    monkeypatch.setattr(search, "OPEN_ROWS", 40)
    ids, words, term, count, starts, known, df, n, mean, k1, b = one = made(700)
    shard = shard_of(one)
    assert len(shard.row_max) == min(rows, len(shard.row_max)) and (rows < 512 or len(shard.row_max) > 20)
    doc = np.repeat(np.arange(n), np.diff(starts))
    at = np.searchsorted(known, term)
    impact = np.log(1 + (n - df[at] + 0.5) / (df[at] + 0.5)) * count * (k1 + 1) / (count + k1 * (1 - b + b * words[doc] / mean))
    for q in [*range(0, n, 35), 9, 4]:
        query = at[starts[q] : starts[q + 1]]
        has = np.isin(at, query)
        want = np.round(np.bincount(doc[has], impact[has], n), 6)
        order = np.lexsort((ids, -want))[:10]
        found, score = shard.search(query, 10)
        assert np.abs(score - want[order]).max() < 2e-6
        assert set(shard.ids[found][score > score[-1] + 2e-6]) == set(ids[order][want[order] > want[order[-1]] + 2e-6])
        assert shard.ids[found].tolist() == ids[order].tolist()


def test_memory_for_each_posting():
    one = made(4000, most=150)
    tracemalloc.start()
    shard = shard_of(one)
    rng = np.random.default_rng(1)
    for q in rng.integers(0, 4000, 5):
        shard.search(np.searchsorted(shard.known, one[2][one[4][q] : one[4][q + 1]]), 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * len(one[2])
