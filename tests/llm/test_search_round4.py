"""Shards of similar documents: a query adds up rows only where they can reach its threshold; bounds hold and are near."""

import numpy as np
import pytest

from seriesmill.llm import search

N, K, PART = 1200, 5, 1000


def vectors(seed=5, n=N):
    """Documents of three languages in turn, which share few terms, short and long ones: term vectors by document."""
    rng = np.random.default_rng(seed)
    each = []
    for d in range(n):
        size = 12 if d % 2 else 150
        own = PART * (d % 3) + np.minimum(rng.zipf(1.25, size), PART - 1)
        each.append(np.unique(np.concatenate((own, 3 * PART + rng.integers(0, 30, 1), 4 * PART + rng.integers(0, 40 * n, size // 3)))))
    return each, [rng.integers(1, 5, len(x)) for x in each]


@pytest.fixture(scope="module")
def made():
    each, counts = vectors()
    known, df = np.unique(np.concatenate(each), return_counts=True)
    words = np.array([c.sum() for c in counts])
    return [np.searchsorted(known, x) for x in each], counts, words, known, df


def impacts(made, d):
    each, counts, words, _, df = made
    w = 1.2 * (0.25 + 0.75 * words[d] / words.mean())
    return np.log(1 + (N - df[each[d]] + 0.5) / (df[each[d]] + 0.5)) * counts[d] * 2.2 / (counts[d] + w)


def shard_of(made, docs):
    each, counts, words, known, df = made
    starts = np.concatenate(([0], np.cumsum([len(each[d]) for d in docs])))
    return search.Shard(docs, words[docs], np.concatenate([each[d] for d in docs]), np.concatenate([counts[d] for d in docs]), starts, known, df, N, words.mean(), 1.2, 0.75, placed=True)


@pytest.mark.parametrize("shared", [0, 10_000])
@pytest.mark.parametrize("n", [1, 2, 301])
def test_bounds_hold(made, monkeypatch, shared, n):
    monkeypatch.setattr(search, "SHARED", shared)
    docs = np.arange(n)
    shard = shard_of(made, docs)
    assert shard.shared == (shared > 0) and len(shard.rows) > 5
    seen, whole = [], search.Shard.unpack
    monkeypatch.setattr(search.Shard, "unpack", lambda self, both, bound: whole(self, both, bound) or seen.append(bound.copy()))
    queries = [made[0][d] for d in (0, 3, 7, 400, 801)]
    cuts = np.concatenate(([0], np.cumsum([len(q) for q in queries])))
    shard.search_all(np.concatenate(queries), cuts, K, np.zeros(len(queries)))
    bound = np.concatenate(seen)
    opened = 0
    for q in queries:
        want = np.array([impacts(made, d)[np.isin(made[0][d], q)].sum() for d in docs])
        if want.any():
            size = np.array([len(made[0][d]) for d in docs])
            assert (bound[opened] >= want * (1 - 1e-6)).all()
            assert (bound[opened] <= want * 1.017 + size * impacts_sum(made, docs) / 3500 + 1e-3).all()
            opened += 1
    assert opened == len(bound)


def impacts_sum(made, docs):
    return np.array([impacts(made, d).sum() for d in docs])


def test_shards_are_of_similar_documents(made, monkeypatch):
    each, counts, words, known, df = made
    cell = search.Cell(K, 100, N, words.mean(), 1.2, 0.75)
    cell.known, cell.df = known, df
    asked = np.arange(0, N, 7)
    cell.asked.append((asked, np.concatenate([each[q] for q in asked]).astype(np.int32), np.array([len(each[q]) for q in asked])))
    shards, opened, ask, unpack = [], [], search.Cell.ask, search.Shard.unpack
    monkeypatch.setattr(search.Cell, "ask", lambda self, shard: shards.append(shard.ids) or ask(self, shard))
    monkeypatch.setattr(search.Shard, "unpack", lambda self, both, bound: opened.append(len(bound)) or unpack(self, both, bound))
    for a in range(0, N, 50):
        own = range(a, a + 50)
        cell.hold(np.arange(a, a + 50), words[a : a + 50], np.concatenate([each[d] for d in own]).astype(np.int32), np.concatenate([counts[d] for d in own]), np.array([len(each[d]) for d in own]))
    query, found, score = (x.to_numpy() for x in cell.best())
    assert sorted(np.concatenate(shards)) == list(range(N)) and max(map(len, shards)) <= 100
    long = [x for x in shards if len(each[x[0]]) > 60]
    assert np.mean([np.bincount(x % 3).max() / len(x) for x in long]) > 0.9
    assert sum(opened) < 0.7 * len(asked) * len(shards)
    for q in asked:
        want = []
        for d in range(N):
            has = np.isin(each[d], each[q])
            if has.any():
                want.append((-round(impacts(made, d)[has].sum(), 6), d))
        own = query == q
        assert found[own].tolist() == [d for _, d in sorted(want)[:K]]
        assert np.abs(score[own] + [s for s, _ in sorted(want)[:K]]).max() < 2e-6


def test_documents_wait_for_similar_ones(made):
    each, counts, words, known, df = made
    cell = search.Cell(K, 100, N, words.mean(), 1.2, 0.75)
    cell.known, cell.df, cell.asked = known, df, [(np.zeros(1, np.int64), each[0].astype(np.int32), np.array([len(each[0])]))]
    own = [*range(0, 870, 3), *range(1, 30, 3)]  # many of one language, few of another
    cell.hold(np.array(own), words[own], np.concatenate([each[d] for d in own]).astype(np.int32), np.concatenate([counts[d] for d in own]), np.array([len(each[d]) for d in own]))
    assert len(own) == 300  # as many as are held
    assert 0 < cell.n_held < 100 and sum(len(x[0]) for x in cell.held) == cell.n_held
    cell.search(last=True)
    assert cell.n_held == 0
