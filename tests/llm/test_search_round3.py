"""A group of documents streamed past the queries: k rows a query whatever the number of shards, and lean vectors."""

import numpy as np
import pytest

from seriesmill.llm import search
from seriesmill.llm.common import bit_table, MARKS

N, K = 240, 3


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(7)
    each = [" ".join(f"w{x}" for x in rng.zipf(1.4, 60) if x < 400) + f" own{d}" for d in range(N)]
    each[50:60] = each[40:50]  # copies: ties across shards
    return each


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_k_rows_a_query_from_any_number_of_shards(spark, texts, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    asked = docs.filter("doc_id % 20 = 0")
    bags = [t.split() for t in texts]
    df = {}
    for b in bags:
        for w in set(b):
            df[w] = df.get(w, 0) + 1
    mean = sum(map(len, bags)) / N
    told = rows_of(search.vectors(docs, "text"))
    known, at = np.unique(np.concatenate([search.unpacked(r, "known") for r in told]), return_inverse=True)
    often = np.bincount(at, weights=np.concatenate([search.unpacked(r, "often") for r in told])).astype(np.int64)
    assert len(known) == len(df) and sorted(often) == sorted(df.values())

    cell, returned = search.Cell(K, 30, N, mean, 1.2, 0.75), []
    whole = search.Shard.search_all

    def counted(self, *args):
        out = whole(self, *args)
        returned.append(len(out[0]))
        return out

    monkeypatch.setattr(search.Shard, "search_all", counted)
    stats = dict(zip(search.PACKED, [c[0].as_py() for c in search.packed(known=known[::-1].copy(), often=often[::-1].copy())], strict=True))
    cell.add(search.FREQUENCIES, stats)
    for r in rows_of(search.vectors(asked, "text")):
        cell.add(search.QUERIES, r)
    for r in told:
        cell.add(search.DOCUMENTS, r)
    query, found, score = (c.to_numpy() for c in cell.best())
    assert len(returned) > 3 and sum(returned[1:]) < (len(returned) - 1) * K * N // 20  # later shards only give better ones
    assert len(query) == K * N // 20
    for q in range(0, N, 20):
        words = set(bags[q])
        want = []
        for d, b in enumerate(bags):
            s = sum(np.log(1 + (N - df[w] + 0.5) / (df[w] + 0.5)) * b.count(w) * 2.2 / (b.count(w) + 1.2 * (0.25 + 0.75 * len(b) / mean)) for w in words & set(b))
            want.append((-round(s, 6), d))
        want = sorted(want)[:K]
        assert found[query == q].tolist() == [d for _, d in want]
        assert np.abs(score[query == q] + [s for s, _ in want]).max() < 2e-6


def test_only_terms_of_queries_are_sent(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    asked = search.vectors(docs.filter("doc_id % 20 = 0"), "text")
    marks = spark.sparkContext.broadcast(bit_table(asked.select("known"), lambda batch: search._bucket(search._all_known(batch)), MARKS))
    (all_,), (some,), (own,) = rows_of(search.vectors(docs, "text")), rows_of(search.vectors(docs, "text", marks)), rows_of(asked)
    assert all_["n"] == some["n"] == N and all_["total"] == some["total"] == sum(len(t.split()) for t in texts)
    assert set(search.unpacked(own, "known")) <= set(search.unpacked(some, "known")) and len(search.unpacked(some, "known")) < len(search.unpacked(all_, "known")) - 200
    known = search.unpacked(own, "known")
    for a, b in zip(search.places(all_, known), search.places(some, known), strict=True):
        assert (a == b).all()
    # A posting takes less than the 8 bytes of its term.
    assert sum(len(all_[c]) for c in search.PACKED) < 8 * search.unpacked(all_, "sizes").sum()
