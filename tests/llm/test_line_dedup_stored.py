"""Lines are cut once and stored: what is read again are the same sets, and texts are not cut a second time."""

from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from seriesmill.llm import line_dedup

FIELDS = ("known", "id", "token", "first", "size", "doc", "line", "row")


def made(n=60, seed=4):
    rng = np.random.default_rng(seed)
    texts = ["\n".join(" ".join(f"w{x}" for x in rng.integers(0, 500, rng.integers(0, 300))) for _ in range(4)) for _ in range(n)]
    return [None, "", "\n \n", *texts, "x", "é x\nX é"]


def test_stored_lines_are_the_same():
    texts = made()
    ids = np.random.default_rng(1).integers(-(2**62), 2**62, len(texts))
    lines = line_dedup.Lines(pa.array(texts), ids)
    again = line_dedup.Lines.unpacked(lines.packed())
    for name in FIELDS:
        assert np.array_equal(getattr(lines, name), getattr(again, name)), name
    assert len(lines.packed()) < 8 * len(lines.id)
    some = np.arange(len(lines.size)) % 3 == 0
    part = lines.only(some)
    want = [lines.token[f : f + n].tolist() for f, n in zip(lines.first[some], lines.size[some], strict=True)]
    assert [part.token[f : f + n].tolist() for f, n in zip(part.first, part.size, strict=True)] == want


def test_order_of_tokens_that_differ_in_low_bits():
    rng = np.random.default_rng(2)
    token = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    token = np.concatenate((token, token, token + np.uint64(1), token - np.uint64(1)))
    assert (token[line_dedup._order(token)] == np.sort(token)).all()


@pytest.mark.parametrize("plain", [False, True])
def test_entries_from_stored_lines(spark, plain):
    docs = spark.createDataFrame(list(enumerate(made())), "doc_id long, text string").coalesce(1)
    told = line_dedup.sets_and_counts(docs, "text")
    rare = spark.sparkContext.broadcast(np.minimum(line_dedup.rarity(told), 65_535).astype(np.uint16))
    stored = told.filter("lines IS NOT NULL").select("lines")
    each = [line_dedup.postings(x, "text", rare, Fraction("0.8"), plain=plain).collect() for x in (docs, stored)]
    assert len(each[0]) > 3 and sorted(each[0]) == sorted(each[1])


def test_texts_are_cut_once(spark, monkeypatch):
    """Each later step reads stored lines: a plan over texts would hold their column."""
    seen, whole = [], line_dedup.postings
    monkeypatch.setattr(line_dedup, "postings", lambda docs, *a, **k: seen.append(docs.columns) or whole(docs, *a, **k))
    sets = line_dedup._sets
    monkeypatch.setattr(line_dedup, "_sets", lambda rows, *a: seen.append(rows.columns) or sets(rows, *a))
    line = " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame([(1, line), (2, line + " more"), (3, "other")], "doc_id long, text string")
    assert [r.n_removed for r in line_dedup.dedup_lines(docs).orderBy("doc_id").collect()] == [0, 1, 0]
    assert len(seen) > 2 and all(c == ["lines"] for c in seen)
