"""Prefix tokens of many pieces travel in few packed runs, and lines are cut the same."""

from fractions import Fraction

import numpy as np

from seriesmill.llm import common, line_dedup


def test_runs_hold_several_pieces(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(k, "\n".join(" ".join(f"w{x}" for x in rng.integers(0, 300, 12)) for _ in range(10))) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    rare = spark.sparkContext.broadcast(np.full(line_dedup.BUCKETS, 2, np.uint16))
    alone = line_dedup.postings(docs, "text", rare, Fraction("0.8"), plain=True).count()
    monkeypatch.setattr(line_dedup, "PIECE", 5_000)  # some 20 pieces
    blobs = [bytes(r.blob) for r in line_dedup.postings(docs, "text", rare, Fraction("0.8")).collect()]
    assert sum(len(line_dedup.unpacked(b)["tok"]) for b in blobs) == alone
    n_parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(blobs) <= n_parts  # before: so many for each piece
    for b in blobs:
        assert (np.diff(line_dedup.unpacked(b)["tok"].view(np.uint64).astype(object)) >= 0).all()


def test_drops_lines_of_texts_in_bytes(spark):
    rows = [(1, "é a b c d\n\nx"), (2, "q r\né a b c d\n"), (3, None), (4, ""), (5, "\n\n"), (6, "é a b c d\ny z"), (6, None), (6, "o")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, (r.text, r.n_lines, r.n_removed)) for r in line_dedup.dedup_lines(docs).collect()}
    want = {1: ("é a b c d\n\nx", 3, 0), 2: ("q r\n", 3, 1), 3: (None, 0, 0), 4: ("", 0, 0), 5: ("\n\n", 3, 0)}
    # Rows that share a doc_id lose the same lines.
    assert found == {*want.items(), (6, ("y z", 2, 1)), (6, (None, 0, 0)), (6, ("", 1, 1))}


def test_planes_owners_and_sums():
    rng = np.random.default_rng(2)
    for kind in (np.int64, np.uint64, np.int32):
        for n, top in ((0, 9), (50, 9), (500, 1), (500, 300), (500, 2**31 - 1)):
            v = rng.integers(0, top, n).astype(kind) if n else np.zeros((0, 1), kind).ravel()
            if n:
                assert common.planes(v) == v.view(np.uint8).reshape(n, -1).T.tobytes()
                assert (common.unplanes(common.planes(v), kind) == v).all()
    v = rng.integers(-(2**63), 2**63, 300)
    assert (common.unplanes(common.planes(v), np.int64) == v).all()
    starts = np.array([0, 0, 3, 3, 7, 9])
    places = np.array([0, 1, 2, 4, 6, 7, 8])
    assert common.owners(places, starts).tolist() == (np.searchsorted(starts, places, "right") - 1).tolist()
    for n in (0, 1, 2, 5, 8):
        data = rng.integers(0, 256, n, dtype=np.uint8)
        up, _ = common.powers(n + 1)
        want = np.concatenate((np.zeros(1, np.uint64), np.cumsum(common._BYTE[data] * up[:n], dtype=np.uint64)))
        assert (common.prefix_sums(data) == want).all()
