"""Parts of suffix deduplication against plain recomputation, and how often a text is taken apart."""

import numpy as np
import pytest
from pyspark import cloudpickle

from seriesmill.llm import suffix_dedup


@pytest.fixture
def by_value():
    """Tasks get the module as it is here, with what a test puts into it."""
    cloudpickle.register_pickle_by_value(suffix_dedup)
    yield
    cloudpickle.unregister_pickle_by_value(suffix_dedup)


@pytest.mark.parametrize("w", [1, 2, 3, 7, 8, 27, 40])
def test_slide(w):
    a = np.random.default_rng(w).integers(0, 2**63, 39, dtype=np.uint64)
    for op in (np.minimum, np.maximum):
        want = [op.reduce(a[k : k + w]) for k in range(len(a) - w + 1)]
        assert suffix_dedup._slide(a, w, op).tolist() == want


def test_strings_covered_by_force():
    rng = np.random.default_rng(4)
    size, n = 6, 400
    suffix = np.array(sorted(bytes(x) for x in rng.integers(97, 99, (n, size), dtype=np.uint8)))
    raw = np.frombuffer(suffix.tobytes(), np.uint8).reshape(n, size)
    common = np.concatenate(([0], [next((k for k in range(size) if x[k] != y[k]), size) for x, y in zip(raw[:-1], raw[1:], strict=True)]))
    before = rng.integers(97, 99, (3, n), dtype=np.uint8)
    mask, doc = rng.integers(0, 16, n), rng.integers(0, 9, n)
    string = [[bytes(before[:j, i][::-1]) + bytes(raw[i, : size - j]) for j in range(4)] for i in range(n)]
    want = [sum(1 << j for j in range(4) if mask[i] >> j & 1 and any(mask[k] >> j & 1 and doc[k] < doc[i] and string[k][j] == string[i][j] for k in range(n))) for i in range(n)]
    assert suffix_dedup.strings_covered(common, mask, doc, before, size).tolist() == want


def test_entries_are_cut_out_once(spark, tmp_path, monkeypatch, by_value):
    """The texts are searched for anchors by two passes, not again when bytes are removed."""
    seen, old = tmp_path / "seen", suffix_dedup.Anchors.__init__

    def counted(self, data, *rest):
        with open(seen, "a") as f:
            f.write(f"{len(data)}\n")
        old(self, data, *rest)

    monkeypatch.setattr(suffix_dedup.Anchors, "__init__", counted)
    line = "the same sixty bytes stand in two of the documents of this table"
    rows = [(1, f"a {line} b"), (2, "short"), (3, f"c d {line}"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert found[3] == (len(line) + 4, len(line) + 1, 1, b"c d") and found[4] == (0, 0, 0, b"") and found[2] == (5, 0, 0, b"short")
    assert len(seen.read_text().split()) == 2
