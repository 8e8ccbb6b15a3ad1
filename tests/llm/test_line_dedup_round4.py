"""Memory beside the JVM's heap: small batches, and entries of a range that are not held several times."""

import tracemalloc
from fractions import Fraction

import numpy as np
import pyarrow as pa
import zstandard

from seriesmill.llm import common, line_dedup
from seriesmill.llm.common import planes


def test_batches_are_small(spark):
    """Texts of 24 MB in one partition reach Python in several batches, also in the plan that is returned."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit, None)
    try:
        spark.conf.unset(limit)
        docs = spark.range(3000).selectExpr("id AS doc_id", "concat('w', id, ' ', repeat('same words ', 700)) AS text").coalesce(1)
        out = line_dedup.dedup_lines(docs)
        sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches), "n long").collect()
        assert len(sizes) > 3 and max(r.n for r in sizes) < 1.5 * common.BATCH_BYTES
        assert sorted({r.n_lines for r in out.select("n_lines").collect()}) == [1] and out.count() == 3000
        spark.conf.set(limit, 1 << 20)
        line_dedup.dedup_lines(docs.limit(2))
        assert spark.conf.get(limit) == str(1 << 20)
    finally:
        if before is None:
            spark.conf.unset(limit)
        else:
            spark.conf.set(limit, before)


def test_memory_of_a_range():
    """Entries of many pieces take little more than once the memory of the entries themselves."""
    rng, blobs, n, pieces = np.random.default_rng(3), [], 20_000, 20
    for k in range(pieces):
        token = np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        columns = [np.full(n, k), np.arange(n), np.full(n, 10 << 32), *rng.integers(0, 1 << 62, (4, n))]
        blobs.append(zstandard.compress(b"".join([planes(np.diff(token, prepend=np.uint64(0))), *(planes(c.astype(np.uint64)) for c in columns)]), 1))
    table = pa.table({"part": np.zeros(pieces, np.int64), "blob": pa.array(blobs, pa.binary())})
    combine = line_dedup._candidates(64, Fraction("0.8"), False)
    combine(table)
    tracemalloc.start()
    found = combine(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows == 0
    assert peak < 2.4 * 64 * n * pieces, peak / (64 * n * pieces)
