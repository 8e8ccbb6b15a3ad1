"""Connected components of an edge table, without collecting it anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EDGE = "u long, v long"


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of a batch: an edge from each vertex to the smallest it reaches."""
    for batch in batches:
        ends, back = np.unique(np.concatenate((batch.column("u").to_numpy(), batch.column("v").to_numpy())), return_inverse=True)
        parent = list(range(len(ends)))

        def root(x: int, parent: list[int] = parent) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        n = batch.num_rows
        for a, b in zip(back[:n].tolist(), back[n:].tolist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        top = np.array([root(x) for x in range(len(ends))], np.int64)
        moved = np.flatnonzero(top != np.arange(len(ends)))
        yield pa.RecordBatch.from_arrays([pa.array(ends[moved]), pa.array(ends[top[moved]])], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """``(vertex, component)`` of every vertex of ``edges(u, v)``: the smallest vertex it can reach.

    In rounds of union-find inside tasks and large and small stars between them, until
    no edge changes. Every round is a table in the shared folder.
    """
    found = edges.select("u", "v").filter("u <> v").mapInArrow(_forest, EDGE).distinct().checkpoint()
    last = None
    while True:
        both = found.union(found.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.filter("u <> v").distinct()
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(lowest, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        found = small.select("e.*").filter("u <> v").mapInArrow(_forest, EDGE).distinct().checkpoint()
        now = found.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    roots = found.select("v").distinct().select(F.col("v").alias("vertex"), F.col("v").alias("component"))
    return found.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(roots)
