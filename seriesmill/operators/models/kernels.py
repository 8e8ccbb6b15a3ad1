"""Array prefixes of series and the runner for per-series solvers.

One row holds one training series (bounded by the months of the calendar). A
solver gets all equal-length series of an Arrow batch as one matrix, so it is
called a few times per batch, not once per series.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import FINAL, fold_list

Kernel = Callable[[np.ndarray], "np.ndarray | None"]

_SCHEMA = "category string, fold date, month date, actual double, predicted double, status string"


def series_prefixes(monthly: DataFrame, folds: DataFrame | None = None) -> DataFrame:
    """``category, fold, month, actual, values``: the training counts of every fold."""
    pairs = F.sort_array(F.collect_list(F.struct("month", "count")))
    whole = monthly.groupBy("category").agg(pairs.alias("_s")).select(
        "category", F.col("_s")[0]["month"].alias("_first"), F.col("_s")["count"].alias("values")
    )
    if folds is None:
        return whole.select(
            "category",
            F.lit(FINAL).alias("fold"),
            F.add_months("_first", F.size("values")).alias("month"),
            F.lit(None).cast("double").alias("actual"),
            "values",
        )
    length = F.months_between("fold", "_first").cast("int")
    return (
        whole.withColumn("_folds", fold_list(folds))
        .withColumn("fold", F.explode(F.filter("_folds", lambda fold: fold > F.col("_first"))))
        .withColumn("_n", length)
        .where(F.col("_n") < F.size("values"))
        .select(
            "category",
            "fold",
            F.col("fold").alias("month"),
            F.get("values", F.col("_n")).alias("actual"),
            F.slice("values", F.lit(1), F.col("_n")).alias("values"),
        )
    )


def apply_kernel(prefixes: DataFrame, kernel: Kernel) -> DataFrame:
    """Run a solver over all series; ``status`` says where a prediction came from.

    ``kernel`` takes a (series, months) matrix and returns one number per series,
    or None if the series are too short. Those, failures and non-finite results
    get the recent average (M4) with status ``short`` or ``error``.

    Range partitioning by length gives every task series of few distinct lengths
    and splits a common length over many tasks. The partition count is explicit, at
    least that of the session's shuffles, because the rows are small but the work per
    row is not; batches stream through a task, so its memory does not depend on it.
    """
    session = prefixes.sparkSession
    shuffles = int(session.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(2 * session.sparkContext.defaultParallelism, shuffles)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            series = batch["values"].to_numpy()
            lengths = np.array([len(v) for v in series])
            predicted = np.full(len(batch), np.nan)
            status = np.full(len(batch), "model", dtype=object)
            for n in np.unique(lengths):
                rows = np.flatnonzero(lengths == n)
                block = np.stack(series[rows]).astype(float)
                try:
                    out = kernel(block)
                    why = "short" if out is None else "error"
                except Exception:
                    out, why = None, "error"
                out = np.full(len(rows), np.nan) if out is None else np.asarray(out, dtype=float)
                bad = ~np.isfinite(out)
                default = block[:, -3:].mean(axis=1) if n >= 3 else block[:, -1]
                predicted[rows] = np.where(bad, default, out)
                status[rows[bad]] = why
            yield batch[["category", "fold", "month", "actual"]].assign(predicted=predicted, status=status)

    spread = prefixes.withColumn("_len", F.size("values")).repartitionByRange(tasks, "_len", "category", "fold")
    return spread.drop("_len").mapInPandas(solve, _SCHEMA)
