"""Ridge regression per series (M6).

The normal equations come from one grouped sum of products, taken around the
level of the series so that nothing cancels, and shared by all folds; only the 5 x 5
solve is Python, in Arrow batches over all series.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import anchors, fold_list, with_since

_X = ("x_month", "x_year", "x_lag1", "x_avg3", "x_lag12")
_PAIRS = [(i, j) for i in range(5) for j in range(i, 5)]


@F.pandas_udf(T.DoubleType())
def _solve(sums: pd.Series) -> pd.Series:
    m = np.stack(sums.to_numpy())
    rows, alpha, shift, y_mean = m[:, 0], m[:, 1], m[:, 2], m[:, 3] / m[:, 0]
    x_mean, x_next = m[:, 4:9] / rows[:, None], m[:, 9:14]
    right = m[:, 14:19] - rows[:, None] * x_mean * y_mean[:, None]
    left = np.zeros((len(m), 5, 5))
    for k, (i, j) in enumerate(_PAIRS):
        left[:, i, j] = left[:, j, i] = m[:, 19 + k] - rows * x_mean[:, i] * x_mean[:, j]
    left += alpha[:, None, None] * np.eye(5)
    weights = np.linalg.solve(left, right[:, :, None])[:, :, 0]
    return pd.Series(shift + y_mean + ((x_next - x_mean) * weights).sum(axis=1))


#: Rows of a series by what they have: calendar only, also lag1 and avg3, also lag12.
_LAGGED, _YEARLY = 4, 13


def moments(state: DataFrame, folds: DataFrame | None = None) -> DataFrame:
    """Sums of products per series, ``since`` and ``stratum``: at most three rows for each fold and one more time.

    ``since`` is the first fold (by position) that may learn from a row; a fold has the
    sums of all up to its own, so rows are read once whatever the number of folds.
    Everything is taken around the level of the series and the middle of the calendar: a
    shift of a feature leaves a fit with free intercept alone.
    """
    level, n = F.col("level"), F.col("n")
    lagged, yearly = n >= _LAGGED, n >= _YEARLY
    rows = with_since(state, folds).select(
        "category",
        "since",
        (lagged.cast("int") + yearly.cast("int")).alias("stratum"),
        (F.col("count") - level).alias("y"),
        (F.col("month_num") - 6.5).alias("x_month"),
        (F.col("year") - 2000.0).alias("x_year"),
        F.when(lagged, F.col("lag1") - level).otherwise(0.0).alias("x_lag1"),
        F.when(lagged, F.col("avg3") - level).otherwise(0.0).alias("x_avg3"),
        F.when(yearly, F.col("lag12") - level).otherwise(0.0).alias("x_lag12"),
    )
    if folds is not None:
        rows = rows.where(F.col("since") < F.size(fold_list(folds)))
    return rows.groupBy("category", "since", "stratum").agg(
        F.count(F.lit(1)).cast("double").alias("rows"),
        F.sum("y").alias("y"),
        *[F.sum(x).alias(x) for x in _X],
        *[F.sum(F.col(x) * F.col("y")).alias(f"y_{x}") for x in _X],
        *[F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"x_{i}{j}") for i, j in _PAIRS],
    )


def ridge(
    state: DataFrame,
    folds: DataFrame | None = None,
    alpha: float = 1.0,
    lag12_anchor: str = "last_row",
) -> DataFrame:
    """M6: ridge forecast of the next month, the recent average below six rows.

    6 or 13-15 rows: calendar features on all rows. 7-12 rows: also lag1 and avg3,
    on the rows that have them. From 16 rows: also lag12. A feature out of use is a
    constant 0, which a penalised fit leaves at weight 0, so one system size serves
    every branch.
    """
    targets = with_since(anchors(state, folds), folds, "at")
    known, level = F.col("n"), F.col("level")
    lags = ((known >= 7) & (known <= 12)) | (known >= 16)
    yearly = known >= 16
    # The last row's lag12 is kept by default, one month older than the others.
    lag12_next = F.col("lag12") if lag12_anchor == "last_row" else F.col("lag11")
    targets = targets.select(
        "category", "fold", "next_month", "actual", "fallback", "level", known.alias("known"), lags.alias("lags"),
        F.when(yearly, 2).when(lags, 1).otherwise(0).alias("least"),
        "at",
        (F.month("next_month") - 6.5).cast("double").alias("next_x_month"),
        (F.year("next_month") - 2000.0).alias("next_x_year"),
        F.when(lags, F.col("count") - level).otherwise(0.0).alias("next_x_lag1"),
        F.when(lags, F.col("mean3") - level).otherwise(0.0).alias("next_x_avg3"),
        F.when(yearly, lag12_next - level).otherwise(0.0).alias("next_x_lag12"),
    )
    head = targets.columns
    cells = targets.join(moments(state, folds), "category")
    used = (F.col("since") <= F.col("at")) & (F.col("stratum") >= F.col("least"))
    lagging = {x for x in _X if x not in ("x_month", "x_year")}

    def added(name: str, *features: str) -> Column:
        on = used & F.col("lags") if lagging & set(features) else used
        return F.coalesce(F.sum(F.when(on, F.col(name))), F.lit(0.0)).alias(name)

    sums = cells.groupBy("category", "fold").agg(
        *[F.max(c).alias(c) for c in head if c not in ("category", "fold")],
        added("rows"),
        added("y"),
        *[added(x, x) for x in _X],
        *[added(f"y_{x}", x) for x in _X],
        *[added(f"x_{i}{j}", _X[i], _X[j]) for i, j in _PAIRS],
    )
    packed = F.array(
        F.greatest(F.col("rows"), F.lit(1.0)),
        F.lit(float(alpha)),
        F.col("level"),
        F.col("y"),
        *[F.col(x) for x in _X],
        *[F.col(f"next_{x}") for x in _X],
        *[F.col(f"y_{x}") for x in _X],
        *[F.col(f"x_{i}{j}") for i, j in _PAIRS],
    )
    solved = sums.withColumn("_fit", _solve(packed))
    enough = F.col("known") >= 6
    return solved.select(
        "category",
        "fold",
        F.col("next_month").alias("month"),
        "actual",
        F.when(enough, F.col("_fit")).otherwise(F.col("fallback")).alias("predicted"),
        F.when(enough, "model").otherwise("short").alias("status"),
    )
