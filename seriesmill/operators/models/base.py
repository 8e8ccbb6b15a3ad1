"""Folds and anchors shared by all forecasters.

A fold is a month to be predicted from the rows before it. The real forecast is
the fold ``FINAL``, which every row precedes and whose target is each series' own
next month. Forecasters return ``category, fold, month, actual, predicted, status``;
``status`` is "model", or says why something simpler stands there: "short" (too few rows
to learn from), "fallback" (the model's own default) or "error".
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINAL = datetime.date(9999, 12, 1)
OUTPUT = ("category", "fold", "month", "actual", "predicted", "status")


def last_folds(monthly: DataFrame, months: int) -> DataFrame:
    """The last K distinct months, as column ``fold``; none for K = 0.

    A table with fewer than two months has nothing to train on and gives none.
    """
    distinct = monthly.select(F.col("month").alias("fold")).distinct()
    enough = distinct.agg(F.count(F.lit(1)) >= 2).scalar()
    return distinct.orderBy(F.desc("fold")).limit(max(int(months), 0)).where(enough)


def fold_list(folds: DataFrame) -> Column:
    """The at most K folds as one array value."""
    return folds.agg(F.sort_array(F.collect_list("fold"))).scalar()


def anchors(state: DataFrame, folds: DataFrame | None) -> DataFrame:
    """The row each series is forecast from, per fold.

    Series have no gaps, so the last training row of a fold is the row of the
    month before, and the value to be predicted sits on that same row (``actual``).
    That makes J1, the join of forecasts with actual counts, free.
    """
    if folds is None:
        return state.where(F.col("n") == F.col("size")).withColumn("fold", F.lit(FINAL))
    return (
        state.where(F.col("actual").isNotNull() & F.array_contains(fold_list(folds), F.col("next_month")))
        .withColumn("fold", F.col("next_month"))
    )


def with_since(frame: DataFrame, folds: DataFrame | None, name: str = "since") -> DataFrame:
    """Adds how many folds are not after a row's month: the position of the first one that may learn from it."""
    if folds is None:
        return frame.withColumn(name, F.lit(0))
    seen = F.filter("_folds", lambda fold: fold <= F.col("month"))
    return frame.withColumn("_folds", fold_list(folds)).withColumn(name, F.size(seen)).drop("_folds")


def forecast_columns(frame: DataFrame, predicted: Column, status: Column | None = None) -> DataFrame:
    return frame.select(
        "category",
        "fold",
        F.col("next_month").alias("month"),
        "actual",
        predicted.cast("double").alias("predicted"),
        (F.lit("model") if status is None else status).alias("status"),
    )
