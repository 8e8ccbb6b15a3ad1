"""Seasonal naive (M5, J8) and the recent-average default (M4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import anchors, forecast_columns


def seasonal_naive(state: DataFrame, folds: DataFrame | None = None) -> DataFrame:
    """M5: the same month last year, else the last value; a zero gives way to the recent mean.

    The recent mean is that of ``series_state``'s ``fallback_window``, if the series is as long.
    """
    same_month = F.coalesce("lag11", "count")
    recent = F.when(F.col("recent_mean") > 0, F.col("recent_mean"))
    gives_way = (same_month == 0) & recent.isNotNull()
    return forecast_columns(
        anchors(state, folds), F.when(gives_way, recent).otherwise(same_month), F.when(gives_way, "fallback").otherwise("model")
    )


def recent_mean(state: DataFrame, folds: DataFrame | None = None) -> DataFrame:
    """M4: mean of the last three rows, or the last value of a shorter series."""
    return forecast_columns(anchors(state, folds), F.col("fallback"))
