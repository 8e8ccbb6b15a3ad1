"""Per-row features of gap-filled series.

All window columns share one partitioning and order, so Spark plans one sort.
Every feature of a row looks only at rows up to it. A model's input "as of" a
month is therefore simply that month's row: the last row of a series for the real
forecast, the row before the evaluation month for a backtest fold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalars import month_cos, month_sin, next_month, year_offset

# Names of the features, in the order models use them.
CALENDAR = ("month_num", "year", "lag1", "avg3", "avg6", "lag12")
CALENDAR_CORE = ("month_num", "year", "lag1", "avg3", "avg6")
CYCLIC = ("month_sin", "month_cos", "year_norm", "lag1", "lag2", "lag3", "avg3", "avg6", "lag12")
CYCLIC_CORE = ("month_sin", "month_cos", "year_norm", "lag1", "lag2", "lag3", "avg3", "avg6")

def _series() -> WindowSpec:
    return Window.partitionBy("category").orderBy("month")


def rolling_mean(size: int) -> Column:
    """Mean of the ``size`` rows before this one, null until there are as many."""
    frame = _series().rowsBetween(-size, -1)
    return F.when(F.count("count").over(frame) == size, F.avg("count").over(frame))


def tail_mean(size: int) -> Column:
    """Mean of this row and the ones before it, null until there are ``size``."""
    frame = _series().rowsBetween(1 - size, 0)
    return F.when(F.count("count").over(frame) == size, F.avg("count").over(frame))


def lagged(steps: int) -> Column:
    """W1."""
    return F.lag("count", steps).over(_series())


def calendar_features(monthly: DataFrame) -> DataFrame:
    """M1: month number, year, lag 1, rolling means of 3 and 6, lag 12."""
    return monthly.select(
        "category", "month", "count",
        F.month("month").cast("double").alias("month_num"),
        F.year("month").cast("double").alias("year"),
        lagged(1).alias("lag1"),
        rolling_mean(3).alias("avg3"),
        rolling_mean(6).alias("avg6"),
        lagged(12).alias("lag12"),
    )


def cyclic_features(monthly: DataFrame) -> DataFrame:
    """M2: circular month, year offset, lags 1-3, rolling means, lag 12."""
    return monthly.select(
        "category", "month", "count",
        month_sin(F.col("month")).alias("month_sin"),
        month_cos(F.col("month")).alias("month_cos"),
        year_offset(F.col("month")).alias("year_norm"),
        *[lagged(k).alias(f"lag{k}") for k in (1, 2, 3)],
        rolling_mean(3).alias("avg3"),
        rolling_mean(6).alias("avg6"),
        lagged(12).alias("lag12"),
    )


def series_state(monthly: DataFrame, fallback_window: int = 3) -> DataFrame:
    """Both feature sets plus what forecasting needs, one row per series month.

    ``n`` rows so far, ``size`` rows in all and their mean ``level``, ``next_month`` and the count found
    there (``actual``, null on the last row), the value 12 months before the next
    month (``lag11``), the mean of the last ``fallback_window`` rows (``recent_mean``) and
    the short-history default (``fallback``, M4).
    """
    return monthly.select(
        "category", "month", "count",
        F.row_number().over(_series()).alias("n"),
        F.count(F.lit(1)).over(Window.partitionBy("category")).alias("size"),
        F.avg("count").over(Window.partitionBy("category")).alias("level"),
        next_month(F.col("month")).alias("next_month"),
        F.lead("count").over(_series()).alias("actual"),
        F.month("month").cast("double").alias("month_num"),
        F.year("month").cast("double").alias("year"),
        month_sin(F.col("month")).alias("month_sin"),
        month_cos(F.col("month")).alias("month_cos"),
        year_offset(F.col("month")).alias("year_norm"),
        *[lagged(k).alias(f"lag{k}") for k in (1, 2, 3, 11, 12)],
        rolling_mean(3).alias("avg3"),
        rolling_mean(6).alias("avg6"),
        tail_mean(3).alias("mean3"),
        tail_mean(6).alias("mean6"),
        tail_mean(fallback_window).alias("recent_mean"),
        F.avg("count").over(_series().rowsBetween(-2, 0)).alias("up_to_3"),
        F.coalesce(tail_mean(3), F.col("count")).alias("fallback"),
    )


#: Which month the inputs of a forecast describe: the last one known, or the one to be predicted.
ANCHORS = ("last_row", "next_month")


def anchor_features(anchors: DataFrame, anchor: str = "last_row") -> DataFrame:
    """The inputs a row of ``series_state`` is forecast from.

    ``last_row`` keeps the row's own features, so the last known month is described
    again. ``next_month`` is the feature row of the month that is not there yet: its
    calendar, the row's count as lag 1, means that end with it, and the count a year before it.
    """
    if anchor not in ANCHORS:
        raise ValueError(f"anchor must be one of {', '.join(ANCHORS)}, not {anchor}")
    if anchor == "last_row":
        return anchors
    month = F.col("next_month")
    ahead = {
        "month_num": F.month(month).cast("double"), "year": F.year(month).cast("double"),
        "month_sin": month_sin(month), "month_cos": month_cos(month), "year_norm": year_offset(month),
        "lag1": F.col("count"), "lag2": F.col("lag1"), "lag3": F.col("lag2"),
        "avg3": F.col("mean3"), "avg6": F.col("mean6"), "lag12": F.col("lag11"),
    }
    return anchors.withColumns(ahead)


def training_rows(features: DataFrame, core: Sequence[str]) -> DataFrame:
    """M3: rows with every core feature present."""
    return features.dropna(subset=[*core, "count"])
