"""Gaussian naive Bayes over demand classes.

A class is a range of target values that each fold cuts elsewhere. All cuts together
divide the values into a few intervals; one pass keeps the feature moments of each
interval and period between folds. A fold's classes are merged from those rows, which are
few whatever the values. Nothing comes to the driver: the fitted classes join the rows
to be forecast as one small array for each fold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.ordered import exact_quantiles
from ...sources.shared import use_shared_folder
from ..features import CALENDAR, CALENDAR_CORE, anchor_features, training_rows
from .base import FINAL, anchors, fold_list, forecast_columns, with_since

# Edges used with few non-zero targets, and the row minimum.
FEW_NONZERO = 20
PLAIN_EDGES = (5.0, 20.0)
MIN_ROWS = 20
VARIANCE_SMOOTHING = 1e-9


@dataclass(frozen=True)
class TrainingValues:
    """Stored training rows ``(since, count, features)``, and the folds ``(at, fold)``.

    A row serves the folds from position ``since`` on.
    """

    rows: DataFrame
    folds: DataFrame

    def groups(self) -> DataFrame:
        """``(since, fold)``: which rows each fold learns from."""
        return self.folds.select(F.explode(F.sequence(F.lit(0), "at")).alias("since"), "fold")


def training_values(state: DataFrame, folds: DataFrame | None = None) -> TrainingValues:
    """Runs a job: the training rows are stored, for several passes read them."""
    use_shared_folder(state.sparkSession)
    one = state.sparkSession.range(1)
    if folds is None:
        numbered = one.select(F.lit(0).alias("at"), F.lit(FINAL).alias("fold"))
    else:
        numbered = one.select(F.posexplode(fold_list(folds)).alias("at", "fold"))
    rows = with_since(training_rows(state, CALENDAR_CORE), folds).select("since", "count", *CALENDAR)
    if folds is not None:
        rows = rows.where(F.col("since") < F.size(fold_list(folds)))
    return TrainingValues(rows.checkpoint(), numbered)


def demand_bins(values: TrainingValues) -> DataFrame:
    """Upper edges of the low and mid class per fold."""
    nonzero = values.rows.where(F.col("count") > 0)
    cuts = exact_quantiles(nonzero, ["since"], "count", [0.33, 0.66], groups=values.groups())
    sizes = values.rows.groupBy("since").agg(F.count(F.when(F.col("count") > 0, 1)).alias("nonzero"))
    sizes = sizes.join(F.broadcast(values.groups()), "since").groupBy("fold").agg(F.sum("nonzero").alias("nonzero"))
    low = F.greatest(F.col("q0"), F.lit(1.0))
    high = F.greatest(F.col("q1"), low + 1)
    enough = F.col("nonzero") >= FEW_NONZERO
    return sizes.join(cuts, "fold", "left").select(
        "fold",
        "nonzero",
        F.when(enough, low).otherwise(F.lit(PLAIN_EDGES[0])).alias("low_edge"),
        F.when(enough, high).otherwise(F.lit(PLAIN_EDGES[1])).alias("high_edge"),
    )


def _cuts(bins: DataFrame) -> Column:
    """All edges of all folds and 0, ascending: at most two for each fold and one."""
    edges = bins.select(F.explode(F.array("low_edge", "high_edge", F.lit(0.0))).alias("edge"))
    return edges.agg(F.sort_array(F.collect_set("edge"))).scalar()


def with_interval(rows: DataFrame, bins: DataFrame) -> DataFrame:
    """Adds ``interval``, the number of edges below the count; an edge belongs to the values under it."""
    below = F.filter("_cuts", lambda edge: edge < F.col("count"))
    return rows.withColumn("_cuts", _cuts(bins)).withColumn("interval", F.size(below)).drop("_cuts")


def interval_classes(values: TrainingValues, bins: DataFrame) -> DataFrame:
    """``(since, interval, fold, class)``: 0 none, 1 low, 2 mid, 3 high. A few rows for each fold.

    No edge of a fold lies inside an interval, so its upper end tells the class.
    """
    upper = F.get("_cuts", F.col("interval"))
    label = (
        F.when(upper <= 0, 0).when(upper <= F.col("low_edge"), 1).when(upper <= F.col("high_edge"), 2).otherwise(3)
    )
    spread = values.folds.join(bins, "fold").withColumn("_cuts", _cuts(bins))
    spread = spread.withColumn("interval", F.explode(F.sequence(F.lit(0), F.size("_cuts"))))
    return spread.select(F.explode(F.sequence(F.lit(0), "at")).alias("since"), "interval", "fold", label.alias("class"))


def interval_moments(values: TrainingValues, bins: DataFrame) -> DataFrame:
    """Rows, rows with lag12, mean and variance of each feature per period and interval.

    One aggregation over all training rows; the result has a few rows for each fold.
    """
    return with_interval(values.rows, bins).groupBy("since", "interval").agg(
        F.count(F.lit(1)).cast("double").alias("rows"),
        F.count("lag12").cast("double").alias("known"),
        *[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"mean_{c}") for c in CALENDAR],
        *[F.coalesce(F.var_pop(c), F.lit(0.0)).alias(f"var_{c}") for c in CALENDAR],
    )


_CLASSES = (
    "fold date, train_rows long, lag12_mean double, classes array<struct<class: int, class_rows: long, "
    "stats: map<string, struct<mean: double, var: double>>>>"
)


def _merged(weight: np.ndarray, mean: np.ndarray, var: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and variance of parts (rows) by feature (columns), around the common mean."""
    total = np.maximum(weight.sum(axis=0), 1e-300)
    common = (weight * mean).sum(axis=0) / total
    return common, (weight * (var + (mean - common) ** 2)).sum(axis=0) / total


def _fold_classes(parts: pd.DataFrame) -> tuple[int, float, list[dict]]:
    """Rows, means and smoothed variances of the classes of one fold, and the mean of lag12.

    A row without a lag12 counts with the mean of the known ones, so all of them
    together are one more part with that mean and no variance.
    """
    rows, known = parts["rows"].to_numpy(float), parts["known"].to_numpy(float)
    mean, var = (parts[[f"{m}_{c}" for c in CALENDAR]].to_numpy(float) for m in ("mean", "var"))
    at = CALENDAR.index("lag12")
    lag12_mean = float((known * mean[:, at]).sum() / known.sum()) if known.sum() else 0.0
    weight = np.repeat(rows[:, None], len(CALENDAR), axis=1)
    share = known / rows
    filled = share * mean[:, at] + (1 - share) * lag12_mean
    var[:, at] = share * (var[:, at] + (mean[:, at] - filled) ** 2) + (1 - share) * (lag12_mean - filled) ** 2
    mean[:, at] = filled
    smoothing = VARIANCE_SMOOTHING * _merged(weight, mean, var)[1].max()
    classes = []
    for label in sorted(parts["class"].unique()):
        own = (parts["class"] == label).to_numpy()
        m, v = _merged(weight[own], mean[own], var[own])
        stats = {c: {"mean": float(m[k]), "var": float(v[k] + smoothing)} for k, c in enumerate(CALENDAR)}
        classes.append({"class": int(label), "class_rows": int(rows[own].sum()), "stats": stats})
    return int(rows.sum()), lag12_mean, classes


def fold_classes(values: TrainingValues, bins: DataFrame) -> DataFrame:
    """``fold, train_rows, lag12_mean, classes``: rows and, by feature, mean and smoothed variance of each class.

    What is merged here are a few rows for each fold, whatever the table.
    """
    parts = interval_moments(values, bins).join(F.broadcast(interval_classes(values, bins)), ["since", "interval"])

    def merge(of_fold: pd.DataFrame) -> pd.DataFrame:
        rows, lag12_mean, classes = _fold_classes(of_fold)
        return pd.DataFrame({"fold": of_fold["fold"].iloc[:1], "train_rows": [rows], "lag12_mean": [lag12_mean], "classes": [classes]})

    return parts.groupBy("fold").applyInPandas(merge, _CLASSES)


def class_stats(values: TrainingValues, bins: DataFrame) -> DataFrame:
    """Rows, mean and smoothed variance per fold, class and feature."""
    rows = fold_classes(values, bins).select("fold", "train_rows", "lag12_mean", F.inline("classes"))
    rows = rows.select("fold", "class", "class_rows", "train_rows", "lag12_mean", F.explode("stats").alias("feature", "s"))
    return rows.select("fold", "class", "feature", "class_rows", "train_rows", "lag12_mean", "s.mean", "s.var")


def present_medians(values: TrainingValues, bins: DataFrame) -> DataFrame:
    """Median target of the classes that occur."""
    rows = with_interval(values.rows.select("since", "count"), bins)
    middle = exact_quantiles(rows, ["since", "interval"], "count", [0.5], groups=interval_classes(values, bins))
    return middle.select("fold", "class", F.col("q0").alias("median"))


def class_medians(values: TrainingValues, bins: DataFrame) -> DataFrame:
    """Median target per fold and class; an empty class gets the overall one."""
    overall = exact_quantiles(values.rows, ["since"], "count", [0.5], groups=values.groups())
    return (
        overall.select("fold", F.col("q0").alias("_all"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("class"))
        .join(present_medians(values, bins), ["fold", "class"], "left")
        .select("fold", "class", F.coalesce("median", "_all").alias("median"))
    )


def fit(state: DataFrame, folds: DataFrame | None = None) -> DataFrame:
    """The fitted model, one row per fold with an array of at most four classes and their medians."""
    values = training_values(state, folds)
    # A row for each fold that all later steps read.
    bins = demand_bins(values).checkpoint()
    medians = present_medians(values, bins).groupBy("fold").agg(F.map_from_entries(F.collect_list(F.struct("class", "median"))).alias("medians"))
    return fold_classes(values, bins).join(F.broadcast(medians), "fold")


def _log_density(c: Column) -> Column:
    total = F.log(c["class_rows"] / F.col("train_rows"))
    for name in CALENDAR:
        x = F.coalesce(F.col("lag12"), F.col("lag12_mean")) if name == "lag12" else F.col(name)
        stats = c["stats"][name]
        spread = F.greatest(stats["var"], F.lit(1e-300))
        total = total - (F.log(2 * F.pi() * spread) + F.pow(x - stats["mean"], 2) / spread) / 2
    return total


def naive_bayes(state: DataFrame, folds: DataFrame | None = None, anchor: str = "last_row") -> DataFrame:
    """The median count of the most likely demand class.

    The fitted classes join the anchor rows as one small array per fold, so
    scoring needs no shuffle. Ties go to the lower class.
    """
    targets = anchor_features(anchors(state, folds), anchor)
    # One row for each fold, with four classes at most.
    scored = targets.join(F.broadcast(fit(state, folds)), "fold", "left")
    best = F.array_max(
        F.transform(
            "classes",
            lambda c: F.struct(_log_density(c).alias("s"), (-c["class"]).alias("c"), F.element_at("medians", c["class"]).alias("m")),
        )
    )["m"]
    average = F.col("up_to_3")
    short = F.when(average > 0, average).otherwise(F.col("count"))
    few = F.coalesce(F.col("train_rows"), F.lit(0)) < MIN_ROWS
    predicted = F.when(few, F.col("fallback")).when(F.col("avg6").isNull(), short).otherwise(best)
    return forecast_columns(scored, predicted, F.when(few | F.col("avg6").isNull(), "short").otherwise("model"))
