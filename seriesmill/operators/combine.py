"""Blending, capping, repairing and ranking forecasts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import ordered_position
from ..sources.shared import use_shared_folder
from .models.registry import run_models

FORECAST = ("category", "month", "predicted", "model")


def clip_zero(forecasts: DataFrame) -> DataFrame:
    """No negative demand."""
    return forecasts.withColumn("predicted", F.greatest("predicted", F.lit(0.0)))


def _joint_status(forecasts: DataFrame) -> list[Column]:
    if "status" not in forecasts.columns:
        return []
    return [F.when(F.every(F.col("status") == "model"), "model").otherwise("part").alias("status")]


def ensemble_average(forecasts: DataFrame) -> DataFrame:
    """Mean over the models, carrying each series' target month."""
    return (
        forecasts.groupBy("category")
        .agg(F.max("month").alias("month"), F.avg("predicted").alias("predicted"), *_joint_status(forecasts))
        .withColumn("model", F.lit("ensemble"))
    )


def inverse_error_weights(metrics: DataFrame, floor: float = 0.001) -> DataFrame:
    """``model, weight`` with weights falling with MAPE and adding up to one."""
    raw = metrics.select("model", (1 / F.greatest("mape", F.lit(float(floor)))).alias("_raw"))
    return raw.select("model", (F.col("_raw") / raw.agg(F.sum("_raw")).scalar()).alias("weight"))


def ensemble_weighted(forecasts: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted sum over the models that have a weight. One weight row per model."""
    return (
        forecasts.join(F.broadcast(weights), "model")
        .groupBy("category")
        .agg(F.max("month").alias("month"), F.sum(F.col("predicted") * F.col("weight")).alias("predicted"), *_joint_status(forecasts))
        .withColumn("model", F.lit("ensemble_w"))
    )


def rank_forecasts(forecasts: DataFrame, out: str = "rank") -> DataFrame:
    """Position within the model, largest prediction first, ties by category."""
    return ordered_position(forecasts, ["model"], [("predicted", True), ("category", False)], out)


def blended_forecasts(
    monthly: DataFrame, models: Iterable[str], weights: DataFrame | None = None, with_status: bool = False, **settings
) -> DataFrame:
    """M19 + M20 + M22: clipped forecasts of all models and the ensembles, unranked.

    Ensembles need at least two models; the weighted one also needs weights. ``settings``
    go to ``run_models``. ``with_status`` keeps where each prediction came from; an
    ensemble is "model" if all it blends are.
    """
    names = list(dict.fromkeys(models))
    base = clip_zero(run_models(monthly, names, **settings)).select(*FORECAST, *(["status"] if with_status else []))
    if len(names) < 2:
        return base
    blended = base.unionByName(ensemble_average(base))
    if weights is not None:
        blended = blended.unionByName(ensemble_weighted(base, weights))
    return blended


def multi_model(
    monthly: DataFrame, models: Iterable[str], weights: DataFrame | None = None, with_status: bool = False, **settings
) -> DataFrame:
    """The ranked forecast table of all models and ensembles.

    Ranking reads its input several times, so the models' output is stored first.
    """
    use_shared_folder(monthly.sparkSession)
    return rank_forecasts(blended_forecasts(monthly, models, weights, with_status, **settings).checkpoint())


def guardrail(forecasts: DataFrame, recent_avg: DataFrame, multiplier: float) -> DataFrame:
    """Cap at a multiple of the recent average, where that is above zero."""
    cap = F.col("recent_avg") * float(multiplier)
    capped = F.when(F.col("recent_avg") > 0, F.least("predicted", cap)).otherwise(F.col("predicted"))
    return (
        forecasts.join(recent_avg.select("category", "recent_avg"), "category", "left")
        .withColumn("predicted", capped)
        .drop("recent_avg")
    )


def repair_zeros(forecasts: DataFrame, averages: DataFrame) -> DataFrame:
    """A model predicting nothing at all falls back to recent, then overall average.

    ``averages`` has ``category, recent_avg, overall_avg``. Adds ``repaired``, true
    on every row of an affected model.
    """
    dead = forecasts.groupBy("model").agg((F.sum("predicted") <= 0).alias("repaired"))
    value = F.when(F.col("predicted") > 0, F.col("predicted")).otherwise(F.col("recent_avg"))
    value = F.coalesce(F.when(value > 0, value).otherwise(F.col("overall_avg")), F.lit(0.0))
    return (
        forecasts.join(F.broadcast(dead), "model")  # one row per model
        .join(averages.select("category", "recent_avg", "overall_avg"), "category", "left")
        .withColumn("predicted", F.when(F.col("repaired"), value).otherwise(F.col("predicted")))
        .drop("recent_avg", "overall_avg")
    )


def best_per_model(forecasts: DataFrame, n: int = 5) -> DataFrame:
    """The first n of each model. Spark cuts to n per task before shuffling."""
    lane = Window.partitionBy("model").orderBy(F.desc("predicted"), "category")
    return (
        forecasts.withColumn("position", F.row_number().over(lane))
        .where(F.col("position") <= n)
        .withColumn("position", F.col("position").cast("long"))
    )
