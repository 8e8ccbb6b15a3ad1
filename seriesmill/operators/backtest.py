"""Rolling-origin backtest."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ENSEMBLES
from ..functions.scalars import ape_base
from .models.base import last_folds
from .models.registry import run_models


def with_errors(rows: DataFrame) -> DataFrame:
    """F8: error, absolute error, denominator and absolute percentage error."""
    error: Column = F.col("predicted") - F.col("actual")
    return (
        rows.withColumn("error", error)
        .withColumn("abs_error", F.abs("error"))
        .withColumn("denom", ape_base(F.col("actual")))
        .withColumn("ape", F.col("abs_error") / F.col("denom"))
    )


def backtest_rows(
    monthly: DataFrame, models: Iterable[str], months: int = 3, clip: bool = False, **settings
) -> DataFrame:
    """Predicted against actual for every series, model and evaluation month.

    All folds are one plan: they are a grouping key, not a loop. ``months = 0``
    means no backtest. ``clip`` cuts predictions at zero first. ``settings`` go to ``run_models``.
    """
    names = [m for m in models if m not in ENSEMBLES]
    raw = run_models(monthly, names, folds=last_folds(monthly, months), **settings)
    predicted = F.greatest("predicted", F.lit(0.0)) if clip else F.col("predicted")
    return with_errors(
        raw.where(F.col("predicted").isNotNull()).select(
            "model", F.col("fold").alias("eval_month"), "category", "actual", predicted.alias("predicted")
        )
    )
