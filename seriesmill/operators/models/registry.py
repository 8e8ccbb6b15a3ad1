"""Names of forecasters and running several of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...config import ModelOptions
from ..features import series_state
from . import arima, bayes, naive, ridge, smoothing, trees
from .kernels import Kernel, apply_kernel, series_prefixes

# From the series state, in Spark expressions or, for trees, in one barrier stage.
_STATE_MODELS = ("naive", "regression", "naive_bayes", "random_forest", "gradient_boost")
# One solver call per block of equal-length series.
_BUILT_IN_KERNELS = ("holt", "sarima")
_KERNELS: dict[str, Kernel] = {}


def register_model(name: str, kernel: Kernel) -> None:
    """Add a forecaster of your own.

    ``kernel`` takes a (series, months) array of equally long histories and
    returns the next value of each, or None to leave them to the recent average.
    """
    if name in _STATE_MODELS:
        raise ValueError(f"{name} is a built-in model")
    _KERNELS[name] = kernel


def model_names() -> list[str]:
    """Every name ``run_models`` accepts."""
    return list(dict.fromkeys([*_STATE_MODELS, *_BUILT_IN_KERNELS, *_KERNELS]))


def _kernel(name: str, options: ModelOptions) -> Kernel:
    if name in _KERNELS:
        return _KERNELS[name]
    if name == "holt":
        return smoothing.smoother(options.season)
    return arima.sarima_kernel(options.season, options.arima_order, options.seasonal_order)


def run_models(
    monthly: DataFrame,
    names: Iterable[str],
    folds: DataFrame | None = None,
    options: ModelOptions = ModelOptions(),
    **sizes: int,
) -> DataFrame:
    """Raw forecasts of the named models, one row per category, fold and model.

    Columns: ``category, fold, month, actual, predicted, status, model``. ``sizes`` are
    single settings that replace those of ``options``.
    """
    names = list(dict.fromkeys(names))
    unknown = [n for n in names if n not in model_names()]
    if unknown or not names:
        raise ValueError(f"unknown models {unknown}; known: {', '.join(model_names())}")
    options = replace(options, **sizes)
    state = series_state(monthly, options.fallback_window)
    prefixes = series_prefixes(monthly, folds)
    # Forest and boosting read the same binned rows.
    rows = trees.training_table(state, folds) if {"random_forest", "gradient_boost"} & set(names) else None
    run: dict[str, Callable[[], DataFrame]] = {
        "naive": lambda: naive.seasonal_naive(state, folds),
        "regression": lambda: ridge.ridge(state, folds, lag12_anchor=options.anchor),
        "naive_bayes": lambda: bayes.naive_bayes(state, folds, options.anchor),
        "random_forest": lambda: trees.random_forest(state, folds, options.forest_trees, options.anchor, rows),
        "gradient_boost": lambda: trees.gradient_boost(state, folds, options.boost_rounds, options.anchor, rows),
    }
    parts = []
    for name in names:
        part = run[name]() if name in run else apply_kernel(prefixes, _kernel(name, options))
        parts.append(part.withColumn("model", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)
