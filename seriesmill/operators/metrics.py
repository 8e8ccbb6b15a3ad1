"""Accuracy tables over backtest rows and data profiles."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import exact_quantiles
from ..functions.scalars import error_percent, one_decimal
from .quality import history_length


def core_metrics(rows: DataFrame) -> DataFrame:
    """MAE, RMSE, MAPE (a fraction) and sample count per model."""
    return rows.groupBy("model").agg(
        F.avg("abs_error").alias("mae"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
        F.avg("ape").alias("mape"),
        F.count(F.lit(1)).alias("samples"),
    )


def correlation(x: str, y: str) -> Column:
    """Pearson correlation, null where a column does not vary."""
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y)))


def _share(condition: Column) -> Column:
    return F.avg(condition.cast("double")) * 100


def extended_metrics(rows: DataFrame) -> DataFrame:
    """Also median APE, bias, R2, correlation and hit rates; percentages in percent."""
    squares = F.sum(F.col("error") * F.col("error"))
    spread = F.var_pop("actual") * F.count(F.lit(1))
    plain = rows.groupBy("model").agg(
        F.avg("abs_error").alias("mae"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
        (F.avg("ape") * 100).alias("mape_pct"),
        F.avg("error").alias("bias"),
        F.when(spread > 0, 1 - squares / spread).alias("r2"),
        correlation("actual", "predicted").alias("corr"),
        _share(F.col("ape") <= 0.20).alias("hit20pct"),
        _share(F.col("ape") <= 0.50).alias("hit50pct"),
        F.count(F.lit(1)).alias("n"),
    )
    middle = exact_quantiles(rows, ["model"], "ape", [0.5]).select(
        "model", (F.col("q0") * 100).alias("mdape_pct")
    )
    return plain.join(F.broadcast(middle), "model")  # one row per model


def verdict(mape: Column) -> Column:
    """How far forecasts with this error can be relied on."""
    return (
        F.when(mape < 0.20, "reliable")
        .when(mape < 0.50, "directional")
        .otherwise("needs more history")
    )


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Models from best to worst MAPE, the best one flagged, with a verdict."""
    best = metrics.agg(F.min(F.struct("mape", "model"))["model"]).scalar()
    return (
        metrics.withColumn("tag", F.when(F.col("model") == best, "Best").otherwise("Other"))
        .withColumn("verdict", verdict(F.col("mape")))
        .orderBy("mape", "model")
    )


def mape_by_month(rows: DataFrame) -> DataFrame:
    """E5: MAPE in percent per model and evaluation month."""
    return rows.groupBy("model", "eval_month").agg((F.avg("ape") * 100).alias("mape_pct"))


def mape_by_category(rows: DataFrame, models: Sequence[str]) -> DataFrame:
    """MAPE in percent, a column per model, best categories first."""
    wide = rows.groupBy("category").pivot("model", list(models)).agg(F.avg("ape") * 100)
    known = [F.col(m) for m in models]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in known), F.lit(0.0))
    filled = sum((c.isNotNull().cast("int") for c in known), F.lit(0))
    return wide.withColumn("mean_mape", F.try_divide(total, filled)).orderBy("mean_mape", "category")


def model_agreement(rows: DataFrame, models: Sequence[str]) -> DataFrame:
    """Correlation of every two models over rows all of them predicted."""
    models = list(models)
    wide = (
        rows.groupBy("category", "eval_month").pivot("model", models).agg(F.avg("predicted")).dropna(subset=models)
    )
    cells = [
        F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"), correlation(a, b).alias("corr"))
        for a, b in product(models, models)
    ]
    return wide.agg(F.array(*cells).alias("_c")).select(F.inline("_c"))


def ape_box(rows: DataFrame, ceiling: float = 2.0) -> DataFrame:
    """Box-plot numbers of APE in percent per model, APE cut at the ceiling."""
    shown = rows.select("model", (F.least("ape", F.lit(ceiling)) * 100).alias("v"))
    box = exact_quantiles(shown, ["model"], "v", [0.25, 0.5, 0.75]).select(
        "model", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3")
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    v = F.col("v")
    return (
        shown.join(F.broadcast(box), "model")  # one row per model
        .groupBy("model")
        .agg(
            F.max("q1").alias("q1"),
            F.max("median").alias("median"),
            F.max("q3").alias("q3"),
            F.min(F.when(v >= F.col("q1") - reach, v)).alias("whisker_low"),
            F.max(F.when(v <= F.col("q3") + reach, v)).alias("whisker_high"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def density(
    rows: DataFrame, key: str, value: str, points: int = 100, expand: float = 0.5, min_rows: int = 6
) -> DataFrame:
    """Gaussian kernel density per key on an even grid, Scott bandwidth.

    Equal values are counted first. One aggregation then keeps a sum for each grid point,
    so no row is multiplied and a task sends one row for each key.
    """
    spread = rows.groupBy(key).agg(
        F.count(value).alias("n"),
        F.min(value).alias("lo"),
        F.max(value).alias("hi"),
        F.stddev_samp(value).alias("sd"),
    ).where((F.col("n") >= min_rows) & (F.col("sd") > 0))
    scaled = spread.select(
        key,
        "n",
        (F.col("sd") * F.pow("n", F.lit(-0.2))).alias("h"),
        (F.col("lo") - (F.col("hi") - F.col("lo")) * expand).alias("start"),
        ((F.col("hi") - F.col("lo")) * (1 + 2 * expand) / (points - 1)).alias("step"),
    )
    counted = rows.where(F.col(value).isNotNull()).groupBy(key, F.col(value).alias("v")).agg(
        F.count(F.lit(1)).alias("c")
    )

    def bump(point: int) -> Column:
        away = (F.col("start") + point * F.col("step") - F.col("v")) / F.col("h")
        return F.sum(F.col("c") * F.exp(-away * away / 2)).alias(f"_{point}")

    sums = counted.join(scaled, key).groupBy(key, "n", "h", "start", "step").agg(*[bump(k) for k in range(points)])
    grid = sums.select(key, "n", "h", "start", "step", F.posexplode(F.array(*[f"_{k}" for k in range(points)])).alias("point", "bumps"))
    return grid.select(
        key,
        F.col("point").cast("long").alias("point"),
        (F.col("start") + F.col("point") * F.col("step")).alias("x"),
        (F.col("bumps") / (F.col("n") * F.col("h") * F.sqrt(2 * F.pi()))).alias("density"),
    )


def error_density(rows: DataFrame, limit: float = 200.0, points: int = 100) -> DataFrame:
    """Density of signed errors per model, errors cut at +-limit."""
    cut = rows.select("model", F.greatest(F.lit(-limit), F.least("error", F.lit(limit))).alias("error"))
    return density(cut, "model", "error", points)


def demand_density(view: DataFrame, points: int = 100) -> DataFrame:
    """Densities of predicted and last-month counts over their own range."""
    long = view.select("category", "predicted", "last_month").unpivot(
        "category", ["predicted", "last_month"], "period", "checkouts"
    )
    return density(long, "period", "checkouts", points, expand=0.0, min_rows=2)


def backtest_scatter(rows: DataFrame) -> DataFrame:
    """Predicted against actual with the error in percent, to one decimal."""
    return rows.select(
        "model", "eval_month", "category", "actual", "predicted",
        one_decimal(error_percent(F.col("actual"), F.col("predicted"))).alias("error_pct"),
    )


def histogram(rows: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; empty bins too."""
    v = F.col(value)
    ends = rows.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    flat = F.col("_hi") == F.col("_lo")
    ends = ends.select(
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("hi"),
    )
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    place = F.least(F.floor((v - lo) / (hi - lo) * bins), F.lit(bins - 1))
    filled = (
        rows.where(v.isNotNull())
        .select(place.cast("long").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    every = ends.select("lo", width.alias("width"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (
        every.withColumn("bin", F.col("bin").cast("long"))
        .join(F.broadcast(filled), "bin", "left")  # at most one row per bin
        .select(
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("from_value"),
            (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("to_value"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def log_count_histogram(monthly: DataFrame, bins: int = 50) -> DataFrame:
    """log(1 + count) of the non-zero rows."""
    return histogram(monthly.where(F.col("count") > 0).select(F.log1p("count").alias("v")), "v", bins)


def history_histogram(monthly: DataFrame, bins: int = 20) -> DataFrame:
    """Months of history per series."""
    return histogram(history_length(monthly).select(F.col("months").cast("double").alias("v")), "v", bins)


def zero_rate(monthly: DataFrame) -> DataFrame:
    """Share of zero rows per series."""
    return monthly.groupBy("category").agg(F.avg((F.col("count") == 0).cast("double")).alias("zero_rate"))


def zero_rate_histogram(monthly: DataFrame, bins: int = 20) -> DataFrame:
    """Zero rate per series, in percent."""
    return histogram(zero_rate(monthly).select((F.col("zero_rate") * 100).alias("v")), "v", bins)


def season_by_series(monthly: DataFrame) -> DataFrame:
    """Mean of all series rows per calendar month, the highest one flagged."""
    means = monthly.groupBy(F.month("month").alias("calendar_month")).agg(F.avg("count").alias("mean"))
    peak = means.agg(F.min(F.struct((-F.col("mean")).alias("m"), "calendar_month"))["calendar_month"]).scalar()
    return means.select("calendar_month", "mean", (F.col("calendar_month") == peak).alias("is_peak"))
