"""One forecasting run from a raw table to ranked forecasts and reports."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ForecastConfig
from ..operators import backtest, combine, insights, metrics, monthly, quality
from ..sources.shared import use_shared_folder
from ..sources.sinks import metrics_report


@dataclass
class ForecastRun:
    """Results of a run, as DataFrames. Series, backtest and forecasts are stored once."""

    config: ForecastConfig
    summary: DataFrame
    series: DataFrame
    backtest: DataFrame | None
    metrics: DataFrame | None
    weights: DataFrame | None
    forecasts: DataFrame

    @cached_property
    def model(self) -> str:
        return insights.default_model(self.forecasts)

    @cached_property
    def view(self) -> DataFrame:
        return insights.prediction_view(self.forecasts, self.series, self.model)

    def report(self) -> DataFrame:
        empty = "model string, mae double, rmse double, mape double, samples long"
        table = self.metrics
        if table is None:
            table = self.series.sparkSession.createDataFrame([], empty)
        return metrics_report(self.series, table)


def run(raw: DataFrame, config: ForecastConfig = ForecastConfig()) -> ForecastRun:
    """Raw rows to forecasts: rollup, filters, backtest, blend, guard, repair, rank.

    ``rank`` is taken before the guardrail and ``final_rank`` after the repair.
    ``status`` says where a prediction came from (see ``models.base``; an ensemble of which a
    part is not from its model is "part"). Tables that several later plans read are checkpointed.
    """
    spark = raw.sparkSession
    use_shared_folder(spark)
    roles = config.roles(raw.columns)
    layouts = config.date_layouts or monthly.DATE_LAYOUTS
    rolled = monthly.monthly_series(raw, roles, config.only_material, layouts)
    filled = monthly.gap_fill(rolled).checkpoint()
    if roles.material and filled.isEmpty():
        kept = monthly.filter_material(raw, roles.material, config.only_material)
        monthly.require_material(raw, kept, roles.material)
    summary = quality.run_summary(filled)
    kept = monthly.exclude_latest(filled) if config.exclude_latest else filled
    series = quality.auto_relax(
        kept, config.top_items, config.min_history, config.recent_window,
        config.min_recent_nonzero, config.relax_below,
    ).checkpoint()
    if series.isEmpty():
        raise ValueError("No series remained after filtering.")

    options = config.model_options()
    rows = scores = weights = None
    if config.backtest_months > 0:
        rows = backtest.backtest_rows(series, config.models, config.backtest_months, options=options).checkpoint()
        scores = metrics.core_metrics(rows)
        weights = combine.inverse_error_weights(scores, config.weight_floor)

    ranked = combine.multi_model(series, config.models, weights, with_status=True, options=options)
    # Loosened filters also shorten the recent window: to three months, or all there are.
    span = kept.agg(F.count_distinct("month")).scalar()
    window = F.when(F.col("relaxed"), F.least(F.lit(3), span)).otherwise(F.lit(config.recent_window))
    means = quality.averages(series, window)
    if config.guardrail:
        ranked = combine.guardrail(ranked, means, config.guardrail)
    forecasts = combine.rank_forecasts(combine.repair_zeros(ranked, means), "final_rank").checkpoint()
    return ForecastRun(config, summary, series, rows, scores, weights, forecasts)
