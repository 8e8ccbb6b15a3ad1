"""Sinks (S5, S6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_forecasts(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """A forecast table as CSV with header, or any other Spark format.

    O3: each file is sorted by model and category; files stay as many as the
    data needs.
    """
    ordered = df.sortWithinPartitions(*[c for c in ("model", "category", "month") if c in df.columns])
    writer = ordered.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def metrics_report(monthly: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row with the run's size and a map of metrics per model."""
    per_category = monthly.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    sizes = per_category.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("categories")
    )
    months = monthly.select("month").distinct().agg(F.count(F.lit(1)))
    # One entry per model name: bounded by the list of models.
    models = metrics.agg(
        F.map_from_entries(
            F.collect_list(F.struct("model", F.struct("mae", "rmse", "mape", "samples")))
        )
    )
    return sizes.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at"),
        "rows", "categories", months.scalar().alias("months"), models.scalar().alias("models"),
    )


def write_report(report: DataFrame, path: str) -> None:
    """The one-row report as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)
