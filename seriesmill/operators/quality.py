"""Series selection and per-series summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import exact_quantiles


def category_totals(monthly: DataFrame) -> DataFrame:
    """A3: total count per category."""
    return monthly.groupBy("category").agg(F.sum("count").alias("total"))


def history_length(monthly: DataFrame) -> DataFrame:
    """A4: months per category. The series hold one row per month, so rows count."""
    return monthly.groupBy("category").agg(F.count(F.lit(1)).alias("months"))


def top_categories(monthly: DataFrame, n: int) -> DataFrame:
    """O1: the n categories with the largest totals, ties by name."""
    return category_totals(monthly).orderBy(F.desc("total"), "category").limit(n)


def top_items(monthly: DataFrame, n: int) -> DataFrame:
    """O1: all rows of the top n categories; n <= 0 keeps everything."""
    if not n or n <= 0:
        return monthly
    return monthly.join(top_categories(monthly, n), "category", "left_semi")


def with_recency(monthly: DataFrame) -> DataFrame:
    """Position of each row counted back from the end of its series."""
    newest_first = Window.partitionBy("category").orderBy(F.desc("month"))
    return monthly.withColumn("back", F.row_number().over(newest_first))


def min_history(monthly: DataFrame, months: int) -> DataFrame:
    """Series with at least that many rows, filled zeros included."""
    whole = Window.partitionBy("category")
    return (
        monthly.withColumn("_n", F.count(F.lit(1)).over(whole))
        .where(F.col("_n") >= months)
        .drop("_n")
    )


def recent_activity(monthly: DataFrame, window: int, min_nonzero: int) -> DataFrame:
    """Series with enough non-zero rows among their own last ``window`` rows."""
    if min_nonzero <= 0:
        return monthly
    whole = Window.partitionBy("category")
    active = F.sum(F.when((F.col("back") <= window) & (F.col("count") > 0), 1).otherwise(0))
    return (
        with_recency(monthly)
        .withColumn("_active", active.over(whole))
        .where(F.col("_active") >= min_nonzero)
        .drop("back", "_active")
    )


def filter_sparse(monthly: DataFrame, months: int, window: int, min_nonzero: int) -> DataFrame:
    """P8 then P9."""
    return recent_activity(min_history(monthly, months), window, min_nonzero)


def auto_relax(
    monthly: DataFrame,
    top: int,
    months: int,
    window: int,
    min_nonzero: int,
    relax_below: int = 5,
) -> DataFrame:
    """P10: the strict filters, or loosened ones if fewer than five series survive.

    The choice depends on the whole table, so the number of survivors comes in as
    a scalar subquery and the plan stays lazy. Adds the column ``relaxed``.
    """
    # The recent window is never longer than the table has months.
    span = monthly.select("month").distinct().agg(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()
    in_window = F.col("back") <= F.least(F.lit(window), span)
    facts = (
        with_recency(monthly)
        .withColumn("_active", F.when(in_window & (F.col("count") > 0), 1).otherwise(0))
        .groupBy("category")
        .agg(
            F.sum("count").alias("total"),
            F.count(F.lit(1)).alias("months"),
            F.sum("_active").alias("active"),
        )
    )
    candidates = facts
    if top and top > 0:
        candidates = facts.orderBy(F.desc("total"), "category").limit(top)
    strict = candidates.where(
        (F.col("months") >= months) & ((F.col("active") >= min_nonzero) | F.lit(min_nonzero <= 0))
    ).select("category")
    few = strict.agg(F.count(F.lit(1)) < relax_below).scalar()
    strict_set = strict.withColumn("_strict", F.lit(True))
    # Loosened: no top list, at least two months (one if the table has only one).
    chosen = (
        facts.join(strict_set, "category", "left")
        .withColumn("relaxed", few)
        .where(
            F.when(F.col("relaxed"), F.col("months") >= F.least(F.lit(2), span)).otherwise(
                F.col("_strict").isNotNull()
            )
        )
        .select("category", "relaxed")
    )
    return monthly.join(chosen, "category")


def recent_average(monthly: DataFrame, window: int) -> DataFrame:
    """Mean of each series' own last rows."""
    return (
        with_recency(monthly)
        .where(F.col("back") <= window)
        .groupBy("category")
        .agg(F.avg("count").alias("recent_avg"))
    )


def overall_average(monthly: DataFrame) -> DataFrame:
    """Mean over the whole history."""
    return monthly.groupBy("category").agg(F.avg("count").alias("overall_avg"))


def averages(monthly: DataFrame, window: int | Column) -> DataFrame:
    """A6 + A7 in one pass over the series; the window may be a value of the row."""
    return (
        with_recency(monthly)
        .groupBy("category")
        .agg(
            F.avg(F.when(F.col("back") <= window, F.col("count"))).alias("recent_avg"),
            F.avg("count").alias("overall_avg"),
        )
    )


def last_month_counts(monthly: DataFrame) -> DataFrame:
    """Counts in the globally last month, as ``category, month, last_month``."""
    latest = monthly.agg(F.max("month")).scalar()
    return monthly.where(F.col("month") == latest).select("category", "month", F.col("count").alias("last_month"))


def run_summary(monthly: DataFrame) -> DataFrame:
    """A5: rows, categories, months and the covered range, as one row."""
    per_category = monthly.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.min("month").alias("lo"), F.max("month").alias("hi")
    )
    totals = per_category.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("categories"),
        F.min("lo").alias("first_month"),
        F.max("hi").alias("last_month"),
    )
    return totals.withColumn("months", monthly.select("month").distinct().agg(F.count(F.lit(1))).scalar())


def count_stats(monthly: DataFrame) -> DataFrame:
    """Mean, median, sample deviation, maximum, total and share of zero rows."""
    plain = monthly.agg(
        F.avg("count").alias("mean"),
        F.stddev_samp("count").alias("std"),
        F.max("count").alias("max"),
        F.sum("count").alias("total"),
        F.avg((F.col("count") == 0).cast("double")).alias("sparsity"),
    )
    return plain.withColumn("median", exact_quantiles(monthly, [], "count", [0.5]).scalar())
