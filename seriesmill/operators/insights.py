"""Planning tables derived from forecasts and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ENSEMBLES, MODEL_LABELS
from ..functions.scalars import direction, month_label, next_month, short_label, signed_label
from .quality import with_recency

# Month names of the seasonal profile.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def model_label(model: Column) -> Column:
    """Display name of a model, its own name if it has none."""
    pairs = [F.lit(x) for item in MODEL_LABELS.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), model), model)


def default_model(forecasts: DataFrame) -> str:
    """Weighted ensemble, else plain ensemble, else the first model by name. Runs a job."""
    # One row per model.
    present = sorted(r.model for r in forecasts.select("model").distinct().collect())
    if not present:
        raise ValueError("no forecasts")
    return next((m for m in ("ensemble_w", "ensemble") if m in present), present[0])


def prediction_view(forecasts: DataFrame, monthly: DataFrame, model: str) -> DataFrame:
    """One model's predictions beside last month and the long-run average.

    Last-month counts are those of the globally last month, so a series that ended
    earlier has 0. Both lookups come from one pass over the series and one join.
    """
    latest = monthly.agg(F.max("month")).scalar()
    facts = (
        monthly.withColumn("_last", F.when(F.col("month") == latest, F.col("count")))
        .groupBy("category")
        .agg(F.sum("_last").alias("_last"), F.avg("count").alias("_mean"))
    )
    gap = F.col("predicted") - F.col("hist_avg")
    return (
        forecasts.where(F.col("model") == model)
        .join(facts, "category", "left")
        .select(
            "category",
            "month",
            "predicted",
            F.coalesce("_last", F.lit(0.0)).alias("last_month"),
            F.coalesce("_mean", F.lit(0.0)).alias("hist_avg"),
        )
        .withColumn("delta", F.col("predicted") - F.col("last_month"))
        .withColumn("vs_avg_pct", gap / F.greatest("hist_avg", F.lit(1.0)) * 100)
    )


def top_rows(view: DataFrame, n: int, by: str = "predicted", descending: bool = True) -> DataFrame:
    """O2: the n largest (or smallest) rows, ties by category."""
    return view.orderBy(F.desc(by) if descending else F.asc(by), "category").limit(n)


def headline(view: DataFrame, monthly: DataFrame, models_run: int) -> DataFrame:
    """Totals, change, share of the ten largest, number of titles and models."""
    latest = monthly.agg(F.max("month")).scalar()
    last = monthly.where(F.col("month") == latest).agg(F.coalesce(F.sum("count"), F.lit(0.0)))
    titles = monthly.select("category").distinct().agg(F.count(F.lit(1)))
    total = view.agg(F.coalesce(F.sum("predicted"), F.lit(0.0)).alias("predicted_total"))
    first_ten = top_rows(view, 10).agg(F.coalesce(F.sum("predicted"), F.lit(0.0)))
    change = F.col("predicted_total") - F.col("last_total")
    return (
        total.withColumn("last_total", last.scalar())
        .withColumn("_ten", first_ten.scalar())
        .withColumn("titles", titles.scalar())
        .select(
            "last_total",
            "predicted_total",
            change.alias("delta_total"),
            F.when(F.col("last_total") > 0, change / F.col("last_total") * 100).alias("pct_change"),
            F.when(F.col("predicted_total") > 0, F.col("_ten") / F.col("predicted_total"))
            .otherwise(F.lit(0.0))
            .alias("top10_share"),
            "titles",
            F.lit(models_run).cast("long").alias("models"),
        )
    )


def top_demand(view: DataFrame, n: int = 15) -> DataFrame:
    """I4: the highest predictions, numbered, with change and trend."""
    # The window runs over the n rows already picked.
    place = Window.orderBy(F.desc("predicted"), "category")
    delta = F.col("delta")
    trend = F.when(delta > 0, "up").when(delta < 0, "down").otherwise("flat")
    return top_rows(view, n).select(
        F.row_number().over(place).cast("long").alias("position"),
        "category", "predicted", "last_month", "delta", trend.alias("trend"), "vs_avg_pct",
    )


def movers(view: DataFrame, n: int = 12) -> DataFrame:
    """The largest rises and the largest falls."""
    rising = top_rows(view.where(F.col("delta") > 0), n, "delta")
    falling = top_rows(view.where(F.col("delta") < 0), n, "delta", descending=False)
    return rising.unionByName(falling).select(
        "category", "predicted", "last_month", "delta",
        direction(F.col("delta")).alias("direction"),
        short_label(F.col("category"), 45).alias("label"),
        signed_label(F.col("delta")).alias("delta_label"),
    )


def deep_dive(monthly: DataFrame, view: DataFrame, category: str | None = None) -> DataFrame:
    """One series' history and forecast point with its length, mean and peak.

    Without a category, the one with the highest prediction.
    """
    chosen = view.where(F.col("category") == category) if category is not None else top_rows(view, 1)
    history = monthly.join(chosen.select("category"), "category", "left_semi")
    facts = history.groupBy("category").agg(
        F.count(F.lit(1)).alias("months"),
        F.avg("count").alias("mean"),
        F.max("count").alias("peak"),
        next_month(F.max("month")).alias("_next"),
    )
    point = chosen.select("category", F.col("predicted").alias("count")).join(
        facts.select("category", F.col("_next").alias("month")), "category"
    )
    both = history.select("category", "month", "count", F.lit("history").alias("kind")).unionByName(
        point.select("category", "month", "count", F.lit("forecast").alias("kind"))
    )
    return both.join(facts.drop("_next"), "category")


def model_range(forecasts: DataFrame) -> DataFrame:
    """Lowest and highest base-model prediction where at least two exist."""
    return (
        forecasts.where(~F.col("model").isin(*ENSEMBLES))
        .groupBy("category")
        .agg(
            F.min("predicted").alias("low"),
            F.max("predicted").alias("high"),
            F.count(F.lit(1)).alias("models"),
        )
        .where(F.col("models") >= 2)
    )


def monthly_totals(monthly: DataFrame) -> DataFrame:
    """Total per month."""
    return monthly.groupBy("month").agg(F.sum("count").alias("total"))


def seasonal_profile(monthly: DataFrame) -> DataFrame:
    """Mean monthly total per calendar month, absent months 0, peaks flagged."""
    means = (
        monthly_totals(monthly)
        .groupBy(F.month("month").alias("calendar_month"))
        .agg(F.avg("total").alias("_mean"))
    )
    # From here on there are twelve rows.
    names = F.array(*[F.lit(m) for m in MONTHS])
    year = monthly.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("calendar_month"))
    full = year.join(F.broadcast(means), "calendar_month", "left").select(
        "calendar_month",
        names[F.col("calendar_month") - 1].alias("name"),
        F.coalesce("_mean", F.lit(0.0)).alias("avg_total"),
    )
    limit = full.agg(F.percentile("avg_total", F.lit(0.67))).scalar()
    return full.select(
        "calendar_month", "name", "avg_total",
        F.when(F.col("avg_total") >= limit, "Peak").otherwise("Normal").alias("season"),
    )


def overall_trend(monthly: DataFrame) -> DataFrame:
    """First and last monthly total, direction and change in percent."""
    ends = monthly_totals(monthly).agg(
        F.min_by("total", "month").alias("first_total"),
        F.max_by("total", "month").alias("last_total"),
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
    )
    first, last = F.col("first_total"), F.col("last_total")
    return ends.select(
        "first_month", "last_month", "first_total", "last_total",
        F.when(last > first, "growing").otherwise("declining").alias("trend"),
        F.abs((last - first) / F.greatest(first, F.lit(1.0)) * 100).alias("pct"),
    )


def all_others(monthly: DataFrame, top: DataFrame) -> DataFrame:
    """Monthly totals of everything outside the given categories."""
    return (
        monthly.join(top.select("category"), "category", "left_anti")
        .groupBy("month")
        .agg(F.sum("count").alias("count"))
    )


def concentration(monthly: DataFrame, top: DataFrame) -> DataFrame:
    """Each top category's share of the month, the rest as "All Others".

    ``top`` is a top-N list, so it is small by construction. One pass adds up both
    the named categories and the rest; a month then has N + 1 rows.
    """
    named = top.select("category", F.lit(True).alias("_named"))
    bucket = F.when(F.col("_named"), F.col("category")).otherwise(F.lit("All Others"))
    sums = (
        monthly.join(named, "category", "left")
        .groupBy("month", bucket.alias("bucket"), F.coalesce("_named", F.lit(False)).alias("is_top"))
        .agg(F.sum("count").alias("count"))
    )
    whole = F.sum("count").over(Window.partitionBy("month"))
    return sums.withColumn("share", F.when(whole > 0, F.col("count") / whole)).select(
        "month", "bucket", "is_top", "count", "share"
    )


def heatmap_cells(monthly: DataFrame, top: DataFrame) -> DataFrame:
    """Counts of the top categories by month, with labels."""
    return monthly.join(top.select("category"), "category", "left_semi").select(
        "category", "month", "count",
        short_label(F.col("category"), 32).alias("label"),
        month_label(F.col("month")).alias("month_label"),
    )


def sparklines(monthly: DataFrame, top: DataFrame, months: int = 12) -> DataFrame:
    """The last rows of the top categories."""
    few = monthly.join(top.select("category"), "category", "left_semi")
    return with_recency(few).where(F.col("back") <= months).select(
        "category", "month", "count", short_label(F.col("category"), 34).alias("label")
    )


def model_compare(forecasts: DataFrame, top: DataFrame) -> DataFrame:
    """Every base model's prediction for the top categories."""
    return (
        forecasts.where(~F.col("model").isin(*ENSEMBLES))
        .join(top.select("category"), "category", "left_semi")
        .select(
            "category", "model", "predicted",
            model_label(F.col("model")).alias("model_label"),
            short_label(F.col("category"), 30).alias("label"),
        )
    )


def planning_actions(view: DataFrame, n: int = 5) -> DataFrame:
    """What to order, which queues to watch, where to cut back."""
    ratio = F.col("predicted") / F.greatest("last_month", F.lit(1.0))
    urgency = F.when(ratio > 1.5, "High").when(ratio > 1.1, "Moderate").otherwise("Stable")
    nothing = F.lit(None).cast("string")

    def block(rows: DataFrame, action: str, note: Column) -> DataFrame:
        return rows.select(
            F.lit(action).alias("action"), "category", "predicted", "last_month", "delta", note.alias("urgency")
        )

    order = block(top_rows(view, n), "Order more copies", urgency)
    watch = block(top_rows(view.where("delta > 0"), n, "delta"), "Watch hold queues", nothing)
    cut = block(top_rows(view.where("delta < 0"), n, "delta", descending=False), "Reallocate budget", nothing)
    return order.unionByName(watch).unionByName(cut)


def planning_bands(view: DataFrame) -> DataFrame:
    """Prediction against the long-run average, in bands."""
    ratio = F.col("predicted") / F.greatest("hist_avg", F.lit(1.0))
    band = (
        F.when(F.col("ratio") > 1.2, "Order more")
        .when(F.col("ratio") >= 1.0, "Watch")
        .when(F.col("ratio") < 0.8, "Reallocate")
        .otherwise("Hold")
    )
    return view.select("category", "predicted", "hist_avg", ratio.alias("ratio")).withColumn("band", band)
