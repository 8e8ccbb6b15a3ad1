"""Raw rows to gap-filled monthly series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Material, Roles
from ..functions.scalars import clean_text

# Layouts tried, in this order, for date text that is not ISO.
DATE_LAYOUTS = (
    "M/d/yyyy[ h:mm:ss a]", "yyyy/M/d", "yyyyMMdd", "MMM d, yyyy", "MMM yyyy", "M-d-yyyy", "d MMM yyyy",
    "d/M/yyyy[ H:mm:ss]", "d.M.yyyy", "d-M-yyyy", "MMMM d, yyyy", "d MMMM yyyy", "MMMM yyyy", "M/yyyy", "yyyy.M.d",
)
ISO = "ISO"


def filter_material(df: DataFrame, column: str, words: Material = Material(), strict: bool = False) -> DataFrame:
    """Keep one material type, in two stages.

    Rows equal to the exact word; only if the whole table has none, rows that
    contain a word and none of the excluded ones. ``strict`` keeps the first stage
    only, which needs no look at the whole table (streams, pushdown).
    """
    text = clean_text(F.col(column))
    exact = text == words.exact
    if strict:
        return df.where(exact)
    loose = text.contains(words.contains)
    for word in words.excludes:
        loose = loose & ~text.contains(word)
    # Did any row of the table match exactly? Reads this column only.
    found = df.agg(F.coalesce(F.bool_or(exact), F.lit(False))).scalar()
    return df.where(F.when(found, exact).otherwise(loose))


def require_material(df: DataFrame, filtered: DataFrame, column: str) -> None:
    """Raise if the filter left nothing, naming at most 15 values. Runs a job."""
    if not filtered.isEmpty():
        return
    values = df.select(F.btrim(F.col(column).cast("string")).alias("v")).where("v is not null")
    sample = [r.v for r in values.distinct().orderBy("v").limit(15).collect()]
    raise ValueError(f"no row of {column} fits the material words; it holds {', '.join(sample)}")


def _has_time(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def _read_as(text: Column, layout: str) -> Column:
    return text.try_cast("timestamp") if layout == ISO else F.try_to_timestamp(text, F.lit(layout))


def month_from_date(column: Column, dtype: T.DataType, layouts: Sequence[str] = DATE_LAYOUTS) -> Column:
    """First of the month, each row by the first layout that reads it; text that is no date becomes null."""
    if _has_time(dtype):
        return F.trunc(column, "MM")
    return F.trunc(F.coalesce(*[_read_as(column, layout) for layout in (ISO, *layouts)]), "MM")


def layout_counts(df: DataFrame, column: str, layouts: Sequence[str] = DATE_LAYOUTS) -> DataFrame:
    """One row with the rows that each layout reads (``counts``) and the first that reads most (``layout``).

    Equal texts are counted first, so a layout is tried once for each different text.
    """
    names = [ISO, *layouts]
    texts = df.groupBy(F.col(f"`{column}`").cast("string").alias("text")).agg(F.count(F.lit(1)).alias("c"))
    read = [F.coalesce(F.sum(F.when(_read_as(F.col("text"), n).isNotNull(), F.col("c"))), F.lit(0)) for n in names]
    counts = texts.agg(F.array(*read).alias("counts"))
    best = F.array_position("counts", F.array_max("counts")).cast("int")
    return counts.select("counts", F.element_at(F.array(*[F.lit(n) for n in names]), best).alias("layout"))


def month_in_column(df: DataFrame, column: str, layouts: Sequence[str] = DATE_LAYOUTS) -> Column:
    """First of the month, all rows by the one layout that reads most of the column.

    So ``05/03/2020`` means what the rest of its column says. Text that the layout does not
    read becomes null. Dates and timestamps need no layout.
    """
    text = F.col(f"`{column}`")
    if _has_time(df.schema[column].dataType):
        return F.trunc(text, "MM")
    chosen = layout_counts(df, column, layouts).select("layout").scalar()
    parsed = [F.when(chosen == layout, _read_as(text.cast("string"), layout)) for layout in (ISO, *layouts)]
    return F.trunc(F.coalesce(*parsed), "MM")


def _whole_number(column: Column) -> Column:
    number = column.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def month_from_parts(year: Column, month: Column) -> Column:
    """First of the month from year and month numbers; month 13 becomes null."""
    zero = F.lit(0)
    made = F.try_make_timestamp(
        _whole_number(year), _whole_number(month), F.lit(1), zero, zero, F.lit(0.0)
    )
    return made.cast("date")


def count_value(column: Column | None) -> Column:
    """The count as a number, 0 where it is none or NaN; 1 per row without a column."""
    if column is None:
        return F.lit(1.0)
    return F.nanvl(F.coalesce(column.try_cast("double"), F.lit(0.0)), F.lit(0.0))


def _month(df: DataFrame, roles: Roles, layouts: Sequence[str], by_row: bool) -> Column:
    if not roles.date:
        return month_from_parts(F.col(f"`{roles.year}`"), F.col(f"`{roles.month}`"))
    if by_row:
        return month_from_date(F.col(f"`{roles.date}`"), df.schema[roles.date].dataType, layouts)
    return month_in_column(df, roles.date, layouts)


def typed_rows(df: DataFrame, roles: Roles, layouts: Sequence[str] = DATE_LAYOUTS, by_row: bool = False) -> DataFrame:
    """``category, month, count`` per raw row, rows lacking a key dropped.

    Date text is read by one layout for the whole column, or ``by_row``, which a stream needs.
    """
    month = _month(df, roles, layouts, by_row)
    return df.select(
        F.col(f"`{roles.category}`").cast("string").alias("category"),
        month.alias("month"),
        count_value(F.col(f"`{roles.count}`") if roles.count else None).alias("count"),
    ).dropna(subset=["category", "month"])


def read_report(df: DataFrame, roles: Roles, layouts: Sequence[str] = DATE_LAYOUTS) -> DataFrame:
    """A5/P5: one row on how raw rows were read.

    ``rows``, of these ``kept``, ``no_month`` and ``no_category`` (a row can lack both), ``no_count`` kept
    rows whose count is no number and became 0, and the ``layout`` of the dates (null without date text).
    """
    month, category = _month(df, roles, layouts, False), F.col(f"`{roles.category}`")
    no_number = F.col("_n").isNull() | F.isnan(F.col("_n"))
    number = F.lit(0.0) if not roles.count else F.col(f"`{roles.count}`").try_cast("double")
    seen = df.select(month.isNull().alias("_m"), category.isNull().alias("_c"), number.alias("_n"))
    kept = ~F.col("_m") & ~F.col("_c")
    totals = seen.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(kept).alias("kept"), F.count_if("_m").alias("no_month"),
        F.count_if("_c").alias("no_category"), F.count_if(kept & no_number).alias("no_count"),
    )
    text = roles.date and not _has_time(df.schema[roles.date].dataType)
    layout = layout_counts(df, roles.date, layouts).select("layout").scalar() if text else F.lit(None).cast("string")
    return totals.withColumn("layout", layout)


def rollup(rows: DataFrame) -> DataFrame:
    """A1: one row per category and month. Sums combine on the map side first."""
    return rows.groupBy("category", "month").agg(F.sum("count").alias("count"))


def monthly_series(
    df: DataFrame, roles: Roles, words: Material | None = None, layouts: Sequence[str] = DATE_LAYOUTS
) -> DataFrame:
    """A1 over raw columns: material filter, typing and rollup."""
    if words is not None and roles.material:
        df = filter_material(df, roles.material, words)
    return rollup(typed_rows(df, roles, layouts))


def gap_fill(monthly: DataFrame) -> DataFrame:
    """Zero rows for the months missing inside each series' own range.

    Every observed month also emits the empty months up to the next observed one,
    so one window over the rolled-up rows does it, without a calendar join. The
    result stays partitioned by category, which every later window reuses.
    """
    per_series = Window.partitionBy("category").orderBy("month")
    up_to = F.coalesce(F.add_months(F.lead("month").over(per_series), -1), F.col("month"))
    return (
        monthly.select("category", "month", "count", up_to.alias("_to"))
        .select(
            "category",
            F.col("month").alias("_from"),
            "count",
            F.explode(F.expr("sequence(month, _to, interval 1 month)")).alias("month"),
        )
        .select(
            "category",
            "month",
            F.when(F.col("month") == F.col("_from"), F.col("count")).otherwise(F.lit(0.0)).alias("count"),
        )
    )


def exclude_latest(monthly: DataFrame) -> DataFrame:
    """Drop the globally latest month, which is usually partial."""
    return monthly.where(F.col("month") < monthly.agg(F.max("month")).scalar())
