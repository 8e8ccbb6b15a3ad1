import datetime as dt

import pytest
from pyspark.sql import functions as F

from seriesmill.config import Material, Roles
from seriesmill.operators import monthly, quality

D = dt.date


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_material_exact_stage(spark):
    df = spark.createDataFrame([("Book",), (" BOOK\t",), ("EBOOK",), ("book club",), (None,)], "m string")
    assert [r.m for r in monthly.filter_material(df, "m").collect()] == ["Book", " BOOK\t"]


def test_material_fallback_stage(spark):
    values = ["Large print book", "ebook", "audiobook", "e-book", "DVD", None]
    df = spark.createDataFrame([(v,) for v in values], "m string")
    assert rows(monthly.filter_material(df, "m")) == [("Large print book",), ("e-book",)]
    assert monthly.filter_material(df, "m", strict=True).count() == 0


def test_material_nothing_left(spark):
    df = spark.createDataFrame([("DVD",), ("CD",)], "m string")
    with pytest.raises(ValueError, match="it holds CD, DVD"):
        monthly.require_material(df, monthly.filter_material(df, "m"), "m")


def test_bad_dates_and_counts(spark):
    df = spark.createDataFrame(
        [("a", "2020-01-15", "12"), ("a", "1/20/2020", "x"), ("a", "2020-13-01", "5"), ("a", "abc", "5"),
         ("a", None, "5"), (None, "2020-01-01", "5"), ("b", "2020-02-01 10:00:00", "-3"), ("b", "2020-02-02", None)],
        "c string, d string, n string",
    )
    typed = monthly.typed_rows(df, Roles("c", date="d", count="n"))
    assert rows(monthly.rollup(typed)) == [("a", D(2020, 1, 1), 12.0), ("b", D(2020, 2, 1), -3.0)]


def test_year_month_parts(spark):
    df = spark.createDataFrame(
        [("a", "2020", "1"), ("a", "2020.0", "2"), ("a", "2020", "13"), ("a", "2020", "0"), ("a", "x", "1"),
         ("a", "2020", None), ("a", "2020", "1.5")],
        "c string, y string, m string",
    )
    typed = monthly.typed_rows(df, Roles("c", year="y", month="m"))
    assert rows(typed) == [("a", D(2020, 1, 1), 1.0), ("a", D(2020, 2, 1), 1.0)]


def test_gap_fill_own_range(spark, make_series):
    raw = spark.createDataFrame(
        [("A", D(2020, 1, 1), 5.0), ("A", D(2020, 3, 1), 2.0), ("A", D(2020, 6, 1), 1.0), ("B", D(2019, 12, 1), 4.0)],
        "category string, month date, count double",
    )
    filled = monthly.gap_fill(raw)
    assert rows(filled) == [
        ("A", D(2020, 1, 1), 5.0), ("A", D(2020, 2, 1), 0.0), ("A", D(2020, 3, 1), 2.0),
        ("A", D(2020, 4, 1), 0.0), ("A", D(2020, 5, 1), 0.0), ("A", D(2020, 6, 1), 1.0),
        ("B", D(2019, 12, 1), 4.0),
    ]
    assert rows(monthly.gap_fill(filled)) == rows(filled)
    assert rows(monthly.gap_fill(filled.repartition(7))) == rows(filled)
    assert rows(monthly.exclude_latest(filled))[-2][1] == D(2020, 5, 1)


def test_gap_fill_needs_one_shuffle_by_category(spark, make_series):
    base = make_series({"a": (D(2020, 1, 1), [1, 2])})
    plan = monthly.gap_fill(monthly.rollup(base))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_top_items_ties_by_name(make_series):
    series = make_series({c: (D(2020, 1, 1), [5]) for c in "dbca"} | {"z": (D(2020, 1, 1), [9])})
    assert {r.category for r in quality.top_items(series, 3).collect()} == {"z", "a", "b"}
    assert quality.top_items(series, 0).count() == 5


def test_history_counts_filled_zeros(make_series):
    series = make_series({"a": (D(2020, 1, 1), [1, 0, 0, 1]), "b": (D(2020, 1, 1), [1, 1])})
    assert {r.category for r in quality.min_history(series, 4).collect()} == {"a"}


def test_recent_window_is_rows_of_the_series(make_series):
    series = make_series({"old": (D(2010, 1, 1), [0, 3, 4]), "dead": (D(2020, 1, 1), [5, 0, 0])})
    assert {r.category for r in quality.recent_activity(series, 2, 1).collect()} == {"old"}
    assert quality.recent_activity(series, 2, 0).count() == 6
    means = {r.category: r.recent_avg for r in quality.recent_average(series, 2).collect()}
    assert means == {"old": 3.5, "dead": 0.0}


@pytest.mark.parametrize("survivors, relaxed", [(4, True), (5, False)])
def test_auto_relax_boundary(make_series, survivors, relaxed):
    series = {f"s{i}": (D(2020, 1, 1), [1, 1, 1]) for i in range(survivors)}
    series |= {"two": (D(2020, 1, 1), [1, 1]), "one": (D(2020, 1, 1), [1])}
    out = quality.auto_relax(make_series(series), 0, 3, 6, 1).collect()
    assert {r.relaxed for r in out} == {relaxed}
    expected = {f"s{i}" for i in range(survivors)} | ({"two"} if relaxed else set())
    assert {r.category for r in out} == expected


def test_words_are_parameters(spark):
    df = spark.createDataFrame([("red bolt",), ("blue bolt",)], "m string")
    words = Material("bolt", "bolt", ("red bolt",))
    assert rows(monthly.filter_material(df, "m", words)) == [("blue bolt",)]


def test_count_stats(make_series):
    row = quality.count_stats(make_series({"a": (D(2020, 1, 1), [0, 1, 2, 9])})).first()
    assert (row["mean"], row["median"], row["max"], row["sparsity"]) == (3.0, 1.5, 9.0, 0.25)
    assert row["std"] == pytest.approx(4.08248290)


def test_labels(spark):
    from seriesmill.functions import scalars

    row = spark.range(1).select(
        scalars.number_label(F.lit(1234.5)).alias("a"),
        scalars.signed_label(F.lit(1234.0)).alias("b"),
        scalars.signed_label(F.lit(-5.0)).alias("c"),
        scalars.month_label(F.lit("2020-01-01").cast("date")).alias("d"),
        scalars.short_label(F.lit("abcdef"), 4).alias("e"),
        scalars.one_decimal(F.lit(2.25)).alias("f"),
    ).first()
    assert tuple(row) == ("1,234", "+1,234", "-5", "Jan 2020", "abc…", 2.2)


def test_one_category_with_a_third_of_the_rows(spark):
    raw = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("c"),
        F.date_add(F.lit("2020-01-01"), (F.col("id") % 700).cast("int")).alias("d"),
        F.lit(2).alias("n"),
    )
    series = monthly.gap_fill(monthly.monthly_series(raw, Roles("c", date="d", count="n")))
    totals = {r.category: r.total for r in quality.category_totals(series).collect()}
    assert totals["hot"] == 20000.0 and sum(totals.values()) == 60000.0
    row = quality.run_summary(series).first()
    assert row.months == 23 and row.rows == series.count()


@pytest.mark.parametrize("seed", range(3))
def test_gap_fill_properties(spark, seed):
    import random

    rng = random.Random(seed)
    seen = {(f"c{rng.randrange(8)}", rng.randrange(60)): rng.randrange(1, 50) for _ in range(90)}
    rows = [(c, D(2015 + m // 12, m % 12 + 1, 1), float(v)) for (c, m), v in seen.items()]
    raw = spark.createDataFrame(rows, "category string, month date, count double").repartition(5)
    filled = {(r.category, r.month): r["count"] for r in monthly.gap_fill(raw).collect()}
    assert all(filled[c, m] == v for c, m, v in rows) and sum(filled.values()) == sum(v for _, _, v in rows)
    for c in {c for c, _, _ in rows}:
        span = [m for k, m, _ in rows if k == c]
        months = (max(span).year - min(span).year) * 12 + max(span).month - min(span).month + 1
        assert sum(k == c for k, _ in filled) == months
