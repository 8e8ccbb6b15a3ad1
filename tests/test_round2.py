"""Inputs that were once read wrongly: page headers, NaN, date layouts, null ranks, relaxed windows."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.config import ForecastConfig
from seriesmill.functions.ordered import ordered_position
from seriesmill.operators import monthly
from seriesmill.plans.run import run
from seriesmill.sources import readers


def test_pages_are_matched_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("title,year,month,count\nA,2020,1,5\n")
    (tmp_path / "b.csv").write_text("count,month,year,title\n7,2,2020,B\n")
    (tmp_path / "c.csv").write_text("title,year,month\nC,2021,3\n")
    (tmp_path / "d.csv").write_text("title,year,month,count\nD,2020,4,8\n")
    (tmp_path / "e.csv").write_text("")
    rows = readers.read_pages(spark, str(tmp_path)).select("title", "year", "month", "count").collect()
    assert sorted(map(tuple, rows), key=str) == [("A", "2020", "1", "5"), ("B", "2020", "2", "7"), ("C", "2021", "3", None), ("D", "2020", "4", "8")]
    with pytest.raises(FileNotFoundError):
        readers.read_pages(spark, str(tmp_path / "none"))


def test_nan_counts_are_zero(spark):
    df = spark.createDataFrame([("NaN",), ("3",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(monthly.count_value(F.col("v"))).collect()] == [0.0, 3.0, 0.0, 0.0]
    df = spark.createDataFrame([(float("nan"),), (2.0,)], "v double")
    assert [r[0] for r in df.select(monthly.count_value(F.col("v"))).collect()] == [0.0, 2.0]


def test_usual_date_layouts(spark):
    texts = ["2020/01/05", "20200105", "Jan 5, 2020", "Jan 2020", "01-05-2020", "5 Jan 2020", "1/5/2020", "2020-01-05", "2020-01-05T10:00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    got = [r[0] for r in df.select(monthly.month_from_date(F.col("d"), T.StringType())).collect()]
    assert got == [datetime.date(2020, 1, 1)] * len(texts)
    assert spark.createDataFrame([("soon",), ("2020-13-01",)], "d string").select(monthly.month_from_date(F.col("d"), T.StringType()).alias("m")).where("m IS NOT NULL").count() == 0


@pytest.mark.parametrize("descending", [True, False])
def test_null_and_nan_rank_as_in_row_number(spark, descending):
    values = [None, 3.0, float("nan"), 9.0, -1.0, None, float("nan"), 0.0]
    df = spark.createDataFrame([("k", v, i) for i, v in enumerate(values)], "k string, v double, i int")
    df.createOrReplaceTempView("ranked_values")
    want = spark.sql(f"SELECT i, row_number() OVER (ORDER BY v {'DESC' if descending else 'ASC'}, i) AS p FROM ranked_values")
    got = ordered_position(df, ["k"], [("v", descending), ("i", False)], "p", slices=4)
    assert {tuple(r) for r in got.select("i", "p").collect()} == {tuple(r) for r in want.collect()}


def test_descending_text_is_refused(spark):
    df = spark.createDataFrame([("k", "a")], "k string, v string")
    with pytest.raises(TypeError, match="v is string"):
        ordered_position(df, ["k"], [("v", True)], "p")


def test_guardrail_uses_the_relaxed_window(spark):
    """One title with early high months: loosened filters leave a window of three months."""
    rows = [("t", 2020 + k // 12, k % 12 + 1, 90.0 if k < 10 else 6.0) for k in range(13)]
    raw = spark.createDataFrame(rows, "title string, year int, month int, count double")
    config = ForecastConfig(category="title", only_material=None, models=("naive",), backtest_months=0, exclude_latest=False, recent_window=6)
    top = run(raw, config).forecasts.agg(F.max("predicted")).first()[0]
    assert top == 18.0


def test_quantiles_of_close_values(spark):
    """Distinct values within a millionth of a large level share one or two coarse cells."""
    from seriesmill.functions.ordered import exact_quantiles

    df = spark.range(200_000).select((F.lit(1e9) + F.col("id") / 250).alias("v"), (F.col("id") % 2).alias("k"))
    got = exact_quantiles(df, ["k"], "v", [0.0, 0.25, 0.5, 1.0]).collect()
    for r in got:
        values = [1e9 + i / 250 for i in range(r.k, 200_000, 2)]
        n = len(values) - 1
        for q, p in zip((r.q0, r.q1, r.q2, r.q3), (0.0, 0.25, 0.5, 1.0), strict=True):
            low, part = int(n * p), n * p - int(n * p)
            assert q == pytest.approx(values[low] + part * (values[min(low + 1, n)] - values[low]), abs=1e-6)
