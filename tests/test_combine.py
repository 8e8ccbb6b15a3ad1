import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import backtest, combine, insights, metrics, quality
from seriesmill.operators.models import base

D = dt.date
SCHEMA = "category string, month date, predicted double, model string"


@pytest.fixture(scope="module")
def forecasts(spark):
    values = {"a": (10.0, 20.0), "b": (5.0, 5.0), "c": (0.0, 7.0)}
    rows = [(c, D(2021, 1, 1), v, m) for c, vs in values.items() for m, v in zip(("x", "y"), vs)]
    return spark.createDataFrame(rows, SCHEMA)


def test_ensembles(spark, forecasts):
    plain = {r.category: (r.predicted, r.month) for r in combine.ensemble_average(forecasts).collect()}
    assert plain == {"a": (15.0, D(2021, 1, 1)), "b": (5.0, D(2021, 1, 1)), "c": (3.5, D(2021, 1, 1))}
    scores = spark.createDataFrame([("x", 0.0), ("y", 0.003)], "model string, mape double")
    weights = combine.inverse_error_weights(scores)
    assert {r.model: r.weight for r in weights.collect()} == pytest.approx({"x": 0.75, "y": 0.25})
    mixed = {r.category: r.predicted for r in combine.ensemble_weighted(forecasts, weights).collect()}
    assert mixed == pytest.approx({"a": 12.5, "b": 5.0, "c": 1.75})


def test_guardrail_spares_dead_series(spark, forecasts):
    recent = spark.createDataFrame([("a", 4.0), ("b", 0.0)], "category string, recent_avg double")
    out = {(r.category, r.model): r.predicted for r in combine.guardrail(forecasts, recent, 3).collect()}
    assert out[("a", "y")] == 12.0 and out[("a", "x")] == 10.0
    assert out[("b", "x")] == 5.0 and out[("c", "y")] == 7.0


def test_zero_model_is_repaired(spark, forecasts):
    idle = forecasts.where("model = 'x'").withColumn("predicted", F.lit(0.0)).withColumn("model", F.lit("idle"))
    means = spark.createDataFrame(
        [("a", 3.0, 2.0), ("b", 0.0, 4.0)], "category string, recent_avg double, overall_avg double"
    )
    out = combine.repair_zeros(forecasts.unionByName(idle), means).collect()
    assert {r.category: r.predicted for r in out if r.model == "idle"} == {"a": 3.0, "b": 4.0, "c": 0.0}
    assert {r.model for r in out if r.repaired} == {"idle"}
    assert {r.category: r.predicted for r in out if r.model == "x"} == {"a": 10.0, "b": 5.0, "c": 0.0}


def test_best_per_model(forecasts):
    out = combine.best_per_model(forecasts, 2).collect()
    assert {(r.model, r.position): r.category for r in out} == {
        ("x", 1): "a", ("x", 2): "b", ("y", 1): "a", ("y", 2): "c",
    }


def test_backtest_uses_no_later_row(make_series):
    quiet = {"a": (D(2020, 1, 1), [5] * 20), "b": (D(2020, 6, 1), [2] * 15)}
    spiked = {"a": (D(2020, 1, 1), [5] * 19 + [9000]), "b": (D(2020, 6, 1), [2] * 15)}
    names = ["naive", "regression", "holt", "naive_bayes"]
    before = backtest.backtest_rows(make_series(quiet), names, 1).collect()
    after = backtest.backtest_rows(make_series(spiked), names, 1).collect()
    key = lambda r: (r.model, r.category)
    assert {key(r): r.predicted for r in before} == pytest.approx({key(r): r.predicted for r in after})
    assert {r.actual for r in after} == {9000.0, 2.0}


def test_backtest_sizes(make_series):
    series = make_series({"a": (D(2020, 1, 1), range(1, 9)), "late": (D(2020, 8, 1), [4]), "gone": (D(2019, 1, 1), [1, 2])})
    rows = backtest.backtest_rows(series, ["naive", "ensemble"], 2).collect()
    assert sorted((r.category, r.eval_month) for r in rows) == [("a", D(2020, 7, 1)), ("a", D(2020, 8, 1))]
    assert backtest.backtest_rows(series, ["naive"], 0).count() == 0
    assert base.last_folds(make_series({"a": (D(2020, 1, 1), [1])}), 3).count() == 0


def test_backtest_clip(make_series):
    series = make_series({"a": (D(2020, 1, 1), [30, 25, 20, 15, 10, 5, 1, 0])})
    raw = backtest.backtest_rows(series, ["regression"], 1).first()
    cut = backtest.backtest_rows(series, ["regression"], 1, clip=True).first()
    assert cut.predicted == max(raw.predicted, 0.0)


@pytest.fixture(scope="module")
def scored(spark):
    rows = [("x", "a", 10.0, 11.0), ("x", "b", 0.0, 2.0), ("x", "c", 4.0, 4.0), ("y", "a", 10.0, 0.0), ("y", "b", 0.0, 0.0)]
    df = spark.createDataFrame(rows, "model string, category string, actual double, predicted double")
    return backtest.with_errors(df.withColumn("eval_month", F.lit("2020-01-01").cast("date")))


def test_metrics(scored):
    core = {r.model: r for r in metrics.core_metrics(scored).collect()}
    assert core["x"].mae == 1.0 and core["x"].mape == pytest.approx(0.7) and core["x"].samples == 3
    assert core["y"].rmse == pytest.approx(50**0.5)
    more = {r.model: r for r in metrics.extended_metrics(scored).collect()}
    assert more["x"].mdape_pct == pytest.approx(10.0) and more["x"].hit20pct == pytest.approx(200 / 3)
    assert more["x"].r2 == pytest.approx(1 - 5 / (116 - 14**2 / 3))
    assert more["x"]["corr"] == pytest.approx(np.corrcoef([10, 0, 4], [11, 2, 4])[0, 1])
    assert more["y"]["corr"] is None
    board = metrics.leaderboard(metrics.core_metrics(scored)).collect()
    assert [(r.model, r.tag, r.verdict) for r in board] == [
        ("y", "Best", "needs more history"), ("x", "Other", "needs more history"),
    ]


def test_wide_and_agreement(scored):
    wide = {r.category: r for r in metrics.mape_by_category(scored, ["x", "y"]).collect()}
    assert wide["a"].mean_mape == pytest.approx(55.0) and wide["c"].y is None and wide["c"].mean_mape == 0.0
    pairs = {(r.model_a, r.model_b): r["corr"] for r in metrics.model_agreement(scored, ["x", "y"]).collect()}
    assert pairs[("x", "x")] == pytest.approx(1.0) and len(pairs) == 4


def test_density_integrates_to_one(spark):
    df = spark.range(200).select(F.lit("k").alias("k"), ((F.col("id") * 37) % 101).cast("double").alias("v"))
    rows = sorted(metrics.density(df, "k", "v", 200).collect(), key=lambda r: r.point)
    assert sum(r.density for r in rows) * (rows[1].x - rows[0].x) == pytest.approx(1.0, abs=1e-3)
    assert metrics.density(df.limit(3), "k", "v").count() == 0


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.5, 1.0, 2.0, 4.0)], "v double")
    assert [r.n for r in sorted(metrics.histogram(df, "v", 4).collect())] == [2, 1, 1, 1]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [r.n for r in sorted(metrics.histogram(flat, "v", 2).collect())] == [0, 2]


def test_view_and_planning(spark, make_series, forecasts):
    series = make_series({"a": (D(2020, 11, 1), [8, 8]), "b": (D(2020, 10, 1), [6]), "c": (D(2020, 12, 1), [9])})
    view = insights.prediction_view(forecasts, series, "y")
    rows = {r.category: r for r in view.collect()}
    assert (rows["a"].last_month, rows["b"].last_month, rows["c"].hist_avg) == (8.0, 0.0, 9.0)
    assert rows["a"].vs_avg_pct == 150.0 and rows["c"].delta == -2.0
    head = insights.headline(view, series, 2).first()
    assert (head.last_total, head.predicted_total, head.top10_share, head.titles) == (17.0, 32.0, 1.0, 3)
    actions = insights.planning_actions(view).collect()
    assert [(r.category, r.urgency) for r in actions if r.urgency] == [("a", "High"), ("c", "Stable"), ("b", "High")]
    assert {r.category for r in actions if r.action == "Reallocate budget"} == {"c"}
    bands = {r.category: r.band for r in insights.planning_bands(view).collect()}
    assert bands == {"a": "Order more", "b": "Hold", "c": "Reallocate"}
    assert insights.default_model(forecasts) == "x"
    assert insights.default_model(combine.ensemble_average(forecasts).unionByName(forecasts)) == "ensemble"


def test_headline_without_last_total(spark, make_series, forecasts):
    series = make_series({"a": (D(2020, 11, 1), [8, 0])})
    assert insights.headline(insights.prediction_view(forecasts, series, "x"), series, 1).first().pct_change is None


def test_concentration_shares_add_up(make_series):
    series = make_series({c: (D(2020, 1, 1), [i + 1, i]) for i, c in enumerate("abcdef")})
    out = insights.concentration(series, quality.top_categories(series, 2)).collect()
    for month in (D(2020, 1, 1), D(2020, 2, 1)):
        assert sum(r.share for r in out if r.month == month) == pytest.approx(1.0)
    assert {r.bucket for r in out} == {"e", "f", "All Others"}
    profile = insights.seasonal_profile(series).collect()
    assert len(profile) == 12 and {r.name for r in profile if r.season == "Peak" and r.avg_total > 0} == {"Jan", "Feb"}
