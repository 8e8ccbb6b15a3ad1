import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.functions.ordered import exact_quantiles, ordered_position


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    values = {
        "ints": rng.integers(-50, 50, 501).astype(float),
        "mixed": np.concatenate([rng.normal(0, 1e6, 300), np.zeros(200), rng.normal(1, 1e-9, 300)]),
        "close": 1000 + np.arange(400) * 1e-10,
        "single": np.array([7.5]),
        "powers": np.concatenate([np.nextafter(2.0 ** np.arange(-5, 20), 0), 2.0 ** np.arange(-5, 20)]),
    }
    data = [(k, float(v)) for k, vs in values.items() for v in vs] + [("ints", None)]
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    probs = [0.0, 0.25, 0.33, 0.5, 0.66, 0.9, 1.0]
    for row in exact_quantiles(df, ["k"], "v", probs).collect():
        want = np.quantile(values[row.k], probs)
        assert [row[f"q{i}"] for i in range(len(probs))] == pytest.approx(list(want), rel=1e-13, abs=1e-12)


def test_quantiles_without_keys_and_with_weights(spark):
    df = spark.createDataFrame([(1.0, 3), (10.0, 1), (2.0, 2)], "v double, w long")
    row = exact_quantiles(df, [], "v", [0.5, 0.66], weight="w").first()
    assert list(row) == pytest.approx(list(np.quantile([1, 1, 1, 2, 2, 10], [0.5, 0.66])))


def test_quantile_input_is_counted_once(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).cast("double").alias("v"))
    done = exact_quantiles(df, ["k"], "v", [0.5])
    done.collect()
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_positions_with_most_rows_tied(spark):
    rows = [(m, f"c{i:04d}", 0.0 if i % 3 else float(i)) for m in ("x", "y") for i in range(3000)]
    df = spark.createDataFrame(rows, "model string, category string, predicted double").repartition(9)
    out = ordered_position(df, ["model"], [("predicted", True), ("category", False)], "rank", slices=100).collect()
    for model in ("x", "y"):
        want = sorted((r for r in rows if r[0] == model), key=lambda r: (-r[2], r[1]))
        got = {r.category: r["rank"] for r in out if r.model == model}
        assert got == {r[1]: i + 1 for i, r in enumerate(want)}


def test_positions_of_empty_and_tiny(spark):
    df = spark.createDataFrame([("x", "a", 1.0)], "model string, category string, predicted double")
    order = [("predicted", True), ("category", False)]
    assert ordered_position(df, ["model"], order, "rank").first()["rank"] == 1
    assert ordered_position(df.where("false"), ["model"], order, "rank").count() == 0
