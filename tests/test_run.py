import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from seriesmill.config import ForecastConfig, Roles
from seriesmill.operators import monthly
from seriesmill.plans.run import run
from seriesmill.sources import readers, sinks
from seriesmill.streaming.rollup import latest_sums, read_page_stream, stream_rollup, write_batches

D = dt.date
HEADER = "CheckoutYear,CheckoutMonth,MaterialType,Title,Checkouts\n"


def lines(months, titles, material="BOOK"):
    return [
        f"{2018 + m // 12},{m % 12 + 1},{material},{t},{10 * (i + 1) + m % 12}\n"
        for m in months
        for i, t in enumerate(titles)
    ]


@pytest.fixture
def pages(tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    titles = [f"title {i}" for i in range(6)]
    rows = lines(range(30), titles) + lines(range(30), ["film"], "DVD")
    for p in range(3):
        (folder / f"page{p}.csv").write_text(HEADER + "".join(rows[p::3]))
    (folder / "page9.csv").write_text(HEADER)
    return str(folder)


def test_sources(spark, pages, tmp_path):
    df = readers.read_pages(spark, pages)
    assert df.count() == 210 and {t for _, t in df.dtypes} == {"string"}
    assert readers.read_table(spark, pages, "csv", max_rows=7).count() == 7
    assert readers.normalise_headers(spark.createDataFrame([(1, 2)], [' "Title" ', "'A b'"])).columns == ["title", "a b"]
    with pytest.raises(FileNotFoundError):
        readers.read_table(spark, str(tmp_path / "nothing.csv"))
    calls = []

    def load():
        calls.append(1)
        return df

    target = str(tmp_path / "copy")
    assert readers.snapshot(spark, target, load).count() == readers.snapshot(spark, target, load).count() == 210
    assert len(calls) == 1
    assert readers.read_table(spark, target, "parquet").count() == 210


def test_whole_run(spark, pages, tmp_path):
    raw = readers.normalise_headers(readers.read_pages(spark, pages))
    config = ForecastConfig(category="title", models=("naive", "regression", "holt"), backtest_months=2)
    done = run(raw, config)
    rows = done.forecasts.collect()
    assert {r.model for r in rows} == {"naive", "regression", "holt", "ensemble", "ensemble_w"}
    assert {r.category for r in rows} == {f"title {i}" for i in range(6)}
    assert {r.month for r in rows} == {D(2020, 6, 1)}
    for model in ("naive", "ensemble_w"):
        assert sorted(r["rank"] for r in rows if r.model == model) == list(range(1, 7))
        assert sorted(r.final_rank for r in rows if r.model == model) == list(range(1, 7))
    assert sum(r.weight for r in done.weights.collect()) == pytest.approx(1.0)
    assert done.backtest.count() == 3 * 2 * 6
    assert done.model == "ensemble_w" and done.view.count() == 6
    by = {(r.category, r.model): r.predicted for r in rows}
    trio = [by["title 1", m] for m in ("naive", "regression", "holt")]
    assert min(trio) <= by["title 1", "ensemble_w"] <= max(trio)

    sinks.write_forecasts(done.forecasts, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == len(rows)
    sinks.write_report(done.report(), str(tmp_path / "report"))
    part = next(f for f in os.listdir(tmp_path / "report") if f.endswith(".json"))
    report = json.loads((tmp_path / "report" / part).read_text())
    assert (report["rows"], report["categories"], report["months"]) == (174, 6, 29)
    assert set(report["models"]) == {"naive", "regression", "holt"}
    assert report["models"]["naive"]["samples"] == 12


def test_run_without_backtest_relaxes_and_reports(spark, pages):
    raw = readers.read_pages(spark, pages).where(F.col("Title").isin("title 1", "title 2"))
    done = run(raw, ForecastConfig(category="title", models=("naive",), backtest_months=0))
    assert done.metrics is None and done.weights is None
    assert {r.relaxed for r in done.series.select("relaxed").distinct().collect()} == {True}
    assert {r.model for r in done.forecasts.collect()} == {"naive"}
    assert done.report().first().models == {}


def test_run_names_materials_when_none_fit(spark, pages):
    raw = readers.read_pages(spark, pages).where("MaterialType = 'DVD'")
    with pytest.raises(ValueError, match="it holds DVD"):
        run(raw, ForecastConfig(category="title"))


ROLES = Roles("title", year="y", month="m", count="n")
SCHEMA = "title string, y string, m string, n string"


def stream(spark, folder, files, mode, tmp_path):
    """One page file per micro-batch, in the given order."""
    os.makedirs(folder)
    for i, rows in enumerate(files):
        path = os.path.join(folder, f"p{i}.csv")
        with open(path, "w") as f:
            f.write("title,y,m,n\n" + "".join(f"{r}\n" for r in rows))
        os.utime(path, (1_600_000_000 + i * 10,) * 2)
    schema = spark.createDataFrame([], SCHEMA).schema
    sums = stream_rollup(read_page_stream(spark, folder, schema, files_per_batch=1), ROLES)
    target, state = str(tmp_path / f"sums-{mode}"), str(tmp_path / f"state-{mode}")
    write_batches(sums, target, state, mode).awaitTermination()
    return {(r.category, r.month): r["count"] for r in latest_sums(spark, target).collect()}


FILES = [
    ["a,2020,1,1", "a,2020,2,2"],
    ["a,2020,6,3", "b,2020,6,4"],
    ["a,2020,7,5"],
    ["a,2020,1,100", "b,2020,7,6"],
]


def test_stream_complete_equals_batch(spark, tmp_path):
    got = stream(spark, str(tmp_path / "in"), FILES, "complete", tmp_path)
    rows = spark.createDataFrame([r.split(",") for f in FILES for r in f], SCHEMA)
    want = {(r.category, r.month): r["count"] for r in monthly.monthly_series(rows, ROLES).collect()}
    assert got == want


def test_stream_update_drops_late_rows(spark, tmp_path):
    got = stream(spark, str(tmp_path / "in"), FILES, "update", tmp_path)
    assert got[("a", D(2020, 1, 1))] == 1.0
    assert got[("a", D(2020, 7, 1))] == 5.0 and got[("b", D(2020, 7, 1))] == 6.0
