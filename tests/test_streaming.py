"""Sinks of the incremental rollup: append, compaction, restarts."""

import datetime as dt
import os

import pytest

from seriesmill.config import Roles
from seriesmill.operators import monthly
from seriesmill.streaming import rollup
from seriesmill.streaming.rollup import compact, latest_sums, read_page_stream, stream_rollup, write_batches

D = dt.date
ROLES = Roles("title", year="y", month="m", count="n")
SCHEMA = "title string, y string, m string, n string"
FILES = [[f"{t},{2020 + k // 12},{k % 12 + 1},{k + 1}" for t in "abc"[: 1 + k % 3]] for k in range(14)]


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    return folder


def land(folder, files, start=0):
    for i, rows in enumerate(files, start):
        path = folder / f"p{i:02d}.csv"
        path.write_text("title,y,m,n\n" + "".join(f"{r}\n" for r in rows))
        os.utime(path, (1_600_000_000 + i * 10,) * 2)


def run(spark, folder, tmp_path, mode, **more):
    schema = spark.createDataFrame([], SCHEMA).schema
    sums = stream_rollup(read_page_stream(spark, str(folder), schema, files_per_batch=1), ROLES)
    write_batches(sums, str(tmp_path / "sums"), str(tmp_path / "state"), mode, **more).awaitTermination()
    return str(tmp_path / "sums")


def sums_of(df):
    rows = [(r.category, r.month, r["count"]) for r in df.collect()]
    assert len({r[:2] for r in rows}) == len(rows)
    return {r[:2]: r[2] for r in rows}


def batch_sums(spark, files):
    rows = spark.createDataFrame([r.split(",") for f in files for r in f], SCHEMA)
    return sums_of(monthly.monthly_series(rows, ROLES))


def test_append_equals_the_rollup_of_closed_months(spark, landed, tmp_path):
    land(landed, FILES)
    got = sums_of(latest_sums(spark, run(spark, landed, tmp_path, "append")))
    closed = D(2021, 2, 1) - dt.timedelta(days=62)
    assert got == {k: v for k, v in batch_sums(spark, FILES).items() if k[1] <= closed}
    # A late row of a closed month changes nothing; a new month closes others.
    land(landed, [["a,2020,1,1000", "a,2021,6,5"]], len(FILES))
    again = sums_of(latest_sums(spark, run(spark, landed, tmp_path, "append")))
    assert set(got.items()) < set(again.items()) and again["a", D(2020, 1, 1)] == got["a", D(2020, 1, 1)]


@pytest.mark.parametrize("every", [1, 3, 100])
def test_update_with_compaction_equals_the_rollup(spark, landed, tmp_path, every):
    land(landed, FILES[:9])
    target = run(spark, landed, tmp_path, "update", every=every)
    assert sums_of(latest_sums(spark, target)) == batch_sums(spark, FILES[:9])
    # The stream goes on from its checkpoint.
    land(landed, FILES[9:], 9)
    run(spark, landed, tmp_path, "update", every=every)
    assert sums_of(latest_sums(spark, target)) == batch_sums(spark, FILES)
    folders = [n for n in os.listdir(target) if n.startswith(("batch=", "state="))]
    assert len(folders) <= (len(FILES) + 4 if every == 100 else 2 * every + 2)  # with batches that only close months
    compact(spark, target)
    compact(spark, target)
    assert sums_of(latest_sums(spark, target)) == batch_sums(spark, FILES)


def test_what_a_lost_driver_leaves_is_not_read(spark, landed, tmp_path):
    land(landed, FILES[:4])
    target = run(spark, landed, tmp_path, "update")
    want = batch_sums(spark, FILES[:4])
    # Sums written without the pointer to them, and a pointer that was not moved into place.
    spark.createDataFrame([("a", D(2020, 1, 1), -1.0)], rollup._SUMS).write.parquet(f"{target}/state=3")
    (tmp_path / "sums" / "__sums-000000000009.new").write_text("{")
    assert sums_of(latest_sums(spark, target)) == want
    compact(spark, target)
    assert sums_of(latest_sums(spark, target)) == want


def test_complete_mode_reads_one_folder(spark, landed, tmp_path):
    land(landed, FILES)
    target = run(spark, landed, tmp_path, "complete")
    df = latest_sums(spark, target)
    assert len({os.path.dirname(f) for f in df.inputFiles()}) == 1
    assert sums_of(df) == batch_sums(spark, FILES)
    assert len([n for n in os.listdir(target) if n.startswith("state=")]) == 2


def test_no_batch_yet_and_wrong_mode(spark, landed, tmp_path):
    assert latest_sums(spark, str(tmp_path / "nothing")).collect() == []
    with pytest.raises(ValueError, match="no such mode"):
        run(spark, landed, tmp_path, "sometimes")
