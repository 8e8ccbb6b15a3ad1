"""Date text read by one layout for the whole column, and how raw rows were read."""

import datetime as dt

import pytest

from seriesmill.config import ForecastConfig, Roles
from seriesmill.operators import monthly

D = dt.date
ROLES = Roles("t", date="d", count="n")


def frame(spark, days):
    return spark.createDataFrame([("a", d, "1") for d in days], "t string, d string, n string")


def months(df, **more):
    return [r.m for r in df.select(monthly.month_in_column(df, "d", **more).alias("m")).collect()]


@pytest.mark.parametrize(
    "days, want",
    [
        (["13/02/2020", "05/03/2020", "01/12/2020"], [D(2020, 2, 1), D(2020, 3, 1), D(2020, 12, 1)]),
        (["02/13/2020", "05/03/2020", "12/01/2020"], [D(2020, 2, 1), D(2020, 5, 1), D(2020, 12, 1)]),
        (["5 January 2020", "17 May 2021"], [D(2020, 1, 1), D(2021, 5, 1)]),
        (["January 2020", "May 2021"], [D(2020, 1, 1), D(2021, 5, 1)]),
        (["January 5, 2020", "May 17, 2021"], [D(2020, 1, 1), D(2021, 5, 1)]),
        (["05.01.2020", "17.05.2021"], [D(2020, 1, 1), D(2021, 5, 1)]),
        (["2020-01-05", "2020-02", "2020-03-01T10:00:00", "x", None, ""], [D(2020, 1, 1), D(2020, 2, 1), D(2020, 3, 1), None, None, None]),
        (["05/03/2020"], [D(2020, 5, 1)]),  # month first where nothing else tells
        (["13/02/2020", "2020-01-05", "14/02/2020"], [D(2020, 2, 1), None, D(2020, 2, 1)]),
        (["x", None], [None, None]),
    ],
)
def test_a_column_has_one_layout(spark, days, want):
    assert months(frame(spark, days).coalesce(1)) == want


def test_own_layouts_and_real_dates(spark):
    assert months(frame(spark, ["2020|07"]), layouts=("yyyy|MM",)) == [D(2020, 7, 1)]
    df = spark.createDataFrame([(D(2020, 5, 17),), (None,)], "d date")
    assert months(df) == [D(2020, 5, 1), None]


def test_how_rows_were_read(spark):
    rows = [("a", "13/02/2020", "3"), (None, "14/02/2020", "1"), ("a", "2020-02-01", "1"), (None, None, "x"), ("b", "05/02/2020", "x"), ("b", "06/02/2020", None), ("b", "06/02/2020", "NaN")]
    df = spark.createDataFrame(rows, "t string, d string, n string")
    r = monthly.read_report(df, ROLES).first()
    assert (r.rows, r.kept, r.no_month, r.no_category, r.no_count, r.layout) == (7, 4, 2, 2, 3, "d/M/yyyy[ H:mm:ss]")
    assert monthly.typed_rows(df, ROLES).count() == 4
    empty = monthly.read_report(df.limit(0), ROLES).first()
    assert (empty.rows, empty.kept) == (0, 0)
    parts = monthly.read_report(spark.createDataFrame([("a", "2020", "13"), ("a", "2020", "1")], "t string, y string, m string"), Roles("t", year="y", month="m")).first()
    assert (parts.rows, parts.kept, parts.no_month, parts.no_count, parts.layout) == (2, 1, 1, 0, None)


def test_roles_with_dots_are_read(spark):
    df = spark.createDataFrame([("a", "13/02/2020")], "`t.x` string, `d.y` string")
    assert monthly.typed_rows(df, Roles("t.x", date="d.y")).first().month == D(2020, 2, 1)
    assert ForecastConfig().model_options().season == 12
