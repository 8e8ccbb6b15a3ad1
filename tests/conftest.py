import datetime
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_series(spark):
    """Gap-filled series from ``{category: (first month, counts)}``."""

    def build(series):
        rows = []
        for category, (first, counts) in series.items():
            start = first.year * 12 + first.month - 1
            for i, count in enumerate(counts):
                year, month = divmod(start + i, 12)
                rows.append((category, datetime.date(year, month + 1, 1), float(count)))
        return spark.createDataFrame(rows, "category string, month date, count double")

    return build
