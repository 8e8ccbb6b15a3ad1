"""From raw documents to a clean, tokenised corpus, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seriesmill.llm import stages
from seriesmill.llm.common import table, written
from seriesmill.sources.shared import use_shared_folder

STAGES = [
    ("quality", stages.keep_quality),
    ("lines", stages.drop_repeated_lines),
    ("near_duplicates", stages.one_of_each_group),
    ("benchmark", stages.drop_leaked),
    ("encode", stages.encode),
]

#: The stages learn, join by similarity and tokenise: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``."""
    use_shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
