"""Stages of the corpus pipeline: ``(spark, docs, sf_dir)`` to a DataFrame.

All but the last keep the columns of ``docs``, whatever their names. Rows without doc_id
can't be compared with others: they pass, except through the quality filter. A null or
empty text is scored as empty, has no lines, near duplicates or passages, and encodes to no
tokens. Of rows that share a doc_id all stay or go together. An empty table stays empty.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm import bpe, decontamination, line_dedup, near_dups, quality
from seriesmill.llm.common import table
from seriesmill.llm.queries import WORD_VOCABULARY
from seriesmill.sources.shared import use_shared_folder


def _unused(docs: DataFrame, name: str) -> str:
    """The first name made from ``name`` that no column has."""
    own = {c.lower() for c in docs.columns}
    return next(n for k in range(len(own) + 1) if (n := f"{name}_{k}") not in own)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    use_shared_folder(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    out = _unused(docs, "quality_score")
    return quality.score(docs, model, out=out).filter(F.col(out) >= 0.3).drop(out)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines similar to an earlier one; documents of which no word is left go."""
    use_shared_folder(spark)
    # The operator's own columns replace those of their names: these take others meanwhile.
    put_by = {c: _unused(docs, c) for c in docs.columns if c in ("n_lines", "n_removed")}
    left = line_dedup.dedup_lines(docs.withColumnsRenamed(put_by)).filter(r"n_removed = 0 OR text RLIKE '[^\x20\x09-\x0D]'")
    left = left.drop("n_lines", "n_removed").withColumnsRenamed({b: a for a, b in put_by.items()})
    return left.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates."""
    use_shared_folder(spark)
    others = near_dups.near_duplicates(docs).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(docs.columns)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    use_shared_folder(spark)
    leaks = decontamination.passages(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the text that they decode to."""
    use_shared_folder(spark)
    found = bpe.encode_decode(docs, Path(WORD_VOCABULARY).read_text())
    return found.select("doc_id", *[c for c in ("lang", "source") if c in docs.columns], "n_tokens", "ids", "decoded")
