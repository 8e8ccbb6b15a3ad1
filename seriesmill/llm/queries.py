"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm import bpe, decontamination, html_main, licenses, line_dedup, manifest, near_dups, oracles, prefix_trie, quality, search, suffix_dedup, token_counts, toxicity
from seriesmill.llm.common import crc_bucket, table, written
from seriesmill.sources.shared import use_shared_folder

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_shared_folder(spark)
    return table(spark, sf_dir, "documents")


def similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return search.top_k(docs, docs.filter("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id"))


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of document and benchmark item; documents without a passage are not in it."""
    return decontamination.passages(documents(spark, sf_dir).select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    coded = bpe.encode_decode(docs, Path(WORD_VOCABULARY).read_text())
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def scored(docs: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    return found.select("doc_id", (crc_bucket("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, toxicity.score(docs, model), 0.5)


def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    counted = token_counts.token_counts(docs, Path(PIECE_MODEL).read_bytes())
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return counted.select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, quality.score(docs, model), 0.3)


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_shared_folder(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_main.main_text(pages, html_main.fit_pages(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def near_duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), words=4)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_shared_folder(spark)
    found = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_heads(written(found)))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return manifest.manifest(docs, manifest.tampered(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k": similar_documents,
    "op2_benchmark_leaks": benchmark_leaks,
    "op3_bpe_round_trip": bpe_round_trip,
    "op4_line_dedup": repeated_lines,
    "op5_toxicity": toxicity_scores,
    "op6_token_counts": token_count,
    "op7_quality": quality_scores,
    "op8_main_text": page_text,
    "op9_suffix_dedup": repeated_strings,
    "op10_near_duplicates": near_duplicate_groups,
    "op11_prefix_trie": conversation_trie,
    "op12_license_scan": license_scan,
    "op13_merkle_manifest": dataset_manifest,
}

#: BM25 in SQL: the terms, constants and ties of ``search.top_k``.
TOP_K_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM documents WHERE doc_id IS NOT NULL
), lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
totals AS (SELECT count(*) AS docs, avg(n) AS mean FROM lengths),
idf AS (SELECT term, ln(1 + (docs - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM counts, totals GROUP BY term, docs),
scored AS (
  SELECT q.doc_id AS query_id, d.doc_id, round(sum(idf * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * n / mean))), 6) AS score
  FROM counts q JOIN counts d USING (term) JOIN idf USING (term) JOIN lengths l ON l.doc_id = d.doc_id, totals
  WHERE q.doc_id % 20 = 0 GROUP BY q.doc_id, d.doc_id
)
SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INT AS rank, score
FROM scored QUALIFY rank <= 10
"""

ORACLES: dict[str, str] = {"op1_top_k": TOP_K_SQL, "op11_prefix_trie": oracles.TRIE_SQL, "op12_license_scan": oracles.LICENSE_SQL, "op13_merkle_manifest": oracles.MANIFEST_SQL}
