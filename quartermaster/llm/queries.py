"""The queries of this package: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quartermaster.llm import (alignment, ann, bpe, fingerprints, html_extract, language_id, packing, quality, simhash, token_counts, toxicity,
                               url_filter, whitening)
from quartermaster.llm.common import prepare, table

URL_RULES = tuple(url_filter.HostRule(v, t) for v, t in (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Co-trains the quality classifier outside the held-out fold and scores every document."""
    prepare(spark)
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts every page's main text by its host's winning container paths."""
    prepare(spark)
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes every document by the ranks of byte_bpe_50k.tiktoken."""
    prepare(spark)
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products found for every vector whose id is divisible by 20."""
    prepare(spark)
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judges every page's URL by the host rules, then by the default patterns."""
    prepare(spark)
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word SimHash fingerprints of every document, linked at four bits or fewer."""
    prepare(spark)
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs every document's ids and a closing 2 into sequences of 1024 tokens."""
    prepare(spark)
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, closing_id=2)


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiset fingerprints of every document and its half-edited text, and their likeness."""
    prepare(spark)
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts the tokens of every document from its prefix table, against a budget of 512."""
    prepare(spark)
    return token_counts.count(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), budget=512)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores every document's restored text with a model learnt from the labels outside the held-out fold."""
    prepare(spark)
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of every usable vector."""
    prepare(spark)
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligns two tokenizers' tokens of every document and weighs their links by corpus-wide counts."""
    prepare(spark)
    return alignment.link_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                 public_tokenizers.path("piece_bpe_32k.model"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicts every document's language with piece probabilities learnt outside the held-out fold."""
    prepare(spark)
    return language_id.judge(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


QUERIES = {f.__name__: f for f in (
    op1_quality, op2_html_text, op3_byte_bpe, op4_nearest_neighbours, op5_url_filter, op6_simhash, op7_best_fit_packing,
    op8_document_fingerprints, op9_token_counts, op10_toxicity, op11_embedding_whitening, op12_token_alignment, op13_language_id)}

_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_PATTERN_ROWS = ", ".join(f"({i}, '{p.verdict}', '{p.pattern}', {list(p.literals)})" for i, p in enumerate(url_filter.PATTERNS))

#: DuckDB twins of the queries that SQL can express.
ORACLES = {"op5_url_filter": f"""
WITH u AS (
  SELECT page_id, row_number() OVER () AS n, url, translate(CASE WHEN contains(url, '://') THEN url ELSE '' END, {_FOLD}) AS low,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), {_FOLD}) AS host,
         regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
r(verdict, rule, rhost, rpath) AS (VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
  ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
best AS (
  SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY n),
p(i, verdict, pattern, literals) AS (VALUES {_PATTERN_ROWS}),
hit AS (
  SELECT n, arg_min(pattern, i) AS pattern, arg_min(verdict, i) AS verdict
  FROM u JOIN p ON list_has_all(string_split_regex(low, '[^a-z0-9]+'), literals) AND regexp_matches(low, pattern)
  WHERE n NOT IN (SELECT n FROM best) GROUP BY n)
SELECT page_id, host, path, best.rule, coalesce(best.verdict, hit.verdict, 'allow') AS verdict, hit.pattern
FROM u LEFT JOIN best USING (n) LEFT JOIN hit USING (n)"""}
