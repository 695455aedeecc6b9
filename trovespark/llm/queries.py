"""Registered queries of the text-corpus operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from trovespark.llm import bytebpe, hnsw, hpylm, htmltext, langid, mixing, pii, setsketch, spotsigs, tokencount


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.label(table(spark, sf_dir, "documents"), parts=4, part=2)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpylm.score(table(spark, sf_dir, "documents"), parts=5, part=1)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edit_report(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in (op1_language_id, op2_token_counts, op3_lm_scores, op4_pii, op5_nearest, op6_html_text, op7_near_duplicates, op8_byte_bpe, op9_spotsigs, op10_mixing)}


#: Links by shared shingles counted exactly, then what they reach.
OP7_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') l FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(l) >= 4 THEN list_distinct(list_transform(range(1, len(l) - 2), lambda i: array_to_string(list_slice(l, i, i + 3), chr(10)))) WHEN len(l) > 0 THEN [array_to_string(l, chr(10))] ELSE [] END) g FROM w),
n AS (SELECT doc_id, count(*) c FROM s GROUP BY doc_id),
k AS (SELECT a.doc_id a, b.doc_id b, count(*) k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM k JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.c + y.c - k)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id node, doc_id label FROM documents UNION SELECT b, label FROM r JOIN both_ways ON node = a)
SELECT d.doc_id, coalesce(n.c, 0) n_shingles, m.label component_id, d.doc_id = m.label kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(label) label FROM r GROUP BY node) m ON m.node = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    """SQL gives op7's rows; models, tokenizers, graphs and markup have none, and their tests use brute force."""
    return {"op7_near_duplicates": OP7_SQL}
