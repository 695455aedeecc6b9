"""A corpus pipeline of five stages: language, near-duplicates, personal data, source mix, tokens.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of `documents`. Every stage works on
all that its predecessor kept, and its decisions take effect. No stage can be said in SQL as a whole, so ORACLE_SQL is
None; tests hold `run` against a plain version of the same stages.

Null texts and texts without a letter leave in the first stage; later stages therefore see texts with letters, but take
any. Every stage takes nulls in any column, repeated rows and empty tables, and finds its columns by exact spelling, the
first of a repeated name, so that extra columns (`Text`, a second `lang`) do no harm; they go. What a stage does with ties
and repeated rows stands at its function.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from trovespark.frames import materialise, pick, release
from trovespark.llm import bytebpe, langid, mixing, pii, setsketch

COLUMNS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; `lang` becomes the one found. What has no letter is rejected.

    Repeated rows are judged alike; of equally near languages the first in order is taken. Without a label in the table no
    language can be told and all go.
    """
    rows = pick(docs, **COLUMNS)
    model = langid.fit(rows)
    named = langid.label_rows(rows, model)
    return named.where(F.col("lang") != langid.UNKNOWN)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, Jaccard 0.8 or more) the document with the smallest id.

    Rows that repeat a doc_id are one document and stay or go together; rows without an id stay.
    """
    rows = pick(docs, **COLUMNS)
    gone = setsketch.near_duplicates(rows, width=5, percent=80).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return rows.join(setsketch.sized(gone), rows.doc_id == gone._gone, "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with identifiers, plain and disguised, replaced by their kind; repeated rows alike."""
    return pii.redact(pick(docs, **COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: never, once or twice. Rows equal in id and text are drawn
    together; rows without an id by their texts; a null source is a source of its own."""
    return mixing.mixed_documents(pick(docs, **COLUMNS))


def byte_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and of decoded bytes, a row for each row; a null text counts as empty."""
    return bytebpe.encode(pick(docs, **COLUMNS), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language ID", language),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("byte-level BPE", byte_tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's rows written to the shared folder before the next, and deleted behind it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            made = materialise(made, f"stage-{i}")
            release(docs)
        docs = made
    return docs
