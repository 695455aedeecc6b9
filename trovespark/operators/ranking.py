"""Ranked lists: order, cuts, duplicates, chunks and their documents. A run has qid, docno, rank and maybe score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from trovespark.functions.ids import parent


def ranked(run: DataFrame, *order: Column, by: tuple[str, ...] = ("qid",), start: int = 1) -> DataFrame:
    """`run` with rank set anew by `order` within each query."""
    return run.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) + F.lit(start - 1))


def by_score(run: DataFrame, start: int = 1) -> DataFrame:
    """Ranked by falling score (missing ones last), ties by document."""
    return ranked(run, F.desc_nulls_last("score"), F.asc("docno"), start=start)


def cut(run: DataFrame, k: int) -> DataFrame:
    return run.where(F.col("rank") <= k)


def first_of(run: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row for each key: the first in order."""
    return run.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def clean_dense(run: DataFrame) -> DataFrame:
    """A dense run in order: repeated documents once, at their best rank, and ranks without gaps."""
    return ranked(first_of(run, ["qid", "docno"], F.asc("rank"), F.desc_nulls_last("score")), F.asc("rank"), F.asc("docno"))


def best_chunk(run: DataFrame) -> DataFrame:
    """Each document at its best chunk's score; ranks count from 0."""
    pooled = run.groupBy("qid", parent(F.col("docno")).alias("docno")).agg(F.max("score").alias("score"))
    return by_score(pooled, start=0)


def first_chunk(run: DataFrame) -> DataFrame:
    """Each document at its first chunk, ranks closed up."""
    one = run.withColumn("docno", parent(F.col("docno"))).groupBy("qid", "docno").agg(F.min("rank").alias("rank"))
    return ranked(one, F.asc("rank"), F.asc("docno"))


def cap_chunks(run: DataFrame, most: int) -> DataFrame:
    """At most so many chunks of a document, ranks closed up; all if `most` is not positive."""
    if most <= 0:
        return run
    own = Window.partitionBy("qid", "_p").orderBy("rank", "docno")
    kept = run.withColumn("_p", parent(F.col("docno"))).withColumn("_n", F.row_number().over(own)).where(F.col("_n") <= most)
    return ranked(kept.drop("_p", "_n"), F.asc("rank"), F.asc("docno"))


def top_parents(run: DataFrame, k: int, most: int = 1) -> DataFrame:
    """Chunks of the k first documents, at most `most` of each, in their own order. Chunks of such a document count
    wherever they stand, also behind the first chunk of document k."""
    doc = Window.partitionBy("qid", "_p")
    run = run.withColumn("_p", parent(F.col("docno"))).withColumn("_first", F.min("rank").over(doc))
    run = run.withColumn("_doc", F.dense_rank().over(Window.partitionBy("qid").orderBy("_first", "_p"))).where(F.col("_doc") <= k)
    run = run.withColumn("_n", F.row_number().over(doc.orderBy("rank", "docno")))
    if most > 0:
        run = run.where(F.col("_n") <= most)
    return ranked(run.drop("_p", "_first", "_doc", "_n"), F.asc("rank"), F.asc("docno"))


def first_queries(run: DataFrame, n: int) -> DataFrame:
    """The rows of the n queries that come first by name."""
    return run.join(run.select("qid").distinct().orderBy("qid").limit(n), "qid", "left_semi")


def without_queries(run: DataFrame, other: DataFrame) -> DataFrame:
    """Rows of queries that the other table doesn't have: training queries that would leak into a test."""
    return run.join(other.select("qid").distinct(), "qid", "left_anti")


def with_override(*tables: DataFrame) -> DataFrame:
    """Union of gold tables (qid, docnos); of a query in several the last table's row holds."""
    both = [t.withColumn("_at", F.lit(i)) for i, t in enumerate(tables)]
    union = both[0]
    for t in both[1:]:
        union = union.unionByName(t)
    return first_of(union, ["qid"], F.desc("_at")).drop("_at")


def upserted(old: DataFrame, new: DataFrame, key: str = "query_id") -> DataFrame:
    """Rows of `old`, replaced by `new` where it has the key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new.join(old.select(key), key, "left_semi"))
