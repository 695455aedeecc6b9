"""Sentence windows of documents: build, score, pool, choose disjoint ones, pool across a document's chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from trovespark.functions.ids import parent
from trovespark.functions.text import is_prose
from trovespark.operators.fusion import order_by_two
from trovespark.operators.lexical import grouped_bm25
from trovespark.operators.ranking import by_score
from trovespark.operators.rerank import Scorer, overlap_score


def prose_only(sentences: Column) -> Column:
    """The sentences that are prose. Apply it once, where sentences are made: window numbers refer to this list."""
    return F.filter(sentences, is_prose)


def window_list(title: Column, sentences: Column, size: int = 3, stride: int = 1) -> Column:
    """Windows of consecutive sentences behind the title, as structs of start and text.

    Without sentences the title alone is one; up to `size` sentences are one; a rest shorter than `size` is none.
    """
    head = F.coalesce(title, F.lit(""))
    whole = F.array(F.struct(F.lit(0).alias("sent_start"), F.trim(F.concat_ws(" ", head, F.array_join(sentences, " "))).alias("text")))
    starts = F.sequence(F.lit(0), F.greatest(F.size(sentences) - size, F.lit(0)), F.lit(stride))
    cut = F.transform(starts, lambda i: F.struct(i.alias("sent_start"), F.trim(F.concat_ws(" ", head, F.array_join(F.slice(sentences, i + 1, size), " "))).alias("text")))
    none = F.when(F.trim(head) == "", F.slice(whole, 1, 0)).otherwise(whole)
    return F.when(F.size(sentences) == 0, none).when(F.size(sentences) <= size, whole).otherwise(cut)


def build(docs: DataFrame, size: int = 3, stride: int = 1) -> DataFrame:
    """One row a window of (…, title, sentences): window_idx, sent_start, window_text."""
    rows = docs.select("*", F.posexplode(window_list(F.col("title"), F.col("sentences"), size, stride)).alias("window_idx", "_w"))
    return rows.select("*", F.col("_w.sent_start").alias("sent_start"), F.col("_w.text").alias("window_text")).drop("_w", "title", "sentences")


def shortlist(windows: DataFrame, top: int, embed_score: Scorer = overlap_score, k: int = 60, weights: tuple[float, float] = (1.0, 1.0)) -> DataFrame:
    """At most `top` windows a document: all in order where there are no more, else the best by fused BM25 (within the
    document) and embedding order."""
    pair = ["qid", "docno"]
    counted = windows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*pair)))
    few = counted.where(F.col("_n") <= top).drop("_n")
    many = grouped_bm25(counted.where(F.col("_n") > top).drop("_n"), pair, "window_idx", F.col("query"), F.col("window_text"))
    chosen = order_by_two(many, pair, "window_idx", F.col("bm25"), embed_score(F.col("query"), F.col("window_text")), k, 1, weights)
    return few.unionByName(chosen.where(F.col("rank") <= top).select(*few.columns))


def scored(windows: DataFrame, scorer: Scorer = overlap_score) -> DataFrame:
    """ce_score of every window; 0 for a blank query."""
    score = F.when(F.trim(F.coalesce("query", F.lit(""))) == "", F.lit(0.0)).otherwise(scorer(F.col("query"), F.col("window_text")))
    return windows.withColumn("ce_score", score)


def document_run(windows: DataFrame) -> DataFrame:
    """Documents by their best window."""
    return by_score(windows.groupBy("qid", "docno").agg(F.max("ce_score").alias("score"))).select("qid", "docno", "rank", "score")


def max_pool(windows: DataFrame) -> DataFrame:
    """Each window once at its best score over query fields; of equal scores the field first in order, none last."""
    best = Window.partitionBy("qid", "docno", "window_idx").orderBy(F.desc_nulls_last("ce_score"), F.asc_nulls_last("query_field"))
    return windows.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")


def best_text(windows: DataFrame) -> DataFrame:
    """The text of each document's best window, the first of equals."""
    key = F.struct(F.col("ce_score"), -F.col("window_idx"))
    return windows.groupBy("qid", "docno").agg(F.max_by("window_text", key).alias("text"))


def sentence_ids(start: Column, size: int) -> Column:
    return F.sequence(start, start + (size - 1))


def choose(pooled: DataFrame, size: int = 3, top: int = 2) -> DataFrame:
    """The best window of each document, and with `top` 2 the second if it shares no sentence with it.

    Adds place (1, 2), chosen, overlap (sentences that the second shares with the first); other windows go.
    """
    order = Window.partitionBy("qid", "docno").orderBy(F.desc_nulls_last("ce_score"), "window_idx")
    rows = pooled.withColumn("place", F.row_number().over(order)).withColumn("_best", F.first("sent_start").over(order)).where(F.col("place") <= top)
    shared = F.greatest(F.lit(0), F.lit(size) - F.abs(F.col("sent_start") - F.col("_best")))
    rows = rows.withColumn("overlap", F.when(F.col("place") == 2, shared).otherwise(0)).drop("_best")
    return rows.withColumn("chosen", (F.col("place") == 1) | (F.col("overlap") == 0)).withColumn("sent_ids", sentence_ids(F.col("sent_start"), size))


def pool_chunks(chosen: DataFrame, n: int) -> DataFrame:
    """Each document's n best chosen windows over its chunks; qid, docno (the document), chunk_id, place."""
    rows = chosen.where("chosen").withColumn("chunk_id", F.col("docno")).withColumn("docno", parent(F.col("docno")))
    order = Window.partitionBy("qid", "docno").orderBy(F.desc_nulls_last("ce_score"), "window_idx", "chunk_id")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def embedded(chosen: DataFrame) -> DataFrame:
    """One row a query: a map from document to its selected windows (structs in order)."""
    window = F.struct("place", "window_idx", "ce_score", "sent_ids", "query_field")
    per = chosen.where("chosen").groupBy("qid", "docno").agg(F.array_sort(F.collect_list(window)).alias("w"))
    selected = F.struct(F.transform("w", lambda w: w.dropFields("place")).alias("selected_windows"))
    return per.groupBy("qid").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("docno", selected.alias("v"))), lambda a, b: F.when(a["docno"] < b["docno"], -1).when(a["docno"] > b["docno"], 1).otherwise(0))).alias("doc_snippet_windows"))


def unembedded(records: DataFrame) -> DataFrame:
    """The windows of embedded records as rows again."""
    docs = records.select("qid", F.explode("doc_snippet_windows").alias("docno", "v"))
    return docs.select("qid", "docno", F.explode("v.selected_windows").alias("w")).select("qid", "docno", "w.*")


def stats(pairs: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row of counts and rates over document slots (qid, docno): windows kept, seconds dropped, overlaps."""
    aux = chosen.groupBy("qid", "docno").agg(
        F.sum(F.col("chosen").cast("int")).alias("kept"), F.max((F.col("place") == 2).cast("int")).alias("two"), F.max(F.when(F.col("place") == 2, F.col("overlap")).otherwise(0)).alias("overlap")
    )
    rows = pairs.select("qid", "docno").join(aux, ["qid", "docno"], "left")
    total = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    kept, two, overlap = F.coalesce("kept", F.lit(0)), F.coalesce("two", F.lit(0)), F.coalesce("overlap", F.lit(0))
    out = rows.agg(
        F.count(F.lit(1)).alias("doc_pairs"), total(kept >= 2).alias("final_two"), total(kept == 1).alias("final_one"), total(kept == 0).alias("fallback"),
        total(two == 1).alias("ranked_two"), total(overlap > 0).alias("dropped_second"), total(overlap).alias("overlap_sum"),
        total(overlap > 0).alias("overlapping"), total(kept == 1).alias("under_two"),
    )
    rate = lambda a, b: F.when(F.col(b) > 0, F.round(F.col(a) / F.col(b), 9)).otherwise(0.0)
    return out.select(
        "*", F.when(F.col("dropped_second") > 0, F.round(F.col("overlap_sum") / F.col("dropped_second"), 9)).alias("overlap_mean"), rate("final_two", "doc_pairs").alias("rate_two"),
        rate("final_one", "doc_pairs").alias("rate_one"), rate("fallback", "doc_pairs").alias("rate_fallback"), rate("dropped_second", "ranked_two").alias("rate_dropped"),
        rate("overlapping", "ranked_two").alias("rate_overlapping"),
    )


def legacy_rows(records: DataFrame) -> DataFrame:
    """The windows of records that carry them as one flat list (structs with docno) as scored rows, places by score within
    a document: the shape before windows were kept by document."""
    rows = records.select("qid", F.explode("snippet_windows").alias("w")).select("qid", "w.*")
    order = Window.partitionBy("qid", "docno").orderBy(F.desc_nulls_last("ce_score"), "window_idx")
    return rows.withColumn("place", F.row_number().over(order))


def source_label(records: DataFrame) -> DataFrame:
    """One row: whether records carry windows by document ('embedded') or as a flat list ('legacy'), none does ('file'), or
    only some or some of each ('mixed')."""
    has = lambda c, size: F.coalesce(size(F.col(c)) > 0, F.lit(False)) if c in records.columns else F.lit(False)
    new, old = has("doc_snippet_windows", lambda m: F.size(F.map_keys(m))), has("snippet_windows", F.size)
    told = records.agg(F.bool_and(new).alias("all_new"), F.bool_and(old & ~new).alias("all_old"), F.bool_or(new | old).alias("some"))
    return told.select(F.when(F.col("all_new"), "embedded").when(F.col("all_old"), "legacy").when(F.col("some"), "mixed").otherwise("file").alias("source"))
