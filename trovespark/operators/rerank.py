"""Reranking through pluggable scorers, and the cut by score threshold.

A scorer is a function of columns; models sit behind Arrow UDFs made by `arrow_scorer`, loaded once in each Python
worker. `overlap_score` stands in for a model where none is installed: it is a plain expression and says so by its name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from trovespark.functions.text import content_words
from trovespark.operators.ranking import ranked

Scorer = Callable[[Column, Column], Column]


def overlap_score(query: Column, text: Column) -> Column:
    """Stand-in scorer: the share of the query's content words that the text has; null for a query without any."""
    wanted = content_words(query)
    return F.when(F.size(wanted) > 0, F.size(F.array_intersect(wanted, content_words(text))) / F.size(wanted))


def arrow_scorer(load: Callable[[], Callable[[list[str], list[str]], list[float]]]) -> Scorer:
    """A scorer from a loader of a pair model; the model is loaded once a worker and takes Arrow batches."""

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = load()
        for queries, texts in batches:
            yield pd.Series(model(queries.fillna("").tolist(), texts.fillna("").tolist()), dtype="float64")

    return score


def rerank(run: DataFrame, topics: DataFrame, texts: DataFrame, scorer: Scorer = overlap_score, skip_empty: bool = True) -> DataFrame:
    """The run's documents by falling score; ties and unscored ones keep their order behind. Documents without text are
    scored as empty. Queries without text go, or with `skip_empty` off keep their order with no score."""
    told = run.join(topics.where(F.trim("query") != ""), "qid", "inner" if skip_empty else "left").join(texts.select("docno", "text"), "docno", "left")
    score = F.when(F.col("query").isNotNull(), F.nanvl(scorer(F.col("query"), F.coalesce("text", F.lit(""))).cast("double"), F.lit(None).cast("double")))
    scored = told.withColumn("score", score).withColumn("_in", F.col("rank"))
    return ranked(scored, F.desc_nulls_last("score"), F.asc("_in"), F.asc("docno")).select("qid", "docno", "rank", "score")


def best_passages(pairs: DataFrame, size: int, step: int | None = None, overhead: int = 4) -> DataFrame:
    """(qid, docno, query, text) cut into windows of words that leave room for the query: one row a window (`window`).

    A window has max(128, size - query words - overhead) words; windows begin every `step` words, half a window if unset,
    up to the first that reaches the end.
    """
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    room = F.greatest(F.lit(128), F.lit(size - overhead) - F.size(F.split("query", r"\s+")))
    rows = pairs.withColumn("_w", words).withColumn("_n", room).withColumn("_s", F.lit(step) if step else F.greatest(F.floor(F.col("_n") / 2), F.lit(1)).cast("int"))
    last = F.greatest(F.lit(0), F.ceil((F.size("_w") - F.col("_n")) / F.col("_s"))).cast("int")
    rows = rows.withColumn("window", F.explode(F.sequence(F.lit(0), last)))
    part = F.array_join(F.slice("_w", F.col("window") * F.col("_s") + 1, F.col("_n")), " ")
    return rows.select("qid", "docno", "query", "window", part.alias("text"))


def by_best_passage(run: DataFrame, topics: DataFrame, texts: DataFrame, scorer: Scorer = overlap_score, size: int = 512, step: int | None = None) -> DataFrame:
    """Documents by the score of their best window."""
    pairs = run.join(topics, "qid").join(texts.select("docno", "text"), "docno", "left").withColumn("text", F.coalesce("text", F.lit("")))
    windows = best_passages(pairs, size, step).withColumn("score", scorer(F.col("query"), F.col("text")))
    best = windows.groupBy("qid", "docno").agg(F.max("score").alias("score"))
    joined = run.select("qid", "docno", F.col("rank").alias("_in")).join(best, ["qid", "docno"], "left")
    return ranked(joined, F.desc_nulls_last("score"), F.asc("_in"), F.asc("docno")).select("qid", "docno", "rank", "score")


def listwise_requests(run: DataFrame, topics: DataFrame, snippets: DataFrame, k: int, most_words: int = 250) -> DataFrame:
    """One row a query: its first k documents that have a snippet, as docnos and clipped passages in order."""
    clip = F.array_join(F.slice(F.filter(F.split("text", r"\s+"), lambda w: w != ""), 1, most_words), " ")
    rows = run.where(F.col("rank") <= k).join(snippets.select("qid", "docno", "text"), ["qid", "docno"]).join(topics, "qid")
    listed = F.array_sort(F.collect_list(F.struct("rank", "docno", clip.alias("passage"))))
    return rows.groupBy("qid", "query").agg(listed.alias("c")).select("qid", "query", F.col("c.docno").alias("docnos"), F.col("c.passage").alias("passages"))


def overlap_order(query: str, passages: list[str]) -> list[int]:
    """Stand-in permutation: by number of the query's words, ties in order."""
    wanted = set(query.lower().split())
    return sorted(range(len(passages)), key=lambda i: -len(wanted & set(passages[i].lower().split())))


def permuted(requests: DataFrame, order: Callable[[str, list[str]], list[int]] = overlap_order, window: int | None = None, stride: int = 5) -> DataFrame:
    """qid, docno, rank after listwise ranking: all at once, or in windows that slide from the end to the front."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in pdf.itertuples():
            docs, texts = list(row.docnos), list(row.passages)
            size = window or len(docs)
            begin = max(0, len(docs) - size)
            while True:
                part = slice(begin, begin + size)
                new = order(row.query, texts[part])
                docs[part], texts[part] = [docs[part][i] for i in new], [texts[part][i] for i in new]
                if begin == 0:
                    break
                begin = max(0, begin - stride)
            out += [(row.qid, d, i) for i, d in enumerate(docs, 1)]
        return pd.DataFrame(out, columns=["qid", "docno", "rank"])

    return requests.mapInPandas(lambda parts: (run(p) for p in parts), "qid string, docno string, rank int")


def snippet_sizes(snippets: DataFrame, size: Column) -> DataFrame:
    """One row: mean, median, 95th percentile and largest size."""
    return snippets.agg(F.round(F.avg(size), 6).alias("mean"), F.percentile(size, 0.5).alias("median"), F.round(F.percentile(size, 0.95), 6).alias("p95"), F.max(size).alias("most"))


def best_scores(*runs: DataFrame) -> DataFrame:
    """Each pair's best finite score over one or several runs."""
    rows = reduce(DataFrame.unionByName, [r.select("qid", "docno", "score") for r in runs])
    finite = F.when(~F.isnan("score") & (F.abs("score") < float("inf")), F.col("score"))
    return rows.groupBy("qid", "docno").agg(F.max(finite).alias("score"))


def cutoff(fused: DataFrame, scores: DataFrame, least: float, floor: int, cap: int | None = None) -> DataFrame:
    """Documents that score at least `least`, in fused order, at most `cap`; where fewer than `floor` are left, others
    follow in fused order up to it. Columns: qid, docno, rank, score, topped (whether it only fills up)."""
    run = fused.select("qid", "docno", F.col("rank").alias("_in")).join(scores.select("qid", "docno", "score"), ["qid", "docno"], "left")
    above = F.coalesce(F.col("score") >= least, F.lit(False))
    run = run.withColumn("_place", F.row_number().over(Window.partitionBy("qid", above).orderBy("_in", "docno")))
    kept = above & (F.col("_place") <= cap) if cap is not None and cap >= 0 else above
    run = run.withColumn("topped", ~kept)
    run = ranked(run, F.asc("topped"), F.asc("_in"), F.asc("docno"))
    return run.where(~F.col("topped") | (F.col("rank") <= floor)).select("qid", "docno", "rank", "score", "topped")


def cutoff_summary(fused: DataFrame, scores: DataFrame, gold: DataFrame, least: float, floor: int, cap: int | None = None) -> DataFrame:
    """A row a split and one of all: what the cut kept and what gold of the pool it lost. `fused` has split; a query's
    gold is in (qid, docno). The pooled row takes kept counts over all queries and means of the splits' shares."""
    own = fused.select(F.concat_ws("\x01", "split", "qid").alias("qid"), "docno", "rank")
    pairs = fused.select(F.concat_ws("\x01", "split", "qid").alias("key"), "split", "qid").distinct()
    keyed = scores.join(pairs, "qid").select(F.col("key").alias("qid"), "docno", "score")
    kept = cutoff(own, keyed, least, floor, cap)
    passing = own.join(keyed, ["qid", "docno"], "left").groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce((F.col("score") >= least).cast("int"), F.lit(0))).alias("over"))
    shape = lambda r: F.transform(F.array_sort(F.collect_list(F.struct("rank", "docno"))), lambda x: x["docno"]).alias(r)
    before, after = own.groupBy("qid").agg(shape("before")), kept.groupBy("qid").agg(shape("after"))
    golds = gold.join(pairs, "qid").select(F.col("key").alias("qid"), "docno").groupBy("qid").agg(F.collect_set("docno").alias("gold"))
    rows = before.join(after, "qid", "left").join(passing, "qid").join(golds, "qid", "left").join(pairs.select(F.col("key").alias("qid"), "split"), "qid")
    after_or_none = F.coalesce("after", F.array().cast("array<string>"))
    pool = F.array_intersect("before", F.coalesce("gold", F.array().cast("array<string>")))
    capped = F.least(F.col("over"), F.lit(cap)) if cap is not None and cap >= 0 else F.col("over")
    rows = rows.select("split", F.size(after_or_none).alias("kept"), (capped < floor).cast("double").alias("floored"), (F.col("over") / F.col("n")).alias("share"), (F.col("before") != after_or_none).cast("double").alias("changed"), F.when(F.size(pool) > 0, F.size(F.array_except(pool, after_or_none)) / F.size(pool)).alias("loss"))
    stats = lambda c, name: [F.avg(c).alias(f"mean_{name}"), F.percentile(c, 0.5).alias(f"median_{name}"), F.percentile(c, 0.9).alias(f"p90_{name}")]
    common = [F.count(F.lit(1)).alias("n_queries"), *stats("kept", "kept")]
    loss = [F.count("loss").alias("n_eval_pool_gold"), *stats("loss", "res_loss")]
    per = rows.groupBy("split").agg(*common, F.avg("floored").alias("floor_hit_frac"), F.avg("share").alias("threshold_keep_frac"), F.avg("changed").alias("changed_vs_input_frac"), *loss)
    fractions = per.agg(*(F.avg(c).alias(c) for c in ("floor_hit_frac", "threshold_keep_frac", "changed_vs_input_frac")))
    pooled = rows.agg(*common, *loss).crossJoin(fractions).withColumn("split", F.lit("__pooled__"))
    return per.unionByName(pooled)


def kept_histogram(kept: DataFrame) -> DataFrame:
    """How many queries kept how many documents."""
    return kept.groupBy("qid").agg(F.count(F.lit(1)).alias("kept")).groupBy("kept").agg(F.count(F.lit(1)).alias("n_queries"))
