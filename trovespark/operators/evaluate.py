"""Ranking metrics. One evaluator covers every variant: documents or chunks, and which queries are averaged.

A gold table has qid and docno, one row a relevant document; `universe` lists all queries, so that queries without gold
count. Metrics per query are a row each; summaries average them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from trovespark.operators.ranking import first_chunk, first_of, ranked

KS = (50, 100, 200, 300, 400, 500, 1000, 2000, 5000)
EPSILON = 1e-5


def judged(run: DataFrame, gold: DataFrame, collapse: bool = True) -> DataFrame:
    """The run with rel (0 or 1) and hits (relevant so far), chunks as their documents if `collapse`."""
    listed = first_chunk(run.select("qid", "docno", "rank")) if collapse else ranked(first_of(run.select("qid", "docno", "rank"), ["qid", "docno"], F.asc("rank")), F.asc("rank"), F.asc("docno"))
    rel = listed.join(gold.select("qid", "docno").distinct().withColumn("rel", F.lit(1)), ["qid", "docno"], "left")
    rel = rel.withColumn("rel", F.coalesce("rel", F.lit(0)))
    return rel.withColumn("hits", F.sum("rel").over(Window.partitionBy("qid").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)))


def average_precision(k: int) -> Column:
    """Over judged rows of a query with `n_gold`: precision at each hit over the gold there could be."""
    at = F.when((F.col("rel") == 1) & (F.col("rank") <= k), F.col("hits") / F.col("rank")).otherwise(0.0)
    return F.when(F.first("n_gold") > 0, F.sum(at) / F.least(F.first("n_gold"), F.lit(k))).otherwise(0.0)


def recall(k: int | Column) -> Column:
    return F.when(F.first("n_gold") > 0, F.sum(F.when(F.col("rank") <= k, F.col("rel")).otherwise(0)) / F.first("n_gold")).otherwise(0.0)


def queries_of(gold: DataFrame, run: DataFrame, universe: DataFrame | None, scope: str) -> DataFrame:
    """qid, n_gold of the queries averaged: 'gold' all given, 'both' those also in the run, 'nonempty' those in the run
    with gold."""
    sizes = gold.groupBy("qid").agg(F.countDistinct("docno").alias("n_gold"))
    every = (universe if universe is not None else gold).select("qid").distinct().join(sizes, "qid", "left")
    every = every.withColumn("n_gold", F.coalesce("n_gold", F.lit(0)))
    if scope == "gold":
        return every
    seen = every.join(run.select("qid").distinct(), "qid", "left_semi")
    return seen.where("n_gold > 0") if scope == "nonempty" else seen


def per_query(run: DataFrame, gold: DataFrame, universe: DataFrame | None = None, k: int = 10, ks: Iterable[int] = (50,), collapse: bool = True, scope: str = "gold") -> DataFrame:
    """qid, n_gold, ap, rr, success and recall at k, and r_K for each K."""
    rows = queries_of(gold, run, universe, scope).join(judged(run, gold, collapse), "qid", "left")
    hit = F.when((F.col("rel") == 1) & (F.col("rank") <= k), F.col("rank"))
    columns = [average_precision(k).alias("ap"), F.coalesce(1.0 / F.min(hit), F.lit(0.0)).alias("rr"), F.coalesce(F.max(F.when(hit.isNotNull(), 1.0)), F.lit(0.0)).alias("success"), recall(k).alias("recall")]
    return rows.groupBy("qid", "n_gold").agg(*columns, *(recall(x).alias(f"r_{x}") for x in ks))


def summary(metrics: DataFrame, *by: str) -> DataFrame:
    """Means over queries; gmap is the geometric mean of average precisions of at least EPSILON."""
    ks = [c for c in metrics.columns if c.startswith("r_")]
    columns = [F.count(F.lit(1)).alias("n_queries"), F.avg("ap").alias("map"), F.exp(F.avg(F.log(F.greatest("ap", F.lit(EPSILON))))).alias("gmap"), F.avg("rr").alias("mrr"), F.avg("success").alias("success"), F.avg("recall").alias("mean_r")]
    return metrics.groupBy(*by).agg(*columns, *(F.avg(c).alias(f"mean_{c}") for c in ks))


def recall_points(run: DataFrame, gold: DataFrame, ks: Iterable[int], universe: DataFrame | None = None) -> DataFrame:
    """k, mean recall at min(k, list length), share of queries with fewer than k documents, mean length counted."""
    per = queries_of(gold, run, universe, "gold").join(judged(run, gold), "qid", "left").groupBy("qid").agg(
        F.count("docno").alias("n"), *(recall(k).alias(f"r{k}") for k in ks)
    )
    points = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"r{k}").alias("r"), (F.col("n") < k).cast("double").alias("short"), F.least("n", F.lit(k)).alias("keff")) for k in ks)))
    return per.select(points.alias("p")).select("p.*").groupBy("k").agg(F.avg("r").alias("mean_r"), F.avg("short").alias("shortfall"), F.avg("keff").alias("mean_keff"))


def zero_recall(run: DataFrame, gold: DataFrame, k: int) -> DataFrame:
    """Queries with gold of which the first k documents have none."""
    hits = judged(run, gold).where((F.col("rel") == 1) & (F.col("rank") <= k)).select("qid")
    return gold.select("qid").distinct().join(hits, "qid", "left_anti")


def map_curve(run: DataFrame, gold: DataFrame, ks: Iterable[int], collapse: bool = True) -> DataFrame:
    """k, mean average precision at k over queries in the run that have gold."""
    rows = queries_of(gold, run, None, "nonempty").join(judged(run, gold, collapse), "qid")
    per = rows.groupBy("qid").agg(*(average_precision(k).alias(f"a{k}") for k in ks))
    points = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"a{k}").alias("ap")) for k in ks)))
    return per.select(points.alias("p")).select("p.*").groupBy("k").agg(F.avg("ap").alias("map"))


def comparable(legs: dict[str, DataFrame]) -> tuple[DataFrame, list[str]]:
    """Queries of any leg but the first, and the legs that have all of them."""
    names = list(legs)
    tagged = None
    for name in names:
        part = legs[name].select("qid").distinct().withColumn("leg", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part)
    different = tagged.where(F.col("leg") != names[0]).select("qid").distinct()
    n = different.count()
    covered = tagged.join(different, "qid", "left_semi").groupBy("leg").agg(F.countDistinct("qid").alias("n")).where(F.col("n") == n)
    return different, sorted(r.leg for r in covered.collect())


def deltas(after: DataFrame, before: DataFrame, key: str, columns: Iterable[str]) -> DataFrame:
    """Differences of metrics by key."""
    old = before.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    return after.join(old, key).select(key, *((F.col(c) - F.col(f"_{c}")).alias(f"delta_{c}") for c in columns))
