"""Reciprocal-rank fusion. One function covers every variant: rank column or list position, base 0 or 1, pools, scopes,
fixed or adaptive weights, ties by document or by position. Legs are summed left to right, so sums are exact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from trovespark.operators.ranking import by_score, cap_chunks, cut, first_of, ranked


def positioned(run: DataFrame) -> DataFrame:
    """Ranks by place in the list, repeated documents at their first place."""
    return ranked(first_of(run, ["qid", "docno"], F.asc("rank")), F.asc("rank"), F.asc("docno"))


def fuse(
    legs: list[DataFrame],
    weights: list[float] | None = None,
    k: int = 60,
    pools: list[int | None] | None = None,
    out: int | None = None,
    base: int = 1,
    by_place: bool = False,
    scope: int | None = None,
    first_weight: float | None = None,
) -> DataFrame:
    """qid, docno, rank, score by sum of weight / (k + rank).

    `weights` default to 1/N each; a leg of weight 0 takes no part. `pools` cut each leg. `by_place` ranks by place in
    the list, `base` is the first rank's number (ranks below it count as it). `scope` keeps only queries of that leg.
    With `first_weight` w the weights are set for each query: leg 0 has w, or 1 if no other leg has rows for the query;
    the others share the rest equally, or all if leg 0 has none.
    """
    n = len(legs)
    weights = weights or [1.0 / n] * n
    parts = []
    for i, leg in enumerate(legs):
        leg = positioned(leg) if by_place else leg
        leg = cut(leg, pools[i]) if pools and pools[i] is not None else leg
        rank = F.greatest(F.col("rank"), F.lit(1)) + F.lit(base - 1)
        parts.append(leg.groupBy("qid", "docno").agg(F.min(rank).alias("r")).select("qid", "docno", F.lit(i).alias("leg"), "r"))
    rows = reduce(DataFrame.unionByName, [p for p, w in zip(parts, weights) if w != 0 or first_weight is not None])
    share: list[Column] = [F.lit(float(w)) for w in weights]
    columns = [F.max(F.when(F.col("leg") == i, F.col("r"))).alias(f"r{i}") for i in range(n)]
    wide = rows.groupBy("qid", "docno").agg(*columns)
    if first_weight is not None:
        own = Window.partitionBy("qid")
        active = [F.max(F.col(f"r{i}").isNotNull()).over(own) for i in range(n)]
        others = reduce(lambda a, b: a + b, [a.cast("int") for a in active[1:]], F.lit(0))
        rest = F.when(active[0], 1.0 - first_weight).otherwise(1.0)
        share = [F.when(others > 0, F.lit(float(first_weight))).otherwise(1.0), *([F.when(others > 0, rest / others).otherwise(0.0)] * (n - 1))]
    terms = [F.coalesce(share[i] / (k + F.col(f"r{i}")), F.lit(0.0)) for i in range(n)]
    fused = wide.select("qid", "docno", reduce(lambda a, b: a + b, terms).alias("score"))
    if scope is not None:
        fused = fused.join(legs[scope].select("qid").distinct(), "qid", "left_semi")
    fused = by_score(fused).select("qid", "docno", "rank", "score")
    return cut(fused, out) if out else fused


def two_legs(lexical: DataFrame, dense: DataFrame, k_lexical: int, k_dense: int, k: int = 60, w_lexical: float = 1.0, w_dense: float = 1.0, out: int | None = None) -> DataFrame:
    """Both runs cut and fused, over the queries and documents of either."""
    return fuse([lexical, dense], [w_lexical, w_dense], k, [k_lexical, k_dense], out)


def after_rerank(reranked: DataFrame, retrieved: DataFrame, pool_rerank: int, pool_retrieved: int, k: int = 60, w_rerank: float = 0.8, chunks: int = 0) -> DataFrame:
    """A reranked list fused with the list it came from, for the reranked queries; at most `chunks` of a document if positive."""
    fused = fuse([reranked, retrieved], [w_rerank, 1 - w_rerank], k, [pool_rerank, pool_retrieved], by_place=True, scope=0)
    return cap_chunks(fused, chunks).select("qid", "docno", "rank")


def listwise(listed: DataFrame, snippets: DataFrame, pool: int = 15, k: int = 20, w_listed: float = 0.6) -> DataFrame:
    return fuse([listed, snippets], [w_listed, 1 - w_listed], k, [pool, pool], by_place=True, scope=0)


def order_by_two(items: DataFrame, group: list[str], item: str, first: Column, second: Column, k: int = 60, base: int = 0, weights: tuple[float, float] = (1.0, 1.0)) -> DataFrame:
    """`rank` of items within a group by fusing their orders under two scores (higher first, ties by `item`)."""
    order = lambda c: F.row_number().over(Window.partitionBy(*group).orderBy(F.desc_nulls_last(c), F.asc(item))) - 1 + base
    scored = items.withColumn("_a", first).withColumn("_b", second)
    scored = scored.withColumn("rrf", weights[0] / (k + order("_a")) + weights[1] / (k + order("_b"))).drop("_a", "_b")
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("rrf"), F.asc(item))))


def grid(lexical: DataFrame, dense: DataFrame, configs: DataFrame, k_lexical: int, k_dense: int, out: int) -> DataFrame:
    """Two-leg fusion under every configuration (config, k_rrf, w_lexical, w_dense) in one job: configuration by
    configuration a row for each fused document. The table of configurations is small; every document meets each once."""
    parts = cut(lexical, k_lexical).select("qid", "docno", F.col("rank").alias("a"), F.lit(None).cast("int").alias("b"))
    parts = parts.unionByName(cut(dense, k_dense).select("qid", "docno", F.lit(None).cast("int").alias("a"), F.col("rank").alias("b")))
    wide = parts.groupBy("qid", "docno").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    both = wide.crossJoin(configs)
    score = F.coalesce(F.col("w_lexical") / (F.col("k_rrf") + F.col("a")), F.lit(0.0)) + F.coalesce(F.col("w_dense") / (F.col("k_rrf") + F.col("b")), F.lit(0.0))
    order = Window.partitionBy("config", "qid").orderBy(F.desc("score"), F.asc("docno"))
    return both.withColumn("score", score).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= out).select("config", "qid", "docno", "rank", "score")


def ranked_configs(results: DataFrame, cap: str, k_max: str) -> DataFrame:
    """Configurations by mean recall over splits at the cap, then at the largest k."""
    means = results.groupBy("k_rrf", "w_lexical", "w_dense").agg(F.avg(cap).alias("at_cap"), F.avg(k_max).alias("at_max"))
    order = Window.orderBy(F.desc(F.round("at_cap", 9)), F.desc(F.round("at_max", 9)), "k_rrf", "w_lexical", "w_dense")
    return means.withColumn("place", F.row_number().over(order))


def weight_pairs(text: str) -> list[tuple[float, float]]:
    """'1,1;2,1' as pairs of weights."""
    return [tuple(float(x) for x in p.split(",")) for p in text.split(";") if p.strip()]  # type: ignore[misc]


def weight_list(text: str, n: int) -> list[float]:
    """'0.5,0.3,0.2' as n weights; another number of them is an error."""
    found = [float(x) for x in text.split(",") if x.strip()]
    if len(found) != n:
        raise ValueError(f"{n} weights are needed, not {len(found)}")
    return found


def whole_numbers(text: str) -> list[int]:
    return [int(x) for x in text.split(",") if x.strip()]
