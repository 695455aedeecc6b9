"""Lexical retrieval: postings and statistics, BM25, relevance feedback, and BM25 within small groups.

BM25 (Robertson and Zaragoza 2009) with an inverse document frequency that is never negative; feedback is RM3
(Abdul-Jaleel et al. 2004). Scores are rounded to six places before ranking, so that sums taken in another order rank the
same. A corpus is tokenised once, into an `Index` of postings that lies in the shared folder; first retrieval, feedback and
second retrieval all read that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from trovespark.frames import materialise, release
from trovespark.functions.text import window_words, words
from trovespark.operators.ranking import by_score, cut

K1, B = 1.2, 0.75


def with_tokens(corpus: DataFrame) -> DataFrame:
    return corpus.select("docno", words(F.col("text")).alias("tokens"))


def postings(corpus: DataFrame) -> DataFrame:
    """term, docno, tf and the document's length dl."""
    tokens = with_tokens(corpus).select("docno", F.size("tokens").alias("dl"), F.explode("tokens").alias("term"))
    return tokens.groupBy("term", "docno").agg(F.count(F.lit(1)).alias("tf"), F.first("dl").alias("dl"))


def corpus_stats(corpus: DataFrame) -> DataFrame:
    """One row: documents n, mean length avgdl."""
    return with_tokens(corpus).agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("tokens")).alias("avgdl"))


def term_stats(corpus: DataFrame) -> DataFrame:
    """term, df, cf."""
    return postings(corpus).groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def query_terms(topics: DataFrame) -> DataFrame:
    """qid, term, weight: how often the query has the term."""
    return topics.select("qid", F.explode(words(F.col("query"))).alias("term")).groupBy("qid", "term").agg(F.count(F.lit(1)).cast("double").alias("weight"))


@dataclass
class Index:
    """A corpus's postings (term, docno, tf, dl), document frequencies and statistics, written once and used by every
    retrieval; `stats` has one row. Terms are those of `words`: neither stemmed nor stopped."""

    postings: DataFrame
    df: DataFrame
    stats: DataFrame

    @classmethod
    def build(cls, corpus: DataFrame) -> Index:
        """The index in the shared folder, postings in order of their terms, so that a look-up reads few of their files."""
        rows = postings(corpus).repartitionByRange("term").sortWithinPartitions("term", "docno")
        stored = materialise(rows, "postings")
        df = materialise(stored.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "document-frequencies")
        return cls(stored, df, materialise(corpus_stats(corpus), "corpus-stats"))

    def release(self) -> None:
        release(self.postings, self.df, self.stats)


def part(weight: Column, n: Column | float, df: Column, tf: Column, dl: Column, avgdl: Column | float, k1: float = K1, b: float = B) -> Column:
    """One term's part of a BM25 score."""
    idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
    return weight * idf * tf * (k1 + 1) / (tf + k1 * ((1 - b) + b * dl / avgdl))


def bm25(index: Index, terms: DataFrame, k: int, k1: float = K1, b: float = B) -> DataFrame:
    """The k best documents of each query (qid, docno, score, rank), terms being qid, term, weight."""
    met = terms.join(index.df, "term").join(index.postings, "term").join(F.broadcast(index.stats))
    one = part(F.col("weight"), F.col("n"), F.col("df"), F.col("tf"), F.col("dl"), F.col("avgdl"), k1, b)
    scores = met.groupBy("qid", "docno").agg(F.round(F.sum(one), 6).alias("score"))
    return cut(by_score(scores), k).select("qid", "docno", "rank", "score")


def retrieve(corpus: DataFrame | Index, topics: DataFrame, k: int) -> DataFrame:
    """The k best documents of each topic. A corpus without an index gets one for this call."""
    return bm25(corpus if isinstance(corpus, Index) else Index.build(corpus), query_terms(topics), k)


def rm3_terms(index: Index, topics: DataFrame, first: DataFrame, fb_docs: int = 20, fb_terms: int = 30, fb_lambda: float = 0.6) -> DataFrame:
    """qid, term, weight of expanded queries: lambda of the query's own term shares, the rest of the feedback documents'.

    A feedback document counts by its share of the first scores; its terms by their share of its length. Weights are
    rounded to nine places before the best `fb_terms` are chosen, ties by term.
    """
    pool = first.where(F.col("rank") <= fb_docs)
    pool = pool.withColumn("share", F.col("score") / F.sum("score").over(Window.partitionBy("qid"))).select("qid", "docno", "share")
    model = index.postings.join(pool, "docno").groupBy("qid", "term").agg(F.round(F.sum(F.col("share") * F.col("tf") / F.col("dl")), 9).alias("p"))
    best = Window.partitionBy("qid").orderBy(F.desc("p"), "term")
    model = model.withColumn("r", F.row_number().over(best)).where(F.col("r") <= fb_terms)
    model = model.select("qid", "term", ((1 - fb_lambda) * F.col("p") / F.sum("p").over(Window.partitionBy("qid"))).alias("fed"), F.lit(0.0).alias("own"))
    own = query_terms(topics)
    own = own.select("qid", "term", F.lit(0.0).alias("fed"), (fb_lambda * F.col("weight") / F.sum("weight").over(Window.partitionBy("qid"))).alias("own"))
    both = model.unionByName(own).groupBy("qid", "term").agg(F.max("fed").alias("fed"), F.max("own").alias("own"))
    return both.select("qid", "term", F.round(F.col("own") + F.col("fed"), 9).alias("weight"))


def retrieve_rm3(corpus: DataFrame | Index, topics: DataFrame, k: int, k_feedback: int = 50, fb_docs: int = 20, fb_terms: int = 30, fb_lambda: float = 0.6) -> DataFrame:
    index = corpus if isinstance(corpus, Index) else Index.build(corpus)
    first = bm25(index, query_terms(topics), max(k_feedback, fb_docs))
    return bm25(index, rm3_terms(index, topics, first, fb_docs, fb_terms, fb_lambda), k)


def grouped_bm25(items: DataFrame, group: list[str], item: str, query: Column, text: Column, tokens=window_words, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """BM25 of each group's items against the group's query, with document frequencies of that group alone.

    Items without tokens, and all items of a query without tokens, score 0. The inverse document frequency is
    ln(1 + (n - df + 0.5) / (df + 0.5)).
    """
    rows = items.select(*group, item, tokens(query).alias("_q"), tokens(text).alias("_t"))
    times = lambda words, term: F.size(F.filter(words, lambda w: w == term))
    hits = F.transform(F.array_intersect("_q", "_t"), lambda term: F.struct(term.alias("term"), times(F.col("_t"), term).alias("tf"), times(F.col("_q"), term).alias("w")))
    rows = rows.select(*group, item, F.size("_t").alias("_dl"), hits.alias("_hits"))  # tokens go no further than here
    whole = Window.partitionBy(*group)
    rows = rows.withColumn("_n", F.sum((F.col("_dl") > 0).cast("int")).over(whole)).withColumn("_avg", F.sum("_dl").over(whole) / F.greatest("_n", F.lit(1)))
    met = rows.select(*group, item, "_n", "_avg", "_dl", F.inline("_hits")).withColumn("_df", F.count(F.lit(1)).over(Window.partitionBy(*group, "term")))
    one = part(F.col("w"), F.col("_n"), F.col("_df"), F.col("tf"), F.col("_dl"), F.col("_avg"), k1, b)
    scores = met.groupBy(*group, item).agg(F.round(F.sum(one), 6).alias("bm25"))
    return items.join(scores, [*group, item], "left").withColumn("bm25", F.coalesce("bm25", F.lit(0.0)))
