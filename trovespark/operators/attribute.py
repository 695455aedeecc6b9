"""Sentence citations: which documents each sentence of an answer rests on.

Slots have qid, id, doc_id, text, and for facets member_ids and member_doc_ids. Evidence has qid, pos, id: the slots
that an answer names. Sentences have qid, sent, text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from trovespark.functions.text import content_words

# What each kind of context is attributed by.
ROUTES = {"claim": "lineage", "claim_facet_summary": "descent"}


def route(mode: Column) -> Column:
    """The attribution of a context mode; other modes have no slots and are an error."""
    wrong = F.raise_error(F.concat(F.lit("contexts without claim or facet slots: "), F.coalesce(mode, F.lit("none"))))
    out = F.when(mode == "claim", ROUTES["claim"]).when(mode == "claim_facet_summary", ROUTES["claim_facet_summary"])
    return out.otherwise(wrong.cast("string"))


def recall(sentence: Column, target: Column) -> tuple[Column, Column]:
    """How much of a target's content words a sentence has: share and number; 0 of 0 for an empty target."""
    both = F.size(F.array_intersect(sentence, target))
    return F.when(F.size(target) > 0, both / F.size(target)).otherwise(F.lit(0.0)), F.when(F.size(target) > 0, both).otherwise(0)


def _cited(rows: DataFrame, most: int) -> DataFrame:
    """qid, sent, cite (from 1), doc_id: each document at its first place in order `o`, at most `most` if positive."""
    one = rows.groupBy("qid", "sent", "doc_id").agg(F.min("o").alias("o"))
    out = one.withColumn("cite", F.row_number().over(Window.partitionBy("qid", "sent").orderBy("o"))).drop("o")
    return (out.where(F.col("cite") <= most) if most else out).select("qid", "sent", "cite", "doc_id")


def references(evidence: DataFrame, slots: DataFrame) -> DataFrame:
    """qid, pos, doc_id: every document behind the evidence, facets with all their members, first places only."""
    docs = F.coalesce("member_doc_ids", F.array("doc_id"))
    rows = evidence.join(slots.select("qid", "id", docs.alias("docs")), ["qid", "id"]).select("qid", "pos", F.posexplode("docs").alias("i", "doc_id"))
    one = rows.groupBy("qid", "doc_id").agg(F.min(F.struct("pos", "i")).alias("o"))
    return one.select("qid", F.row_number().over(Window.partitionBy("qid").orderBy("o")).alias("pos"), "doc_id")


def trivial(sentences: DataFrame, evidence: DataFrame, slots: DataFrame) -> DataFrame:
    """Every sentence cites every document behind the evidence."""
    return sentences.select("qid", "sent").join(references(evidence, slots), "qid").select("qid", "sent", F.col("pos").alias("cite"), "doc_id")


def unresolved(evidence: DataFrame, slots: DataFrame) -> DataFrame:
    return evidence.join(slots.select("qid", "id"), ["qid", "id"], "left_anti")


def lineage(sentences: DataFrame, evidence: DataFrame, slots: DataFrame, least: float = 0.5, overlap: int = 2, most: int = 0, rerank: str = "lex", cosine=None, k: int = 60, alpha: float = 0.6) -> DataFrame:
    """Each sentence cites the documents whose evidence slots it restates.

    A document scores by its best slot (share, then number). lex: documents past both gates by falling score, else the
    best one. rrf and blend: exactly the `most` (or 1) best by fused order of score and cosine, or by a weighted sum.
    """
    texts = evidence.join(slots.select("qid", "id", "doc_id", F.coalesce("text", F.lit("")).alias("slot")), ["qid", "id"])
    texts = texts.withColumn("_first", F.min("pos").over(Window.partitionBy("qid", "doc_id")))
    pairs = sentences.select("qid", "sent", F.col("text").alias("sentence")).join(texts, "qid")
    share, number = recall(content_words(F.col("sentence")), content_words(F.col("slot")))
    near = cosine(F.col("sentence"), F.col("slot")) if cosine else F.lit(-1.0)
    best = pairs.groupBy("qid", "sent", "doc_id", "_first").agg(F.max(F.struct(share.alias("share"), number.cast("int").alias("number"))).alias("s"), F.max(near).alias("near"))
    own = Window.partitionBy("qid", "sent")
    down = F.struct(-F.col("s.share"), -F.col("s.number"), F.col("_first"))
    if rerank == "lex":
        passes = (F.col("s.share") >= least) & (F.col("s.number") >= overlap)
        rows = best.withColumn("_ok", passes).withColumn("_any", F.max("_ok").over(own)).withColumn("_top", F.row_number().over(own.orderBy(down)))
        return _cited(rows.where(F.col("_ok") | (~F.col("_any") & (F.col("_top") == 1))).withColumn("o", down), most)
    if rerank == "rrf":
        a = F.row_number().over(own.orderBy(down)) - 1
        b = F.row_number().over(own.orderBy(F.desc("near"), "_first")) - 1
        best = best.withColumn("_a", a).withColumn("_b", b)
        key = F.struct(-(1.0 / (k + F.col("_a")) + 1.0 / (k + F.col("_b"))), F.col("_first"))
    else:
        key = F.struct(-((1 - alpha) * F.col("s.share") + alpha * F.col("near")), F.col("_first"))
    return _cited(best.withColumn("o", key), most or 1)


def descent(sentences: DataFrame, evidence: DataFrame, slots: DataFrame, members: DataFrame, least: float = 0.5, overlap: int = 2, most: int = 0, fallback: str = "argmax", compat: bool = True, rerank: str = "lex", cosine=None, k: int = 60, alpha: float = 0.6) -> DataFrame:
    """Facets, then members: a sentence's facets are those past both gates by their text, else the best one; in each, it
    cites the member documents whose claims pass the gates, else by `fallback` the best member, all or none.

    With `rerank` rrf or blend the best facet is that of a fused order of score and cosine, or of a weighted sum, and the
    members of all its facets together give exactly the `most` (or 1) best documents by score.

    `members` is a claim cache (qid, context_id, claims). `compat` pairs a facet's member ids with its sorted documents
    place by place, as records made so expect; a member without claims is measured by the facet's text.
    """
    ids, docs = F.coalesce("member_ids", F.array("id")), F.coalesce("member_doc_ids", F.array("doc_id"))
    pairs = F.filter(F.arrays_zip(ids.alias("m"), docs.alias("d")), lambda p: p["m"].isNotNull() & p["d"].isNotNull()) if compat else F.transform(ids, lambda m: F.struct(m.alias("m"), F.col("doc_id").alias("d")))
    facets = evidence.join(slots.select("qid", "id", F.coalesce("text", F.lit("")).alias("facet"), pairs.alias("pairs")), ["qid", "id"])
    told = sentences.select("qid", "sent", F.col("text").alias("sentence"), content_words(F.col("text")).alias("_s")).join(facets, "qid")
    share, number = recall(F.col("_s"), content_words(F.col("facet")))
    own = Window.partitionBy("qid", "sent")
    told = told.withColumn("_share", share).withColumn("_number", number).withColumn("_ok", (F.col("_share") >= least) & (F.col("_number") >= overlap))
    by_score = own.orderBy(F.desc("_share"), F.desc("_number"), "pos")
    if rerank == "lex":
        told = told.withColumn("_top", F.row_number().over(by_score))
    else:
        told = told.withColumn("_near", cosine(F.col("sentence"), F.col("facet")) if cosine else F.lit(-1.0))
        if rerank == "rrf":
            told = told.withColumn("_a", F.row_number().over(by_score) - 1).withColumn("_b", F.row_number().over(own.orderBy(F.desc_nulls_last("_near"), "pos")) - 1)
            fused = 1.0 / (k + F.col("_a")) + 1.0 / (k + F.col("_b"))
        else:
            fused = (1 - alpha) * F.col("_share") + alpha * F.col("_near")
        told = told.withColumn("_fused", fused).withColumn("_top", F.row_number().over(own.orderBy(F.desc_nulls_last("_fused"), "pos")))
    told = told.withColumn("_any", F.max("_ok").over(own)).where(F.col("_ok") | (~F.col("_any") & (F.col("_top") == 1)))
    rows = told.select("qid", "sent", "pos", "facet", "_s", F.posexplode("pairs").alias("i", "p")).select("*", F.col("p.m").alias("context_id"), F.col("p.d").alias("doc_id"))
    rows = rows.join(members.select("qid", "context_id", "claims"), ["qid", "context_id"], "left")
    texts = F.when(F.size("claims") > 0, F.col("claims")).otherwise(F.array("facet"))

    def scored(claim: Column) -> Column:
        a, b = recall(F.col("_s"), content_words(claim))
        return F.struct(a.alias("share"), b.cast("int").alias("number"))

    rows = rows.withColumn("b", F.array_max(F.transform(texts, scored)))
    down = F.struct(-F.col("b.share"), -F.col("b.number"), "pos", "i")
    if rerank != "lex":
        return _cited(rows.withColumn("o", down), most or 1)
    rows = rows.withColumn("_hit", (F.col("b.share") >= least) & (F.col("b.number") >= overlap))
    facet = Window.partitionBy("qid", "sent", "pos")
    rows = rows.withColumn("_any", F.max("_hit").over(facet)).withColumn("_top", F.row_number().over(facet.orderBy(F.desc("b.share"), F.desc("b.number"), "i")))
    floor = {"argmax": F.col("_top") == 1, "all": F.lit(True), "none": F.lit(False)}[fallback]
    rows = rows.where(F.col("_hit") | (~F.col("_any") & floor))
    return _cited(rows.withColumn("o", down), most)


def attributed(sentences: DataFrame, citations: DataFrame) -> DataFrame:
    """One row an answer: its sentences in order with their documents in order."""
    docs = F.transform(F.array_sort(F.collect_list(F.struct("cite", "doc_id"))), lambda c: c["doc_id"])
    per = citations.groupBy("qid", "sent").agg(docs.alias("doc_ids"))
    rows = sentences.join(per, ["qid", "sent"], "left").withColumn("doc_ids", F.coalesce("doc_ids", F.array().cast("array<string>")))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("sent", "text", "doc_ids"))), lambda s: s.dropFields("sent"))
    return rows.groupBy("qid").agg(listed.alias("answer_sentences"))


def with_citations(answers: DataFrame, sentences: DataFrame, citations: DataFrame) -> DataFrame:
    """Answers (qid, ideal_answer, …) with their cited sentences; a blank answer passes through with none."""
    cited = attributed(sentences, citations)
    kind = cited.schema["answer_sentences"].dataType.simpleString()
    rows = answers.join(cited, "qid", "left")
    has = F.trim(F.coalesce("ideal_answer", F.lit(""))) != ""
    return rows.withColumn("answer_sentences", F.coalesce(F.when(has, F.col("answer_sentences")), F.array().cast(kind)))
