"""The engine's inputs derived from the standard tables: topics, corpus, gold, runs, windows, contexts, claims, slots."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from trovespark.frames import materialise, shared_dir
from trovespark.functions.text import sentences, word_count, words
from trovespark.operators import lexical
from trovespark.operators.ranking import by_score, cut


#: What a session has worked out and written for a folder of tables: the index, the gold judgements, the first-stage run
#: and its windows. Every query that starts from one of them reads the stored table.
_STORED: dict[tuple[str, str, str], object] = {}
_STORING = threading.RLock()


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def once(self, name: str, make: Callable[[], object]):
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        with _STORING:
            if key not in _STORED:
                _STORED[key] = make()
            return _STORED[key]

    def stored(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return self.once(name, lambda: materialise(make(), name))

    def scratch(self, suffix: str = "") -> str:
        """A path of its own in the shared folder."""
        return f"{shared_dir(self.spark)}/files-{uuid.uuid4().hex}{suffix}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def topics(self) -> DataFrame:
        return self.table("benchmark").select(F.col("item_id").cast("string").alias("qid"), F.col("text").alias("query"))

    def corpus(self) -> DataFrame:
        return self.table("documents").select(F.col("doc_id").cast("string").alias("docno"), F.split("text", "\n")[0].alias("title"), "text")

    def chunks(self) -> DataFrame:
        """Lines of documents that aren't blank, as chunks."""
        lines = self.corpus().select("docno", F.posexplode(F.split("text", "\n")).alias("line", "text")).where("trim(text) <> ''")
        return lines.select(F.concat("docno", F.lit("#"), F.lpad(F.col("line").cast("string"), 4, "0")).alias("docno"), "text")

    def gold(self) -> DataFrame:
        return self.stored("gold", self._gold)

    def _gold(self) -> DataFrame:
        """Documents that contain a topic's passage. Such a document has the passage's rarest inner word, so only pairs
        that share it are looked at."""
        docs = self.corpus().select("docno", "text")
        inner = self.topics().select("qid", "query", words(F.col("query")).alias("w"))
        inner = inner.select("qid", "query", F.explode(F.array_distinct(F.slice("w", 2, F.greatest(F.size("w") - 2, F.lit(1))))).alias("term"))
        tokens = docs.select("docno", F.explode(F.array_distinct(words(F.col("text")))).alias("term")).join(inner.select("term").distinct(), "term", "left_semi")
        rarity = tokens.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        rarest = Window.partitionBy("qid").orderBy("df", "term")
        key = inner.join(rarity, "term").withColumn("n", F.row_number().over(rarest)).where("n = 1").select("qid", "query", "term")
        pairs = key.join(tokens, "term").select("qid", "query", "docno").join(docs, "docno")
        return pairs.where(F.contains("text", F.col("query"))).select("qid", "docno")

    def index(self) -> lexical.Index:
        return self.once("index", lambda: lexical.Index.build(self.corpus()))

    def lexical_run(self, k: int = 100) -> DataFrame:
        return cut(self.stored("lexical-run", lambda: lexical.retrieve(self.index(), self.topics(), 200)), k)

    def _shared(self, docs: DataFrame, k: int) -> DataFrame:
        terms = lexical.query_terms(self.topics()).select("qid", "term")
        tokens = docs.select("docno", F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
        found = tokens.join(terms, "term").groupBy("qid", "docno").agg(F.count(F.lit(1)).cast("double").alias("score"))
        return cut(by_score(found), k).select("qid", "docno", "rank", "score")

    def shared_run(self, k: int = 100) -> DataFrame:
        """Documents by the number of different query words they have."""
        return cut(self.stored("shared-run", lambda: self._shared(self.corpus(), 100)), k)

    def chunk_run(self, k: int = 60) -> DataFrame:
        return cut(self.stored("chunk-run", lambda: self._shared(self.chunks(), 60)), k)

    def scores(self, run: DataFrame) -> DataFrame:
        """A stand-in for rerank scores: the share of the query's words; none for every seventh document."""
        rows = run.select("qid", "docno").join(self.topics(), "qid").join(self.corpus().select("docno", "text"), "docno")
        wanted = F.array_distinct(words(F.col("query")))
        share = F.round(F.size(F.array_intersect(wanted, words(F.col("text")))) / F.size(wanted), 6)
        return rows.select("qid", "docno", F.when(F.col("docno").cast("bigint") % 7 != 0, share).alias("score"))

    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(F.col("vec_id").cast("string").alias("docno"), F.col("embedding").alias("vector"), (F.col("vec_id") % 4).cast("int").alias("shard"))

    def query_vectors(self) -> DataFrame:
        return self.table("embeddings").where("vec_id % 100 = 0").select(F.col("vec_id").cast("string").alias("qid"), F.col("embedding").alias("vector"))

    def window_rows(self, stride: int = 1) -> DataFrame:
        return self.stored(f"windows-{stride}", lambda: self._window_rows(stride))

    def _window_rows(self, stride: int) -> DataFrame:
        """Sentence windows of the 20 best documents of each topic, scored by query words under two fields."""
        from trovespark.operators import windows

        docs = self.corpus().select("docno", F.lit("").alias("title"), sentences(F.col("text")).alias("sentences"))
        pairs = cut(self.lexical_run(20), 20).select("qid", "docno").join(self.topics(), "qid").join(docs, "docno")
        made = windows.build(pairs, 3, stride)
        wanted, own = F.array_distinct(words(F.col("query"))), words(F.col("window_text"))
        score = F.round(F.size(F.array_intersect(wanted, own)) / F.size(wanted), 6)
        return made.select("qid", "docno", "window_idx", "sent_start", "window_text", score.alias("ce_score"), F.lit("query_text").alias("query_field"))

    def two_fields(self) -> DataFrame:
        """Windows under two query fields; the second's scores are higher for every third window and equal otherwise."""
        rows = self.window_rows()
        other = rows.withColumn("ce_score", F.round(F.col("ce_score") + F.when(F.col("window_idx") % 3 == 0, 0.1).otherwise(0.0), 6)).withColumn("query_field", F.lit("query_alt"))
        return rows.unionByName(other)

    def turns(self) -> DataFrame:
        return self.table("conversations").select(F.col("conv_id").cast("string").alias("qid"), F.col("turn").cast("int").alias("turn"), "role", "text")

    def asked(self) -> DataFrame:
        """Each conversation's first user turn."""
        user = self.turns().where("role = 'user'")
        return user.groupBy("qid").agg(F.min_by("text", "turn").alias("query"))

    def contexts(self) -> DataFrame:
        """Assistant turns in order, their score the share of the question's words; none for every fifth turn."""
        rows = self.turns().where("role = 'assistant'").join(self.asked(), "qid")
        wanted = F.array_distinct(words(F.col("query")))
        share = F.round(F.size(F.array_intersect(wanted, words(F.col("text")))) / F.size(wanted), 6)
        place = F.row_number().over(Window.partitionBy("qid").orderBy("turn")) - 1
        id_ = F.concat("qid", F.lit("-"), F.col("turn").cast("string"))
        return rows.select("qid", place.alias("pos"), id_.alias("id"), F.concat(F.lit("d"), (F.col("turn") % 3).cast("string")).alias("doc_id"), "text", F.when(F.col("turn") % 5 != 0, share).alias("ce_score"))

    def cache(self) -> DataFrame:
        """A claim cache: the sentences of three words or more of each context."""
        found = F.filter(sentences(F.col("text")), lambda s: word_count(s) >= 3)
        return self.contexts().select("qid", F.col("id").alias("context_id"), "doc_id", F.col("pos").alias("rank"), "ce_score", found.alias("claims"))

    def slots(self) -> DataFrame:
        """Claim slots: a context's claims, named context:place."""
        rows = self.cache().select("qid", "context_id", "doc_id", F.posexplode("claims").alias("p", "text"))
        return rows.select("qid", F.concat("context_id", F.lit(":"), F.col("p").cast("string")).alias("id"), "doc_id", "text", F.lit(None).cast("array<string>").alias("member_ids"), F.lit(None).cast("array<string>").alias("member_doc_ids"))

    def evidence(self) -> DataFrame:
        """The first five slots by id are each answer's evidence."""
        order = F.row_number().over(Window.partitionBy("qid").orderBy("id"))
        return self.slots().select("qid", order.alias("pos"), "id").where(F.col("pos") <= 5)

    def answers(self) -> DataFrame:
        """The last assistant turn's sentences: qid, sent, text."""
        last = self.turns().where("role = 'assistant'").groupBy("qid").agg(F.max_by("text", "turn").alias("answer"))
        return last.select("qid", F.posexplode(sentences(F.col("answer"))).alias("sent", "text"))
