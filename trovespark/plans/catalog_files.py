"""Registered queries of sources and sinks: each writes a table as the files of a stage, reads them back, and must have the
table's rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from trovespark.operators import dense, evaluate, ranking, windows
from trovespark.operators import evidence as ev
from trovespark.plans.catalog import EVAL, big, evaluated, r9, records_of, register
from trovespark.plans.fixtures import Fixtures
from trovespark.sources import readers, sinks


def lines(df: DataFrame) -> DataFrame:
    """Rows as JSON lines."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


@register("read_queries", "SELECT qid query_id, trim(query) query_text, '7' || qid documents, 'kept ' || qid note FROM topics")
def _(f: Fixtures):
    path = f.scratch(".jsonl")
    rows = f.topics().select(F.concat(F.lit(" "), "qid").alias("query_id"), F.col("query").alias("query_text"), F.lit("  ").alias("query_type"), F.array(F.concat(F.lit("http://x/pubmed/7"), "qid")).alias("documents"), F.concat(F.lit("kept "), "qid").alias("note"))
    lines(rows).union(f.topics().select(F.lit("").alias("value"))).write.text(path)  # as many blank lines as queries
    return readers.queries(f.spark, path, ("note",)).select("query_id", "query_text", F.array_join("documents", ",").alias("documents"), "note")


@register("read_records", "SELECT qid, id, pos, ce_score, md5(text) h FROM ctx")
def _(f):
    path = f.scratch(".jsonl")
    sinks.jsonl(f.contexts(), path)
    rows = readers.records(f.spark, path, "qid string, id string, pos bigint, ce_score double, text string")
    return rows.select("qid", "id", "pos", "ce_score", F.md5("text").alias("h"))


@register("read_corpus", "SELECT docno, md5(text) h FROM corpus WHERE CAST(docno AS BIGINT) % 5 <> 0")
def _(f):
    folder, n = f.scratch(), F.col("docno").cast("bigint")
    rows = f.corpus().withColumn("docno", F.when(n % 5 == 0, " ").otherwise(F.concat(F.lit(" "), "docno")))  # every fifth has no id
    for shard in (0, 1):
        sinks.jsonl(rows.where(F.abs(F.xxhash64("text")) % 2 == shard), f"{folder}/shard-{shard}.jsonl")
    f.topics().select(F.concat(F.lit("{broken "), "qid").alias("value")).write.text(f"{folder}/shard-2.jsonl")
    return readers.corpus(f.spark, f"{folder}/shard-*.jsonl", strict=False).select("docno", F.md5("text").alias("h"))


@register("read_run_tsv", "SELECT qid, docno, rank, score FROM lex")
def _(f):
    path = f.scratch()
    sinks.run_tsv(f.lexical_run().withColumn("method", F.lit("bm25")), path, by=("method",))
    return readers.run_file(f.spark, f"{path}/method=bm25").select("qid", "docno", *big("rank"), "score")


@register("read_run_by_aliases", "SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docno) rank FROM lex")
def _(f):
    path = f.scratch()
    rows = f.lexical_run().select(F.col("qid").alias("query_id"), F.concat(F.lit("https://host/pubmed/"), "docno").alias("docid"), "score")
    rows.write.csv(path, sep="\t", header=True)
    return readers.run_file(f.spark, path).select("qid", "docno", *big("rank"))


@register("read_run_in_file_order", "SELECT qid, docno, rank FROM shared")
def _(f):
    path = f.scratch()
    f.shared_run().orderBy("qid", "rank").select("qid", "docno").write.csv(path, sep="\t", header=True)
    return readers.run_file(f.spark, path).select("qid", "docno", *big("rank"))


@register("read_run_parquet", "SELECT qid, docno, rank FROM lex")
def _(f):
    path = f.scratch(".parquet")
    f.lexical_run().select("qid", "docno", "rank").write.parquet(path)
    return readers.run_file(f.spark, path).select("qid", "docno", *big("rank"))


@register("read_run_bad_ranks", "SELECT qid, docno, CASE WHEN rank % 3 = 0 THEN 0 ELSE rank END rank FROM lex")
def _(f):
    path = f.scratch()
    rank = F.when(F.col("rank") % 3 == 0, "none").otherwise(F.col("rank").cast("string"))
    f.lexical_run().select("qid", "docno", rank.alias("rank"), "score").write.csv(path, sep="\t", header=True)
    return readers.run_file(f.spark, path).select("qid", "docno", *big("rank"))


@register("read_positional_run", "SELECT qid, docno, rank FROM lex WHERE rank % 3 <> 0")
def _(f):
    path = f.scratch()
    rank = F.when(F.col("rank") % 3 == 0, "none").otherwise(F.col("rank").cast("string"))
    f.lexical_run().select(F.col("qid").alias("a"), F.col("docno").alias("b"), rank.alias("c"), "score").write.csv(path, sep="\t", header=True)
    return readers.positional_run(f.spark, path).select("qid", "docno", *big("rank"))


@register("dense_run_sink", "SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY rank, docno) rank FROM (SELECT qid, docno, min(rank) rank FROM (SELECT qid, docno, rank FROM lex UNION ALL SELECT qid, docno, rank + 3 FROM lex WHERE rank <= 10) GROUP BY qid, docno)")
def _(f):
    path, run = f.scratch(), f.lexical_run()
    sinks.dense_run(run.unionByName(run.where("rank <= 10").withColumn("rank", F.col("rank") + 3)), path)
    return readers.run_file(f.spark, path).select("qid", "docno", *big("rank"))


@register("fused_run_sink", "SELECT qid, docno, rank, CAST(NULL AS DOUBLE) score FROM lex")
def _(f):
    path = f.scratch()
    sinks.fused_run(f.lexical_run(), path)
    return readers.run_file(f.spark, path).select("qid", "docno", *big("rank"), "score")


@register("listwise_run_sink", "SELECT qid, docno, rank FROM lex WHERE rank <= 15")
def _(f):
    path = f.scratch()
    sinks.run_tsv(f.lexical_run(15).drop("score"), path)
    return f.spark.read.csv(path, sep="\t", header=True, schema="qid string, docno string, rank bigint")


@register("read_windows", "SELECT qid, docno, window_idx, window_idx sent_start, ce_score, query_field, md5(window_text) h FROM fields")
def _(f):
    path = f.scratch(".jsonl")
    sinks.jsonl(f.two_fields().drop("sent_start"), path)  # a start that isn't written is the window's number
    return readers.windows(f.spark, path).select("qid", "docno", "window_idx", "sent_start", "ce_score", "query_field", F.md5("window_text").alias("h"))


@register("best_window_texts", "SELECT qid, docno, md5(window_text) h FROM (SELECT *, row_number() OVER (PARTITION BY qid, docno ORDER BY ce_score DESC, window_idx) n FROM winscore) WHERE n = 1")
def _(f):
    path = f.scratch(".jsonl")
    sinks.jsonl(f.window_rows(), path)
    return windows.best_text(readers.windows(f.spark, path)).select("qid", "docno", F.md5("text").alias("h"))


@register("read_row_ids", "SELECT CAST(row_number() OVER (ORDER BY docno) - 1 AS BIGINT) rowid, docno FROM corpus")
def _(f):
    path = f.scratch()
    ids = f.corpus().select((F.row_number().over(Window.orderBy("docno")) - 1).cast("bigint").alias("rowid"), "docno")
    sinks.row_map(ids, path)
    return dense.check_rowids(readers.row_ids(f.spark, path))


@register("read_claim_cache", "SELECT qid, context_id, doc_id, rank, ce_score, len(claims) n FROM claimrows")
def _(f):
    path = f.scratch(".jsonl")
    rows = f.cache().withColumn("rank", F.col("rank").cast("int")).withColumn("key", F.md5("context_id")).withColumn("n_claims", F.size("claims"))
    again = rows.where("rank = 0").withColumn("key", F.lit(""))  # repeated contexts: the larger key counts
    sinks.jsonl(rows.unionByName(again), path)
    return readers.claim_cache(f.spark, path).select("qid", "context_id", "doc_id", *big("rank"), "ce_score", F.size("claims").cast("bigint").alias("n"))


@register("read_evidence_queries", "SELECT qid query_id, query query_text, coalesce(d, '') doc_ids FROM topics LEFT JOIN (SELECT qid, string_agg(docno, ',' ORDER BY rank) d FROM lex WHERE rank <= 5 GROUP BY qid) USING (qid)")
def _(f):
    path = f.scratch(".jsonl")
    sinks.jsonl(records_of(f), path)
    rows = readers.records(f.spark, path, "query_id string, query_text string, doc_ids array<string>")
    return rows.select("query_id", "query_text", F.array_join("doc_ids", ",").alias("doc_ids"))


@register("slim_answers_sink", "SELECT qid query_id, count(*) n FROM ctx GROUP BY qid")
def _(f):
    path = f.scratch(".jsonl")
    rows = ev.collected(f.contexts().select("qid", "pos", "id", "text", F.array(F.struct(F.lit(1).alias("window_idx"), F.lit(0.5).alias("ce_score"))).alias("selected_windows"), F.array(F.lit("r")).alias("rejected_windows")), "snippets")
    sinks.jsonl(sinks.slim_answers(rows.withColumn("doc_snippet_windows", F.lit("x"))), path)
    back = f.spark.read.json(path)
    wrong = F.lit("doc_snippet_windows" in back.columns or "rejected_windows" in json.dumps(back.schema.jsonValue()))
    return back.select("query_id", F.size("contexts").cast("bigint").alias("n")).where(~wrong)


@register("window_stats_sink", "SELECT count(*) doc_pairs FROM lex WHERE rank <= 20")
def _(f):
    path = f.scratch()
    windows.stats(f.lexical_run(20), windows.choose(windows.max_pool(f.two_fields()))).write.json(path)
    return f.spark.read.json(path).select("doc_pairs")


@register("metrics_sink", f"SELECT qid, {', '.join(f'round({m}, 9) {m}' for m in ('ap', 'rr', 'recall', 'r_50'))} FROM evalq", **EVAL)
def _(f):
    path = f.scratch()
    sinks.metrics_csv(evaluated(f), path)
    back = f.spark.read.csv(path, header=True, schema=evaluated(f).schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))
    return back.select("qid", *(r9(m, m) for m in ("ap", "rr", "recall", "r_50")))


MISSED = EVAL | {"missed": "SELECT DISTINCT qid FROM gold WHERE qid NOT IN (SELECT qid FROM jrun WHERE rel = 1 AND rank > 2 AND rank <= 10)"}


@register("zero_recall_sink", "SELECT qid FROM missed", **MISSED)
def _(f):
    path = f.scratch()
    late = f.lexical_run().where("rank > 2")  # without the first two documents many queries miss their gold
    sinks.zero_recall_txt(evaluate.zero_recall(ranking.ranked(late, F.asc("rank")), f.gold(), 8), path)
    return f.spark.read.text(path).select(F.col("value").alias("qid"))


@register("recall_sources", "SELECT 'per_query' kind, 1 n UNION ALL SELECT 'runs', 2")
def _(f):
    a, b = f.scratch(), f.scratch()
    for folder in (a, b):
        for name in ("x", "y"):
            sinks.run_tsv(f.lexical_run(5), f"{folder}/runs/{name}.tsv")
    sinks.metrics_csv(f.topics(), f"{a}/per_query/x.csv")
    found = [readers.recall_sources(f.spark, folder) for folder in (a, b)]
    return f.spark.createDataFrame([(kind, len(paths)) for kind, paths in found], "kind string, n int")


FROM_RUNS = EVAL | {"given": "SELECT qid FROM evalq WHERE n_gold > 0"}


@register("metrics_of_runs", "SELECT 'lex' run, 'base' AS label, count(*) n_queries, round(avg(ap), 9) map, round(avg(r_50), 9) mean_r_50 FROM evalq WHERE n_gold > 0", **EVAL)
def _(f):
    folder = f.scratch()
    sinks.run_tsv(f.lexical_run(), f"{folder}/runs/lex.tsv")
    return readers.metrics_of_folder(f.spark, folder, f.gold(), "base").select("run", "label", "n_queries", r9("map", "map"), r9("mean_r_50", "mean_r_50"))


@register("metrics_of_table", "SELECT 'given' AS label, round(avg(ap), 9) map FROM evalq", **EVAL)
def _(f):
    folder = f.scratch()
    sinks.metrics_csv(evaluate.summary(evaluated(f)), f"{folder}/metrics.csv")
    return readers.metrics_of_folder(f.spark, folder, f.gold(), "given").select("label", r9("map", "map"))


@register("skip_if_done", "SELECT qid, count(*) n FROM lex GROUP BY qid")
def _(f):
    path, log = f.scratch(), []
    counts = lambda: f.lexical_run().groupBy("qid").agg(F.count(F.lit(1)).alias("n"))
    sinks.once(f.spark, path, counts, log)
    return sinks.once(f.spark, path, lambda: counts().where("1 = 0"), log)  # the second time nothing is made


@register("run_log", "SELECT 'made' done, 1 n UNION ALL SELECT 'kept', 1")
def _(f):
    path, table, log, seconds = f.scratch(), f.scratch(), [], []
    for _ in range(2):
        sinks.once(f.spark, table, f.topics, log, seconds)
    sinks.log_lines(f.spark, log, seconds, path)
    back = f.spark.read.csv(path, sep="\t", header=True, schema="path string, done string, seconds double")
    return back.where("seconds >= 0").groupBy("done").agg(F.count(F.lit(1)).cast("int").alias("n"))


@register("resume_scored", "SELECT qid, docno, rank FROM lex WHERE CAST(qid AS BIGINT) % 2 = 0 UNION ALL SELECT qid, docno, rank FROM shared WHERE CAST(qid AS BIGINT) % 2 = 1")
def _(f):
    folder, out = f.scratch(), None
    for split, run in enumerate((f.lexical_run(), f.shared_run())):
        own = run.where(F.col("qid").cast("bigint") % 2 == split).select("qid", "docno", "rank")
        path = f"{folder}/split-{split}"
        if split == 0:
            own.write.parquet(path)  # scored in an earlier session
        part = sinks.once(f.spark, path, lambda rows=own: rows if split else rows.where("1 = 0"))
        out = part if out is None else out.unionByName(part)
    return out.select("qid", "docno", *big("rank"))


@register("dense_index", "SELECT qid, docno, rank, score FROM dense WHERE rank <= 10")
def _(f):
    path = f.scratch()
    dense.write_index(f.vectors().select("docno", "vector"), path, shards=4, space="cosine", breadth=50)
    return dense.search_index(f.spark, path, f.query_vectors(), 10, 20, 40).select("qid", "docno", *big("rank"), "score")


@register("dense_index_shards", "SELECT count(*) n, max(len(v)) dim, 4 shards, 4 n_shards FROM vecs")
def _(f):
    path = f.scratch()
    dense.write_index(f.vectors().select("docno", "vector"), path, shards=4)
    vectors, about = dense.read_index(f.spark, path)
    own = dense.read_index(f.spark, path, shard=1)[0].select("shard").distinct().count()
    return vectors.agg(F.count(F.lit(1)).alias("n"), F.lit(about["dim"]).cast("bigint").alias("dim"), F.lit(about["shards"] * own).cast("int").alias("shards"), F.countDistinct("shard").cast("int").alias("n_shards"))


@register("embedding_cache", "SELECT id, length(text) v FROM ctx")
def _(f):
    path, encode = f.scratch(), lambda t: F.array(F.length(t).cast("double"))
    dense.embedded(f.spark, path, f.contexts().select("id", "text").where("pos = 0"), encode).count()
    told = dense.embedded(f.spark, path, f.contexts().select("id", "text"), encode)
    return told.select("id", F.col("vector")[0].cast("bigint").alias("v"))
