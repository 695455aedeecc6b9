"""Registered queries of column rules, settings and small operators that no larger query shows by itself."""

from __future__ import annotations

import urllib.error

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from trovespark.functions import ids, text
from trovespark.operators import attribute, dense, distil, evaluate, evidence, fusion, generate, rerank, windows
from trovespark.plans import config
from trovespark.plans.catalog import CT, EVAL, LIN, big, overlap, r9, register
from trovespark.plans.fixtures import Fixtures
from trovespark.sources import readers

def even() -> Column:
    return F.col("qid").cast("bigint") % 2 == 0


def none_of() -> Column:
    return F.array().cast("array<string>")


@register("ranked_ids", "SELECT qid, CASE WHEN CAST(qid AS BIGINT) % 3 = 0 THEN qid || ',b' WHEN CAST(qid AS BIGINT) % 3 = 1 THEN 'n' || qid ELSE '5' || qid END ids, CASE WHEN CAST(qid AS BIGINT) % 3 = 0 THEN qid WHEN CAST(qid AS BIGINT) % 3 = 1 THEN 'n' || qid ELSE '5' || qid END first FROM topics")
def _(f: Fixtures):
    n = F.col("qid").cast("bigint") % 3
    given = F.when(n == 0, F.array("qid", F.lit("b"))).otherwise(none_of())
    docnos = F.when(n == 1, F.array(F.concat(F.lit("n"), "qid")))
    links = F.array(F.concat(F.lit("http://h/pubmed/5"), "qid"), F.lit("http://h/no-number"))
    found = ids.ranked_ids(given, docnos, links)
    return f.topics().select("qid", F.array_join(found, ",").alias("ids"), ids.first_ids(found, 1)[0].alias("first"))


@register("topics_by_field", "SELECT qid, trim(query) query FROM topics WHERE CAST(qid AS BIGINT) % 2 = 0")
def _(f):
    rows = f.topics().select(F.col("qid").alias("query_id"), F.when(even(), F.col("query")).otherwise(F.lit("  ")).alias("body"))
    return readers.topics(rows, "body", skip_empty=True)


@register("query_ids", "SELECT CASE WHEN CAST(qid AS BIGINT) % 2 = 0 THEN qid ELSE 'row' || qid END query_id, query FROM topics")
def _(f):
    rows = f.topics().select(F.when(even(), F.concat(F.lit(" "), "qid")).otherwise(F.lit(" ")).alias("query_id"), F.concat(F.lit("row"), "qid").alias("idx"), "query")
    return readers.indexed_queries(rows).select("query_id", "query")


@register("dense_texts", "SELECT docno, md5(CASE WHEN trim(title) <> '' THEN trim(title) || chr(10) || chr(10) ELSE '' END || 'body ' || docno || chr(10) || chr(10) || 'MeSH: Term A; plain ' || docno) h FROM corpus")
def _(f):
    mesh = F.concat(F.lit("D01:Term A; ;plain "), "docno")
    title = F.when(F.trim("title") != "", F.trim("title"))
    return f.corpus().select("docno", F.md5(text.dense_text(title, F.concat(F.lit(" body "), "docno"), mesh)).alias("h"))


@register("docnos", "SELECT docno, docno kept FROM corpus WHERE CAST(docno AS BIGINT) % 4 <> 0 UNION ALL SELECT docno, NULL FROM corpus WHERE CAST(docno AS BIGINT) % 4 = 0")
def _(f):
    given = F.when(F.col("docno").cast("bigint") % 4 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "docno", F.lit("\t")))
    return f.corpus().select("docno", ids.blank_to_null(given).alias("kept"))


@register("rerank_texts", "SELECT docno, md5(concat_ws(' ', nullif(trim(title), ''), 'x')) h FROM corpus")
def _(f):
    return f.corpus().select("docno", F.md5(text.rerank_text(F.trim("title"), F.lit("x"))).alias("h"))


@register("seed_swap", "SELECT qid, 'x ' || qid query, 'Which is x ' || qid || ' ?' AS query_raw FROM topics")
def _(f):
    return text.with_seed(f.topics().select("qid", F.concat(F.lit("Which is x "), "qid", F.lit(" ?")).alias("query"))).select("qid", "query", "query_raw")


@register("run_names", "SELECT qid, 's' || qid split, 'a_s' || qid stem, CASE WHEN CAST(qid AS BIGINT) % 2 = 0 THEN 'train' ELSE 'test' END role, 's' || qid AS label, 'x_y_' || qid AS file FROM topics")
def _(f):
    name = F.concat(F.lit("stage1_s"), "qid", F.lit("_top50"))
    role = ids.role_of(F.when(even(), "run_tr1").otherwise("run_te1"), ["tr1"], ["te1"])
    stem = ids.rerank_name(F.concat(F.lit("a_s"), "qid", F.lit("_rrf_pool15_k60")))
    return f.topics().select("qid", ids.split_of_run(name).alias("split"), stem.alias("stem"), role.alias("role"), ids.short_label(name).alias("label"), ids.safe_name(F.concat(F.lit("x y/"), "qid")).alias("file"))


@register("candidate_limits", "SELECT a.x \"limit\", b.x cap, least(least(greatest(least(a.x, b.x), 30), 2000), 500) AS n FROM (SELECT unnest([10, 100, 5000]) x) a, (SELECT unnest([20, 700, 9000]) x) b")
def _(f):
    rows = [(a, b, config.candidate_limit(a, b, 500)) for a in (10, 100, 5000) for b in (20, 700, 9000)]
    return f.spark.createDataFrame(rows, "limit int, cap int, n int")


SETTINGS = """
# a comment
BASE=/data
export OUT="${BASE}/out"   # trailing
RAW='$BASE'
LIST=1,2, 3
MISSING=$NOWHERE
"""


@register("settings", "SELECT * FROM (VALUES ('BASE', '/data'), ('OUT', '/data/out'), ('RAW', '$BASE'), ('LIST', '1,2, 3'), ('MISSING', ''), ('list', '6'), ('think', 'True'), ('level', 'high'), ('first', '/data'), ('endpoint', 'http://h/v1/chat/completions'), ('weights', '0.5+0.5'), ('pairs', '4.0')) t(name, setting)")
def _(f):
    found = config.parse(SETTINGS.replace("   # trailing", ""))
    out = dict(found) | {
        "list": str(sum(config.numbers(found["LIST"]))), "think": str(config.thinking("on")), "level": str(config.thinking(" High ")), "first": config.first_set(None, "", found["BASE"]),
        "endpoint": config.endpoint("http://h/v1/chat/completions/", "v1/chat/completions"), "weights": "+".join(map(str, fusion.weight_list("0.5,0.5", 2))), "pairs": str(sum(map(sum, fusion.weight_pairs("1,1;2,0")))),
    }
    return f.spark.createDataFrame(list(out.items()), "name string, setting string")


@register("gold_files", "SELECT * FROM (VALUES ('named', 'a'), ('test_7', 'b'), ('run_dev', 'c'), ('other', 'd')) t(run, file)")
def _(f):
    rows = [(r, config.ground_truth(r, {"named": "a"}, {"test_*": "b"}, {"dev": "c"}, "d")) for r in ("named", "test_7", "run_dev", "other")]
    return f.spark.createDataFrame(rows, "run string, file string")


@register("search_breadths", "SELECT r.x asked, k.x k, CAST(least(greatest(coalesce(nullif(r.x, 0), 64), k.x), 300) AS INTEGER) breadth FROM (SELECT unnest([0, 50, 500]) x) r, (SELECT unnest([10, 100, 400]) x) k")
def _(f):
    rows = [(r, k, dense.breadth(r or None, 64, k, 300)) for r in (0, 50, 500) for k in (10, 100, 400)]
    return f.spark.createDataFrame(rows, "asked int, k int, breadth int")


@register("retry_rules", "SELECT code, code IN (429, 502, 503, 504) retried FROM (SELECT unnest([400, 401, 404, 429, 500, 502, 503, 504]) code)")
def _(f):
    codes = (400, 401, 404, 429, 500, 502, 503, 504)
    return f.spark.createDataFrame([(c, generate.worth_retrying(urllib.error.HTTPError("u", c, "m", None, None))) for c in codes], "code int, retried boolean")


@register("best_window_scores", "SELECT qid, docno, max(ce_score) best FROM fields GROUP BY qid, docno")
def _(f):
    rows = f.two_fields().groupBy("qid", "docno").agg(F.collect_list(F.struct("window_idx", "ce_score")).alias("w"))
    return rows.select("qid", "docno", distil.best_window(F.col("w")).alias("best"))


@register("slot_words", "SELECT id, len(regexp_extract_all(lower(text), '[a-z0-9]+')) n, md5(array_to_string(regexp_extract_all(lower(text), '[a-z0-9]+'), ' ')) h FROM slots")
def _(f):
    return f.slots().select("id", F.size(text.slot_words(F.col("text"))).cast("bigint").alias("n"), F.md5(F.array_join(text.slot_words(F.col("text")), " ")).alias("h"))


@register("run_in_row_order", "SELECT qid, docno, rank FROM shared")
def _(f):
    place = F.row_number().over(Window.partitionBy("qid").orderBy("rank"))
    rows = f.shared_run().select("qid", "docno", (-place).alias("rank"), F.lit(0.0).alias("score"))
    return fusion.positioned(rows.withColumn("rank", -F.col("rank"))).select("qid", "docno", *big("rank"))


@register("map_without_collapse", "SELECT 10 k, round(avg(ap), 9) map FROM evalq WHERE n_gold > 0 AND qid IN (SELECT qid FROM lex)", **EVAL)
def _(f):
    return evaluate.map_curve(f.lexical_run(), f.gold(), (10,), collapse=False).select("k", r9("map", "map"))


@register("recall_of_run", "SELECT qid, n_gold, round(r_50, 9) r_50 FROM evalq WHERE n_gold > 0 AND qid IN (SELECT qid FROM lex)", **EVAL)
def _(f):
    return evaluate.per_query(f.lexical_run(), f.gold(), f.topics(), collapse=False, scope="nonempty").select("qid", *big("n_gold"), r9("r_50", "r_50"))


@register("rerank_skips_empty", "SELECT DISTINCT qid FROM lex WHERE CAST(qid AS BIGINT) % 2 = 0")
def _(f):
    topics = f.topics().select("qid", F.when(even(), F.col("query")).otherwise(F.lit(" ")).alias("query"))
    return rerank.rerank(f.lexical_run(), topics, f.corpus()).select("qid").distinct()


@register("pairs_in_batches", "SELECT qid, docno, CAST(length(query) + length(text) AS DOUBLE) score FROM lex JOIN topics USING (qid) JOIN corpus USING (docno) WHERE rank <= 20")
def _(f):
    scorer = rerank.arrow_scorer(lambda: lambda queries, texts: [len(q) + len(t) for q, t in zip(queries, texts)])
    rows = f.lexical_run(20).join(f.topics(), "qid").join(f.corpus(), "docno")
    return rows.select("qid", "docno", scorer(F.col("query"), F.col("text")).alias("score"))


@register("pair_scores_by_model", "SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY length(text) DESC, rank, docno) rank FROM lex JOIN corpus USING (docno)")
def _(f):
    scorer = rerank.arrow_scorer(lambda: lambda queries, texts: [float(len(t)) for t in texts])
    return rerank.rerank(f.lexical_run(), f.topics(), f.corpus(), scorer).select("qid", "docno", *big("rank"))


@register("window_scores", f"SELECT qid, docno, window_idx, round(CASE WHEN CAST(qid AS BIGINT) % 2 = 0 THEN {overlap('query', 'window_text')} ELSE 0.0 END, 9) s FROM wins")
def _(f):
    topics = f.topics().select("qid", F.when(even(), F.col("query")).otherwise(F.lit("")).alias("query"))
    return windows.scored(f.window_rows().join(topics, "qid")).select("qid", "docno", "window_idx", r9("ce_score", "s"))


@register("vector_cosines", "SELECT q.qid, v.docno, round(list_cosine_similarity(q.q, v.v), 6) s FROM qvecs q JOIN vecs v ON CAST(v.docno AS BIGINT) = CAST(q.qid AS BIGINT) + 1 UNION ALL SELECT qid, 'none', -1.0 FROM qvecs")
def _(f):
    asked = f.query_vectors()
    near = asked.join(f.vectors().select("docno", F.col("vector").alias("v")), F.col("docno").cast("bigint") == F.col("qid").cast("bigint") + 1)
    none = asked.select("qid", F.lit("none").alias("docno"), "vector", F.transform("vector", lambda x: x * 0).alias("v"))
    return near.select("qid", "docno", "vector", "v").unionByName(none).select("qid", "docno", F.round(dense.cosine(F.col("vector"), F.col("v")), 6).alias("s"))


@register("legacy_windows", "SELECT qid, docno, window_idx, row_number() OVER (PARTITION BY qid, docno ORDER BY ce_score DESC, window_idx) place FROM winscore")
def _(f):
    flat = f.window_rows().groupBy("qid").agg(F.collect_list(F.struct("docno", "window_idx", "ce_score")).alias("snippet_windows"))
    return windows.legacy_rows(flat).select("qid", "docno", "window_idx", *big("place"))


@register("window_sources", "SELECT * FROM (VALUES ('a', 'embedded'), ('b', 'legacy'), ('c', 'mixed'), ('d', 'file')) t(records, source)")
def _(f):
    new = windows.embedded(windows.choose(windows.max_pool(f.two_fields()))).withColumn("snippet_windows", F.array().cast("array<struct<docno: string>>"))
    old = new.withColumn("doc_snippet_windows", F.when(F.lit(False), F.col("doc_snippet_windows"))).withColumn("snippet_windows", F.array(F.struct(F.lit("d").alias("docno"))))
    none = old.withColumn("snippet_windows", F.slice("snippet_windows", 1, 0))
    kinds = {"a": new, "b": old, "c": new.unionByName(none), "d": none}
    out = None
    for name, rows in kinds.items():
        part = windows.source_label(rows).select(F.lit(name).alias("records"), "source")
        out = part if out is None else out.unionByName(part)
    return out


@register("sentence_contexts", "SELECT docno, md5('T. ' || s[1] || CASE WHEN len(s) >= 3 THEN '. ' || s[3] ELSE '' END) h FROM (SELECT docno, list_transform(s, lambda x: trim(regexp_replace(x, '[^a-zA-Z]+', ' ', 'g'))) s FROM sents) WHERE len(s) > 0 AND s[1] <> '' AND (len(s) < 3 OR s[3] <> '')")
def _(f):
    own = F.transform(text.sentences(F.col("text")), lambda s: F.trim(F.regexp_replace(s, "[^a-zA-Z]+", " ")))
    rows = f.corpus().select("docno", own.alias("s")).where("size(s) > 0 and s[0] <> '' and (size(s) < 3 or s[2] <> '')")
    return rows.select("docno", F.md5(evidence.sentence_context(F.lit(" T "), F.col("s"), F.array(F.lit(0), F.lit(2), F.lit(99999)))).alias("h"))


@register("given_contexts", "SELECT qid, CASE WHEN CAST(qid AS BIGINT) % 4 = 0 THEN 'own' WHEN CAST(qid AS BIGINT) % 4 = 1 THEN '7' || qid || '-12' WHEN CAST(qid AS BIGINT) % 4 = 2 THEN '8' || qid ELSE 'snippet-0' END id, trim(query) AS text FROM topics")
def _(f):
    n = F.col("qid").cast("bigint") % 4
    snippet = F.struct(
        F.when(n == 0, "own").otherwise("").alias("id"), F.when(n <= 1, F.concat(F.lit("http://h/pubmed/7"), "qid")).when(n == 2, F.concat(F.lit("8"), "qid")).otherwise("elsewhere").alias("document"),
        F.when(n == 1, 12).alias("offset"), F.col("query").alias("text"),
    )
    return f.topics().select("qid", evidence.given_contexts(F.array(snippet))[0].alias("c")).select("qid", "c.id", "c.text")


SLOTQ = {
    "sl": "SELECT qid, place, doc_id, query, text FROM (SELECT qid, doc_id, text, row_number() OVER (PARTITION BY qid ORDER BY turn, source) place FROM claims1) JOIN asked USING (qid) WHERE place <= 24",
    "sw": "SELECT qid, place, regexp_extract_all(lower(query), '[a-z0-9]+') q, regexp_extract_all(lower(text), '[a-z0-9]+') t FROM sl",
    "sv": "SELECT *, count(*) FILTER (len(t) > 0) OVER (PARTITION BY qid) n, sum(len(t)) OVER (PARTITION BY qid) / greatest(count(*) FILTER (len(t) > 0) OVER (PARTITION BY qid), 1) avgl FROM sw",
    "sq": "SELECT qid, place, n, avgl, dl, term, count(*) w, max(tf) tf FROM (SELECT qid, place, n, avgl, len(t) dl, term, len(list_filter(t, lambda x: x = term)) tf FROM (SELECT *, unnest(q) term FROM sv)) GROUP BY qid, place, n, avgl, dl, term",
    "sd": "SELECT *, count(*) OVER (PARTITION BY qid, term) df FROM sq WHERE tf > 0",
    "sb": "SELECT qid, place, round(sum(w * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgl))), 6) s FROM sd GROUP BY qid, place",
    "so": f"SELECT qid, place, doc_id, row_number() OVER (PARTITION BY qid ORDER BY {overlap('query', 'text')} DESC NULLS LAST, place) - 1 a, row_number() OVER (PARTITION BY qid ORDER BY coalesce(s, 0.0) DESC, place) - 1 b FROM sl LEFT JOIN sb USING (qid, place)",
    "sr": "SELECT * FROM (SELECT qid, place, doc_id, row_number() OVER (PARTITION BY qid ORDER BY 1.0 / (60 + a) + 1.0 / (60 + b) DESC, place) rank FROM so) WHERE rank <= 8",
}


def chosen_slots(f: Fixtures) -> DataFrame:
    slots = distil.packed(distil.claims(f.cache()), slots=24).select("qid", "place", "doc_id", "text")
    return distil.selected_slots(slots, f.asked(), 8)


@register("slot_select", "SELECT qid, place, rank FROM sr", **SLOTQ)
def _(f):
    return chosen_slots(f).select("qid", *big("place", "rank"))


@register("slot_documents", "SELECT qid, string_agg(DISTINCT doc_id, ',' ORDER BY doc_id) docs FROM sr GROUP BY qid", **SLOTQ)
def _(f):
    return distil.with_doc_ids(chosen_slots(f)).select("qid", F.array_join("doc_ids", ",").alias("docs"))


@register("fidelity", f"SELECT qid, round(avg(s), 9) AS mean, round(min(s), 9) least FROM (SELECT qid, {overlap('member', 'summary')} s FROM (SELECT qid, summary, claims[1] AS member FROM claimrows JOIN (SELECT qid, string_agg(text, ' ' ORDER BY id) summary FROM ctx WHERE pos < 2 GROUP BY qid) USING (qid) WHERE len(claims) > 0)) GROUP BY qid")
def _(f):
    listed = F.array_sort(F.collect_list(F.struct("id", "text")))
    summary = f.contexts().where("pos < 2").groupBy("qid").agg(F.array_join(F.transform(listed, lambda c: c["text"]), " ").alias("summary"))
    members = f.cache().where("size(claims) > 0").groupBy("qid").agg(F.collect_list(F.col("claims")[0]).alias("members"))
    return distil.fidelity(summary.join(members, "qid").withColumnRenamed("qid", "key")).select(F.col("key").alias("qid"), "mean", r9("least", "least"))


@register("answers_to_do", "SELECT qid FROM topics WHERE CAST(qid AS BIGINT) % 3 <> 0 OR CAST(qid AS BIGINT) % 2 = 0")
def _(f):
    run = generate.fingerprint("input", "model", 200, None)
    n = F.col("qid").cast("bigint")
    done = f.topics().where(n % 3 == 0).select(F.col("qid").alias("query_id"), F.when(n % 2 == 0, "HTTP 504").alias("error"), F.lit(run).alias("run"))
    old = f.topics().select(F.col("qid").alias("query_id"), F.lit(None).cast("string").alias("error"), F.lit(generate.fingerprint("input", "other", 200, None)).alias("run"))
    return generate.to_do(f.topics().withColumnRenamed("qid", "query_id"), done.unionByName(old), run).select(F.col("query_id").alias("qid"))


@register("unanswered_prompts", "SELECT qid query_id, query prompt FROM topics WHERE CAST(qid AS BIGINT) % 2 = 1")
def _(f):
    rows = f.topics().select(F.col("qid").alias("query_id"), F.col("query").alias("prompt"), F.when(~even(), "HTTP 504").alias("error"))
    return generate.unanswered(rows).select("query_id", "prompt")


@register("prompt_preflight", r"SELECT CAST(round(max(len(list_filter(regexp_split_to_array(query, '\s+'), lambda w: w <> '')) * 1.4 + 800), 6) AS DOUBLE) most_tokens, max(len(list_filter(regexp_split_to_array(query, '\s+'), lambda w: w <> '')) * 1.4 + 800) <= 0.75 * 1024 fits FROM topics")
def _(f):
    return generate.preflight(f.topics(), text.word_count(F.col("query")), 1024).select(F.round("most_tokens", 6).alias("most_tokens"), "fits")


@register("replies_by_row", "SELECT id, CASE WHEN pos % 2 = 1 THEN 'empty prompt' END error, CASE WHEN pos % 2 = 0 THEN upper(id) END reply FROM ctx")
def _(f):
    rows = f.contexts().select("id", F.when(F.col("pos") % 2 == 0, F.col("id")).otherwise(" ").alias("prompt"))
    return generate.replied(rows, str.upper).select("id", "error", "reply")


@register("attribution_routes", "SELECT qid, CASE WHEN CAST(qid AS BIGINT) % 2 = 0 THEN 'lineage' ELSE 'descent' END route FROM topics")
def _(f):
    mode = F.when(even(), "claim").otherwise("claim_facet_summary")
    return f.topics().select("qid", attribute.route(mode).alias("route"))


@register("attributed_answers", "SELECT qid, n, n_cited FROM (SELECT a.qid, count(*) n, count(c.qid) n_cited FROM ans a LEFT JOIN (SELECT DISTINCT qid, sent FROM (SELECT qid, sent FROM ok WHERE ok.ok OR (NOT a AND r = 1))) c ON c.qid = a.qid AND c.sent = a.sent GROUP BY a.qid) UNION ALL SELECT 'blank', 0, 0", **LIN)
def _(f):
    cited = attribute.lineage(f.answers(), f.evidence(), f.slots())
    blank = f.spark.createDataFrame([("blank", " ")], "qid string, ideal_answer string")
    given = f.answers().groupBy("qid").agg(F.first("text").alias("ideal_answer")).unionByName(blank)
    rows = attribute.with_citations(given, f.answers(), cited)
    some = F.filter("answer_sentences", lambda s: F.size(s["doc_ids"]) > 0)
    return rows.select("qid", F.size("answer_sentences").cast("bigint").alias("n"), F.size(some).cast("bigint").alias("n_cited"))


@register("claim_recall", f"SELECT a.qid, a.sent, s.id, round(CASE WHEN len({CT.format('s.text')}) > 0 THEN len(list_intersect({CT.format('a.text')}, {CT.format('s.text')})) / len({CT.format('s.text')}) ELSE 0.0 END, 9) share FROM ans a JOIN (SELECT * FROM evid JOIN slots USING (qid, id)) s ON a.qid = s.qid")
def _(f):
    texts = f.evidence().join(f.slots().select("qid", "id", F.col("text").alias("slot")), ["qid", "id"])
    share, _ = attribute.recall(text.content_words(F.col("text")), text.content_words(F.col("slot")))
    return f.answers().join(texts, "qid").select("qid", *big("sent"), "id", r9(share, "share"))


@register("external_first_stage", "SELECT qid, docno, rank FROM shared")
def _(f):
    from trovespark.plans.route import first_stage

    given = f.shared_run().select(F.col("qid").alias("query_id"), F.col("docno").alias("doc"), "score")
    return first_stage(readers.RunSource.EXTERNAL, f.corpus(), f.topics(), config.Settings(), given).select("qid", "docno", *big("rank"))


@register("claim_route", "SELECT qid, count(*) n FROM (SELECT DISTINCT qid, text FROM ctx WHERE pos < 30) GROUP BY qid")
def _(f):
    from trovespark.plans.route import claim_route

    made = claim_route(f.contexts(), config.Settings(slots=100_000))  # the stand-in gives two claims a context
    return made.groupBy("qid").agg((F.count(F.lit(1)) / 2).cast("bigint").alias("n"))
