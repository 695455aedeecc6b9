"""Every registered query of the retrieval engine, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from trovespark.functions import ids, text
from trovespark.functions.answers import parsed_answer
from trovespark.operators import attribute, dense, distil, evaluate, evidence, fusion, generate, lexical, ranking, reports, rerank, windows
from trovespark.plans.fixtures import Fixtures
from trovespark.plans.oracle import TOK, sql
from trovespark.sources import readers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, statement: str | None = None, **own: str):
    """Registers a function of Fixtures as a query; `statement` gives its rows over the tables named in oracle.TABLES."""

    def add(make: Callable[[Fixtures], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: make(Fixtures(spark, sf_dir))
        if statement:
            SQL[name] = sql(statement, **own)
        return make

    return add


def big(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


def r9(column: Column | str, name: str) -> Column:
    return F.round(column, 9).alias(name)


# Identifiers and text

@register("norm_ids", r"""SELECT page_id, regexp_replace(coalesce(nullif(regexp_extract(url, '(?i)/pubmed/(\d+)', 1), ''), nullif(regexp_extract(url, '(?i)pubmed\.ncbi\.nlm\.nih\.gov/(\d+)', 1), ''), trim(url), ''), '^\s+|\s+$', '', 'g') AS doc,
    split_part(url, '#', 1) AS parent, CASE WHEN lower(trim(url)) LIKE 'http%' THEN nullif(regexp_extract(url, 'pubmed/(\d+)/?$', 1), '') ELSE nullif(trim(url), '') END AS listed FROM pages""")  # fmt: skip
def _(f):
    return f.table("pages").select("page_id", ids.doc_id(F.col("url")).alias("doc"), ids.parent(F.col("url")).alias("parent"), ids.listed_doc_id(F.col("url")).alias("listed"))


@register("chunk_parents", "SELECT p docno, count(*) n FROM (SELECT split_part(docno, '#', 1) p FROM chunks) GROUP BY p")
def _(f):
    return f.chunks().groupBy(ids.parent(F.col("docno")).alias("docno")).agg(F.count(F.lit(1)).alias("n"))


# Words are marked at both ends, for the oracle's word boundaries know ASCII alone
_CODE = r"'\x01([A-Za-z]{2,12})(?:\x02\s*[-–]?\s*\x01)?(\d{2,})\x02'"
CODES = rf"""SELECT docno, text, list_transform(list_zip(regexp_extract_all(m, {_CODE}, 1), regexp_extract_all(m, {_CODE}, 2)), lambda z: CASE WHEN length(z[2]) >= 5 THEN list_concat([lower(z[1])], list_concat(regexp_extract_all(z[2], '.{{1,4}}'), [lower(z[1]) || ' ' || array_to_string(regexp_extract_all(z[2], '.{{1,4}}'), ' ')]))
    ELSE [lower(z[1]), z[2], lower(z[1]) || z[2], lower(z[1]) || '-' || z[2], lower(z[1]) || ' ' || z[2]] END) c FROM (SELECT docno, text, regexp_replace(text, '([\p{{L}}\p{{N}}_]+)', chr(1) || '\1' || chr(2), 'g') m FROM corpus)"""  # fmt: skip


@register("augment_codes_index", "SELECT docno, md5(CASE WHEN len(flatten(c)) > 0 THEN text || chr(10) || chr(10) || array_to_string(list_sort(list_distinct(flatten(c))), ' ') ELSE text END) h, len(list_distinct(flatten(c))) n FROM codes", codes=CODES)
def _(f):
    terms = F.array_distinct(text.code_terms(F.col("text")))
    return f.corpus().select("docno", F.md5(text.with_codes_for_index(F.col("text"))).alias("h"), F.size(terms).cast("bigint").alias("n"))


@register("augment_codes_query", "SELECT docno, md5(CASE WHEN len(flatten(c)) > 0 THEN text || ' ' || array_to_string(flatten(c), ' ') ELSE text END) h, len(flatten(c)) n FROM codes", codes=CODES)
def _(f):
    return f.corpus().select("docno", F.md5(text.with_codes_for_query(F.col("text"))).alias("h"), F.size(text.code_terms(F.col("text"))).cast("bigint").alias("n"))


@register("seed_clean", r"""SELECT qid, turn, CASE WHEN bare <> '' THEN bare ELSE regexp_replace(regexp_replace(text, '[?]+$', ''), '^\s+|\s+$', '', 'g') END seed FROM (SELECT qid, turn, text, trim(regexp_replace(flat, '(?i)^\s*(?:what\s+is|what\s+are|what\s+was|what\s+were|what\s+does|which\s+(?:is|are)|when\s+(?:is|was)|how\s+many|list|describe|define)\s+', '')) bare
    FROM (SELECT qid, turn, text, regexp_replace(regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g'), '[ ?]+$', '') flat FROM (SELECT qid, turn, 'What is ' || text AS text FROM turns WHERE role = 'user')))""")  # fmt: skip
def _(f):
    return f.turns().where("role = 'user'").select("qid", *big("turn"), text.seed_query(F.concat(F.lit("What is "), F.col("text"))).alias("seed"))


@register("claim_keys", r"SELECT id, sha1(encode(qid) || '\x00'::BLOB || encode(text)) k FROM ctx")
def _(f):
    return f.contexts().select("id", text.claim_key(F.col("qid"), F.col("text")).alias("k"))


@register("member_hash", r"SELECT context_id, substr(sha1(array_to_string(list_sort(list_transform(claims, lambda c: trim(regexp_replace(lower(c), '[^\p{L}\p{N}_]+', ' ', 'g')))), chr(10))), 1, 16) h FROM claimrows")
def _(f):
    return f.cache().select("context_id", text.member_hash(F.col("claims")).alias("h"))


@register("whitespace_norm", r"SELECT docno, md5(trim(regexp_replace(regexp_replace(text, '[\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]', ' ', 'g'), ' {2,}', ' ', 'g'))) h FROM corpus")
def _(f):
    return f.corpus().select("docno", F.md5(text.plain_spaces(F.col("text"))).alias("h"))


@register("preamble", r"SELECT id, regexp_replace(regexp_replace('Here is the combined statement: ' || text, '(?is)^\s*(?:here(?:''s| is| are)|the combined|combined statement|sure[,:]?|below is)\b[^:]*:\s*', ''), '^\s+|\s+$', '', 'g') t FROM ctx")
def _(f):
    return f.contexts().select("id", text.without_preamble(F.concat(F.lit("Here is the combined statement: "), "text")).alias("t"))


@register("content_tokens", f"SELECT qid, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(lower(query), '[a-z0-9]+'), lambda w: length(w) > 1 AND NOT list_contains({text.STOP!r}, w)))), ' ') t FROM topics".replace('"', "'").replace("it's", "it''s"))
def _(f):
    return f.topics().select("qid", F.array_join(F.array_sort(text.content_words(F.col("query"))), " ").alias("t"))


# Sources

@register("canonical_queries", "SELECT qid query_id, trim(query) query_text, 'd' || CAST(CAST(qid AS BIGINT) % 3 AS VARCHAR) documents FROM topics WHERE CAST(qid AS BIGINT) % 2 = 0 UNION ALL SELECT qid, trim(query), NULL FROM topics WHERE CAST(qid AS BIGINT) % 2 = 1")
def _(f):
    n = F.col("qid").cast("bigint")
    given = F.when(n % 2 == 0, F.array(F.lit(" "), F.concat(F.lit(" d"), (n % 3).cast("string")))).otherwise(F.array(F.lit("")))
    rows = readers.canonical(f.topics().select(F.concat(F.lit(" "), "qid").alias("query_id"), F.col("query").alias("query_text"), F.lit(" ").alias("query_type"), given.alias("documents")))
    return rows.select("query_id", "query_text", F.array_join("documents", ",").alias("documents"))


@register("topics_and_gold", "SELECT qid, count(docno) n_gold FROM topics LEFT JOIN gold USING (qid) GROUP BY qid")
def _(f):
    listed = f.gold().groupBy("qid").agg(F.collect_list("docno").alias("documents"))
    rows = f.topics().join(listed, "qid", "left").select(F.col("qid").alias("query_id"), F.col("query").alias("query_text"), F.lit(None).cast("string").alias("query_type"), "documents")
    gold, every = readers.gold(readers.canonical(rows))
    return every.join(gold, "qid", "left").groupBy("qid").agg(F.count("docno").alias("n_gold"))


@register("run_from_scores", "SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docno) rank, score FROM lex WHERE rank <= 20")
def _(f):
    raw = ranking.cut(f.lexical_run(), 20).select(F.col("qid").alias("query_id"), F.concat(F.lit(" "), "docno").alias("docid"), "score")
    return readers.run(raw).select("qid", "docno", *big("rank"), "score")


@register("texts_for_run", "SELECT DISTINCT docno, length(coalesce(text, '')) n FROM shared LEFT JOIN corpus USING (docno)")
def _(f):
    return readers.texts_for(f.shared_run(), f.corpus()).select("docno", F.length("text").cast("bigint").alias("n"))


@register("corpus_documents", "SELECT docno, md5(trim(title) || chr(10) || chr(10) || text) h FROM (SELECT docno, trim(title) title, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text FROM corpus) WHERE title <> ''")
def _(f):
    rows = f.corpus().where("trim(title) <> ''").withColumn("keywords", F.array(F.lit("k")))
    return readers.index_documents(rows).select("docno", F.md5("text").alias("h"))


@register("row_map", "SELECT count(*) n, count(DISTINCT docno) n_unique FROM vecs")
def _(f):
    return dense.unique_count(f.vectors(), numeric=True)


# Lexical and dense retrieval

@register("corpus_stats", "SELECT n, round(avgdl, 9) avgdl FROM cstats")
def _(f):
    return lexical.corpus_stats(f.corpus()).select("n", r9("avgdl", "avgdl"))


@register("postings", "SELECT term, count(*) df, CAST(sum(tf) AS BIGINT) cf FROM allpost GROUP BY term")
def _(f):
    return lexical.term_stats(f.corpus())


@register("bm25_top10", "SELECT qid, docno, rank, score FROM lex WHERE rank <= 10")
def _(f):
    return ranking.cut(f.lexical_run(10), 10).select("qid", "docno", *big("rank"), "score")


RM3 = {
    "fb": "SELECT qid, docno, score / sum(score) OVER (PARTITION BY qid) share FROM lex WHERE rank <= 20",
    "fbterm": "SELECT qid, term, round(sum(share * tf / dl), 9) p FROM fb JOIN allpost USING (docno) GROUP BY qid, term",
    "fbtop": "SELECT qid, term, 0.4 * p / sum(p) OVER (PARTITION BY qid) fed, 0.0 own FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY p DESC, term) r FROM fbterm) WHERE r <= 30",
    "expanded": "SELECT qid, term, round(max(own) + max(fed), 9) w FROM (SELECT * FROM fbtop UNION ALL SELECT qid, term, 0.0, 0.6 * qtf / sum(qtf) OVER (PARTITION BY qid) FROM qterms) GROUP BY qid, term",
    "alldf": "SELECT term, count(*) df FROM allpost GROUP BY term",
    "rmscore": "SELECT qid, docno, round(sum(w * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) score FROM expanded JOIN alldf USING (term) JOIN allpost USING (term), cstats GROUP BY qid, docno",
}


@register("bm25_rm3_top10", "SELECT * FROM (SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docno) rank, score FROM rmscore) WHERE rank <= 10", **RM3)
def _(f):
    return lexical.retrieve_rm3(f.index(), f.topics(), 10).select("qid", "docno", *big("rank"), "score")


@register("dense_top10", "SELECT qid, docno, rank, score FROM dense WHERE rank <= 10")
def _(f):
    return dense.retrieve(f.vectors(), f.query_vectors(), 10).select("qid", "docno", *big("rank"), "score")


@register("dense_sharded_top10", "SELECT * FROM (SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docno) rank, score FROM (SELECT qid, docno, score, row_number() OVER (PARTITION BY qid, CAST(docno AS BIGINT) % 4 ORDER BY score DESC, docno) r FROM dense) WHERE r <= 5) WHERE rank <= 10")
def _(f):
    return dense.retrieve_sharded(f.vectors(), f.query_vectors(), 10, 5).select("qid", "docno", *big("rank"), "score")


@register("dense_l2_top10", "SELECT * FROM (SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docno) rank, score FROM (SELECT qid, docno, round(-list_sum(list_transform(list_zip(q, v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 6) score FROM qvecs, vecs)) WHERE rank <= 10")
def _(f):
    return dense.retrieve(f.vectors(), f.query_vectors(), 10, "l2").select("qid", "docno", *big("rank"), "score")


@register("dense_schema", "SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY rank, docno) rank FROM (SELECT qid, docno, min(rank) rank FROM (SELECT qid, docno, rank FROM lex UNION ALL SELECT qid, docno, rank + 3 FROM lex WHERE rank <= 10) GROUP BY qid, docno)")
def _(f):
    run = f.lexical_run()
    twice = run.unionByName(run.where("rank <= 10").withColumn("rank", F.col("rank") + 3))
    return ranking.clean_dense(twice).select("qid", "docno", *big("rank"))


@register("exclude_test_qids", "SELECT qid, count(*) n FROM lex WHERE qid NOT IN (SELECT qid FROM topics WHERE CAST(qid AS BIGINT) % 2 = 1) GROUP BY qid")
def _(f):
    return ranking.without_queries(f.lexical_run(), f.topics().where("cast(qid as bigint) % 2 = 1")).groupBy("qid").agg(F.count(F.lit(1)).alias("n"))


@register("first_queries", "SELECT qid, docno FROM lex WHERE rank = 1 AND qid IN (SELECT qid FROM lex GROUP BY qid ORDER BY qid LIMIT 7)")
def _(f):
    return ranking.first_queries(f.lexical_run(), 7).where("rank = 1").select("qid", "docno")


# Fusion

def rrf_sql(a: str, b: str, wa: float, wb: float, k: int, pa: int, pb: int, base: int = 1, scope: str = "") -> str:
    return f"""SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docno) rank, score FROM (SELECT qid, docno, coalesce({wa} / ({k} + a.rank + {base - 1}), 0.0) + coalesce({wb} / ({k} + b.rank + {base - 1}), 0.0) score FROM
        (SELECT qid, docno, rank FROM {a} WHERE rank <= {pa}) a FULL JOIN (SELECT qid, docno, rank FROM {b} WHERE rank <= {pb}) b USING (qid, docno)) {scope}"""


def fused_out(df: DataFrame) -> DataFrame:
    return df.select("qid", "docno", *big("rank"), F.round("score", 12).alias("score"))


ROUND = "SELECT qid, docno, rank, round(score, 12) score FROM fz"


@register("rrf_two_leg", ROUND + " WHERE rank <= 50", fz=rrf_sql("lex", "shared", 1.0, 1.0, 60, 100, 80))
def _(f):
    return fused_out(fusion.two_legs(f.lexical_run(), f.shared_run(), 100, 80, out=50))


@register("rrf_weighted", ROUND, fz=rrf_sql("lex", "shared", 2.0, 1.0, 30, 50, 50))
def _(f):
    return fused_out(fusion.two_legs(f.lexical_run(), f.shared_run(), 50, 50, 30, 2.0, 1.0))


THREE = "SELECT qid, docno, max(CASE WHEN l = 0 THEN rank END) r0, max(CASE WHEN l = 1 THEN rank END) r1, max(CASE WHEN l = 2 THEN rank END) r2 FROM (SELECT 0 l, qid, docno, rank FROM lex UNION ALL SELECT 1, qid, docno, rank FROM shared WHERE CAST(qid AS BIGINT) % 2 = 0 UNION ALL SELECT 2, qid, docno, rank FROM lex WHERE rank > 5 AND CAST(qid AS BIGINT) % 3 = 0) GROUP BY qid, docno"


def three_legs(f: Fixtures) -> list[DataFrame]:
    lex, n = f.lexical_run(), F.col("qid").cast("bigint")
    return [lex, f.shared_run().where(n % 2 == 0), lex.where((F.col("rank") > 5) & (n % 3 == 0))]


@register("rrf_nway", "SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY s DESC, docno) rank, round(s, 12) score FROM (SELECT qid, docno, coalesce(0.5 / (60 + r0), 0.0) + coalesce(0.3 / (60 + r1), 0.0) + coalesce(0.2 / (60 + r2), 0.0) s FROM three)", three=THREE)
def _(f):
    return fused_out(fusion.fuse(three_legs(f), [0.5, 0.3, 0.2]))


@register("rrf_adaptive", """SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY s DESC, docno) rank, round(s, 12) score FROM (SELECT qid, docno, coalesce(CASE WHEN o > 0 THEN 0.6 ELSE 1.0 END / (60 + r0), 0.0) + coalesce(CASE WHEN o > 0 THEN CASE WHEN a0 THEN 1.0 - 0.6 ELSE 1.0 END / o ELSE 0.0 END / (60 + r1), 0.0) + coalesce(CASE WHEN o > 0 THEN CASE WHEN a0 THEN 1.0 - 0.6 ELSE 1.0 END / o ELSE 0.0 END / (60 + r2), 0.0) s FROM
    (SELECT *, bool_or(r0 IS NOT NULL) OVER (PARTITION BY qid) a0, CAST(bool_or(r1 IS NOT NULL) OVER (PARTITION BY qid) AS INTEGER) + CAST(bool_or(r2 IS NOT NULL) OVER (PARTITION BY qid) AS INTEGER) o FROM three))""", three=THREE)  # fmt: skip
def _(f):
    return fused_out(fusion.fuse(three_legs(f), first_weight=0.6))


@register("rrf_zero_based", ROUND, fz=rrf_sql("lex", "shared", 1.0, 1.0, 60, 100, 100, 0))
def _(f):
    return fused_out(fusion.fuse([f.lexical_run(), f.shared_run()], [1.0, 1.0], base=0))


@register("post_rerank_fusion", "SELECT qid, docno, rank FROM fz", fz=rrf_sql("shared", "lex", 0.8, 0.19999999999999996, 60, 50, 50, scope="WHERE qid IN (SELECT qid FROM shared)"))
def _(f):
    return fusion.after_rerank(f.shared_run(), f.lexical_run(), 50, 50).select("qid", "docno", *big("rank"))


CAPPED = "SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY rank, docno) rank FROM (SELECT *, row_number() OVER (PARTITION BY qid, split_part(docno, '#', 1) ORDER BY rank, docno) n FROM fz) WHERE n <= 2"


@register("post_rerank_chunk_cap", CAPPED, fz=rrf_sql("chunkrun", "late", 0.8, 0.19999999999999996, 60, 30, 60), late="SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY rank DESC) rank FROM chunkrun")
def _(f):
    run = f.chunk_run()
    late = ranking.ranked(run.withColumn("_r", F.col("rank")), F.desc("_r")).select("qid", "docno", "rank")
    return fusion.after_rerank(run, late, 30, 60, chunks=2).select("qid", "docno", *big("rank"))


@register("listwise_fusion", ROUND, fz=rrf_sql("lex", "shared", 0.6, 0.4, 20, 15, 15, scope="WHERE qid IN (SELECT qid FROM lex)"))
def _(f):
    return fused_out(fusion.listwise(f.lexical_run(), f.shared_run()))


GRID = {
    "configs": "SELECT * FROM (VALUES (1, 30, 1.0, 1.0), (2, 60, 2.0, 1.0), (3, 60, 1.0, 2.0)) t(config, k_rrf, w_lexical, w_dense)",
    "gridrun": "SELECT * FROM (SELECT config, qid, docno, row_number() OVER (PARTITION BY config, qid ORDER BY s DESC, docno) rank FROM (SELECT config, qid, docno, coalesce(w_lexical / (k_rrf + a.rank), 0.0) + coalesce(w_dense / (k_rrf + b.rank), 0.0) s FROM (SELECT qid, docno, rank FROM lex WHERE rank <= 50) a FULL JOIN (SELECT qid, docno, rank FROM shared WHERE rank <= 50) b USING (qid, docno), configs)) WHERE rank <= 20",
    "gridr": "SELECT config, g.qid, avg(hit) r FROM (SELECT c.config, g.qid, CASE WHEN r.docno IS NULL THEN 0.0 ELSE 1.0 END hit FROM gold g CROSS JOIN configs c LEFT JOIN gridrun r ON r.config = c.config AND r.qid = g.qid AND r.docno = g.docno) g GROUP BY config, g.qid",
}
CONFIGS = [(1, 30, 1.0, 1.0), (2, 60, 2.0, 1.0), (3, 60, 1.0, 2.0)]


def grid_recall(f: Fixtures) -> tuple[DataFrame, DataFrame]:
    configs = f.spark.createDataFrame(CONFIGS, "config int, k_rrf int, w_lexical double, w_dense double")
    run = fusion.grid(f.lexical_run(), f.shared_run(), configs, 50, 50, 20)
    hits = f.gold().crossJoin(configs.select("config")).join(run.select("config", "qid", "docno", F.lit(1.0).alias("hit")), ["config", "qid", "docno"], "left")
    return configs, hits.groupBy("config", "qid").agg(F.avg(F.coalesce("hit", F.lit(0.0))).alias("r"))


@register("rrf_grid", "SELECT config, count(*) n_queries, round(avg(r), 9) mean_r FROM gridr GROUP BY config", **GRID)
def _(f):
    return grid_recall(f)[1].groupBy("config").agg(F.count(F.lit(1)).alias("n_queries"), r9(F.avg("r"), "mean_r"))


@register("rank_configs", "SELECT k_rrf, w_lexical, w_dense, round(m, 9) at_cap, row_number() OVER (ORDER BY round(m, 9) DESC, k_rrf, w_lexical, w_dense) place FROM (SELECT k_rrf, w_lexical, w_dense, avg(r) m FROM gridr JOIN configs USING (config) GROUP BY ALL)", **GRID)
def _(f):
    configs, recalls = grid_recall(f)
    best = fusion.ranked_configs(recalls.join(configs, "config").withColumn("r2", F.col("r")), "r", "r2")
    return best.select("k_rrf", "w_lexical", "w_dense", r9("at_cap", "at_cap"), *big("place"))


@register("recall_pivot", "SELECT w_lexical, round(avg(CASE WHEN k_rrf = 30 THEN r END), 9) AS k30, round(avg(CASE WHEN k_rrf = 60 THEN r END), 9) AS k60 FROM gridr JOIN configs USING (config) GROUP BY w_lexical", **GRID)
def _(f):
    configs, recalls = grid_recall(f)
    return reports.pivot(recalls.join(configs, "config"), "w_lexical", "k_rrf", "r", [30, 60]).select("w_lexical", r9(F.col("30"), "k30"), r9(F.col("60"), "k60"))


# Order, duplicates, parents

@register("max_pool_parent", "SELECT qid, p docno, row_number() OVER (PARTITION BY qid ORDER BY s DESC, p) - 1 rank, s score FROM (SELECT qid, p, max(score) s FROM chunkrun GROUP BY qid, p)")
def _(f):
    return ranking.best_chunk(f.chunk_run()).select("qid", "docno", *big("rank"), "score")


@register("dedupe_parent", "SELECT qid, p docno, row_number() OVER (PARTITION BY qid ORDER BY r, p) rank FROM (SELECT qid, p, min(rank) r FROM chunkrun GROUP BY qid, p)")
def _(f):
    return ranking.first_chunk(f.chunk_run()).select("qid", "docno", *big("rank"))


TOPP = "SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY rank) rank FROM (SELECT *, dense_rank() OVER (PARTITION BY qid ORDER BY f, p) d, row_number() OVER (PARTITION BY qid, p ORDER BY rank) n FROM (SELECT *, min(rank) OVER (PARTITION BY qid, p) f FROM chunkrun)) WHERE d <= {} AND n <= {}"


@register("top_k_parents", TOPP.format(10, 2))
def _(f):
    return ranking.top_parents(f.chunk_run(), 10, 2).select("qid", "docno", *big("rank"))


@register("gold_override", "SELECT qid, count(*) n FROM (SELECT qid, docno FROM gold WHERE CAST(qid AS BIGINT) % 2 = 1 UNION ALL SELECT DISTINCT qid, 'x' FROM gold WHERE CAST(qid AS BIGINT) % 2 = 0) GROUP BY qid")
def _(f):
    listed = f.gold().groupBy("qid").agg(F.collect_list("docno").alias("docnos"))
    later = listed.where("cast(qid as bigint) % 2 = 0").withColumn("docnos", F.array(F.lit("x")))
    return ranking.with_override(listed, later).select("qid", F.size("docnos").cast("bigint").alias("n"))


# Reranking and cut-off

_STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in text.STOP) + "]"
CT = "list_distinct(list_filter(regexp_extract_all(lower({}), '[a-z0-9]+'), lambda w: length(w) > 1 AND NOT list_contains(" + _STOP + ", w)))"
#: The share of a text's content words among a query's, nothing for a query without any.
OVERLAP = f"CASE WHEN len({CT.format('{q}')}) > 0 THEN len(list_intersect({CT.format('{q}')}, {CT.format('{t}')})) / len({CT.format('{q}')}) END"


def overlap(q: str, t: str) -> str:
    return OVERLAP.replace("{q}", q).replace("{t}", t)


RERANKED = f"SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY score DESC NULLS LAST, rank, docno) rank, score FROM (SELECT qid, docno, rank, {overlap('query', 'text')} score FROM lex JOIN topics USING (qid) JOIN corpus USING (docno) WHERE trim(query) <> '')"


@register("rerank_stub", "SELECT qid, docno, rank, round(score, 9) score FROM rr", rr=RERANKED)
def _(f):
    return rerank.rerank(f.lexical_run(), f.topics(), f.corpus()).select("qid", "docno", *big("rank"), r9("score", "score"))


TSTAR = {
    "order1": "SELECT l.qid, l.docno, l.rank, s.score, coalesce(s.score >= 0.25, false) ok FROM lex l LEFT JOIN scores s USING (qid, docno)",
    "placed": "SELECT *, ok AND row_number() OVER (PARTITION BY qid, ok ORDER BY rank) <= 12 kept FROM order1",
    "cutrun": "SELECT * FROM (SELECT qid, docno, score, kept, row_number() OVER (PARTITION BY qid ORDER BY NOT kept, rank) rank FROM placed) WHERE kept OR rank <= 5",
}


@register("tstar_cutoff", "SELECT qid, docno, rank, score, NOT kept topped FROM cutrun", **TSTAR)
def _(f):
    run = f.lexical_run()
    return rerank.cutoff(run, f.scores(run), 0.25, 5, 12).select("qid", "docno", *big("rank"), "score", "topped")


@register("tstar_max_subruns", "SELECT qid, docno, max(score) score FROM (SELECT qid, docno, score FROM scores UNION ALL SELECT qid, docno, 0.3 FROM shared WHERE rank <= 10) GROUP BY qid, docno")
def _(f):
    return rerank.best_scores(f.scores(f.lexical_run()), f.shared_run(10).select("qid", "docno", F.lit(0.3).alias("score")))


TSUM = TSTAR | {
    "perq": """SELECT CASE WHEN CAST(qid AS BIGINT) % 2 = 0 THEN 'even' ELSE 'odd' END split, qid, n, over_, kept, CAST(least(over_, 12) < 5 AS INTEGER) floored, before_ <> after_ changed, loss FROM
        (SELECT qid, count(*) n, sum(CAST(ok AS INTEGER)) over_, array_agg(docno ORDER BY rank) before_ FROM order1 GROUP BY qid) JOIN (SELECT qid, count(*) kept, array_agg(docno ORDER BY rank) after_ FROM cutrun GROUP BY qid) USING (qid)
        LEFT JOIN (SELECT g.qid, avg(CASE WHEN c.docno IS NULL THEN 1.0 ELSE 0.0 END) loss FROM gold g JOIN lex USING (qid, docno) LEFT JOIN cutrun c USING (qid, docno) GROUP BY g.qid) USING (qid)""",
    "persplit": "SELECT split, count(*) n_queries, avg(kept) mean_kept, quantile_cont(kept, 0.5) median_kept, quantile_cont(kept, 0.9) p90_kept, avg(floored) floor_hit_frac, avg(over_ / n) threshold_keep_frac, avg(CAST(changed AS INTEGER)) changed_vs_input_frac, count(loss) n_eval_pool_gold, avg(loss) mean_res_loss FROM perq GROUP BY split",
    "allsplits": "SELECT '__pooled__' split, count(*) n_queries, avg(kept) mean_kept, quantile_cont(kept, 0.5) median_kept, quantile_cont(kept, 0.9) p90_kept, (SELECT avg(floor_hit_frac) FROM persplit) floor_hit_frac, (SELECT avg(threshold_keep_frac) FROM persplit) threshold_keep_frac, (SELECT avg(changed_vs_input_frac) FROM persplit) changed_vs_input_frac, count(loss) n_eval_pool_gold, avg(loss) mean_res_loss FROM perq",
}
TCOLS = ("mean_kept", "median_kept", "p90_kept", "floor_hit_frac", "threshold_keep_frac", "changed_vs_input_frac", "mean_res_loss")


@register("tstar_summary", f"SELECT split, n_queries, n_eval_pool_gold, {', '.join(f'round({c}, 9) {c}' for c in TCOLS)} FROM (SELECT * FROM persplit UNION ALL SELECT * FROM allsplits)", **TSUM)
def _(f):
    run = f.lexical_run()
    split = F.when(F.col("qid").cast("bigint") % 2 == 0, "even").otherwise("odd")
    out = rerank.cutoff_summary(run.withColumn("split", split), f.scores(run), f.gold(), 0.25, 5, 12)
    return out.select("split", "n_queries", "n_eval_pool_gold", *(r9(c, c) for c in TCOLS))


@register("kept_histogram", "SELECT kept, count(*) n_queries FROM (SELECT qid, count(*) kept FROM cutrun GROUP BY qid) GROUP BY kept", **TSTAR)
def _(f):
    run = f.lexical_run()
    return rerank.kept_histogram(rerank.cutoff(run, f.scores(run), 0.25, 5, 12))


@register("snippet_sizes", f"SELECT round(avg(n), 6) mean, quantile_cont(n, 0.5) median, round(quantile_cont(n, 0.95), 6) p95, max(n) most FROM (SELECT len({TOK.format('window_text')}) n FROM wins)")
def _(f):
    out = rerank.snippet_sizes(f.window_rows(), F.size(text.words(F.col("window_text"))))
    return out.select("mean", "median", "p95", *big("most"))


SNIPPETS = "SELECT qid, docno, window_text FROM (SELECT *, row_number() OVER (PARTITION BY qid, docno ORDER BY ce_score DESC, window_idx) n FROM winscore) WHERE n = 1"
CLIP = r"array_to_string(list_slice(list_filter(regexp_split_to_array(window_text, '\s+'), lambda w: w <> ''), 1, 40), ' ')"


@register("listwise_requests", "SELECT qid, string_agg(docno, ',' ORDER BY rank) docnos, md5(string_agg(" + CLIP + ", chr(10) ORDER BY rank)) h FROM (SELECT qid, docno, rank FROM lex WHERE rank <= 50) JOIN best USING (qid, docno) GROUP BY qid", best=SNIPPETS)
def _(f):
    requests = rerank.listwise_requests(f.lexical_run(50), f.topics(), windows.best_text(f.window_rows()), 50, 40)
    return requests.select("qid", F.array_join("docnos", ",").alias("docnos"), F.md5(F.array_join("passages", "\n")).alias("h"))


SHARED_WORDS = r"len(list_intersect(list_distinct(list_filter(regexp_split_to_array(lower(query), '\s+'), lambda w: w <> '')), regexp_split_to_array(lower(clip), '\s+')))"


@register("listwise_single", f"SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY {SHARED_WORDS} DESC, rank) rank FROM (SELECT qid, docno, rank, query, {CLIP} clip FROM lex JOIN best USING (qid, docno) JOIN topics USING (qid) WHERE rank <= 50)", best=SNIPPETS)
def _(f):
    requests = rerank.listwise_requests(f.lexical_run(50), f.topics(), windows.best_text(f.window_rows()), 50, 40)
    return rerank.permuted(requests).select("qid", "docno", *big("rank"))


SLIDE = {"lq": f"SELECT qid, docno, n, c, rank - 1 i FROM (SELECT qid, docno, {SHARED_WORDS} c, row_number() OVER (PARTITION BY qid ORDER BY rank) rank, count(*) OVER (PARTITION BY qid) n FROM (SELECT qid, docno, rank, query, {CLIP} clip FROM lex JOIN best USING (qid, docno) JOIN topics USING (qid) WHERE rank <= 50))", "best": SNIPPETS}
#: One pass of windows of 15 from the back, 5 at a time: with at most 20 documents there are two windows.
SLIDE["s1"] = "SELECT qid, docno, c, n, CASE WHEN i < greatest(n - 15, 0) THEN i ELSE greatest(n - 15, 0) + row_number() OVER (PARTITION BY qid, i >= greatest(n - 15, 0) ORDER BY c DESC, i) - 1 END i FROM lq"
SLIDE["s2"] = "SELECT qid, docno, n, CASE WHEN n <= 15 OR i >= 15 THEN i ELSE row_number() OVER (PARTITION BY qid, i < 15 ORDER BY c DESC, i) - 1 END i FROM s1"


@register("listwise_sliding", "SELECT qid, docno, i + 1 rank FROM s2", **SLIDE)
def _(f):
    requests = rerank.listwise_requests(f.lexical_run(50), f.topics(), windows.best_text(f.window_rows()), 50, 40)
    return rerank.permuted(requests, window=15, stride=5).select("qid", "docno", *big("rank"))


MAXP = {
    "mw": r"SELECT qid, docno, rank, query, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') w, CAST(greatest(128, 252 - len(regexp_split_to_array(query, '\s+'))) AS BIGINT) n FROM lex JOIN topics USING (qid) JOIN corpus USING (docno) WHERE rank <= 10",
    "mp": f"SELECT qid, docno, max(sc) score FROM (SELECT qid, docno, {overlap('query', 'part')} sc FROM (SELECT qid, docno, query, array_to_string(list_slice(w, i * (n // 2) + 1, i * (n // 2) + n), ' ') part FROM (SELECT *, unnest(range(0, CAST(greatest(0, ceil((len(w) - n) / (n // 2))) AS BIGINT) + 1)) i FROM mw))) GROUP BY qid, docno",
}


@register("maxp_stub", "SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY score DESC NULLS LAST, rank, docno) rank, round(score, 9) score FROM mw JOIN mp USING (qid, docno)", **MAXP)
def _(f):
    return rerank.by_best_passage(f.lexical_run(10), f.topics(), f.corpus(), size=256).select("qid", "docno", *big("rank"), r9("score", "score"))


# Windows

@register("windows_build", "SELECT qid, docno, count(*) n, min(md5(window_text)) a, max(md5(window_text)) b FROM wins GROUP BY qid, docno")
def _(f):
    h = F.md5("window_text")
    return f.window_rows().groupBy("qid", "docno").agg(F.count(F.lit(1)).alias("n"), F.min(h).alias("a"), F.max(h).alias("b"))


PROSE = r"""SELECT page_id, unnest(regexp_split_to_array(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>', '', 'g'), '(?i)</?(p|div|li|h[1-6]|br|ul|nav|footer|article)[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g'), '\n\n\n')) s FROM pages"""


@register("prose_filter", r"""SELECT page_id, count(*) n FROM (SELECT page_id, s, list_filter(list_transform(string_split(s, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') l FROM pr) WHERE NOT (len(l) > 1 AND len(list_filter(l, lambda x: len(list_filter(regexp_split_to_array(x, '\s+'), lambda w: w <> '')) < 4)) / len(l) > 0.5)
    AND len(list_filter(regexp_split_to_array(s, '\s+'), lambda w: w <> '')) >= 5 GROUP BY page_id""", pr=PROSE)  # fmt: skip
def _(f):
    rows = f.table("pages").select("page_id", F.explode(F.split(readers.prose_of(F.col("html")), "\n\n\n")).alias("s"))
    return rows.where(text.is_prose(F.col("s"))).groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))


WTOK = r"list_filter(regexp_split_to_array(regexp_replace(lower({}), '[^a-zA-Z0-9\s]', ' ', 'g'), '\s+'), lambda w: w <> '')"
WBM = {
    "wt": f"SELECT qid, docno, window_idx, {WTOK.format('window_text')} t, {WTOK.format('query')} q FROM wins",
    "ws": "SELECT *, count(*) FILTER (len(t) > 0) OVER (PARTITION BY qid, docno) n, sum(len(t)) OVER (PARTITION BY qid, docno) / greatest(count(*) FILTER (len(t) > 0) OVER (PARTITION BY qid, docno), 1) avgl FROM wt",
    "wq": "SELECT qid, docno, window_idx, n, avgl, len(t) dl, term, count(*) w, max(len(list_filter(t, lambda x: x = term))) tf FROM (SELECT *, unnest(q) term FROM ws) GROUP BY ALL",
    "wd": "SELECT *, count(*) OVER (PARTITION BY qid, docno, term) df FROM wq WHERE tf > 0",
}
WBM["wq"] = "SELECT qid, docno, window_idx, n, avgl, dl, term, count(*) w, max(tf) tf FROM (SELECT qid, docno, window_idx, n, avgl, len(t) dl, term, len(list_filter(t, lambda x: x = term)) tf FROM (SELECT *, unnest(q) term FROM ws)) GROUP BY qid, docno, window_idx, n, avgl, dl, term"


@register("window_bm25", "SELECT qid, docno, window_idx, coalesce(s, 0.0) bm25 FROM wins LEFT JOIN (SELECT qid, docno, window_idx, round(sum(w * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgl))), 6) s FROM wd GROUP BY qid, docno, window_idx) USING (qid, docno, window_idx)", **WBM)
def _(f):
    rows = f.window_rows().join(f.topics(), "qid")
    out = lexical.grouped_bm25(rows, ["qid", "docno"], "window_idx", F.col("query"), F.col("window_text"))
    return out.select("qid", "docno", "window_idx", "bm25")


WBS = WBM | {
    "wbm": "SELECT qid, docno, window_idx, query, window_text, coalesce(s, 0.0) bm25 FROM wins LEFT JOIN (SELECT qid, docno, window_idx, round(sum(w * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgl))), 6) s FROM wd GROUP BY qid, docno, window_idx) USING (qid, docno, window_idx)",
    "wro": f"SELECT qid, docno, window_idx, count(*) OVER (PARTITION BY qid, docno) n, row_number() OVER (PARTITION BY qid, docno ORDER BY bm25 DESC NULLS LAST, window_idx) a, row_number() OVER (PARTITION BY qid, docno ORDER BY {overlap('query', 'window_text')} DESC NULLS LAST, window_idx) b FROM wbm",
}


@register("window_shortlist", "SELECT qid, docno, window_idx FROM (SELECT qid, docno, window_idx, n, row_number() OVER (PARTITION BY qid, docno ORDER BY 1.0 / (60 + a) + 1.0 / (60 + b) DESC, window_idx) r FROM wro) WHERE n <= 5 OR r <= 5", **WBS)
def _(f):
    rows = f.window_rows().join(f.topics(), "qid")
    return windows.shortlist(rows, 5).select("qid", "docno", "window_idx")


@register("window_maxpool", "SELECT qid, docno, window_idx, ce_score, query_field FROM pooled")
def _(f):
    return windows.max_pool(f.two_fields()).select("qid", "docno", "window_idx", "ce_score", "query_field")


@register("window_doc_run", "SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY s DESC NULLS LAST, docno) rank, s score FROM (SELECT qid, docno, max(ce_score) s FROM pooled GROUP BY qid, docno)")
def _(f):
    return windows.document_run(windows.max_pool(f.two_fields())).select("qid", "docno", *big("rank"), "score")


@register("window_select_disjoint", "SELECT qid, docno, window_idx, place, chosen, overlap FROM chosen")
def _(f):
    return windows.choose(windows.max_pool(f.two_fields())).select("qid", "docno", "window_idx", *big("place"), "chosen", *big("overlap"))


@register("window_pool_parent", "SELECT qid, docno, chunk_id, window_idx, place FROM (SELECT qid, split_part(docno, '#', 1) docno, docno chunk_id, window_idx, row_number() OVER (PARTITION BY qid, split_part(docno, '#', 1) ORDER BY ce_score DESC NULLS LAST, window_idx, docno) place FROM chosen WHERE chosen) WHERE place <= 2")
def _(f):
    return windows.pool_chunks(windows.choose(windows.max_pool(f.two_fields())), 2).select("qid", "docno", "chunk_id", "window_idx", *big("place"))


@register("window_embed", "SELECT qid, docno, window_idx, ce_score, query_field FROM chosen WHERE chosen")
def _(f):
    record = windows.embedded(windows.choose(windows.max_pool(f.two_fields())))
    return windows.unembedded(record).select("qid", "docno", "window_idx", "ce_score", "query_field")


@register("window_stats", """SELECT count(*) doc_pairs, count(*) FILTER (kept >= 2) final_two, count(*) FILTER (kept = 1) final_one, count(*) FILTER (coalesce(kept, 0) = 0) fallback, count(*) FILTER (two = 1) ranked_two, count(*) FILTER (overlap > 0) dropped_second, CAST(coalesce(sum(overlap), 0) AS BIGINT) overlap_sum FROM (SELECT qid, docno FROM lex WHERE rank <= 30) LEFT JOIN
    (SELECT qid, docno, sum(CAST(chosen AS INTEGER)) kept, max(CAST(place = 2 AS INTEGER)) two, max(overlap) overlap FROM chosen GROUP BY qid, docno) USING (qid, docno)""")  # fmt: skip
def _(f):
    return windows.stats(f.lexical_run(30), windows.choose(windows.max_pool(f.two_fields()))).select("doc_pairs", "final_two", "final_one", "fallback", "ranked_two", "dropped_second", "overlap_sum")


RATES = "SELECT round(two / n, 9) rate_two, round(one / n, 9) rate_one, round(none / n, 9) rate_fallback, CASE WHEN r2 > 0 THEN round(o / r2, 9) ELSE 0.0 END rate_dropped, CASE WHEN r2 > 0 THEN round(o / r2, 9) ELSE 0.0 END rate_overlapping, o overlapping, one under_two, CASE WHEN o > 0 THEN round(s / o, 9) END overlap_mean FROM (SELECT count(*) n, count(*) FILTER (kept >= 2) two, count(*) FILTER (kept = 1) one, count(*) FILTER (coalesce(kept, 0) = 0) AS none, count(*) FILTER (two = 1) r2, count(*) FILTER (overlap > 0) o, sum(overlap) s FROM (SELECT qid, docno FROM lex WHERE rank <= 30) LEFT JOIN (SELECT qid, docno, sum(CAST(chosen AS INTEGER)) kept, max(CAST(place = 2 AS INTEGER)) two, max(overlap) overlap FROM chosen GROUP BY qid, docno) USING (qid, docno))"


@register("window_rates", RATES)
def _(f):
    out = windows.stats(f.lexical_run(30), windows.choose(windows.max_pool(f.two_fields())))
    return out.select("rate_two", "rate_one", "rate_fallback", "rate_dropped", "rate_overlapping", "overlapping", "under_two", "overlap_mean")


# Evidence

DOCCTX = r"SELECT qid, rank - 1 pos, docno || '-1' id, docno doc_id, trim(regexp_replace(regexp_replace(array_to_string(list_filter([nullif(trim(title), ''), nullif(regexp_replace(text, '^\s+|\s+$', '', 'g'), '')], lambda x: x IS NOT NULL), '. '), '[\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]', ' ', 'g'), ' {2,}', ' ', 'g')) AS text FROM lex JOIN corpus USING (docno) WHERE rank <= 5"


def records_of(f: Fixtures) -> DataFrame:
    queries = f.topics().select(F.col("qid").alias("query_id"), F.col("query").alias("query_text"), F.lit("x").alias("ideal_answer"))
    return evidence.records(queries, f.lexical_run(), 5)


@register("post_rerank_record", "SELECT qid query_id, query query_text, coalesce(d, '') doc_ids FROM topics LEFT JOIN (SELECT qid, string_agg(docno, ',' ORDER BY rank) d FROM lex WHERE rank <= 5 GROUP BY qid) USING (qid)")
def _(f):
    return records_of(f).select("query_id", "query_text", F.array_join("doc_ids", ",").alias("doc_ids"))


@register("doc_contexts", "SELECT qid, pos, id, doc_id, md5(text) h FROM docctx", docctx=DOCCTX)
def _(f):
    return evidence.document_contexts(records_of(f), f.corpus()).select("qid", *big("pos"), "id", "doc_id", F.md5("text").alias("h"))


SNIP = r"SELECT qid, docno, trim(regexp_replace(regexp_replace(array_to_string(coalesce(w, s), '. '), '[\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]', ' ', 'g'), ' {2,}', ' ', 'g')) AS text, w IS NULL fallback FROM (SELECT qid, docno FROM lex WHERE rank <= 25) JOIN sents USING (docno) LEFT JOIN (SELECT qid, docno, flatten(array_agg(list_slice(s, sent_start + 1, sent_start + 3) ORDER BY place)) w FROM chosen JOIN sents USING (docno) WHERE chosen GROUP BY qid, docno) USING (qid, docno)"


@register("snippet_contexts", "SELECT qid, docno doc_id, md5(text) h, fallback FROM snip", snip=SNIP)
def _(f):
    pairs = f.lexical_run(25).select("qid", "docno", (F.col("rank") - 1).alias("pos"))
    docs = f.corpus().select("docno", F.lit("").alias("title"), text.sentences(F.col("text")).alias("sentences"))
    pooled = windows.pool_chunks(windows.choose(windows.max_pool(f.two_fields())), 2)
    return evidence.snippet_contexts(pairs, docs, pooled).select("qid", "doc_id", F.md5("text").alias("h"), "fallback")


@register("evidence_block", r"SELECT qid, md5(string_agg('[' || id || '],' || CASE WHEN t <> '' THEN chr(10) || t ELSE '' END, chr(10) || chr(10) ORDER BY pos)) h FROM (SELECT qid, pos, id, CASE WHEN length(x) > 200 THEN substr(x, 1, 200) || '...' ELSE x END t FROM (SELECT qid, pos, id, regexp_replace(text, '^\s+|\s+$', '', 'g') x FROM docctx)) WHERE pos < 3 GROUP BY qid", docctx=DOCCTX)
def _(f):
    rows = evidence.collected(evidence.document_contexts(records_of(f), f.corpus()), "document")
    return rows.select(F.col("query_id").alias("qid"), F.md5(evidence.evidence_block(F.col("contexts"), 3, 200)).alias("h"))


@register("prompts", "SELECT qid, md5('Answer in JSON.' || chr(10) || chr(10) || 'Question (type=yesno):' || chr(10) || query || chr(10) || 'none') h FROM topics")
def _(f):
    q = evidence.prompt("{SCHEMA_BLOCK}{QUESTION_HEADER}{QUESTION}\n{EVIDENCE_BLOCK}", evidence.schema_of(F.lit("YesNo"), {"default": "", "yesno": " Answer in JSON. "}), F.lit("YesNo"), F.col("query"), F.lit("none"))
    return f.topics().select("qid", F.md5(q).alias("h"))


# Evaluation

EVAL = {
    "jrun": "SELECT l.qid, l.docno, l.rank, CAST(g.docno IS NOT NULL AS INTEGER) rel FROM lex l LEFT JOIN gold g USING (qid, docno)",
    "jhit": "SELECT *, sum(rel) OVER (PARTITION BY qid ORDER BY rank) hits FROM jrun",
    "golds": "SELECT qid, count(docno) n_gold FROM topics LEFT JOIN gold USING (qid) GROUP BY qid",
    "evalq": """SELECT qid, n_gold, CASE WHEN n_gold > 0 THEN sum(CASE WHEN rel = 1 AND rank <= 10 THEN hits / rank ELSE 0.0 END) / least(n_gold, 10) ELSE 0.0 END ap, coalesce(1.0 / min(CASE WHEN rel = 1 AND rank <= 10 THEN rank END), 0.0) rr, coalesce(max(CASE WHEN rel = 1 AND rank <= 10 THEN 1.0 END), 0.0) success,
        CASE WHEN n_gold > 0 THEN sum(CASE WHEN rank <= 10 THEN rel ELSE 0 END) / n_gold ELSE 0.0 END recall, CASE WHEN n_gold > 0 THEN sum(CASE WHEN rank <= 50 THEN rel ELSE 0 END) / n_gold ELSE 0.0 END r_50 FROM golds LEFT JOIN jhit USING (qid) GROUP BY qid, n_gold""",
}
METRICS = ("ap", "rr", "success", "recall", "r_50")


def evaluated(f: Fixtures) -> DataFrame:
    return evaluate.per_query(f.lexical_run(), f.gold(), f.topics())


@register("bm25_eval_per_query", f"SELECT qid, n_gold, {', '.join(f'round({m}, 9) {m}' for m in METRICS)} FROM evalq", **EVAL)
def _(f):
    return evaluated(f).select("qid", *big("n_gold"), *(r9(m, m) for m in METRICS))


@register("eval_summary", "SELECT count(*) n_queries, round(avg(ap), 9) map, round(exp(avg(ln(greatest(ap, 1e-5)))), 9) gmap, round(avg(rr), 9) mrr, round(avg(success), 9) success, round(avg(recall), 9) mean_r, round(avg(r_50), 9) mean_r_50 FROM evalq", **EVAL)
def _(f):
    return evaluate.summary(evaluated(f)).select("n_queries", *(r9(c, c) for c in ("map", "gmap", "mrr", "success", "mean_r", "mean_r_50")))


@register("eval_recall_points", "SELECT k, round(avg(r), 9) mean_r, round(avg(CAST(n < k AS INTEGER)), 9) shortfall, round(avg(least(n, k)), 9) mean_keff FROM (SELECT qid, k, count(docno) n, CASE WHEN n_gold > 0 THEN sum(CASE WHEN rank <= k THEN rel ELSE 0 END) / n_gold ELSE 0.0 END r FROM golds CROSS JOIN (VALUES (5), (50), (200)) t(k) LEFT JOIN jhit USING (qid) GROUP BY qid, k, n_gold) GROUP BY k", **EVAL)
def _(f):
    out = evaluate.recall_points(f.lexical_run(), f.gold(), (5, 50, 200), f.topics())
    return out.select("k", r9("mean_r", "mean_r"), r9("shortfall", "shortfall"), r9("mean_keff", "mean_keff"))


@register("map_at_ks", "SELECT k, round(avg(a), 9) map FROM (SELECT qid, k, sum(CASE WHEN rel = 1 AND rank <= k THEN hits / rank ELSE 0.0 END) / least(n_gold, k) a FROM golds JOIN jhit USING (qid) CROSS JOIN (VALUES (1), (10), (100)) t(k) WHERE n_gold > 0 GROUP BY qid, k, n_gold) GROUP BY k", **EVAL)
def _(f):
    return evaluate.map_curve(f.lexical_run(), f.gold(), (1, 10, 100)).select("k", r9("map", "map"))


@register("zero_recall", "SELECT DISTINCT qid FROM gold WHERE qid NOT IN (SELECT qid FROM jrun WHERE rel = 1 AND rank > 2 AND rank <= 10)", **EVAL)
def _(f):
    late = ranking.ranked(f.lexical_run().where("rank > 2"), F.asc("rank"))  # many miss their gold without the first two
    return evaluate.zero_recall(late, f.gold(), 8)


@register("eval_chunks", "SELECT qid, sum(rel) hits FROM (SELECT DISTINCT qid, p docno FROM chunkrun) LEFT JOIN (SELECT qid, docno, 1 rel FROM gold) USING (qid, docno) GROUP BY qid")
def _(f):
    return evaluate.judged(f.chunk_run(), f.gold()).groupBy("qid").agg(F.sum("rel").cast("double").alias("h")).select("qid", F.when(F.col("h") > 0, F.col("h")).cast("bigint").alias("hits"))


@register("different_qids_eval", "SELECT qid, round(ap, 9) ap FROM evalq WHERE CAST(qid AS BIGINT) % 2 = 0 AND qid IN (SELECT qid FROM shared)", **EVAL)
def _(f):
    different, _legs = evaluate.comparable({"lex": f.lexical_run(), "even": f.shared_run().where("cast(qid as bigint) % 2 = 0")})
    run = f.lexical_run().join(different, "qid", "left_semi")
    return evaluate.per_query(run, f.gold(), different).select("qid", r9("ap", "ap"))


@register("eval_deltas", "SELECT qid, round(r_50 - recall, 9) d FROM evalq", **EVAL)
def _(f):
    rows = evaluated(f)
    out = evaluate.deltas(rows.select("qid", F.col("r_50").alias("recall")), rows.select("qid", "recall"), "qid", ["recall"])
    return out.select("qid", r9("delta_recall", "d"))


# Distillation

@register("claims_dedup", "SELECT qid, context_id, source, turn, md5(text) h FROM claims1")
def _(f):
    return distil.claims(f.cache()).select("qid", "context_id", *big("source", "turn"), F.md5("text").alias("h"))


PACK = "SELECT *, row_number() OVER (PARTITION BY qid ORDER BY turn, source) place FROM claims1"


@register("claims_slots", "SELECT qid, context_id, place, md5(text) h FROM pk WHERE place <= 8", pk=PACK)
def _(f):
    return distil.packed(distil.claims(f.cache()), slots=8).select("qid", "context_id", *big("place"), F.md5("text").alias("h"))


@register("claims_budget", r"SELECT qid, context_id, place FROM (SELECT *, coalesce(sum(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))) OVER (PARTITION BY qid ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) b FROM pk) WHERE b < 60", pk=PACK)
def _(f):
    return distil.packed(distil.claims(f.cache()), budget=60).select("qid", "context_id", *big("place"))


FACET = {
    "lab": "SELECT *, place % 4 label FROM (" + PACK + ") WHERE place <= 12",
    "fac": "SELECT qid, label, count(*) n, min(place) f, arg_min(context_id, o) id, arg_min(doc_id, o) doc_id, arg_min(text, o) lead, max(ce_score) ce_score, string_agg(text, ' ' ORDER BY o) joined, string_agg(context_id, ',' ORDER BY o) members, string_agg(DISTINCT doc_id, ',') docs FROM (SELECT *, row_number() OVER (PARTITION BY qid, label ORDER BY ce_score DESC NULLS LAST, place) o FROM lab) GROUP BY qid, label",
}


@register("facet_slots", r"SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY ce_score DESC NULLS LAST, f) place, id, doc_id, CASE WHEN n >= 2 THEN 'summary' ELSE 'claim' END kind, n n_members, members, md5(CASE WHEN n >= 2 THEN regexp_replace(regexp_replace(joined, '(?is)^\s*(?:here(?:''s| is| are)|the combined|combined statement|sure[,:]?|below is)\b[^:]*:\s*', ''), '^\s+|\s+$', '', 'g') ELSE lead END) h FROM fac", **FACET)
def _(f):
    rows = distil.packed(distil.claims(f.cache()), slots=12).withColumn("label", F.col("place") % 4)
    out = distil.facet_slots(rows)
    return out.select("qid", *big("place"), "id", "doc_id", "kind", *big("n_members"), F.array_join("member_ids", ",").alias("members"), F.md5("text").alias("h"))


@register("facet_clusters")
def _(f):
    rows = f.table("embeddings").select(F.expr("cast(floor(vec_id / 200) as string)").alias("qid"), F.col("vec_id").cast("int").alias("place"), F.col("embedding").cast("array<double>").alias("vector"))
    return distil.facets(rows, distance=0.9).select("qid", "place", "label")


@register("claim_requests", "SELECT qid, pos, md5(text) h FROM (SELECT *, row_number() OVER (PARTITION BY qid, text ORDER BY pos) n FROM ctx WHERE pos < 30) WHERE n = 1")
def _(f):
    return distil.claim_requests(f.contexts()).select("qid", *big("pos"), F.md5("text").alias("h"))


# Attribution

@register("attr_trivial", "SELECT ans.qid, sent, cite, doc_id FROM ans JOIN (SELECT qid, doc_id, row_number() OVER (PARTITION BY qid ORDER BY p) cite FROM (SELECT qid, doc_id, min(pos) p FROM evid JOIN slots USING (qid, id) GROUP BY qid, doc_id)) r ON r.qid = ans.qid")
def _(f):
    return attribute.trivial(f.answers(), f.evidence(), f.slots()).select("qid", *big("sent", "cite"), "doc_id")


LIN = {
    "toka": f"SELECT qid, sent, {CT.format('text')} s FROM ans",
    "st": f"SELECT qid, id, pos, doc_id, {CT.format('text')} t, min(pos) OVER (PARTITION BY qid, doc_id) f FROM evid JOIN slots USING (qid, id)",
    "pr": "SELECT toka.qid, sent, pos, doc_id, f, CASE WHEN len(t) > 0 THEN len(list_intersect(s, t)) / len(t) ELSE 0.0 END share, CASE WHEN len(t) > 0 THEN len(list_intersect(s, t)) ELSE 0 END num FROM toka JOIN st ON toka.qid = st.qid",
    "bd": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid, sent, doc_id ORDER BY share DESC, num DESC) k FROM pr) WHERE k = 1",
    "ok": "SELECT *, share >= 0.5 AND num >= 2 ok, bool_or(share >= 0.5 AND num >= 2) OVER (PARTITION BY qid, sent) a, row_number() OVER (PARTITION BY qid, sent ORDER BY share DESC, num DESC, f) r FROM bd",
}


@register("attr_lineage_lex", "SELECT qid, sent, row_number() OVER (PARTITION BY qid, sent ORDER BY share DESC, num DESC, f) cite, doc_id FROM ok WHERE ok.ok OR (NOT a AND r = 1)", **LIN)
def _(f):
    return attribute.lineage(f.answers(), f.evidence(), f.slots()).select("qid", *big("sent", "cite"), "doc_id")


DESC = {k: LIN[k] for k in ("toka",)} | {
    "fs": f"SELECT qid, pos, id, doc_id, {CT.format('text')} t FROM evid JOIN slots USING (qid, id)",
    "fp": "SELECT toka.qid, sent, s, pos, doc_id, CASE WHEN len(t) > 0 THEN len(list_intersect(s, t)) / len(t) ELSE 0.0 END share, CASE WHEN len(t) > 0 THEN len(list_intersect(s, t)) ELSE 0 END num FROM toka JOIN fs ON toka.qid = fs.qid",
    "fk": "SELECT *, share >= 0.5 AND num >= 2 ok, bool_or(share >= 0.5 AND num >= 2) OVER (PARTITION BY qid, sent) a, row_number() OVER (PARTITION BY qid, sent ORDER BY share DESC, num DESC, pos) r FROM fp",
    "fc": "SELECT qid, sent, doc_id, min((-share, -num, pos)) o FROM fk WHERE ok OR (NOT a AND r = 1) GROUP BY qid, sent, doc_id",
}


@register("attr_descent_lex", "SELECT qid, sent, row_number() OVER (PARTITION BY qid, sent ORDER BY o) cite, doc_id FROM fc", **DESC)
def _(f):
    members = f.slots().select("qid", F.col("id").alias("context_id"), F.array("text").alias("claims"))
    return attribute.descent(f.answers(), f.evidence(), f.slots(), members).select("qid", *big("sent", "cite"), "doc_id")


DESC_RRF = DESC | {
    "fp": DESC["fp"].replace(" share,", " share, CASE WHEN len(s) > 0 THEN len(list_intersect(s, t)) / len(s) END near,", 1),
    "fr": "SELECT *, share >= 0.5 AND num >= 2 ok, bool_or(share >= 0.5 AND num >= 2) OVER (PARTITION BY qid, sent) a, row_number() OVER (PARTITION BY qid, sent ORDER BY share DESC, num DESC, pos) - 1 x, row_number() OVER (PARTITION BY qid, sent ORDER BY near DESC NULLS LAST, pos) - 1 y FROM fp",
    "fk": "SELECT *, row_number() OVER (PARTITION BY qid, sent ORDER BY 1.0 / (60 + x) + 1.0 / (60 + y) DESC, pos) r FROM fr",
}


@register("attr_descent_rrf", "SELECT * FROM (SELECT qid, sent, row_number() OVER (PARTITION BY qid, sent ORDER BY o) cite, doc_id FROM fc) WHERE cite <= 2", **DESC_RRF)
def _(f):
    members = f.slots().select("qid", F.col("id").alias("context_id"), F.array("text").alias("claims"))
    return attribute.descent(f.answers(), f.evidence(), f.slots(), members, most=2, rerank="rrf", cosine=rerank.overlap_score).select("qid", *big("sent", "cite"), "doc_id")


RRF_LIN = {
    "toka": f"SELECT qid, sent, text sentence, {CT.format('text')} s FROM ans",
    "st": f"SELECT qid, id, pos, doc_id, text slot, {CT.format('text')} t, min(pos) OVER (PARTITION BY qid, doc_id) f FROM evid JOIN slots USING (qid, id)",
    "pr": "SELECT toka.qid, sent, pos, doc_id, f, CASE WHEN len(t) > 0 THEN len(list_intersect(s, t)) / len(t) ELSE 0.0 END share, CASE WHEN len(t) > 0 THEN len(list_intersect(s, t)) ELSE 0 END num, CASE WHEN len(s) > 0 THEN len(list_intersect(s, t)) / len(s) END near FROM toka JOIN st ON toka.qid = st.qid",
    "bd": "SELECT qid, sent, doc_id, f, max((share, num)) sn, max(near) near FROM pr GROUP BY qid, sent, doc_id, f",
    "ro": "SELECT *, row_number() OVER (PARTITION BY qid, sent ORDER BY sn[1] DESC, sn[2] DESC, f) - 1 a, row_number() OVER (PARTITION BY qid, sent ORDER BY near DESC NULLS LAST, f) - 1 b FROM (SELECT qid, sent, doc_id, f, [sn[1], sn[2]] sn, near FROM (SELECT qid, sent, doc_id, f, [struct_extract(sn, 1), struct_extract(sn, 2)] sn, near FROM bd))",
}


@register("attr_lineage_blend", "SELECT qid, sent, cite, doc_id FROM (SELECT qid, sent, doc_id, row_number() OVER (PARTITION BY qid, sent ORDER BY 0.4 * sn[1] + 0.6 * near DESC NULLS LAST, f) cite FROM ro) WHERE cite <= 2", **RRF_LIN)
def _(f):
    return attribute.lineage(f.answers(), f.evidence(), f.slots(), rerank="blend", cosine=rerank.overlap_score, most=2).select("qid", *big("sent", "cite"), "doc_id")


@register("attr_lineage_rrf", "SELECT qid, sent, cite, doc_id FROM (SELECT qid, sent, doc_id, row_number() OVER (PARTITION BY qid, sent ORDER BY 1.0 / (60 + a) + 1.0 / (60 + b) DESC, f) cite FROM ro) WHERE cite <= 2", **RRF_LIN)
def _(f):
    return attribute.lineage(f.answers(), f.evidence(), f.slots(), rerank="rrf", cosine=rerank.overlap_score, most=2).select("qid", *big("sent", "cite"), "doc_id")


@register("sentence_split")
def _(f):
    from trovespark.functions.answers import answer_sentences

    return f.turns().where("role = 'assistant'").select("qid", *big("turn"), F.size(answer_sentences("text")).cast("bigint").alias("n"))


# Generation

@register("answers_mock", "SELECT qid query_id, 'Mock answer.' ideal_answer, 0 n_evidence, CAST(NULL AS VARCHAR) error FROM topics")
def _(f):
    rows = f.topics().select(F.col("qid").alias("query_id"), F.lit("").alias("query_type"), F.col("query").alias("prompt"), F.lit(1).alias("n_contexts"))
    return generate.answers(rows).select("query_id", "ideal_answer", F.size("evidence_ids").alias("n_evidence"), "error")


@register("claims_mock", """SELECT id, 'Fact ' || substr(md5('"claims" ' || text), 1, 8) || ' is the first of two.' AS first FROM ctx""")
def _(f):
    from trovespark.functions.answers import parsed_claims

    told = generate.replied(f.contexts().select("id", F.concat(F.lit('"claims" '), "text").alias("prompt")))
    return told.select("id", parsed_claims("reply")[0].alias("first"))


@register("rescue_merge", "SELECT qid query_id, 'Mock answer.' ideal_answer, CAST(NULL AS VARCHAR) error FROM topics")
def _(f):
    rows = f.topics().select(F.col("qid").alias("query_id"), F.lit("").alias("query_type"), F.col("query").alias("prompt"), F.lit(1).alias("n_contexts"))
    done = generate.answers(rows)
    bad = F.col("query_id").cast("bigint") % 3 == 0
    broken = done.withColumn("error", F.when(bad, "HTTP 504").otherwise(F.col("error"))).withColumn("ideal_answer", F.when(~bad, F.col("ideal_answer")))
    return generate.rescued(broken, only_timeouts=True).select("query_id", "ideal_answer", "error")


@register("answer_validate", "SELECT qid, CASE WHEN CAST(qid AS BIGINT) % 2 = 0 THEN 'yes' END exact, CAST(qid AS BIGINT) % 2 = 1 failed FROM topics")
def _(f):
    raw = F.concat(F.lit('Sure: {"ideal_answer": "a {b} \\"c\\"", "evidence_ids": ["x"], "exact_answer": '), F.when(F.col("qid").cast("bigint") % 2 == 0, '"Yes"').otherwise("3"), F.lit("}"))
    return f.topics().select("qid", parsed_answer(raw, F.lit("yesno")).alias("a")).select("qid", F.col("a.exact_yesno").alias("exact"), F.col("a.error").isNotNull().alias("failed"))


# Reports

LOW = EVAL | {"rc": "SELECT qid, recall FROM evalq WHERE n_gold > 0", "lw": "SELECT * FROM rc WHERE recall = 0 OR recall <= (SELECT quantile_cont(recall, 0.1) FROM rc)"}


def recalls(f: Fixtures) -> DataFrame:
    return evaluated(f).where("n_gold > 0").select("qid", "recall", "r_50")


@register("low_recall", "SELECT qid, query, round(recall, 6) recall, n_gold n_rel, (SELECT string_agg(docno, ', ' ORDER BY docno) FROM gold WHERE gold.qid = lw.qid) gold_ids FROM lw JOIN topics USING (qid) JOIN golds USING (qid)", **LOW)
def _(f):
    low = reports.low_recall(recalls(f).select("qid", "recall"))
    return reports.low_recall_report(low, f.topics(), f.gold()).select("qid", "query", "recall", *big("n_rel"), "gold_ids")


@register("question_report", "SELECT t.qid, n_gold n_rel, round(CASE WHEN n_gold > 0 THEN r_50 END, 9) hybrid_recall, round(CASE WHEN n_gold > 0 THEN recall END, 9) rerank_recall FROM topics t JOIN evalq USING (qid)", **EVAL)
def _(f):
    rows = recalls(f)
    out = reports.question_report(f.topics(), f.gold(), rows.select("qid", F.col("r_50").alias("recall")), rows.select("qid", "recall"))
    return out.select("qid", *big("n_rel"), r9("hybrid_recall", "hybrid_recall"), r9("rerank_recall", "rerank_recall"))


@register("compare_summary", "SELECT m method, round(avg(v), 9) recall FROM (SELECT 'at10' m, recall v FROM evalq UNION ALL SELECT 'at50', r_50 FROM evalq) GROUP BY m", **EVAL)
def _(f):
    rows = evaluated(f)
    both = readers.metric_tables({"at10": rows.select("recall"), "at50": rows.select(F.col("r_50").alias("recall"))}).withColumn("method", F.col("label"))
    return reports.comparison(reports.by_label(both, ["recall"]).select("method", r9("recall", "recall")), ["method", "recall"])


@register("gold_titles", "SELECT qid, docno, title FROM gold JOIN corpus USING (docno)")
def _(f):
    return reports.with_titles(f.gold(), f.corpus()).select("qid", "docno", "title")


RERANK_TEXT = overlap("query", "trim(concat_ws(' ', nullif(trim(title), ''), nullif(trim(text), '')))")
ROUTED = RERANKED.replace(overlap("query", "text"), RERANK_TEXT)


@register("document_route", "SELECT qid, docno, rank FROM fz", rr=ROUTED, fz=rrf_sql("rr", "lex200", 0.8, 0.19999999999999996, 60, 50, 50, scope="WHERE qid IN (SELECT qid FROM rr)"))
def _(f):
    from trovespark.plans.config import Settings
    from trovespark.plans.route import document_route

    return document_route(f.corpus(), f.topics(), Settings(candidates=100, k_lexical=200), index=f.index()).select("qid", "docno", *big("rank"))


@register("hybrid_route", "SELECT qid, docno, rank FROM fz WHERE rank <= 60", dn="SELECT qid, docno, rank FROM (SELECT t.qid, d.docno, row_number() OVER (PARTITION BY t.qid ORDER BY d.score DESC, d.docno) rank FROM (SELECT qid, CAST(CAST(qid AS BIGINT) % 5 * 100 AS VARCHAR) v FROM topics) t JOIN dense d ON d.qid = t.v) WHERE rank <= 40", fz=rrf_sql("lex", "dn", 1.0, 1.0, 60, 50, 40))
def _(f):
    from trovespark.plans.config import Settings
    from trovespark.plans.route import hybrid

    own = f.topics().select("qid", (F.col("qid").cast("bigint") % 5 * 100).cast("string").alias("v"))
    asked = own.join(f.vectors().select(F.col("docno").alias("v"), "vector"), "v").select("qid", "vector")
    settings = Settings(k_lexical=50, k_dense=40, fusion_cap=60)
    return hybrid(f.corpus(), f.topics(), settings, f.vectors(), asked, f.index()).select("qid", "docno", *big("rank"))


def queries() -> dict[str, Query]:
    from trovespark.plans import catalog_files, catalog_rules  # noqa: F401 - they register their queries

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
