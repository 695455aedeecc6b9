"""The same inputs in SQL: named common table expressions, and a builder that puts those needed before a query."""

from __future__ import annotations

import re

TOK = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"
SENT = r"list_filter(list_transform(regexp_split_to_array(regexp_replace(coalesce({}, ''), '([.!?])\s+', '\1' || chr(10), 'g'), '\n+'), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '')"

TABLES = {
    "topics": "SELECT CAST(item_id AS VARCHAR) qid, text query FROM benchmark",
    "corpus": "SELECT CAST(doc_id AS VARCHAR) docno, split_part(text, chr(10), 1) title, text FROM documents",
    "chunks": "SELECT docno || '#' || lpad(CAST(i - 1 AS VARCHAR), 4, '0') docno, l[i] AS text FROM (SELECT docno, l, unnest(range(1, len(l) + 1)) i FROM (SELECT docno, string_split(text, chr(10)) l FROM corpus)) WHERE trim(l[i]) <> ''",
    "gold": "SELECT qid, docno FROM topics, corpus WHERE contains(text, query)",
    "qterms": f"SELECT qid, term, count(*) qtf FROM (SELECT qid, unnest({TOK.format('query')}) term FROM topics) GROUP BY qid, term",
    "doctok": f"SELECT docno, {TOK.format('text')} toks FROM corpus",
    "cstats": "SELECT count(*) n, avg(len(toks)) avgdl FROM doctok",
    "allpost": "SELECT term, docno, count(*) tf, max(dl) dl FROM (SELECT docno, len(toks) dl, unnest(toks) term FROM doctok) GROUP BY term, docno",
    "post": "SELECT * FROM allpost WHERE term IN (SELECT term FROM qterms)",
    "dfs": "SELECT term, count(*) df FROM post GROUP BY term",
    "lexscore": "SELECT qid, docno, round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) score FROM qterms JOIN dfs USING (term) JOIN post USING (term), cstats GROUP BY qid, docno",
    "lex200": "SELECT * FROM (SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docno) rank, score FROM lexscore) WHERE rank <= 200",
    "lex": "SELECT * FROM lex200 WHERE rank <= 100",
    "sharedscore": f"SELECT qid, docno, CAST(count(*) AS DOUBLE) score FROM (SELECT docno, unnest(list_distinct({TOK.format('text')})) term FROM corpus) JOIN qterms USING (term) GROUP BY qid, docno",
    "shared": "SELECT * FROM (SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docno) rank, score FROM sharedscore) WHERE rank <= 100",
    "chunkscore": f"SELECT qid, docno, CAST(count(*) AS DOUBLE) score FROM (SELECT docno, unnest(list_distinct({TOK.format('text')})) term FROM chunks) JOIN qterms USING (term) GROUP BY qid, docno",
    "chunkrun": "SELECT qid, docno, split_part(docno, '#', 1) p, rank, score FROM (SELECT qid, docno, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docno) rank, score FROM chunkscore) WHERE rank <= 60",
    "scores": f"SELECT qid, docno, CASE WHEN CAST(docno AS BIGINT) % 7 <> 0 THEN round(len(list_intersect(list_distinct({TOK.format('query')}), {TOK.format('text')})) / len(list_distinct({TOK.format('query')})), 6) END score FROM lex JOIN topics USING (qid) JOIN corpus USING (docno)",
    "vecs": "SELECT CAST(vec_id AS VARCHAR) docno, CAST(embedding AS DOUBLE[]) v, vec_id % 4 shard FROM embeddings",
    "qvecs": "SELECT CAST(vec_id AS VARCHAR) qid, CAST(embedding AS DOUBLE[]) q FROM embeddings WHERE vec_id % 100 = 0",
    "dense": "SELECT * FROM (SELECT qid, docno, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, docno) rank FROM (SELECT qid, docno, round(list_dot_product(q, v), 6) score FROM qvecs, vecs))",
    "sents": f"SELECT docno, {SENT.format('text')} s FROM corpus",
    "wins": f"""SELECT qid, docno, CAST(i AS INTEGER) window_idx, CAST(i AS INTEGER) sent_start, trim(array_to_string(list_slice(s, i + 1, i + 3), ' ')) window_text, query FROM
        (SELECT qid, docno, s, query, unnest(range(0, greatest(len(s) - 2, 1))) i FROM (SELECT qid, docno FROM lex WHERE rank <= 20) JOIN topics USING (qid) JOIN sents USING (docno) WHERE len(s) > 0)""",
    "winscore": f"SELECT qid, docno, window_idx, sent_start, window_text, round(len(list_intersect(list_distinct({TOK.format('query')}), {TOK.format('window_text')})) / len(list_distinct({TOK.format('query')})), 6) ce_score, 'query_text' query_field FROM wins",
    "fields": "SELECT * FROM winscore UNION ALL SELECT qid, docno, window_idx, sent_start, window_text, round(ce_score + CASE WHEN window_idx % 3 = 0 THEN 0.1 ELSE 0.0 END, 6), 'query_alt' FROM winscore",
    "pooled": "SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY qid, docno, window_idx ORDER BY ce_score DESC NULLS LAST, query_field NULLS LAST) n FROM fields) WHERE n = 1",
    "chosen": """SELECT *, place = 1 OR overlap = 0 chosen FROM (SELECT *, CASE WHEN place = 2 THEN greatest(0, 3 - abs(sent_start - best)) ELSE 0 END overlap FROM
        (SELECT *, row_number() OVER w place, first_value(sent_start) OVER w best FROM pooled WINDOW w AS (PARTITION BY qid, docno ORDER BY ce_score DESC NULLS LAST, window_idx)) WHERE place <= 2)""",
    "turns": "SELECT CAST(conv_id AS VARCHAR) qid, turn, role, text FROM conversations",
    "asked": "SELECT qid, arg_min(text, turn) query FROM turns WHERE role = 'user' GROUP BY qid",
    "ctx": f"SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY turn) - 1 pos, qid || '-' || turn id, 'd' || (turn % 3) doc_id, text, CASE WHEN turn % 5 <> 0 THEN round(len(list_intersect(list_distinct({TOK.format('query')}), {TOK.format('text')})) / len(list_distinct({TOK.format('query')})), 6) END ce_score FROM turns JOIN asked USING (qid) WHERE role = 'assistant'",
    "claimrows": r"SELECT qid, id context_id, doc_id, pos AS rank, ce_score, list_filter(SENTS, lambda s: len(list_filter(regexp_split_to_array(s, '\s+'), lambda w: w <> '')) >= 3) claims FROM ctx".replace("SENTS", SENT.format("text")),
    "claims1": r"""SELECT *, row_number() OVER (PARTITION BY qid, source ORDER BY p) turn FROM (SELECT *, row_number() OVER (PARTITION BY qid, k ORDER BY source, p) n FROM
        (SELECT qid, context_id, doc_id, rank, ce_score, source, p, claims[p] AS text, trim(regexp_replace(lower(claims[p]), '[^\p{L}\p{N}_]+', ' ', 'g')) k FROM
        (SELECT *, unnest(range(1, len(claims) + 1)) p FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY ce_score DESC NULLS LAST, rank, context_id) source FROM claimrows WHERE rank < 30))) WHERE k <> '') WHERE n = 1""",
    "slots": "SELECT qid, context_id || ':' || (p - 1) id, doc_id, claims[p] AS text FROM (SELECT *, unnest(range(1, len(claims) + 1)) p FROM claimrows)",
    "evid": "SELECT * FROM (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY id) pos FROM slots) WHERE pos <= 5",
    "ans": f"SELECT qid, i - 1 sent, s[i] AS text FROM (SELECT qid, s, unnest(range(1, len(s) + 1)) i FROM (SELECT qid, {SENT.format('answer')} s FROM (SELECT qid, arg_max(text, turn) answer FROM turns WHERE role = 'assistant' GROUP BY qid)))",
}


def sql(query: str, **own: str) -> str:
    """`query` behind the tables that it names, and those that they name."""
    known, order, seen = TABLES | own, [], set()

    def visit(text: str) -> None:
        for name in re.findall(r"[a-z_0-9]+", re.sub(r"'[^']*'", "''", text)):
            if name in known and name not in seen:
                seen.add(name)
                visit(known[name])
                order.append(name)

    visit(query)
    head = ",\n".join(f"{n} AS ({known[n]})" for n in order)
    return f"WITH {head}\n{query}" if head else query
