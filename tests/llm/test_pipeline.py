import re

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from trovespark.llm import bytebpe, mixing, pii, setsketch

LIB = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bytebpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_stages_against_a_plain_version(spark, tmp_path):
    rng = np.random.default_rng(2)
    words = {"en": "the of and to in that house water people".split(), "de": "der die und das nicht haus wasser leute".split()}
    rows = []
    for i in range(240):
        lang = "en" if i % 3 else "de"
        rows.append((i, " ".join(rng.choice(words[lang], 30 + i % 40)) + f" id{i} a{i}@mail.example.com", lang, f"s{i % 4}", 0))
    rows += [(1000 + i, rows[i][1].replace("mail.", "post."), rows[i][2], "copies", 0) for i in range(20)]
    rows += [(2000, None, "en", "s1", 0), (2001, "12 34", None, None, 5), (2002, rows[5][1], None, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    stages, docs = [], spark.read.parquet(str(tmp_path / "documents.parquet"))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / f"{i}.parquet"))
        docs = spark.read.parquet(str(tmp_path / f"{i}.parquet"))
        stages.append(docs.collect())
        if i < 4:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    assert {r.doc_id for r in stages[0]} == {i for i, *_ in rows} - {2000, 2001}
    assert {r.lang for r in stages[0] if r.doc_id < 240} == {"en", "de"}
    texts = {i: t for i, t, *_ in rows}
    sets = {i: shingles(texts[i]) for i in texts if i not in (2000, 2001)}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    assert {r.doc_id for r in stages[1]} == {i for i in sets if top(i) == i}
    assert {(r.doc_id, r.text, r.n_chars) for r in stages[2]} == {(r.doc_id, t := pii.redacted(r.text, pii.spans(r.text)[1]), len(t)) for r in stages[1]}
    assert all("<EMAIL>" in r.text for r in stages[2])
    size = {r.doc_id: len(r.text.split()) for r in stages[2]}
    total = {}
    for r in stages[2]:
        total[r.source] = total.get(r.source, 0) + size[r.doc_id]
    taken = dict.fromkeys(total, 0)
    for r in stages[3]:
        taken[r.source] += size[r.doc_id]
    want = mixing.shares(total)
    assert all(abs(taken[s] - want[s]) <= max(size.values()) for s in total)
    assert {(r.doc_id, r.text) for r in stages[3]} <= {(r.doc_id, r.text) for r in stages[2]}
    clean = {r.doc_id: r.text for r in stages[2]}
    assert sorted((r.doc_id, r.n_tokens) for r in stages[4]) == sorted((r.doc_id, len(LIB.encode_ordinary(clean[r.doc_id]))) for r in stages[3])
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(tuple, stages[4]))


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES)
def test_stage_takes_empty_tables_and_nulls(spark, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra int"
    assert stage[1](spark, spark.createDataFrame([], schema), "").count() == 0
    odd = spark.createDataFrame([(None, None, None, None, None, 1), (1, "", None, None, 0, 1), (1, "a b", "en", None, 3, 1), (1, "a b", "en", None, 3, 1)], schema)
    stage[1](spark, odd, "").collect()


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES)
def test_stage_ignores_columns_that_clash(spark, stage):
    rows = [(i, f"the water of the house and people number{'x' * (i % 9)} mail{i}@host.example.com", "en", f"s{i % 3}", 0) for i in range(40)]
    rows += [(3, rows[3][1], "en", "s0", 0), (None, "water and people", "en", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    key = lambda found: sorted(map(str, map(tuple, found)))
    plain = key(stage[1](spark, df, "").collect())
    odd = df.selectExpr("*", "'other' as TEXT", "7 as Doc_Id", "'zz' as Lang", "'none' as SOURCE")
    assert key(stage[1](spark, odd, "").collect()) == plain and len(plain) > 0


def test_texts_are_not_dealt_to_leave_out_a_few_ids(spark, monkeypatch):
    """What goes is broadcast by its number of rows, whatever Spark estimates; above the bound the same rows stay."""
    rows = [(i, f"the water of the house and people by name{i // 3} or number{i // 3} at last", "en", "s", 0) for i in range(60)]
    rows += [(None, rows[0][1], "en", "s", 0), (4, rows[4][1], "en", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = []
        for bound in (1000, 10):
            monkeypatch.setattr(setsketch, "BROADCAST_IDS", bound)
            made = corpus_pipeline.near_duplicates(spark, df, "")
            plan = made._jdf.queryExecution().executedPlan().toString()
            assert ("SortMergeJoin" in plan) == (bound == 10)
            found.append(sorted(map(str, made.collect())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    kept = [(i, t) for i, t, *_ in rows if i is None or i % 3 == 0]
    assert found[0] == found[1] and len(found[0]) == len(kept)
