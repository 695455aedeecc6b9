import hashlib
import re

import numpy as np
import pytest
from trovespark.llm import spotsigs as S


def signed(text):
    words = re.findall(r"[^\W_]+", text.lower())
    marked = [(w, w in S.COMMON) for w in words]
    out = set()
    for i, (w, common) in enumerate(marked):
        if not common and i and marked[i - 1][1]:
            out.add((words[i - 1], w, next((x for x, c in marked[i + 1 :] if not c), "")))
    return out or {(a, b) for a, b in zip(words, [*words[1:], ""])} or ({text} if text else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "der", "la", "que", *[f"w{i}" for i in range(25)], "Été", "x-y."], n))


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (d, t) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        a, b, c = signed(t), signed(edited), signed(following)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), len(a), len(b), round(jaccard(a, b), 9), round(jaccard(a, c), 9)))
    return sorted(out, key=str)


@pytest.mark.parametrize("stretch", [1000, 7])
def test_report_by_brute_force(spark, monkeypatch, stretch):
    monkeypatch.setattr(S, "STRETCH_ROWS", stretch)
    rng = np.random.default_rng(4)
    rows = [(int(i), prose(rng, int(rng.integers(0, 60)))) for i in rng.choice(5000, 150, replace=False)]
    rows += [(7001, None), (7002, ""), (7003, "!! ?"), (7004, "nothing common here"), (7005, "😀 the cat sat 😀"), (rows[3][0], rows[3][1]), (rows[4][0], "another text"), (None, "no id"), (None, None), (10**15, "the far id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_chars", "2 as TEXT")
    got = S.edit_report(df).collect()
    count = lambda s: s.count(",") + 1 if s else 0
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, count(r.fingerprint), count(r.edited_fingerprint), round(r.near_edited, 9), round(r.near_next, 9)) for r in got), key=str) == expected(rows)
    prints = {}
    for r in got:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert len(prints[rows[3][0]]) == 1 and prints[7001] == prints[7002] == {""}
    assert S.edit_report(df.limit(0)).count() == 0


def test_one_row_follows_itself(spark):
    (r,) = S.edit_report(spark.createDataFrame([(5, "the big cat")], "doc_id long, text string")).collect()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"the big cat"[:6] + b"the b").hexdigest()


def test_near_pairs_by_brute_force(spark):
    rng, rows = np.random.default_rng(8), []
    for g in range(12):
        base = prose(rng, int(rng.integers(20, 150))).split()
        for _ in range(6):
            copy = list(base)
            for _ in range(int(rng.integers(0, 4))):
                copy[rng.integers(0, len(copy))] = f"z{rng.integers(0, 99)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(900, None), (901, ""), (902, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    pairs, membership = S.near_pairs(df, 0.7)
    klass = {r.doc_id: r["class"] for r in membership.collect()}
    sets = {d: signed(t) for d, t in rows if t}
    assert klass == {d: min(e for e in sets if sets[e] == sets[d]) for d in sets}
    reps = sorted(set(klass.values()))
    want = {(a, b): round(jaccard(sets[a], sets[b]), 9) for a in reps for b in reps if a < b and jaccard(sets[a], sets[b]) >= 0.7}
    assert {(r.a, r.b): round(r.likeness, 9) for r in pairs.collect()} == want and len(want) > 20


def test_plans_have_no_python(spark):
    plan = S.edit_report(spark.createDataFrame([(5, "the big cat")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_the_next_content_word_may_be_far_away(spark):
    near, far = "the cat " + "of the " * 20 + "dog", "the cat " + "of the " * 20 + "bird"
    rows = spark.createDataFrame([(1, near), (2, far)], "doc_id long, text string")
    got = {r.doc_id: set(r.signatures) for r in S.fingerprints(rows).collect()}
    assert len(got[1]) == 2 and not got[1] & got[2]


def test_rows_of_one_id_are_cut_into_stretches(spark, monkeypatch):
    monkeypatch.setattr(S, "STRETCH_ROWS", 20)
    rng = np.random.default_rng(6)
    rows = [(7, prose(rng, 12)) for _ in range(150)] + [(None, prose(rng, 12)) for _ in range(90)] + [(i, prose(rng, 12)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.edit_report(df).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted((str(d), n, h) for d, n, h, *_ in expected(rows))
    begun = S.fingerprints(df).withColumn("begins", S.opening(S.F.col("text")))
    sizes = [r["count"] for r in begun.groupBy(S._stretch(begun.select("doc_id", "begins"), 300)).count().collect()]
    assert max(sizes) < 60
