import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from trovespark.llm import setsketch as S
from trovespark.llm import words


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aAbÉé \t\n\x0b\x0c\r\x1c\xa0\x00.", max_size=12), max_size=5))
def test_words_by_regex(texts):
    numbers, starts = words.word_numbers(texts)
    want = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t in texts]
    assert np.diff(starts).tolist() == list(map(len, want))
    flat = [w for ws in want for w in ws]
    assert len(set(flat)) == len(set(numbers.tolist())) and len({(w, n) for w, n in zip(flat, numbers.tolist())}) == len(set(flat))


def random_set(rng, n):
    return np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))


def test_sketch_merges_and_estimates():
    rng = np.random.default_rng(3)
    a, b, c = (random_set(rng, n) for n in (700, 300, 500))
    ab, ac = np.union1d(a, b), np.union1d(a, c)
    assert (S.merged(S.registers(a), S.registers(b)) == S.registers(ab)).all()
    errors = []
    for _ in range(60):
        a, b, c = (random_set(rng, n) for n in (800, 100, 120))
        ab, ac = np.union1d(a, b), np.union1d(a, c)
        true = len(np.intersect1d(ab, ac)) / len(np.union1d(ab, ac))
        x, y = S.registers(ab).astype(int), S.registers(ac).astype(int)
        got = S.estimate(*(np.array([float(v)]) for v in ((x > y).sum(), (x < y).sum(), len(ab), len(ac))))[0]
        errors.append(got - true)
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.04
    assert S.registers(np.zeros(0, np.uint64)).sum() == 0


def brute(rows, width, percent=80):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        n = min(width, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set())
    root = {i: i for i, _ in rows if i is not None}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for x in range(len(rows)):
        for y in range(x):
            (i, _), (j, _), both = rows[x], rows[y], len(sets[x] & sets[y])
            if i is not None and j is not None and both and 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                i, j = top(i), top(j)
                root[max(i, j)] = min(i, j)
    return sorted(((i, len(s), None if i is None else top(i), None if i is None else top(i) == i) for (i, _), s in zip(rows, sets)), key=str)


def corpus(seed, groups, most):
    rng, rows, vocabulary = np.random.default_rng(seed), [], [f"w{i}" for i in range(300)]
    for g in range(groups):
        base = list(rng.choice(vocabulary, rng.integers(3, 160)))
        for _ in range(1 + int(rng.integers(0, most))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 1 + len(base) // 12))):
                copy[rng.integers(0, len(copy))] = f"x{rng.integers(0, 10**6)}"
            rows.append((int(rng.integers(0, 10**9)), " ".join(copy).title() if rng.random() < 0.3 else "\n".join(copy)))
    return rows


@pytest.mark.parametrize("small", [8, 2])
def test_components_by_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(S, "SMALL", small)
    monkeypatch.setattr(S, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(S, "BROADCAST_IDS", 10 if small == 2 else 1000)
    rows = corpus(5, 25, 12)
    rows += [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (6, "one two"), (7, rows[0][1]), (7, rows[-1][1]), (None, rows[0][1])]
    rng = np.random.default_rng(1)
    rng.shuffle(rows)
    rows = [(None if i is None else int(i), t) for i, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "2 as TEXT", "3 as kept")
    assert sorted(map(tuple, S.near_duplicates(df, width=4).collect()), key=str) == brute(rows, 4)
    if small == 8:
        assert S.near_duplicates(df.limit(0)).count() == 0
        lonely = spark.createDataFrame([(1, "a b c d e f"), (2, None)], "doc_id long, text string")
        assert sorted(map(tuple, S.near_duplicates(lonely).collect())) == [(1, 2, 1, True), (2, 0, 2, True)]


def test_words_that_cancel_under_polynomials_differ(spark):
    """Thue-Morse strings and their opposites share every polynomial hash modulo a power of two."""
    flip, a = str.maketrans("ab", "ba"), "a"
    while len(a) < 4096:
        a += a.translate(flip)
        numbers, _ = words.word_numbers([a, a.translate(flip)])
        assert numbers[0] != numbers[1], len(a)
    rows = [(1, a), (2, a.translate(flip)), (3, f"{a} x y z"), (4, f"{a.translate(flip)} x y z")]
    got = S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 2), (3, 3), (4, 4)]


def test_chains_that_no_hub_links(spark, monkeypatch):
    """A long drift of texts: neighbours are alike, the ends share nothing, so most of a bucket isn't linked to its hub."""
    monkeypatch.setattr(S, "SMALL", 2)
    monkeypatch.setattr(S, "BLOCK_BYTES", 20_000)
    rows = [(100 + i, " ".join(f"w{j}" for j in range(3 * i, 3 * i + 60))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, S.near_duplicates(df, width=4).collect()), key=str)
    assert got == brute(rows, 4) and {c for _, _, c, _ in got} == {100}


def test_share_of_pairs_missed_at_the_threshold():
    """Pairs at exactly 0.8 that no band shows or the estimate rejects: none of 3,000 (the README's bound is 4e-5)."""
    rng, missed = np.random.default_rng(12), 0
    for _ in range(3000):
        whole = random_set(rng, 90)
        a, b = whole[: 81], np.r_[whole[:72], whole[81:]]  # 72 shared of 90
        x, y = S.registers(np.sort(a)), S.registers(np.sort(b))
        shown = (S.bands(x) == S.bands(y)).any()
        kept = S.hopeful(x[None], y[None], np.array([len(a)]), np.array([len(b)]), 80)[0]
        missed += not (shown and kept)
    assert missed == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aAbÉé \t\n\x0b\x0c\r\x1c\xa0\x00.", max_size=30), st.integers(1, 5))
def test_shingles_of_words_by_regex(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    n = min(width, len(w))
    assert S.word_shingles(text, width) == ({tuple(x.encode() for x in w[i : i + n]) for i in range(len(w) - n + 1)} if n else set())


def test_links_are_confirmed_on_words(spark, monkeypatch):
    """Numbers that make all words equal link nothing that the words don't."""
    monkeypatch.setattr(S, "linked", lambda a, b, percent: True)
    a, b = S.word_shingles("one two three four five", 4), S.word_shingles("one two three four six", 4)
    assert not S.linked_words(a, b, 80) and S.linked_words(a, set(a), 80)
    rows = corpus(9, 10, 6)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, S.near_duplicates(df, width=4).collect()), key=str) == brute(rows, 4)
