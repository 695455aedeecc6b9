import itertools
import re
import zlib
from collections import Counter
from math import exp, lgamma, log, log10

import numpy as np
import pytest
from trovespark.llm import hpylm as H
from trovespark.llm.stirling import draw, table


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def base(rows):
    held = [zlib.crc32(str(d if d is not None else "").encode()) % 5 == 1 for d, _ in rows]
    c = Counter(t for (_, x), h in zip(rows, held) if not h for t in tokens(x))
    n, v = sum(c.values()), len(c)
    return sorted(((d, h, len(ts := tokens(x)), sum(c[t] > 0 for t in ts), n, round(sum(log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts), 6)) for (d, x), h in zip(rows, held)), key=str)


def chain_text(rng, n):
    """Words whose successor is nearly given: a bigram model must do far better than unigrams."""
    w, out = int(rng.integers(0, 40)), []
    for _ in range(n):
        out.append(f"w{w}")
        w = (w * 7 + 3) % 40 if rng.random() < 0.85 else int(rng.integers(0, 40))
    return " ".join(out)


def collect(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=str)


def test_counts_base_and_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, chain_text(rng, int(rng.integers(0, 80))) + f" only{i}") for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (5, rows[5][1]), (None, "W1 w2"), (1003, chain_text(rng, 30_000))]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as score", "2 as TEXT").repartition(3)
    plain = H.score(df)
    assert collect(plain) == base(rows)
    monkeypatch.setattr(H, "PART_TOKENS", 3000)
    monkeypatch.setattr(H, "GROUP_WORDS", 200)
    many = H.score(df, burn_in=2, samples=2)
    assert collect(many) == base(rows)
    for got in (plain, many):
        table = got.toPandas()
        assert np.isfinite(table.score).all() and (table.score <= 0).all()
        held = table[table.held_out & (table.n_tokens > 20)]
        assert held.score.sum() > 0.8 * held.base_score.sum()
        told = {r.held_out: r for r in H.perplexity(got).collect()}
        assert told[True].perplexity < told[True].base_perplexity and told[False].perplexity < told[False].base_perplexity
    assert H.score(df.limit(0), burn_in=1, samples=1).count() == 0
    none = H.score(spark.createDataFrame([(next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1), "a b")], "doc_id long, text string"), burn_in=1, samples=1).collect()
    assert none[0].n_tokens == 3 and none[0].n_known == 0 and none[0].train_tokens == 0


def test_root_probabilities_sum_to_one():
    customers = np.random.default_rng(3).integers(1, 50, 200).astype(float)
    rooms = H.Rooms(200, 9000, 0.7, 0.5, 0.6, 10.0, customers.sum())
    assert rooms.root(customers).sum() + rooms.unknown == pytest.approx(1)


def test_texts_of_one_word_leave_room_for_longer_ones(spark):
    rng = np.random.default_rng(3)
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(3000)]
    train = [(i, chain_text(rng, 60)) for i in range(60) if not held[i]]
    vocabulary = sorted({w for _, t in train for w in t.split()})
    probe = [i for i in range(1000, 3000) if held[i]]
    rows = train + list(zip(probe, ["", *vocabulary, "unseen"]))
    got = {r.doc_id: r.score for r in H.score(spark.createDataFrame(rows, "doc_id long, text string"), burn_in=3, samples=2).collect()}
    assert 0 < sum(10 ** got[i] for i in probe[: len(vocabulary) + 2]) < 1


def weights(counts, rooms):
    """All seatings' numbers of tables of a small hierarchy (contexts x words) with their exact weights."""
    log_s = table(rooms.discount, 8)
    cells = [(i, j, counts[i, j]) for i in range(counts.shape[0]) for j in range(counts.shape[1]) if counts[i, j]]
    for choice in itertools.product(*(range(1, c + 1) for _, _, c in cells)):
        t = np.zeros(counts.shape)
        log_w = 0.0
        for (i, j, c), k in zip(cells, choice):
            t[i, j], log_w = k, log_w + log_s[c, k]
        log_w += sum(log(rooms.strength + i * rooms.discount) for row in t.sum(1) for i in range(1, int(row)))
        log_w += sum(lgamma(w - rooms.root_discount) for w in t.sum(0)) - sum(log(rooms.root_strength + i) for i in range(1, int(t.sum())))
        yield t, exp(log_w)


def test_sweeps_have_the_exact_distribution_of_a_small_hierarchy():
    """Auxiliary numbers change how readily tables open in every sweep; the seatings must still be those of the model."""
    counts = np.array([[4, 2, 0], [1, 3, 2], [2, 0, 1]])
    rooms = H.Rooms(3, 15, 0.6, 0.8, 0.4, 1.5)
    every = list(weights(counts, rooms))
    total = sum(w for _, w in every)
    mean = sum(t * w for t, w in every) / total
    one = sum(w for t, w in every if t[0, 0] == 1) / total
    at, rng = np.nonzero(counts), np.random.default_rng(8)
    t, sums, ones, many = (counts > 0).astype(float), np.zeros(counts.shape), 0, 30_000
    for sweep in range(many):
        g, m = H.readiness(t.sum(1), 0, sweep, rooms), H.masses(t.sum(0), 0, sweep, rooms)
        share = m / (m.sum() + rng.standard_gamma(rooms.root_strength + rooms.root_discount * rooms.words))
        t = np.zeros(counts.shape)
        t[at] = draw(counts[at], rooms.discount * g[at[0]] * share[at[1]], rooms.discount, rng)
        sums, ones = sums + t, ones + (t[0, 0] == 1)
    assert np.abs(sums / many - mean).max() < 0.025
    assert abs(ones / many - one) < 0.015


def test_newton_steps_find_the_most_likely_values():
    rng, rooms = np.random.default_rng(4), H.Rooms(300, 6000, 0.5, 0.5, 0.5, 10.0)
    counts, tables, words = rng.integers(5, 60, 400).astype(float), rng.integers(2, 5, 400).astype(float), rng.integers(1, 9, 300).astype(float)

    def likely(r):
        spread = float((H.log_gamma(words - r.root_discount) - H.log_gamma(1 - r.root_discount)).sum())
        return H._likely_contexts(r, counts, tables) - 900 * r.discount, spread

    for _ in range(40):
        trials = H.replace(rooms, root_customers=words.sum()).trials
        contexts = [H._likely_contexts(t, counts, tables) for t in trials[:5]]
        rooms = H.refitted(rooms, [-900 * t.discount for t in trials[:3]], contexts, [likely(t)[1] for t in (trials[0], trials[5], trials[6])], words.sum())
    best = likely(rooms)[0], H._likely_root(rooms, likely(rooms)[1])
    for name in ("discount", "strength", "root_discount", "root_strength"):
        for factor in (0.93, 1.07):
            other = H.replace(rooms, **{name: getattr(rooms, name) * factor})
            if 0.02 < other.discount < 0.98 and other.strength > 0.01:
                assert likely(other)[0] <= best[0] + 0.05 and H._likely_root(other, likely(other)[1]) <= best[1] + 0.05


def test_rare_words_are_contexts_of_their_own(spark, monkeypatch):
    rng = np.random.default_rng(7)
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(4000)]
    free, probes = [i for i in range(4000) if not held[i]], [i for i in range(4000) if held[i]]
    rare = [f"r{k} s{k}" for k in range(100)]
    train = [*rare * 4, *(chain_text(rng, 30_000) for _ in range(4))]  # each rare word is under 1/10,000 of all tokens
    asked = [*rare, *(f"r{k} s{(k + 1) % 100}" for k in range(100))]
    rows = list(zip(free, train)) + list(zip(probes, asked))
    for size in (H.PART_TOKENS, 20_000):
        monkeypatch.setattr(H, "PART_TOKENS", size)
        got = {r.doc_id: r.score for r in H.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), burn_in=3, samples=2).collect()}
        scores = np.array([got[i] for i in probes[:200]])
        assert (scores[:100] > scores[100:] + 1).all()
