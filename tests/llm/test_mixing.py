import itertools
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from trovespark.frames import pick
from trovespark.llm import mixing


def test_shares_by_hand():
    got = mixing.shares({"a": 100, "b": 100, None: 100})
    assert got == {"a": 200.0, "b": pytest.approx(500 / 3), None: pytest.approx(250 / 3)}
    assert mixing.shares({}) == {} and mixing.shares({"a": 0}) == {"a": 0.0}


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.text(alphabet="abcé", max_size=3), st.integers(0, 500), max_size=7))
def test_shares_hold_the_rule(sizes):
    got = mixing.shares(sizes)
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(got[s] <= 2 * n + 1e-9 for s, n in sizes.items())


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sampled_from([("a",), ("b",), ("a", "b")]), st.integers(0, 3), min_size=1), st.integers(0, 6), st.integers(0, 6))
def test_flow_is_most_and_cheapest(capacity, qa, qb):
    flow = mixing.route(capacity, {"a": qa, "b": qb}, 2)
    cost = lambda n, c: max(0, n - c)
    used = {p: sum(n for (q, _), n in flow.items() if q == p) for p in capacity}
    best = None
    ranges = [range(2 * c + 1) for p, c in capacity.items() for s in p]
    keys = [(p, s) for p in capacity for s in p]
    for choice in itertools.product(*ranges):
        x = dict(zip(keys, choice))
        per = {p: sum(n for (q, _), n in x.items() if q == p) for p in capacity}
        if all(per[p] <= 2 * c for p, c in capacity.items()) and sum(n for (_, s), n in x.items() if s == "a") <= qa and sum(n for (_, s), n in x.items() if s == "b") <= qb:
            score = (-sum(choice), sum(cost(per[p], c) for p, c in capacity.items()))
            best = score if best is None else min(best, score)
    assert (-sum(flow.values()), sum(cost(used[p], c) for p, c in capacity.items())) == best


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (1 + i * 7919 % 40), None if i % 11 == 0 else "big" if i % 3 == 0 else f"s{i % 5}", 1) for i in range(3000)]
    rows += [(7, None, "s1", 1), (8, "", "s1", 1), (None, "a b", "s2", 1), (5, rows[5][1], rows[5][2], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int").selectExpr("*", "1 as Size")
    got = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in got:
        assert r.taken <= 2 * r.size and r.taken in (0, r.size, 2 * r.size)
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.source_size == sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, s, _ in rows if s == r.source)
    want = mixing.shares(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= 41
    assert mixing.mix(df.limit(0)).count() == 0
    plain = pick(df, doc_id="bigint", text="string", source="string")
    copies = mixing.mixed_documents(plain).groupBy("doc_id").count().collect()
    assert sum(r["count"] for r in copies) == sum(r.repeats for r in got)
