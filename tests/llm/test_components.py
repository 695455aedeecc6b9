import random

import pytest
from trovespark.frames import release
from trovespark.llm.components import components


def brute(links):
    root = {x: x for pair in links for x in pair}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {x: top(x) for x in root if top(x) != x}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_chains_stars_and_repeats(spark, seed):
    rnd = random.Random(seed)
    links = [(rnd.randrange(-50, 300), rnd.randrange(-50, 300)) for _ in range(150)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 40)] + [(5, 5), (3000, 3001), (3001, 3000)]
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == brute(links)
    release(got)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_links(spark):
    rows = [(1, 2, 9), (2, 1, 9), (2, 2, 9), (None, 3, 9), (4, None, 9), (2, 5, 9), (2, 5, 9)]
    got = components(spark.createDataFrame(rows, "a long, b long, A long"))
    assert {r.node: r.component for r in got.collect()} == {2: 1, 5: 1}
    release(got)
