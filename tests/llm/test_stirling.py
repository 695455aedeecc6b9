import math

import numpy as np
import pytest
from trovespark.llm import stirling as S


def test_log_gamma():
    x = [1e-3, 0.5, 1, 2, 7.25, 1e3, 1e9]
    assert S.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("discount", [0.3, 0.6, 0.8, 0.93])
def test_integral_gives_the_numbers_of_the_recursion(discount):
    whole = S.table(discount, 1500)
    for n in (2, 25, 300, 1500):
        t = np.unique(np.linspace(1, max(1, int(0.9 * n)), 40).astype(int))
        assert np.abs(S.integral(n, t, discount) - whole[n, t]).max() < 2e-6


def exact(n, opens, discount):
    """Probability of each number of tables by adding customers one at a time, keeping exact weights of seatings."""
    state = {(1,): opens}
    for _ in range(n - 1):
        new = {}
        for sizes, w in state.items():
            new[(*sizes, 1)] = new.get((*sizes, 1), 0) + w * opens
            for i, s in enumerate(sizes):
                k = (*sizes[:i], s + 1, *sizes[i + 1 :])
                new[k] = new.get(k, 0) + w * (s - discount)
        state = new
    out = np.zeros(n + 1)
    for sizes, w in state.items():
        out[len(sizes)] += w
    return out / out.sum()


@pytest.mark.parametrize("n", [1, 2, 6])
def test_draws_of_few_customers(n):
    got = np.bincount(S.draw(np.full(60_000, n), np.full(60_000, 0.4), 0.7, np.random.default_rng(5)), minlength=n + 1) / 60_000
    assert np.abs(got - exact(n, 0.4, 0.7)).max() < 0.01


@pytest.mark.parametrize("opens", [0.02, 3.0, 60.0, 4000.0])
def test_draws_of_many_customers_are_those_of_the_whole_table(opens):
    n, discount, u = 1400, 0.75, np.linspace(0.001, 0.999, 500)
    log_p = S.table(discount, n)[n, 1:] + np.log(opens) * np.arange(1, n + 1)
    upto = np.cumsum(np.exp(log_p - log_p.max()))
    want = 1 + np.searchsorted(upto, u * upto[-1], side="right")
    got = S._draw_large(np.full(500, n), np.full(500, opens), u, discount)
    assert (got != want).mean() < 0.01 and np.abs(got - want).max() <= 1


def test_cost_does_not_grow_with_customers():
    got = S.draw(np.array([10**6, 10**9, 10**12]), np.array([0.01, 2e5, 1e3]), 0.8, np.random.default_rng(1))
    assert 1 <= got[0] < 10 and abs(got[1] - 2.5e5) < 5000 and abs(got[2] - 1250) < 300
