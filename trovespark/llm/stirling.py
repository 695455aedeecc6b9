"""Numbers of tables, drawn exactly.

Given how readily a dish opens a table, n customers of one dish sit at t tables with probability proportional to
S(n, t) opens^t, where S are generalised Stirling numbers: S(n+1, t) = S(n, t-1) + (n - discount t) S(n, t). Up to `ROWS`
customers S comes from that recursion, beyond from Cauchy's integral for the coefficient of z^n in (1 - (1-z)^discount)^t,
which is n!/(t! discount^t) away from S and is taken along a hyperbola through the integrand's saddle point. Both give the
same numbers (tests compare them), at a cost that doesn't grow with n, so a draw is exact and needs no earlier state.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Customers up to which the recursion's table is used.
ROWS = 1024
#: Points of the integral's half line, angle of the hyperbola, and the drop of the integrand (in log) that ends it.
POINTS, ANGLE, DROP = 104, 0.5, 34.0
#: Knots between which the smooth logarithm of S is interpolated over a wide window of t.
KNOTS = 33


def log_gamma(x) -> np.ndarray:
    """Logarithm of the gamma function of positive numbers: Stirling's series after eight steps of the recurrence."""
    x = np.asarray(x, np.float64)
    low = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7)
    y = x + 8
    s = 1 / (y * y)
    series = (1 / 12 - s * (1 / 360 - s * (1 / 1260 - s * (1 / 1680 - s / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + series - np.log(low)


@lru_cache(12)
def table(discount: float, most: int = ROWS) -> np.ndarray:
    """Logarithms of S(n, t) for n and t up to `most`."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0.0
    t = np.arange(most + 1)
    for n in range(most):
        room = n - discount * t
        stay = np.where(room > 0, np.log(np.maximum(room, 1e-300)), -np.inf) + out[n]
        out[n + 1] = np.logaddexp(stay, np.r_[-np.inf, out[n, :-1]])
    return out


def _saddle(n: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """Where on (0, 1) the integrand's logarithm t log(1 - w^d) - (n+1) log(1 - w) is least, by bisection in log odds."""
    low, high = np.full(n.shape, -600.0), np.full(n.shape, 36.0)
    for _ in range(60):
        mid = (low + high) / 2
        log_w, log_v = -np.logaddexp(0, -mid), -np.logaddexp(0, mid)  # logs of w and 1 - w
        falls = np.log(t * discount) + (discount - 1) * log_w - np.log(-np.expm1(discount * log_w)) > np.log(n + 1) - log_v
        low, high = np.where(falls, mid, low), np.where(falls, high, mid)
    return 1 / (1 + np.exp(-low))


def _log1p(z: np.ndarray) -> np.ndarray:
    """log(1 + z) of complex numbers, to full precision for small ones."""
    out = np.empty_like(z)
    out.real = 0.5 * np.log1p(z.real * (2 + z.real) + z.imag * z.imag)
    out.imag = np.arctan2(z.imag, 1 + z.real)
    return out


def integral(n, t, discount: float) -> np.ndarray:
    """Logarithms of S(n, t) for 1 <= t <= n, t not necessarily whole."""
    n, t = np.broadcast_arrays(np.asarray(n, np.float64), np.asarray(t, np.float64))
    w = np.clip(_saddle(n, t, discount), 0.5 / n, 1 - 0.5 / n)
    size = w / (1 - np.sin(ANGLE))
    left, up = size * np.sin(ANGLE), size * np.cos(ANGLE)
    peak = np.minimum(1.0, 2 * (1 - w) / up)  # how narrow the integrand is where the pole at 1 is near

    def at(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = peak * np.sinh(u)
        grown, rise = np.cosh(x), np.sinh(x)
        point = np.empty(n.shape, np.complex128)
        point.real, point.imag = size - left * grown, up * rise
        way = (-left * rise + 1j * (up * grown)) * (peak * np.cosh(u))
        return t * _log1p(-np.exp(discount * np.log(point))) - (n + 1) * _log1p(-point), way

    first, way = at(np.zeros(n.shape))
    top = first.real
    low, high = np.zeros(n.shape), np.arcsinh(60.0 / peak)
    for _ in range(10):
        mid = (low + high) / 2
        inside = at(mid)[0].real > top - DROP
        low, high = np.where(inside, mid, low), np.where(inside, high, mid)
    total, step = 0.5 * way.imag, high / POINTS
    for i in range(1, POINTS + 1):
        there, way = at(i * step)
        total += (np.exp(there - top) * way).imag
    return log_gamma(n + 1) - log_gamma(t + 1) - t * np.log(discount) + np.log(total * step / np.pi) + top


def log_numbers(n: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """Logarithms of S(n, t) for whole n and t, by the table or the integral."""
    out = np.zeros(len(n))
    small = n <= ROWS
    out[small] = table(discount)[n[small], t[small]]
    if not small.all():
        out[~small] = integral(n[~small], t[~small], discount)
    return out


def _windows(n: np.ndarray, opens: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of tables outside of which less than 1e-15 of the probability lies. Without the condition on n, tables
    would be a Poisson number; the tilt is chosen so that n customers are expected, and the
    spread is that of tables given customers."""
    low, high = np.full(n.shape, -700.0), np.full(n.shape, 36.0)
    for _ in range(60):
        mid = (low + high) / 2
        more = np.log(opens) - np.logaddexp(0, mid) - (discount - 1) * np.logaddexp(0, -mid) > np.log(n)
        low, high = np.where(more, mid, low), np.where(more, high, mid)
    mean = opens / discount * -np.expm1(-discount * np.logaddexp(0, -low))
    wide = 10 * np.sqrt(np.maximum(mean - n / (1 + (1 - discount) * np.exp(-low)), 0))
    return np.maximum(1, mean - wide - 12).astype(np.int64), np.minimum(n, mean + wide + 40).astype(np.int64)


def _draw_large(n: np.ndarray, opens: np.ndarray, u: np.ndarray, discount: float) -> np.ndarray:
    """Numbers of tables of dishes with more than `ROWS` customers: log S at knots over each window, all at once, and
    between them by interpolation."""
    low, high = _windows(n, opens, discount)
    knots = (low + high)[:, None] / 2 - (high - low)[:, None] / 2 * np.cos(np.pi * np.arange(KNOTS) / (KNOTS - 1))
    value = np.where(knots < n[:, None], integral(n[:, None], knots, discount), 0.0)
    weight = np.where(np.arange(KNOTS) % 2, -1.0, 1.0)
    weight[[0, -1]] /= 2
    out = np.empty(len(n), np.int64)
    for i, (a, b) in enumerate(zip(low, high)):
        t = np.arange(a, b + 1)
        gap = t[:, None] - knots[i]
        exact = np.abs(gap) < 1e-9
        share = weight / np.where(exact, 1.0, gap)
        log_s = np.where(exact.any(1), value[i][exact.argmax(1)], (share @ value[i]) / share.sum(1))
        log_p = log_s + t * np.log(opens[i])
        p = np.cumsum(np.exp(log_p - log_p.max()))
        out[i] = t[min(np.searchsorted(p, u[i] * p[-1], side="right"), len(t) - 1)]
    return out


def draw(n: np.ndarray, opens: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Numbers of tables for dishes with n >= 1 customers each that open tables so readily."""
    tables, u = np.ones(len(n), np.int64), rng.random(len(n))
    two = np.flatnonzero(n == 2)
    tables[two] += u[two] * (opens[two] + 1 - discount) < opens[two]
    order = np.argsort(n, kind="stable")
    cut = np.searchsorted(n[order], [3, ROWS + 1])
    some = order[cut[0] : cut[1]]
    log_s, log_opens = table(discount), np.log(np.maximum(opens, 1e-300))
    edges = np.flatnonzero(np.diff(n[some], prepend=-1)).tolist() + [len(some)]
    for a, b in zip(edges, edges[1:]):
        k = int(n[some[a]])
        for c in range(a, b, max(1, (1 << 20) // k)):
            at = some[c : min(b, c + max(1, (1 << 20) // k))]
            log_p = log_s[k, 1 : k + 1] + log_opens[at, None] * np.arange(1, k + 1)
            log_p -= log_p.max(1, keepdims=True)
            p = np.cumsum(np.exp(log_p, out=log_p), 1)
            tables[at] = 1 + (p <= (u[at] * p[:, -1])[:, None]).sum(1)
    for a in range(cut[1], len(order), 1000):
        at = order[a : a + 1000]
        tables[at] = _draw_large(n[at], np.maximum(opens[at], 1e-300), u[at], discount)
    return tables
