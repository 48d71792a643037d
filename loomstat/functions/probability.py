"""Tail probabilities for the small inference tables built on the driver."""

from __future__ import annotations

import math


def normal_two_sided(z: float) -> float:
    """P(|N(0,1)| > |z|)."""
    return math.erfc(abs(z) / math.sqrt(2.0))


def _continued_fraction(next_term, limit: int = 400) -> float:
    """Modified Lentz evaluation of b0 + a1/(b1 + a2/(b2 + ...))."""
    tiny = 1e-300
    _, b = next_term(0)
    value = b or tiny
    c, d = value, 0.0
    for step in range(1, limit):
        a, b = next_term(step)
        d = b + a * d or tiny
        c = b + a / c or tiny
        d = 1.0 / d
        value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value


def beta_tail(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_tail(b, a, 1.0 - x)

    def term(i):
        if i == 0:
            return 0.0, 1.0
        if i == 1:
            return 1.0, 1.0
        m, odd = divmod(i - 1, 2)
        if odd:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    log_front = (
        a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) - math.log(a)
    )
    return math.exp(log_front) * (_continued_fraction(term) - 1.0)


def student_two_sided(t: float, df: float) -> float:
    """P(|T_df| > |t|)."""
    if math.isinf(t):
        return 0.0
    return beta_tail(df / 2.0, 0.5, df / (df + t * t))


def student_quantile(p: float, df: float) -> float:
    """t such that P(T_df <= t) = p, for p > 0.5, by bisection."""
    tail = 2.0 * (1.0 - p)
    low, high = 0.0, 1.0
    while student_two_sided(high, df) > tail:
        high *= 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        if student_two_sided(mid, df) > tail:
            low = mid
        else:
            high = mid
    return (low + high) / 2.0


def f_upper(f: float, df1: float, df2: float) -> float:
    """P(F_{df1,df2} > f)."""
    if f <= 0.0:
        return 1.0
    return beta_tail(df2 / 2.0, df1 / 2.0, df2 / (df2 + df1 * f))


def chi2_upper(x: float, df: float) -> float:
    """P(chi-square_df > x)."""
    if x <= 0.0:
        return 1.0
    a, half = df / 2.0, x / 2.0
    log_front = a * math.log(half) - half - math.lgamma(a)
    if half < a + 1.0:
        total = piece = 1.0 / a
        n = a
        while abs(piece) > abs(total) * 1e-16:
            n += 1.0
            piece *= half / n
            total += piece
        return 1.0 - total * math.exp(log_front)

    def term(i):
        if i == 0:
            return 0.0, half + 1.0 - a
        return -i * (i - a), half + 2.0 * i + 1.0 - a

    return math.exp(log_front) / _continued_fraction(term)
