"""Scalar column expressions (C1–C7, C11–C13, P8, P11–P13): built-ins only,
so they stay inside whole-stage code generation."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# C1 skew-reducing transforms
def log_transform(c: Column | str) -> Column:
    return F.ln(_col(c))


def sqrt_transform(c: Column | str) -> Column:
    return F.sqrt(_col(c))


def log1p_transform(c: Column | str) -> Column:
    return F.log1p(_col(c))


# C3 logistic pieces
def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def cross_entropy(y: Column | str, p: Column) -> Column:
    """-y ln p - (1-y) ln(1-p); NULL where a log is undefined (p at 0 or 1)."""
    y = _col(y)
    return -(y * F.ln(p)) - (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p)


# C4
def squared_norm(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c) * F.col(c) for c in cols])


def array_squared_norm(c: Column | str) -> Column:
    return F.aggregate(_col(c), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))


# C5 binomial probability, in log space so large n does not overflow
def log_gamma(a: Column) -> Column:
    """ln Gamma(a) for a > 0 (Lanczos approximation, g=7, n=9)."""
    # The standard Lanczos coefficients for g = 7, n = 9.
    coef = [0.99999999999980993, 676.5203681218851, -1259.1392167224028,
            771.32342877765313, -176.61502916214059, 12.507343278686905,
            -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7]
    z = a - 1
    s = F.lit(coef[0])
    for i in range(1, 9):
        s = s + F.lit(coef[i]) / (z + i)
    t = z + 7.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.ln(t) - t + F.ln(s)


def _stirling_rest(n: Column) -> Column:
    """ln n! minus Stirling's formula for it: a small number, so that it can
    be added to others of its kind without losing digits."""
    small = log_gamma(n + 1) - (n + 0.5) * F.ln(n) + n - 0.5 * math.log(2 * math.pi)
    n2 = n * n
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / n2) / n2) / n2) / n
    return F.when(n <= 15, small).otherwise(series)


def _deviance(x: Column, m: Column) -> Column:
    """x ln(x / m) + m - x without cancellation where x is near m."""
    v = (x - m) / (x + m)
    terms = F.lit(0.0)
    for j in range(12, 0, -1):  # 2 x v (v^2 / 3 + v^4 / 5 + ...)
        terms = (terms + 1 / (2 * j + 1)) * v * v
    near = (x - m) * v + 2 * x * v * terms
    return F.when(F.abs(x - m) < 0.1 * (x + m), near).otherwise(x * F.ln(x / m) + m - x)


def log_choose(n: Column, k: Column) -> Column:
    """ln C(n, k): constant work, however large k is, and no difference of
    large numbers, however large n is."""
    n, k = n.cast("double"), k.cast("double")
    r = n - k
    inner = (_stirling_rest(n) - _stirling_rest(k) - _stirling_rest(r) + 0.5 * F.ln(n / (2 * math.pi * k * r))
             - k * F.ln(k / n) - r * F.log1p(-k / n))
    return F.when((k == 0) | (k == n), F.lit(0.0)).otherwise(inner)


def binomial_pmf(n: Column, k: Column, p: float | Column) -> Column:
    """C(n, k) p^k (1 - p)^(n - k) by the saddle-point form: its parts are the
    deviations of k and n - k from their means, both near 0 where the
    probability is not."""
    p = (F.lit(float(p)) if not isinstance(p, Column) else p).cast("double")
    n, k = n.cast("double"), k.cast("double")
    r, q = n - k, 1 - p
    inner = F.exp(_stirling_rest(n) - _stirling_rest(k) - _stirling_rest(r) - _deviance(k, n * p) - _deviance(r, n * q)
                  ) * F.sqrt(n / (2 * math.pi * k * r))
    return (F.when((k < 0) | (k > n), F.lit(0.0))
            .when(p == 0, (k == 0).cast("double")).when(q == 0, (k == n).cast("double"))
            .when(k == 0, F.exp(n * F.log1p(-p))).when(k == n, F.exp(n * F.ln(p))).otherwise(inner))


# C6 / C7 time
def parse_timestamp(c: Column | str, fmt: str) -> Column:
    """Text to timestamp; text that does not match gives NULL."""
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def date_gap_days(a: Column | str, b: Column | str) -> Column:
    return F.datediff(_col(b), _col(a))


def date_gap_months(a: Column | str, b: Column | str) -> Column:
    return F.months_between(_col(b), _col(a))


# C11
def array_to_string(c: Column | str) -> Column:
    """`[a,b,c]` without a Python worker."""
    return F.concat(F.lit("["), F.array_join(_col(c).cast("array<string>"), ","), F.lit("]"))


# P8
def non_finite_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(math.inf)), F.lit(None)).otherwise(c)


# P13 horizontal reductions that skip nulls like pandas
def row_sum(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in cols])


def row_max(cols: list[str]) -> Column:
    return F.greatest(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(cols[0])


def row_nonzero_count(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b,
                  [F.when(F.col(c).isNotNull() & (F.col(c) != 0), 1).otherwise(0) for c in cols])


# P11
def outcome_tag(actual: Column | str, predicted: Column | str) -> Column:
    a, p = _col(actual), _col(predicted)
    return (F.when((a == 1) & (p == 1), "tp").when((a == 0) & (p == 1), "fp")
            .when((a == 0) & (p == 0), "tn").when((a == 1) & (p == 0), "fn"))


# P12 the delinquency rules of the loan notebook, as 0/1 expressions
def _nz(c: str) -> Column:
    return (F.col(c) != 0).cast("int")


LOAN_RULES = {
    # m12 > 0 or the largest of m1..m11 > 0
    "m12_or_history": lambda: ((F.col("m12") > 0) | (row_max([f"m{i}" for i in range(1, 12)]) > 0)).cast("int"),
    # m12 alone (the leaderboard rule: m13 = bool(m12))
    "m12_nonzero": lambda: _nz("m12"),
    "m12_positive": lambda: (F.col("m12") > 0).cast("int"),
    # max(m11, m12) > 0
    "m11_or_m12": lambda: (F.greatest("m11", "m12") > 0).cast("int"),
    # m1 + m12 > 0
    "m1_plus_m12": lambda: ((F.col("m1") + F.col("m12")) > 0).cast("int"),
    # m12 == 0 and total of m1..m11 > 10 -> 1, else bool(m12)
    "quiet_m12_heavy_history": lambda: F.when(
        (F.col("m12") == 0) & (row_sum([f"m{i}" for i in range(1, 12)]) > 10), 1).otherwise(_nz("m12")),
}


def rule_with_model(model_col: str, kind: str) -> Column:
    """Rules that combine m12 with a model's 0/1 prediction."""
    if kind == "m12_or_model":
        return ((F.col("m12") > 0) | (F.col(model_col) > 0)).cast("int")
    if kind == "model_vetoes_single":
        return F.when((F.col("m12") == 1) & (F.col(model_col) == 0), 0).otherwise(_nz("m12"))
    raise ValueError(kind)
