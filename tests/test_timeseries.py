"""ADF against a direct NumPy computation of the same procedure (lag
matrix, AIC search on a common sample, refit) on small series."""

import math

import numpy as np
import pytest

from tessera.operators.timeseries import adf_test, default_maxlag, mackinnon_p


def adf_numpy(x, maxlag=None):
    x = np.asarray(x, dtype=float)
    n = len(x)
    L = default_maxlag(n) if maxlag is None else maxlag
    dx = np.diff(x)

    def design(p):
        nobs = n - 1 - p
        y = dx[-nobs:]
        cols = [np.ones(nobs), x[-nobs - 1:-1]]
        for j in range(1, p + 1):
            cols.append(dx[-nobs - j:-j])
        return y, np.column_stack(cols)

    y, full = design(L)
    best = None
    for p in range(L + 1):
        z = full[:, :2 + p]
        beta, *_ = np.linalg.lstsq(z, y, rcond=None)
        ssr = float(((y - z @ beta) ** 2).sum())
        nobs = len(y)
        aic = -2 * (-nobs / 2 * (math.log(2 * math.pi) + math.log(ssr / nobs) + 1)) + 2 * z.shape[1]
        if best is None or aic < best[0]:
            best = (aic, p)
    p = best[1]
    y, z = design(p)
    beta, *_ = np.linalg.lstsq(z, y, rcond=None)
    resid = y - z @ beta
    s2 = float(resid @ resid) / (len(y) - z.shape[1])
    se = math.sqrt(s2 * np.linalg.inv(z.T @ z)[1, 1])
    return beta[1] / se, p, len(y)


@pytest.mark.parametrize("kind", ["walk", "noise", "ar"])
def test_adf_matches_numpy(spark, kind):
    rng = np.random.default_rng(3)
    e = rng.normal(size=150)
    x = {"walk": np.cumsum(e), "noise": e,
         "ar": np.array([0.0] * 150)}[kind]
    if kind == "ar":
        for t in range(2, 150):
            x[t] = 0.5 * x[t - 1] - 0.3 * x[t - 2] + e[t]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "t int, v double")
    got = adf_test(df, "t", "v", block_rows=40).first()
    stat, p, nobs = adf_numpy(x)
    assert got["used_lag"] == p and got["nobs"] == nobs
    assert math.isclose(got["statistic"], stat, rel_tol=1e-6, abs_tol=1e-8)


def test_adf_per_key(spark):
    rng = np.random.default_rng(5)
    data = []
    for k in ("a", "b"):
        x = np.cumsum(rng.normal(size=80)) if k == "a" else rng.normal(size=120)
        data += [(k, i, float(v)) for i, v in enumerate(x)]
        want = adf_numpy(x)
        df = spark.createDataFrame([r for r in data if r[0] == k], "k string, t int, v double")
    df = spark.createDataFrame(data, "k string, t int, v double")
    got = {r["k"]: r for r in adf_test(df, "t", "v", key="k", block_rows=50).collect()}
    for k in ("a", "b"):
        x = [v for kk, _, v in data if kk == k]
        stat, p, nobs = adf_numpy(x)
        assert got[k]["used_lag"] == p
        assert math.isclose(got[k]["statistic"], stat, rel_tol=1e-6)


def test_series_without_a_test_keep_their_row(spark):
    rng = np.random.default_rng(6)
    good = np.cumsum(rng.normal(size=90))
    data = [("good", i, float(v)) for i, v in enumerate(good)]
    data += [("constant", i, 5.0) for i in range(50)] + [("short", i, float(i * i)) for i in range(3)]
    data += [("one", 0, 1.0), ("line", 0, 0.0)] + [("line", i, 2.0 * i) for i in range(1, 60)]
    data += [("missing", 0, None), ("missing", 1, float("nan")), (None, 0, 1.0), (None, 1, 2.0)]
    got = {r["k"]: r for r in adf_test(spark.createDataFrame(data, "k string, t int, v double"), "t", "v", key="k").collect()}
    assert set(got) == {"good", "constant", "short", "one", "line", "missing", None}
    assert math.isclose(got["good"]["statistic"], adf_numpy(good)[0], rel_tol=1e-6)
    assert all(got[k]["statistic"] is None and got[k]["stationary"] is None for k in got if k != "good")


def test_far_from_zero_and_many_blocks(spark):
    rng = np.random.default_rng(7)
    x = np.cumsum(rng.normal(size=3000)) * 1e-3
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x + 1e6)], "t int, v double")
    want = adf_numpy(x)
    for rows in (40, 777):  # with 40, factors meet in two steps
        got = adf_test(df, "t", "v", block_rows=rows).first()
        assert got["used_lag"] == want[1] and got["nobs"] == want[2]
        assert math.isclose(got["statistic"], want[0], rel_tol=1e-5)


def test_null_values_are_left_out_and_empty_tables(spark):
    x = np.cumsum(np.random.default_rng(8).normal(size=60))
    rows = [(2 * i, float(v)) for i, v in enumerate(x)] + [(2 * i + 1, None) for i in range(60)]
    got = adf_test(spark.createDataFrame(rows, "t int, v double"), "t", "v").first()
    assert math.isclose(got["statistic"], adf_numpy(x)[0], rel_tol=1e-9)
    empty = spark.createDataFrame([], "k string, t int, v double")
    assert adf_test(empty, "t", "v").count() == 0 and adf_test(empty, "t", "v", key="k").count() == 0


def test_mackinnon_p_monotone_and_bounds():
    ps = [mackinnon_p(s) for s in (-6, -3.5, -2.86, -1.61, 0.0, 2.0)]
    assert ps == sorted(ps)
    assert mackinnon_p(-30) == 0.0 and mackinnon_p(5) == 1.0
    assert 0.04 < mackinnon_p(-2.8623) < 0.06
