"""Augmented Dickey-Fuller test with a constant and AIC lag choice
and the stationarity report (Q8).

A series is cut into blocks with the rows before them; each block's regression
rows (1, x_{t-1}, dx_{t-1..t-p}; y = dx_t, x centred) become one triangular
factor, factors merge by stacking, and a series' whole regression is a matrix
of p + 3 columns. It gives all nested fits of the lag search at once (rows
after the largest lag); the chosen lag is refitted on its own longer sample,
as statsmodels does. Factors do not square the condition number, as sums of
products would, so values far from zero lose no digits.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import blocked_frame, join_keys

# MacKinnon (1994) response-surface coefficients for the
# p-value of the constant-only ADF statistic with one variable, and
# MacKinnon (2010) critical-value coefficients (1 %, 5 %, 10 %), as
# published (and as used by statsmodels).
TAU_MAX_C = 2.74
TAU_MIN_C = -18.83
TAU_STAR_C = -1.61
TAU_C_SMALLP = [2.1659, 1.4412, 0.038269]
TAU_C_LARGEP = [1.7339, 0.93202, -0.12745, -0.010368]
TAU_C_2010 = {"1%": [-3.43035, -6.5393, -16.786, -79.433],
              "5%": [-2.86154, -2.8903, -4.234, -40.040],
              "10%": [-2.56677, -1.5384, -2.809, 0.0]}


def mackinnon_p(stat: float) -> float:
    if stat > TAU_MAX_C:
        return 1.0
    if stat < TAU_MIN_C:
        return 0.0
    coef = TAU_C_SMALLP if stat <= TAU_STAR_C else TAU_C_LARGEP
    z = sum(c * stat ** i for i, c in enumerate(coef))
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def mackinnon_crit(nobs: int) -> dict[str, float]:
    return {k: c[0] + c[1] / nobs + c[2] / nobs ** 2 + c[3] / nobs ** 3
            for k, c in TAU_C_2010.items()}


def default_maxlag(n: int) -> int:
    return min(n // 2 - 2, int(math.ceil(12.0 * (n / 100.0) ** 0.25)))


def _triangle(z: np.ndarray) -> np.ndarray:
    """The triangular factor of a block of regression rows: blocks merge by
    stacking their factors and factoring again."""
    return np.linalg.qr(z, mode="r") if len(z) else np.zeros((0, z.shape[1]))


def _design(x: np.ndarray, at: np.ndarray, lags: int) -> np.ndarray:
    """Rows [1, x_{t-1}, dx_{t-1} .. dx_{t-lags}, dx_t] for the places ``at``
    (a lag before the start of ``x`` is 0)."""
    dx = np.diff(x, prepend=x[:1])
    cols = [np.ones(len(at)), x[at - 1], *(np.where(at >= j, dx[np.maximum(at - j, 0)], 0.0) for j in range(1, lags + 1)), dx[at]]
    return np.column_stack(cols)


def _verdict(r: np.ndarray, nobs: int, heads: np.ndarray, lags: int) -> dict:
    """Lag choice, refit and test of one series from the triangular factor of
    its common sample (rows after the largest lag) and its first rows."""
    none = dict.fromkeys(("statistic", "p_value", "used_lag", "nobs", "crit_1", "crit_5", "crit_10", "stationary"))
    if lags < 0 or nobs <= lags + 2 or r.shape[0] < r.shape[1]:
        return none
    # nested models: what is left of y below its first k rows is the residual of k columns
    left = np.cumsum((r[:, -1] ** 2)[::-1])[::-1]
    aic = []
    for p in range(lags + 1):
        ssr = max(left[p + 2], np.finfo(float).tiny)
        aic.append(nobs * (math.log(2 * math.pi) + math.log(ssr / nobs) + 1) + 2 * (p + 2))
    p = int(np.argmin(aic))
    cols = [*range(p + 2), r.shape[1] - 1]
    more = heads[heads[:, 0] > p][:, 1:][:, cols]
    n = nobs + len(more)
    r = _triangle(np.vstack([r[:, cols], more]))
    k = p + 2
    size = np.sqrt((r[:, :k] ** 2).sum(axis=0))
    ssr = float(r[k, k] ** 2)
    if n <= k or (np.abs(np.diag(r)[:k]) <= 1e-10 * size).any() or ssr <= 1e-24 * float((r[:, k] ** 2).sum()):
        return none  # a constant series, or one without any residual
    inverse = np.linalg.solve(r[:k, :k], np.eye(k))
    se = math.sqrt(ssr / (n - k) * float((inverse[1] ** 2).sum()))
    stat = float(inverse[1] @ r[:k, k]) / se
    crit = mackinnon_crit(n)
    return dict(statistic=stat, p_value=mackinnon_p(stat), used_lag=p, nobs=n, crit_1=crit["1%"], crit_5=crit["5%"],
                crit_10=crit["10%"], stationary=stat < crit["5%"])


def adf_test(df: DataFrame, ts: str, value: str, key: str | None = None,
             maxlag: int | None = None, block_rows: int = 100_000) -> DataFrame:
    """ADF with constant, lag by AIC (L17). One row per series: statistic,
    p_value, used_lag, nobs, crit_1, crit_5, crit_10, stationary (statistic
    below the 5 % critical value).

    Null and NaN values are left out before lagging. A series that gives no
    test (constant, without residual, too short for its lags, without values)
    keeps its row with nulls; an empty table without a key gives no row.
    Blocks of ``block_rows`` rows of a series are factored in separate tasks
    and their factors merged, so a long series is many tasks' work.
    """
    keys = [key] if key else []
    ok = F.col(value).cast("double")
    values = df.select(*[F.col(k).cast("string").alias(k) for k in keys], F.col(ts), F.when(~F.isnan(ok), ok).alias("_x")).where(
        F.col("_x").isNotNull())
    n_max = values.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    lmax = max(0, maxlag if maxlag is not None else default_maxlag(int(n_max)))
    framed = blocked_frame(values, keys, [ts], lookback=lmax + 2, block_rows=max(block_rows, lmax + 3))
    sizes = framed.where(~F.col("_halo")).groupBy(*keys).agg(
        F.count("*").alias("_n"), F.min("_rn").alias("_first"), F.avg("_x").alias("_mean"))
    framed = join_keys(framed, sizes, keys) if keys else framed.withColumns(
        {c: sizes.select(c).scalar() for c in ("_n", "_first", "_mean")})

    def lags_of(n: int) -> int:
        return default_maxlag(n) if maxlag is None else maxlag

    def row(pdf: pd.DataFrame, **columns) -> pd.DataFrame:
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in keys}, **{c: [v] for c, v in columns.items()}})

    def factor(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_rn")
        x = pdf["_x"].to_numpy(float) - float(pdf["_mean"].iloc[0])  # the constant takes up the shift
        place = pdf["_rn"].to_numpy() - int(pdf["_first"].iloc[0])
        own = ~pdf["_halo"].to_numpy(bool)
        lags = lags_of(int(pdf["_n"].iloc[0]))
        wide = max(lags, 0)
        at = np.flatnonzero(own & (place > wide))
        r = np.zeros((0, wide + 3))
        for a in range(0, len(at), 8192):
            r = _triangle(np.vstack([r, _design(x, at[a:a + 8192], wide)]))
        early = np.flatnonzero(own & (place >= 1) & (place <= wide))
        heads = np.column_stack([place[early], _design(x, early, wide)])
        return row(pdf, _part=int(pdf["_blk"].iloc[0]) // 64, _lags=lags, _nobs=len(at), _r=r.tobytes(), _heads=heads.tobytes())

    def merged(pdf: pd.DataFrame) -> tuple[np.ndarray, int, np.ndarray, int]:
        lags = int(pdf["_lags"].iloc[0])
        wide = max(lags, 0) + 3
        r = _triangle(np.vstack([np.frombuffer(b).reshape(-1, wide) for b in pdf["_r"]]))
        heads = np.vstack([np.frombuffer(b).reshape(-1, wide + 1) for b in pdf["_heads"]])
        return r, int(pdf["_nobs"].sum()), heads, lags

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        r, nobs, heads, lags = merged(pdf)
        return row(pdf, _lags=lags, _nobs=nobs, _r=r.tobytes(), _heads=heads.tobytes())

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        return row(pdf, **_verdict(*merged(pdf)))

    names = "".join(f"`{k}` string, " for k in keys)
    held = "_lags int, _nobs long, _r binary, _heads binary"
    parts = framed.groupBy(*keys, "_blk").applyInPandas(factor, f"{names}_part long, {held}")
    parts = parts.groupBy(*keys, "_part").applyInPandas(merge, f"{names}{held}")
    out = parts.groupBy(*keys).applyInPandas(
        finish, f"{names}statistic double, p_value double, used_lag int, nobs long, crit_1 double, crit_5 double, "
                "crit_10 double, stationary boolean")
    if not keys:
        return out
    kind = df.schema[key].dataType
    return join_keys(df.select(key).distinct(), out.withColumn(key, F.col(key).cast(kind)), keys, "left")


def stationarity_report(df: DataFrame, ts: str, value: str, key: str | None = None,
                        window: int = 6, block_rows: int = 100_000) -> DataFrame:
    """Q8: ADF verdict per series with the range of its rolling mean and
    deviation (how far the level and spread move over time)."""
    from tessera.operators.windows import rolling_stats
    keys = [key] if key else []
    roll = rolling_stats(df, ts, value, window, key, block_rows)
    spread = roll.groupBy(*keys).agg(
        (F.max("rolling_mean") - F.min("rolling_mean")).alias("rolling_mean_range"),
        (F.max("rolling_std") - F.min("rolling_std")).alias("rolling_std_range"))
    adf = adf_test(df, ts, value, key, block_rows=block_rows)
    return join_keys(adf, spread, keys) if keys else adf.withColumns(
        {c: spread.select(c).scalar() for c in spread.columns})
