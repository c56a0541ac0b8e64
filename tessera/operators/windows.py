"""Window operators.

Ranks over a whole group and trailing frames over a whole series are
computed from one distributed sort (``tessera.operators.ordering``), so a key
that holds a third of the table is spread over many tasks; the top-k filter
uses Spark's window group limit, which trims each key to k rows per map task
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordering import blocked_frame, rank_within


def percent_rank_by(df: DataFrame, key: str, order: str, ascending: bool = False,
                    out: str = "percent_rank") -> DataFrame:
    """Percent rank per key (W1): (rank - 1) / (n - 1), 0 for a single row."""
    r = rank_within(df, [key], [order], ascending, kinds=("percent_rank",))
    return r.withColumnRenamed("percent_rank", out) if out != "percent_rank" else r


def dense_rank_by(df: DataFrame, key: str, order: str, ascending: bool = False,
                  out: str = "dense_rank") -> DataFrame:
    """Dense rank per key."""
    r = rank_within(df, [key], [order], ascending, kinds=("dense_rank",))
    return r.withColumnRenamed("dense_rank", out) if out != "dense_rank" else r


def rolling_stats(df: DataFrame, ts: str, value: str, window: int = 6, key: str | None = None,
                  block_rows: int = 1_000_000) -> DataFrame:
    """Trailing mean and sample deviation over ``window`` rows, NULL until
    the window is full (W3)."""
    keys = [key] if key else []
    framed = blocked_frame(df, keys, [ts], lookback=window - 1, block_rows=block_rows)
    w = Window.partitionBy(*keys, "_blk").orderBy("_rn").rowsBetween(-(window - 1), 0)
    full = F.count(F.col(value)).over(w) == window
    out = framed.withColumns({
        "rolling_mean": F.when(full, F.avg(value).over(w)),
        "rolling_std": F.when(full, F.stddev_samp(value).over(w))})
    return out.where(~F.col("_halo")).drop("_blk", "_halo", "_rn")


def lag_features(df: DataFrame, ts: str, value: str, lags: list[int], key: str | None = None,
                 block_rows: int = 1_000_000) -> DataFrame:
    """First difference and lagged first differences (W4):
    diff = x_t - x_{t-1}; diff_lag_k = diff_{t-k}; level_lag_1 = x_{t-1}."""
    keys = [key] if key else []
    depth = max(lags) + 1 if lags else 1
    framed = blocked_frame(df, keys, [ts], lookback=depth, block_rows=block_rows)
    w = Window.partitionBy(*keys, "_blk").orderBy("_rn")
    out = framed.withColumn("level_lag_1", F.lag(value, 1).over(w))
    out = out.withColumn("diff", F.col(value) - F.col("level_lag_1"))
    for k in lags:
        out = out.withColumn(f"diff_lag_{k}", F.lag("diff", k).over(w))
    return out.where(~F.col("_halo")).drop("_blk", "_halo", "_rn")


def top_k_by(df: DataFrame, key: str, score: str, k: int, tiebreak: list[str] = (),
             out: str = "rank") -> DataFrame:
    """The k best rows per key, best first."""
    win = Window.partitionBy(key).orderBy(F.col(score).desc(), *tiebreak)
    return df.withColumn(out, F.row_number().over(win).cast("long")).where(F.col(out) <= k)
