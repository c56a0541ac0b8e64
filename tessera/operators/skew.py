"""Joins on keys of which a few hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of the right side's heavy keys that are broadcast at most.
BROADCAST_ROWS = 100_000


def heavy_hitters(df: DataFrame, key: str, share: float, tracked: int = 10_000) -> list:
    """Keys that hold at least ``share`` of the rows, from one pass with a
    counting summary of ``tracked`` keys (its counts are never too small, so
    no such key is missed; at most 1 / share keys and the summary's error)."""
    most = max(1, min(tracked, int(1 / share)))
    summary = F.expr(f"approx_top_k(`{key}`, {most}, {max(tracked, most)})").alias("top")
    row = df.where(F.col(key).isNotNull()).agg(F.count("*").alias("n"), summary).first()
    return [x["item"] for x in row["top"] or () if x["count"] >= share * row["n"]] if row["n"] else []


def split_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", share: float | None = None,
               salts: int = 64) -> DataFrame:
    """``left.join(right, key, how)`` (inner or left) where some keys hold much
    of ``left``: rows of heavy keys meet the few matching rows of ``right``
    without a shuffle, the others are shuffled as usual. If ``right`` has no more
    than ``BROADCAST_ROWS`` rows at all, no row of ``left`` is shuffled or counted.

    A key is heavy with ``share`` of the rows (default: a quarter of a shuffle
    partition's). The heavy keys' rows of ``right`` are counted first; only up to
    ``BROADCAST_ROWS`` of them are broadcast. Beyond that heavy keys are
    salted: their rows of ``right`` are copied ``salts`` times and those of ``left``
    spread over the copies.
    """
    if how not in ("inner", "left"):
        raise ValueError("inner or left")
    if right.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), key, how)
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_hitters(left, key, share or min(0.25, 1 / (4 * partitions)))
    if not heavy:
        return left.join(right, key, how)
    is_heavy = F.coalesce(F.col(key).isin(heavy), F.lit(False))
    few = right.where(is_heavy)
    if few.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return (left.where(is_heavy).join(F.broadcast(few), key, how)
                .unionByName(left.where(~is_heavy).join(right.where(~is_heavy), key, how)))
    spread = F.when(is_heavy, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts))).otherwise(0)
    copies = F.explode(F.when(is_heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    return (left.withColumn("_salt", spread.cast("int")).join(right.withColumn("_salt", copies), [key, "_salt"], how)
            .drop("_salt"))
