"""Uniform shuffle into shards of exact sizes (operator 5).

The communication matrix says how many rows each input partition sends to each
shard. For a uniform random permutation its law is the multivariate
hypergeometric one: given the shard sizes, the rows of one partition are a
draw without replacement from the slots still free. The matrix is drawn first
(exactly, over groups of partitions on the driver, then inside each group in a
task), so shard sizes are exact; then rows are permuted inside their partition,
dealt out by the matrix, and permuted again inside their shard.
"""

from __future__ import annotations

import math
import random

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordering import global_row_number
from tessera.session import cut_lineage, materialize


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Successes among ``draws`` without replacement from good + bad: the
    probabilities are walked outwards from the mode, so a draw takes about as
    many steps as the standard deviation, at any population size."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    p = math.exp(log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws))
    u = rng.random() - p
    up = down = mode
    pu = pd_ = p
    while u > 0 and (down > low or up < high):
        if up < high:
            pu *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            u -= pu
            if u <= 0:
                return up
        if down > low:
            pd_ *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            u -= pd_
            if u <= 0:
                return down
    return mode


def communication_matrix(rows: list[int], free: list[int], seed: str) -> list[list[int]]:
    """Rows that each sender (``rows``) gives to each receiver (``free``);
    row and column sums are exactly those lists."""
    if sum(rows) != sum(free):
        raise ValueError("senders and receivers must have the same total")
    rng, free, out = random.Random(seed), list(free), []
    for n in rows:
        left, pool, given = n, sum(free), []
        for f in free:
            k = hypergeometric(rng, f, pool - f, left) if left else 0
            given.append(k)
            left, pool = left - k, pool - f
        free = [f - k for f, k in zip(free, given)]
        out.append(given)
    return out


def shard_sizes(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def shard_rows(df: DataFrame, shards: int = 16, seed: int = 7) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` (0 to shards-1; counts at
    most one apart) and ``slot`` (0, 1, ... inside the shard), a uniform random
    permutation given ``seed``. Columns of ``df`` named shard or slot are
    replaced.

    The input is written once to the shared folder with row numbers, so that
    later stages and re-run tasks see the same partitions. Only those numbers
    are sorted; the rows move once, in the join that attaches their place.
    Nulls, empty texts and repeated rows are rows like any other; an empty
    table gives an empty result.
    """
    keep = [c for c in df.columns if c not in ("shard", "slot")]
    pinned = materialize(df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                                   F.spark_partition_id().alias("part"),
                                   F.monotonically_increasing_id().alias("rid")), "shuffle")
    ids = pinned.select("part", "rid")
    counts = cut_lineage(ids.groupBy("part").agg(F.count("*").alias("n")))
    parts, total = counts.agg(F.coalesce(F.max("part"), F.lit(-1)) + 1, F.coalesce(F.sum("n"), F.lit(0))).first()
    sizes = shard_sizes(total, shards)
    # first level: groups of about sqrt(parts) partitions, a small table on the driver
    width = max(1, math.isqrt(max(parts, 1)))
    groups = {r["g"]: r["n"] for r in counts.groupBy(F.floor(F.col("part") / width).alias("g"))
              .agg(F.sum("n").alias("n")).collect()}
    order = sorted(groups)
    dealt = dict(zip(order, communication_matrix([groups[g] for g in order], sizes, f"{seed}")))

    def draw(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        matrix = communication_matrix(pdf["n"].tolist(), dealt[key[0]], f"{seed}-{key[0]}")
        ends = [[sum(row[:k + 1]) for k in range(len(row))] for row in matrix]
        return pd.DataFrame({"part": pdf["part"], "ends": ends})

    matrix = (counts.withColumn("g", F.floor(F.col("part") / width)).groupBy("g")
              .applyInPandas(draw, "part int, ends array<long>"))
    local = Window.partitionBy("part").orderBy(F.xxhash64("rid", F.lit(seed)), "rid")
    sent = (ids.withColumn("rank", F.row_number().over(local)).join(matrix, "part")
            .select("rid", F.expr("size(filter(ends, e -> e < rank))").alias("shard"),
                    F.xxhash64("rid", F.lit(seed), F.lit("slot")).alias("again")))
    placed = global_row_number(sent, [F.col("shard"), F.col("again"), F.col("rid")], out="place", start=0)
    first = F.col("shard") * (total // shards) + F.least(F.col("shard"), F.lit(total % shards))
    placed = placed.select("rid", "shard", (F.col("place") - first).alias("slot"))
    return pinned.join(placed, "rid").select("row.*", "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder ``shard=k`` per shard, its files in slot order (a range
    partitioning: a shard may span several files, none is one task's whole)."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
