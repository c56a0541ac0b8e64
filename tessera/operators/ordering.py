"""Positional numbering over a whole table without a single-partition window.

``row_number()`` over an un-partitioned window moves every row into one task.
Instead the table is range-partitioned by the sort key (a distributed sort), each
partition's row count is taken, and a prefix sum over those counts (one row per
partition, so the table is bounded by the partition count) gives every partition
its starting offset.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tessera.session import cut_lineage


def join_keys(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on shared ``keys`` where null matches null (group keys may be
    null); the keys appear once in the result."""
    keys = list(keys)
    if not keys:
        raise ValueError("join_keys needs at least one key")
    right = b.select(*[F.col(k).alias(f"_jr_{k}") for k in keys],
                     *[c for c in b.columns if c not in keys])
    cond = None
    for k in keys:
        e = a[k].eqNullSafe(right[f"_jr_{k}"])
        cond = e if cond is None else cond & e
    return a.join(right, cond, how).drop(*[f"_jr_{k}" for k in keys])


def global_row_number(df: DataFrame, order: list[Column | str], out: str = "row_number",
                      start: int = 1) -> DataFrame:
    """Number the rows of ``df`` by ``order`` (must be a total order) from ``start``."""
    ordered = (df.orderBy(*order)
               .withColumn("_gpid", F.spark_partition_id())
               .withColumn("_gmid", F.monotonically_increasing_id()))
    # Pin the partition contents so the counts and the rows agree even if a
    # task is re-run on another executor.
    ordered = cut_lineage(ordered)
    counts = ordered.groupBy("_gpid").agg(F.count(F.lit(1)).alias("_gn"),
                                          F.min("_gmid").alias("_gfirst"))
    before = Window.orderBy("_gpid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_gpid", "_gfirst",
                            F.coalesce(F.sum("_gn").over(before), F.lit(0)).alias("_goff"))
    # One row per partition: a broadcast with a bound set by the partition count.
    return (ordered.join(F.broadcast(offsets), "_gpid")
            .withColumn(out, F.col("_goff") + (F.col("_gmid") - F.col("_gfirst")) + F.lit(start))
            .drop("_gpid", "_gmid", "_gfirst", "_goff"))


def _hash_tiebreak(df: DataFrame) -> Column:
    """A per-row hash used only to spread equal sort keys over several range
    partitions; ties it separates are equal for every statistic built on it."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def blocked_frame(df: DataFrame, keys: list[str], order: list[str], lookback: int,
                  block_rows: int = 1_000_000) -> DataFrame:
    """Cut each ordered series into blocks of ``block_rows`` rows and copy the
    last ``lookback`` rows of every block into the next one ("halo").

    A window partitioned by ``keys + ['_blk']`` and ordered by ``_rn`` then sees
    up to ``lookback`` earlier rows of the same series, so trailing frames and
    lags are exact while no task holds more than ``block_rows + lookback`` rows,
    however long or skewed one series is. Keep rows with ``_halo = false``.
    """
    if lookback >= block_rows:
        raise ValueError("lookback must be smaller than block_rows")
    numbered = global_row_number(df, [*keys, *order], out="_rn")
    pos = F.col("_rn") - 1
    main = numbered.withColumns({"_blk": F.floor(pos / block_rows), "_halo": F.lit(False)})
    halo = (numbered.where(pos % block_rows >= block_rows - lookback)
            .withColumns({"_blk": F.floor(pos / block_rows) + 1, "_halo": F.lit(True)}))
    return main.unionByName(halo)


# --- segmented scan ---------------------------------------------------------
#: Compressed bytes of a range partition that are joined with its neighbours at
#: most: sorted rows pack well, and a partition's rows are in memory at once.
PARTITION_BYTES = "4m"


def _pinned(df: DataFrame) -> DataFrame:
    """``cut_lineage`` with partitions no larger than memory likes."""
    conf, name = df.sparkSession.conf, "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = conf.get(name)
    conf.set(name, PARTITION_BYTES)
    try:
        return cut_lineage(df)
    finally:
        conf.set(name, old)


def _segment_flags(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    """Key hashes, order hashes and weights of a partition's rows."""
    def col(name):
        return np.concatenate([b.column(b.schema.get_field_index(name)).to_numpy(zero_copy_only=False) for b in batches])
    return (np.stack([col("_k1"), col("_k2")]), np.stack([col("_o1"), col("_o2")]), col("_w"))


def _changes(h: np.ndarray) -> np.ndarray:
    """Whether each row differs from the one before it (the first one does)."""
    out = np.ones(h.shape[1], bool)
    out[1:] = (h[:, 1:] != h[:, :-1]).any(axis=0)
    return out


def _since(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Running sum of ``values`` before each row, from the last start on."""
    before = np.cumsum(values) - values
    return before - before[np.maximum.accumulate(np.where(start, np.arange(len(values)), 0))]


def segmented_scan(df: DataFrame, keys: list[str], order: list[Column], ties: list[str] = (),
                   weight: str | None = None) -> DataFrame:
    """``df`` sorted once by ``keys`` and ``order``, with the columns

    - ``_before``: rows (or ``weight``) of the same group before this row,
    - ``_total``: rows (or weight) of the group,
    - ``_tie``: ``_before`` of the first row with the same ``ties`` values,
    - ``_dense``: different ``ties`` values in the group before this one.

    A group may reach over any number of range partitions: what a partition
    has to know of its neighbours is a few numbers about its first and last
    group, one row a partition, so nothing is joined back to the table. Rows
    are compared by 128 bits of hash of their keys. A task holds one range
    partition, which a total order keeps near the others in size.
    """
    def hashes(names, a, b):
        cols = [x for c in names for x in (F.col(c).isNull(), F.col(c))] or [F.lit(0)]
        return F.xxhash64(F.lit(a), *cols), F.xxhash64(F.lit(b), *cols)

    k1, k2 = hashes(keys, 1, 2)
    o1, o2 = hashes(ties, 3, 4)
    w = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    work = df.withColumns({"_k1": k1, "_k2": k2, "_o1": o1, "_o2": o2, "_w": w})
    # pinned: both passes have to see the same partitions, also if a task runs again
    pinned = _pinned(work.orderBy(*[F.col(k) for k in keys], *order))

    def ends(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in it if b.num_rows]
        if not batches:
            return
        k, o, w = _segment_flags(batches)
        new = _changes(k)
        tie = new | _changes(o)
        last = int(np.flatnonzero(new)[-1])
        last_tie = int(np.flatnonzero(tie)[-1])
        one = bool(new.sum() == 1)
        first_end = len(w) if one else int(np.flatnonzero(new)[1])
        yield pa.RecordBatch.from_pylist([{
            "part": TaskContext.get().partitionId(), "first": k[:, 0].tolist(), "last": k[:, -1].tolist(),
            "first_tie": o[:, 0].tolist(), "last_tie": o[:, -1].tolist(), "one": one,
            "lead": int(w[:first_end].sum()), "trail": int(w[last:].sum()),
            "tie_at": int(w[last:last_tie].sum()), "one_tie": bool(tie[:first_end].sum() == 1 and one),
            "dense": int(tie[last:].sum())}], schema=_ENDS)

    found = sorted(pinned.select("_k1", "_k2", "_o1", "_o2", "_w").mapInArrow(ends, _ENDS_DDL).collect(), key=lambda r: r["part"])
    # from the left: the open group's weight, the start of its open tie, its ties so far
    carry: dict[int, list] = {}
    key = tie_key = None
    sum_, tie_at, dense = 0, 0, 0
    for r in found:
        same = key == r["first"]
        same_tie = same and tie_key == r["first_tie"]
        carry[r["part"]] = [sum_ if same else 0, tie_at if same_tie else None, dense if same else 0, 0, 0]
        joined = int(same_tie)
        if r["one"] and same:
            tie_at = tie_at if r["one_tie"] and same_tie else sum_ + r["tie_at"]
            sum_, dense = sum_ + r["trail"], dense + r["dense"] - joined
        else:
            sum_, tie_at, dense = r["trail"], r["tie_at"], r["dense"]
        key, tie_key = r["last"], r["last_tie"]
    # from the right: what the group open at a partition's end still gets
    key, ahead = None, 0
    for r in reversed(found):
        more = ahead if key == r["last"] else 0
        carry[r["part"]][3] = more
        ahead = r["lead"] + (more if r["one"] else 0)
        key = r["first"]

    def placed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in it if b.num_rows]
        if not batches:
            return
        k, o, w = _segment_flags(batches)
        left, tie_start, dense_left, right, _ = carry[TaskContext.get().partitionId()]
        new = _changes(k)
        tie = new | _changes(o)
        at = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        total = np.add.reduceat(w, at)
        total[0] += left
        total[-1] += right
        mine = group == 0
        before = _since(w, new) + np.where(mine, left, 0)
        tie_before = before[np.maximum.accumulate(np.where(tie, np.arange(len(w)), 0))]
        ties_so_far = np.cumsum(tie) - 1
        dense = ties_so_far - ties_so_far[at][group] + np.where(mine, dense_left, 0)
        if tie_start is not None:  # the first tie began in an earlier partition
            first_tie = np.cumsum(tie) == 1
            tie_before = np.where(first_tie, tie_start, tie_before)
            dense = dense - mine
        start = 0
        for b in batches:
            part = slice(start, start + b.num_rows)
            start += b.num_rows
            kept = [b.column(i) for i, f in enumerate(b.schema) if f.name not in _INNER]
            names = [f.name for f in b.schema if f.name not in _INNER]
            more = [pa.array(x[part].astype(np.int64)) for x in (before, total[group], tie_before, dense)]
            yield pa.RecordBatch.from_arrays(kept + more, names=names + ["_before", "_total", "_tie", "_dense"])

    out = StructType([f for f in pinned.schema if f.name not in _INNER])
    for name in ("_before", "_total", "_tie", "_dense"):
        out = out.add(name, LongType())
    return pinned.mapInArrow(placed, out)


_INNER = ("_k1", "_k2", "_o1", "_o2", "_w")
_ENDS_DDL = ("part int, first array<long>, last array<long>, first_tie array<long>, last_tie array<long>, one boolean,"
             " lead long, trail long, tie_at long, one_tie boolean, dense long")
_ENDS = pa.schema([("part", pa.int32()), *[(c, pa.list_(pa.int64())) for c in ("first", "last", "first_tie", "last_tie")],
                   ("one", pa.bool_()), *[(c, pa.int64()) for c in ("lead", "trail", "tie_at")], ("one_tie", pa.bool_()),
                   ("dense", pa.int64())])


def rank_within(df: DataFrame, keys: list[str], order: list[str], ascending: bool | list[bool] = True,
                out_prefix: str = "",
                kinds: tuple[str, ...] = ("rank", "percent_rank")) -> DataFrame:
    """rank / dense_rank / percent_rank / row_number inside ``keys`` groups,
    with the meaning of the SQL window functions, from one distributed sort
    (``segmented_scan``) instead of one sort task per group.

    ``row_number`` breaks ties by a row hash; pass a unique ``order`` for a
    fixed numbering.
    """
    asc = [ascending] * len(order) if isinstance(ascending, bool) else list(ascending)
    sort = [F.col(c).asc_nulls_first() if a else F.col(c).desc_nulls_last() for c, a in zip(order, asc)]
    scanned = segmented_scan(df, list(keys), [*sort, _hash_tiebreak(df)], list(order))
    rank = F.col("_tie") + 1
    made = {"rank": rank, "dense_rank": F.col("_dense") + 1, "row_number": F.col("_before") + 1,
            "percent_rank": F.when(F.col("_total") > 1, F.col("_tie") / (F.col("_total") - 1)).otherwise(F.lit(0.0))}
    return scanned.select(*df.columns, *[made[k].alias(out_prefix + k) for k in made if k in kinds])


def _attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate as scalar subqueries."""
    return df.withColumns({c: one_row.select(c).scalar() for c in one_row.columns})


def exact_quantiles(df: DataFrame, value: str, probs: list[float], keys: list[str] = (),
                    out: str = "value") -> DataFrame:
    """Linear-interpolated quantiles (pandas / numpy default, SQL
    ``percentile``), exact, from one distributed sort of the distinct
    (keys, value) pairs.

    Spark's ``percentile`` keeps every distinct value of a group in one
    aggregation buffer. Here equal values are first counted (partial
    aggregation: a value holding a third of the rows becomes one weighted
    row) and a segmented scan gives each pair its count interval in its group
    and the group's size, so each pair knows by itself which target positions
    it holds: nothing is joined on the group key, and only pairs with a target
    reach the last aggregation. Returns one row per (keys, prob).
    """
    keys = list(keys)
    base = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    counts = base.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    pairs = segmented_scan(counts, keys, [F.col("_v")], weight="_c")
    stop = F.col("_before") + F.col("_c")
    hits = []
    for i, p in enumerate(probs):
        at = (F.col("_total") - 1) * F.lit(float(p))
        for low, place in ((True, F.floor(at)), (False, F.ceil(at))):
            hits.append(F.when((place >= F.col("_before")) & (place < stop), F.struct(
                F.lit(i).alias("i"), F.lit(low).alias("low"), (at - F.floor(at)).alias("part"))))
    held = pairs.select(*keys, "_v", F.explode(F.array_compact(F.array(*hits))).alias("h")).select(*keys, "_v", "h.*")
    low, high = F.max(F.when(F.col("low"), F.col("_v"))), F.max(F.when(~F.col("low"), F.col("_v")))
    prob = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("i") + 1)
    # i numbers the probabilities, so that two equal ones stay two rows
    return (held.groupBy(*keys, "i").agg((low + (high - low) * F.max("part")).alias(out))
            .select(*keys, prob.alias("prob"), out))
