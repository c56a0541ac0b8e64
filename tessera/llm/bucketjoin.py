"""Verified similarity join of rows that share buckets (minhash bands, cap
filters), without pair rows.

A bucket is cut into blocks of bounded size, and every pair of its blocks is
one group; a row is copied to the groups of its block. Groups are spread over
all tasks, so a bucket with a third of all rows is the work of many tasks, and
each holds two blocks at most. A task compares the rows of its group exactly
and returns, per row with links, the number of its links and the smallest row
it is connected to inside the group: rows grow with the rows, not with the
pairs. Rows that meet in several buckets are counted in the smallest of them
only; buckets with the same members are looked at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

from .common import discard, small_batches
from .components import connected_components


def shared_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets (arrays of
    distinct 64-bit values). Values on both sides become columns of 0/1
    matrices, ``width`` at a time, so memory does not grow with the sets."""
    out = np.zeros((len(left), len(right)), np.float32)
    same = left is right
    lv = np.concatenate(left) if left else np.empty(0, np.int64)
    rv = lv if same else np.concatenate(right) if right else np.empty(0, np.int64)
    if not len(lv) or not len(rv):
        return out
    lr = np.repeat(np.arange(len(left)), [len(x) for x in left])
    rr = lr if same else np.repeat(np.arange(len(right)), [len(x) for x in right])
    values, inverse, counts = np.unique(lv if same else np.concatenate([lv, rv]), return_inverse=True, return_counts=True)
    column = np.full(len(values), -1, np.int64)
    hot = counts > 1
    column[hot] = np.arange(hot.sum())
    lc = column[inverse[:len(lv)]]
    rc = lc if same else column[inverse[len(lv):]]
    if same:  # a value of one set only counts for that set's overlap with itself, which nobody asks for
        pass
    for lo in range(0, int(hot.sum()), width):
        a = np.zeros((len(left), width), np.float32)
        k = (lc >= lo) & (lc < lo + width)
        a[lr[k], lc[k] - lo] = 1
        if same:
            b = a
        else:
            b = np.zeros((len(right), width), np.float32)
            k = (rc >= lo) & (rc < lo + width)
            b[rr[k], rc[k] - lo] = 1
        out += a @ b.T
    return out


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index connected to each of n rows by the links (i, j)."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _groups(batches, names: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Rows of sorted batches by (bucket, lo, hi): a group may span batches."""
    key, held = None, None
    for b in batches:
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
        if not b.num_rows:
            continue
        change = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0) | (np.diff(cols[2]) != 0)) + 1
        edges = [0, *change.tolist(), b.num_rows]
        for s, e in zip(edges, edges[1:]):
            k = tuple(int(c[s]) for c in cols)
            part = {n: b.column(n).slice(s, e - s) for n in names}
            if k == key:
                for n in names:
                    held[n].append(part[n])
            else:
                if key is not None:
                    yield key, held
                key, held = k, {n: [part[n]] for n in names}
    if key is not None:
        yield key, held


def _lists(chunks: list[pa.Array]) -> list[np.ndarray]:
    """The lists of a list column as arrays."""
    out = []
    for c in chunks:
        flat, off = c.flatten().to_numpy(zero_copy_only=False), c.offsets.to_numpy()
        out += np.split(flat, off[1:-1] - off[0]) if len(c) else []
    return out


def bucket_links(members: DataFrame, rows: DataFrame, linked: Callable[[list, list], np.ndarray],
                 payload: str, block_rows: int = 512, block_size: int = 2_000_000) -> DataFrame:
    """Links between rows that share a bucket and pass ``linked``.

    ``members``: bucket long, k binary. ``rows``: k binary (unique), copies
    long (rows that k stands for), ``payload`` (an array). ``linked(left,
    right)`` gets two lists of payload arrays and returns a boolean matrix.

    Returns k, links (copies of the linked others), root (the smallest k of
    its component) for every k with a link. A block has about ``block_rows``
    rows and ``block_size`` payload elements, which bounds a task's memory and
    cuts no rows off.
    """
    spark = rows.sparkSession
    members = materialize(members.distinct(), "members")
    digest = [F.count("*").alias("n"), F.sum(F.xxhash64("k").cast("decimal(38,0)")).alias("h1"),
              F.bit_xor(F.xxhash64(F.lit(1), "k")).alias("h2"), F.min("k").alias("h3")]
    useful = (members.groupBy("bucket").agg(*digest).where("n > 1")
              .groupBy("n", "h1", "h2", "h3").agg(F.min("bucket").alias("bucket")).select("bucket"))
    kept = materialize(members.join(useful, "bucket"), "buckets")
    lists = kept.groupBy("k").agg(F.sort_array(F.collect_list("bucket")).alias("buckets"))
    held = materialize(rows.join(lists, "k").withColumn("len", F.size(payload)), "rows")
    size = (kept.join(held.select("k", "len"), "k").groupBy("bucket")
            .agg(F.greatest(F.ceil(F.count("*") / block_rows), F.ceil(F.sum("len") / block_size)).alias("blocks")))
    spread = (held.select("k", "copies", payload, "buckets", F.explode("buckets").alias("bucket")).join(size, "bucket")
              .withColumn("blk", F.pmod(F.xxhash64("k", F.lit(5)), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
              .select("bucket", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"), "blk",
                      "k", "copies", "buckets", payload))
    names = ["blk", "k", "copies", "buckets", payload]

    def compare(batches) -> Iterator[pa.RecordBatch]:
        for (bucket, lo, hi), g in _groups(batches, names):
            blk = np.concatenate([c.to_numpy(zero_copy_only=False) for c in g["blk"]])
            ks = [x for c in g["k"] for x in c.to_pylist()]
            order = sorted(range(len(ks)), key=ks.__getitem__)
            copies = np.concatenate([c.to_numpy(zero_copy_only=False) for c in g["copies"]])
            data, buckets = _lists(g[payload]), _lists(g["buckets"])
            below = [x[x < bucket] for x in buckets]
            left = [r for r in order if blk[r] == lo]
            right = left if lo == hi else [r for r in order if blk[r] == hi]
            if not left or not right:
                continue
            x = [data[r] for r in left]
            y = x if right is left else [data[r] for r in right]
            ok = linked(x, y)
            x = [below[r] for r in left]
            y = x if right is left else [below[r] for r in right]
            ok &= shared_counts(x, y) == 0
            if right is left:
                np.fill_diagonal(ok, False)
            i, j = np.nonzero(ok)
            if not len(i):
                continue
            place = np.empty(len(ks), np.int64)
            place[order] = np.arange(len(ks))
            li, rj = np.array(left)[i], np.array(right)[j]
            links = np.zeros(len(ks), np.int64)
            np.add.at(links, li, copies[rj])
            if right is not left:
                np.add.at(links, rj, copies[li])
            root = _roots(len(ks), place[li], place[rj])
            hit = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array([ks[r] for r in hit], pa.binary()), pa.array(links[hit]),
                 pa.array([ks[order[root[place[r]]]] for r in hit], pa.binary())], names=["k", "links", "root"])

    with small_batches(spark, 256):
        found = materialize(spread.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
                            .mapInArrow(compare, "k binary, links long, root binary"), "links")
    discard(members, kept, held)
    comps = connected_components(found.where("k <> root"), "k", "root")
    return (found.groupBy("k").agg(F.sum("links").alias("links"))
            .join(comps.withColumnRenamed("node", "k"), "k"))
