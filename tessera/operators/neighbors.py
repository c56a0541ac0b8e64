"""Exact nearest neighbours through a space partition.

Equal points are one class. Classes are dealt to the leaves of a tree of median
splits; the neighbours inside a class's own leaf bound the distance of its k-th
one, and only leaves whose bounding box lies within that bound see it as a
query. Nothing is approximated: the bound prunes leaves, never neighbours.

Leaves that lie together are one slab. A class is sent once to a slab, however
many of its leaves it meets, so what is moved grows with classes x slabs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordering import global_row_number
from tessera.session import discard, materialize

#: Rows of a distance tile on either side.
TILE = 2048
#: Classes of a slab of leaves, and queries that one task holds against it.
SLAB = 65_536
SLAB_QUERIES = 32_768


@dataclass
class Splits:
    """A binary tree in arrays: inner nodes have a dimension, a cut (<= goes
    left) and two children, leaves a number."""

    dim: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaf: np.ndarray

    @staticmethod
    def grow(sample: np.ndarray, leaves: int) -> Splits:
        """Median splits of the widest dimension, always of the leaf with the
        most sampled points, until there are ``leaves`` or no split is left."""
        import heapq
        rows = [[0, 0.0, -1, -1]]
        heap = [(-len(sample), 0, np.arange(len(sample)))]
        done = 0
        while heap and len(heap) + done < leaves:
            _, at, idx = heapq.heappop(heap)
            x = sample[idx]
            spread = x.max(axis=0) - x.min(axis=0) if len(x) else np.zeros(sample.shape[1])
            dim = int(np.argmax(spread))
            if len(x) < 2 or not spread[dim] > 0:
                done += 1
                continue
            cut = float(np.sort(x[:, dim])[(len(x) - 1) // 2])
            if not (x[:, dim] > cut).any():  # the median is the maximum: the next lower value separates
                cut = float(x[:, dim][x[:, dim] < cut].max())
            go = x[:, dim] <= cut
            rows[at] = [dim, cut, len(rows), len(rows) + 1]
            for part in (idx[go], idx[~go]):
                rows.append([0, 0.0, -1, -1])
                heapq.heappush(heap, (-len(part), len(rows) - 1, part))
        dim, cut, left, right = (np.array(c) for c in zip(*rows))
        leaf = np.where(left < 0, np.cumsum(left < 0) - 1, -1)
        return Splits(dim.astype(int), cut, left.astype(int), right.astype(int), leaf)

    def in_order(self) -> np.ndarray:
        """The leaves from left to right: neighbours in this order lie together."""
        out, todo = [], [0]
        while todo:
            at = todo.pop()
            if self.left[at] < 0:
                out.append(self.leaf[at])
            else:
                todo += [self.right[at], self.left[at]]
        return np.array(out)

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        node = np.zeros(len(x), int)
        at = np.arange(len(x))
        while True:
            inner = self.left[node] >= 0
            if not inner.any():
                return self.leaf[node]
            go = x[at, self.dim[node]] <= self.cut[node]
            node = np.where(inner, np.where(go, self.left[node], self.right[node]), node)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d2 = np.zeros((len(a), len(b)))
    for c in range(a.shape[1]):  # sum squared differences coordinate by coordinate
        diff = a[:, c][:, None] - b[:, c][None, :]
        d2 += diff * diff
    return np.sqrt(d2)


def _near_pairs(a: np.ndarray, b: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``a``, rows of ``b`` and distances of all pairs within ``r`` of
    the row of ``a``. A matrix product rules out pairs that are farther by more
    than its rounding error can be; the distances of the others are sums
    of squared differences, as ``_distances`` makes them."""
    mid = b.mean(axis=0)
    sa, sb = a - mid, b - mid
    na, nb = (sa * sa).sum(axis=1), (sb * sb).sum(axis=1)
    d2 = na[:, None] + nb[None, :] - 2.0 * (sa @ sb.T)
    slack = 1e-12 * a.shape[1] * (na[:, None] + nb[None, :])
    bound = np.minimum(r * (1 + 1e-9), 1e150)[:, None] ** 2
    i, j = np.nonzero(~(d2 > bound + slack))  # a product that overflowed rules out nothing
    total = np.zeros(len(i))
    for c in range(a.shape[1]):
        diff = a[i, c] - b[j, c]
        total += diff * diff
    return i, j, np.sqrt(total)


def _to_boxes(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Distance of every point to every box."""
    d2 = np.zeros((len(x), len(low)))
    for c in range(x.shape[1]):
        v = x[:, c][:, None]
        out = np.maximum(np.maximum(low[:, c] - v, v - high[:, c]), 0.0)
        d2 += out * out
    return np.sqrt(d2)


def _slabs(n: np.ndarray) -> np.ndarray:
    """Where slabs begin among leaves of ``n`` classes: a slab has up to ``SLAB`` classes, or one larger leaf."""
    starts, held = [0], 0
    for at, size in enumerate(n):
        if held and held + size > SLAB:
            starts.append(at)
            held = 0
        held += size
    return np.array(starts)


def _radius(distance: np.ndarray, sizes: np.ndarray, need: np.ndarray) -> np.ndarray:
    """For each row the distance within which its ``need`` nearest members lie
    (infinite if there are too few); ``sizes`` are the columns' members."""
    order = np.argsort(distance, axis=1)
    have = np.cumsum(sizes[order], axis=1)
    k = (have < need[:, None]).sum(axis=1)
    sorted_ = np.take_along_axis(distance, order, axis=1)
    far = np.append(sorted_, np.full((len(distance), 1), np.inf), axis=1)
    return np.where(need <= 0, 0.0, far[np.arange(len(distance)), k])


def neighbor_classes(df: DataFrame, vec_col: str, id_col: str, k: int, block_size: int = 1024,
                     sample: int = 65_536) -> tuple[DataFrame, DataFrame, DataFrame, dict]:
    """(points: id, v; classes: v, cls, ids; near: cls, near; report).

    A class is a set of equal points: cls is its smallest id, ids its k + 1
    smallest; near holds the k nearest points of other classes as (distance,
    id). Splits come from at most ``sample`` classes chosen by hash, and there
    are at most ``sample`` / 16 leaves: leaf boxes are the only thing that all
    tasks get. report counts points, classes, leaves, the leaves that classes
    met as queries (copies) and the rows that were sent for it, one a slab (sent)."""
    spark = df.sparkSession
    v = F.transform(vec_col, lambda x: x.cast("double") + F.lit(0.0))  # -0.0 becomes 0.0
    good = (F.size(vec_col) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    points = df.where(F.col(id_col).isNotNull() & good).select(F.col(id_col).alias("id"), v.alias("v"))
    points = materialize(points, "knn-points")
    first = Window.partitionBy("v").orderBy("id")
    classes = (points.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
               .groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
               .select("v", F.get("ids", 0).alias("cls"), "ids"))
    classes = materialize(classes, "knn-classes")
    n = classes.count()
    report = {"points": points.count(), "classes": n, "leaves": 0, "copies": 0, "sent": 0}
    empty = "cls long, near array<struct<distance: double, id: long>>"
    if n == 0:
        return points, classes, spark.createDataFrame([], empty), report
    some = classes.select("v") if n <= sample else classes.orderBy(F.xxhash64("v")).select("v").limit(sample)
    known = np.array([r["v"] for r in some.collect()])
    d = known.shape[1]
    splits = Splits.grow(known, max(1, min(-(-n // block_size), sample // 16)))

    def place(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pdf.assign(leaf=splits.place(np.stack(pdf["v"].to_numpy())) if len(pdf) else [])

    placed = classes.mapInPandas(place, "v array<double>, cls long, ids array<long>, leaf int")
    placed = materialize(placed, "knn-leaves")
    bounds = placed.groupBy("leaf").agg(F.count("*").alias("n"), *[f(F.get("v", c)).alias(f"{name}{c}")
                                        for c in range(d) for name, f in (("l", F.min), ("h", F.max))]).toPandas()
    seen = set(bounds["leaf"])
    bounds = bounds.set_index("leaf").loc[[leaf for leaf in splits.in_order() if leaf in seen]].reset_index()
    low, high = (bounds[[f"{name}{c}" for c in range(d)]].to_numpy(float) for name in "lh")
    leaves = bounds["leaf"].to_numpy()
    report["leaves"] = len(leaves)
    starts = _slabs(bounds["n"].to_numpy())
    slab_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(leaves))))

    # first round: a class and the others of its leaf (of its part of a large leaf)
    part = F.pmod(F.xxhash64("cls"), F.greatest(F.lit(1), F.col("n") / TILE).cast("long"))
    sizes = spark.createDataFrame(bounds[["leaf", "n"]].astype({"leaf": "int32"}), "leaf int, n long")

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["v"].to_numpy())
        members = np.array([len(i) for i in pdf["ids"]])
        r, most = np.empty(len(x)), np.empty(len(x))
        for a in range(0, len(x), 256):
            rows = np.arange(a, min(a + 256, len(x)))
            dist = _distances(x[rows], x)
            dist[np.arange(len(rows)), rows] = np.inf
            r[rows] = _radius(dist, members, k - (members[rows] - 1))
            most[rows] = _radius(dist, members, np.full(len(rows), k))  # k of other classes, should ids repeat
        return pdf[["v", "cls"]].assign(r=r, most=most)

    bounded = (placed.join(sizes, "leaf").withColumn("part", part).select("leaf", "part", "v", "cls", "ids")
               .groupBy("leaf", "part").applyInPandas(own, "v array<double>, cls long, r double, most double"))

    def sent(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for a in range(0, len(pdf), 512):
                rows = pdf.iloc[a:a + 512]
                r = rows["r"].to_numpy()
                meets = _to_boxes(np.stack(rows["v"].to_numpy()), low, high) <= (r * (1 + 1e-9))[:, None]
                meets &= (r > 0)[:, None]  # a class of k + 1 equal points needs no others
                n = np.add.reduceat(meets, starts, axis=1, dtype=np.int64)
                q, s = np.nonzero(n)
                yield pd.DataFrame({"slab": s.astype(np.int32), "v": rows["v"].to_numpy()[q], "cls": rows["cls"].to_numpy()[q],
                                    "r": r[q], "most": rows["most"].to_numpy()[q], "meets": n[q, s]})

    queries = materialize(bounded.mapInPandas(
        sent, "slab int, v array<double>, cls long, r double, most double, meets long"), "knn-queries")
    # second round: a slab and a part of its queries
    asked = {r["slab"]: r for r in queries.groupBy("slab").agg(F.count("*").alias("q"), F.sum("meets").alias("meets")).collect()}
    report["copies"] = sum(r["meets"] for r in asked.values())
    report["sent"] = sum(r["q"] for r in asked.values())
    members = np.add.reduceat(bounds["n"].to_numpy(), starts)
    spread = -(-4 * spark.sparkContext.defaultParallelism // len(starts))  # few slabs: more, smaller parts
    tiles = F.broadcast(spark.createDataFrame(
        [(s, max(-(-r["q"] // SLAB_QUERIES), min(-(-r["q"] // TILE), spread)), -(-int(members[s]) // SLAB)) for s, r in asked.items()],
        "slab int, qt int, rt int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    share = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    none, zero = F.array().cast("array<long>"), F.lit(0.0)
    held = placed.join(F.broadcast(spark.createDataFrame(
        [(int(leaf), at, int(s)) for at, (leaf, s) in enumerate(zip(leaves, slab_of))], "leaf int, at int, slab int")), "leaf")
    both = (queries.join(tiles, "slab").select("slab", share("qt").alias("q"), every("rt").alias("t"), "v", "cls",
                                               none.alias("ids"), "r", "most", F.lit(-1).alias("at"), F.lit(True).alias("asks"))
            .unionByName(held.join(tiles, "slab").select("slab", every("qt").alias("q"), share("rt").alias("t"), "v", "cls", "ids",
                                                         zero.alias("r"), zero.alias("most"), "at", F.lit(False).alias("asks"))))

    def tile(pdf: pd.DataFrame) -> pd.DataFrame:
        qs, rs = pdf[pdf["asks"]], pdf[~pdf["asks"]].sort_values("at", kind="stable")
        out: list[list] = [[np.empty(0, np.int64)], [np.empty(0)], [np.empty(0, np.int64)]]
        if len(qs) and len(rs):
            b, cls, at = np.stack(rs["v"].to_numpy()), rs["cls"].to_numpy(), rs["at"].to_numpy()
            counts = np.minimum([len(i) for i in rs["ids"]], k)
            first, ids = np.cumsum(counts) - counts, np.concatenate([np.asarray(i)[:k] for i in rs["ids"]])
            begin = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            end, here = np.append(begin[1:], len(at)), at[begin]
            for a in range(0, len(qs), 256):
                part = qs.iloc[a:a + 256]
                mine, x, r = part["cls"].to_numpy(), np.stack(part["v"].to_numpy()), part["most"].to_numpy().copy()
                meets = _to_boxes(x, low[here], high[here]) <= (part["r"].to_numpy() * (1 + 1e-9))[:, None]
                row, far, who = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
                for leaf, lo, hi in ((c, lo, min(lo + TILE, end[c])) for c in range(len(here)) for lo in range(begin[c], end[c], TILE)):
                    go = np.flatnonzero(meets[:, leaf])
                    i, j, d = _near_pairs(x[go], b[lo:hi], r[go])
                    i, j = go[i], j + lo
                    other = (mine[i] != cls[j]) & np.isfinite(d)
                    i, j, d = i[other], j[other], d[other]
                    n = counts[j]  # members of each class met
                    whom = ids[np.repeat(first[j] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                    row, far, who = np.append(row, np.repeat(i, n)), np.append(far, np.repeat(d, n)), np.append(who, whom)
                    order = np.lexsort((who, far, row))
                    s = row[order]
                    start = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.empty(0, int)
                    place = np.arange(len(s)) - np.repeat(start, np.diff(np.append(start, len(s))))
                    full = order[place == k - 1]
                    r[row[full]] = np.minimum(r[row[full]], far[full])  # a query's k-th distance so far
                    best = order[place < k]
                    row, far, who = row[best], far[best], who[best]
                out[0].append(mine[row])
                out[1].append(far)
                out[2].append(who)
        cols = [np.concatenate(c) for c in out]
        return pd.DataFrame({"cls": cols[0].astype(np.int64), "distance": cols[1].astype(float), "id": cols[2].astype(np.int64)})

    found = both.groupBy("slab", "q", "t").applyInPandas(tile, "cls long, distance double, id long")
    order = Window.partitionBy("cls").orderBy("distance", "id")
    near = (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("distance", "id"))).alias("near")))
    near = materialize(near, "knn-near")
    discard(queries, placed)
    return points, classes, near, report


def nearest(df: DataFrame, vec_col: str, id_col: str, k: int, **options) -> DataFrame:
    """id_col, neighbor, distance, rank: the ``k`` nearest other points of
    every point with a whole vector (all there are, if fewer), by Euclidean
    distance, ties by the neighbour's id. Ids are unique and of any type that
    sorts; points with a null id, a null or empty vector or one with null,
    NaN or infinite coordinates have no neighbours and are nobody's."""
    kind = df.schema[id_col].dataType
    named = None
    if kind.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        named = materialize(global_row_number(df.select(F.col(id_col).alias("name")).where("name is not null").distinct(),
                                              ["name"], out="no"), "knn-names")
        df = df.join(named, df[id_col] == named["name"]).select(F.col("no").alias(id_col), vec_col)
    df = df.select(F.col(id_col).cast("long").alias(id_col), vec_col)
    points, classes, near, _ = neighbor_classes(df, vec_col, id_col, k, **options)
    own = F.transform(F.filter("ids", lambda i: i != F.col("id")), lambda i: F.struct(F.lit(0.0).alias("distance"), i.alias("id")))
    both = F.slice(F.array_sort(F.concat(own, F.coalesce("near", F.array().cast("array<struct<distance: double, id: bigint>>")))), 1, k)
    out = (points.join(classes, "v").join(near, "cls", "left").select("id", F.posexplode(both).alias("at", "n"))
           .select(F.col("id").alias(id_col), F.col("n.id").alias("neighbor"), "n.distance", (F.col("at") + 1).alias("rank")))
    if named is None:
        return out
    who, whom = (named.select(F.col("no").alias(c), F.col("name").alias(f"_{c}")) for c in (id_col, "neighbor"))
    return out.join(who, id_col).join(whom, "neighbor").select(
        F.col(f"_{id_col}").alias(id_col), F.col("_neighbor").alias("neighbor"), "distance", "rank")
