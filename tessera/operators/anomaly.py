"""Anomaly scores: isolation forest (L7), local outlier factor (L8) and a
one-class RBF boundary (L9)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.features import _numbered_within, uniform_hash
from tessera.operators.neighbors import nearest
from tessera.operators.ordering import exact_quantiles
from tessera.session import cut_lineage, discard, materialize, scratch_path

EULER_GAMMA = 0.5772156649015329


def avg_path_length(n):
    """c(n): mean path length of an unsuccessful search in a binary search
    tree of n points (the isolation-forest normaliser)."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _path_length(n: Column) -> Column:
    """``avg_path_length`` as a column."""
    return (F.when(n > 2, 2 * (F.log(n - 1.0) + EULER_GAMMA) - 2 * (n - 1.0) / n)
            .when(n == 2, F.lit(1.0)).otherwise(F.lit(0.0)))


def isolation_draws(seed: int) -> tuple[Column, Column]:
    """Two seeded numbers in [0, 1) for the columns ``tree`` and ``node``: one
    picks the feature, the other the threshold."""
    return tuple(F.pmod(F.xxhash64(F.lit(seed), F.lit(k), "tree", "node"), F.lit(1 << 53)) / float(1 << 53) for k in (1, 2))


#: Records of a node from which one task grows the rest of its tree.
LOCAL_ROWS = 1 << 18
#: Rows that a task holds to send them to nodes, and records of one packed row.
HELD = 1 << 16
BLOCK = 1 << 12


def _hash_step(value: np.ndarray, seed: np.ndarray, wide: bool) -> np.ndarray:
    """Spark's ``xxhash64`` of one int (``wide``: long) column on top of ``seed``."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                                 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda h, n: (h << np.uint64(n)) | (h >> np.uint64(64 - n))
    value = np.asarray(value, np.int64).view(np.uint64)
    if wide:
        h = (seed + p5 + np.uint64(8)) ^ (turn(value * p2, 31) * p1)
        h = turn(h, 27) * p1 + p4
    else:
        h = (seed + p5 + np.uint64(4)) ^ ((value & np.uint64(0xFFFFFFFF)) * p1)
        h = turn(h, 23) * p2 + p3
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def _draws(seed: int, tree: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``isolation_draws`` of an int ``tree`` and long ``node``s."""
    out = []
    for k in (1, 2):
        h = np.full(len(node), 42, np.uint64)
        for v, wide in ((seed, not -(1 << 31) <= seed < 1 << 31), (k, False), (tree, False), (node, True)):
            h = _hash_step(np.broadcast_to(np.asarray(v, np.int64), len(node)).copy(), h, wide)
        out.append((h & np.uint64((1 << 53) - 1)) / float(1 << 53))
    return out[0], out[1]


def _columns(batches: Iterator[pa.RecordBatch], d: int, rows: int) -> Iterator[tuple]:
    """ids, x (a row of ``d`` numbers each, NaN for null) and fits (a row a
    tree, or one for all) of at least ``rows`` rows at a time."""
    held: list[pa.RecordBatch] = []

    def joined() -> tuple:
        table = pa.Table.from_batches(held).combine_chunks()
        n = table.num_rows
        x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, d)
        fits = table["fits"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(bool).reshape(n, -1).T
        return table["id"].combine_chunks(), x, fits

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield joined()
            held = []
    if held:
        yield joined()


def _descend(x: np.ndarray, tops: list[dict], tree: int) -> tuple[np.ndarray, np.ndarray]:
    """Node and level of every row below the large nodes of a tree; a row of a
    large leaf stays there. ``tops`` has nodes (sorted), features (-1: leaf),
    thresholds and sizes of a level's large nodes for each tree."""
    at, level, live = np.ones(len(x), np.int64), np.zeros(len(x), np.int64), np.arange(len(x))
    for k, top in enumerate(tops):
        if tree not in top:
            break
        nodes, feature, cut, _ = top[tree]
        place = np.minimum(np.searchsorted(nodes, at[live]), len(nodes) - 1)
        go = (nodes[place] == at[live]) & (feature[place] >= 0)
        live, place = live[go], place[go]
        at[live] = 2 * at[live] + ~(x[live, feature[place]] <= cut[place])
        level[live] = k + 1
    return at, level


def _starts(sorted_: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(sorted_) else np.empty(0, int)


def _node_ranges(batches: Iterator[pa.RecordBatch], d: int, trees: int, tops: list[dict]) -> Iterator[pa.RecordBatch]:
    """tree, node, size, records, lo, hi (a number a feature) of a partition's
    rows that have come to the level below ``tops``."""
    for _, x, fits in _columns(batches, d, 1):
        for tree in range(trees):
            if tops and tree not in tops[-1]:
                continue
            grows = fits[tree % len(fits)]
            if tops or not tree or len(fits) > 1:  # otherwise all trees have the same root
                at, level = _descend(x, tops, tree)
                rows = np.flatnonzero(level == len(tops))
                rows = rows[np.argsort(at[rows], kind="stable")]
                start = _starts(at[rows])
                if not len(start):
                    continue
                seen = np.where(grows[rows][:, None], x[rows], np.nan)
                lo, hi = np.fmin.reduceat(seen, start, axis=0), np.fmax.reduceat(seen, start, axis=0)
                size = np.add.reduceat(grows[rows].astype(np.int64), start)
            ends = np.arange(0, (len(start) + 1) * d, d, dtype=np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(v.ravel(), mask=np.isnan(v.ravel()))) for v in (lo, hi)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(start), tree, np.int32)), pa.array(at[rows][start]), pa.array(size),
                 pa.array(np.diff(np.append(start, len(rows)))), *lists], ["tree", "node", "size", "records", "lo", "hi"])


def _leaf_sizes(tops: list[dict], tree: int, node: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Sizes of the large leaves among ``node``; -1 for nodes that are not large."""
    out = np.full(len(node), -1, np.int64)
    for k, top in enumerate(tops):
        if tree in top:
            nodes, _, _, sizes = top[tree]
            place = np.minimum(np.searchsorted(nodes, node), len(nodes) - 1)
            here = (level == k) & (nodes[place] == node)
            out[here] = sizes[place[here]]
    return out


def _sent_to_nodes(batches: Iterator[pa.RecordBatch], d: int, trees: int, tops: list[dict]) -> Iterator[pa.RecordBatch]:
    """A partition's records below the large nodes, packed by tree and node: ids, x and fits as bytes."""
    for ids, x, fits in _columns(batches, d, HELD):
        for tree in range(trees):
            grows = fits[tree % len(fits)]
            at, level = _descend(x, tops, tree)
            order = np.flatnonzero(_leaf_sizes(tops, tree, at, level) < 0)
            order = order[np.argsort(at[order], kind="stable")]
            if not len(order):
                continue
            cuts = np.unique(np.append(_starts(at[order]), np.arange(0, len(order), BLOCK)))
            rows = np.split(order, cuts[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), tree, np.int32)), pa.array(at[order][cuts]), pa.array(level[order][cuts].astype(np.int32)),
                 pa.ListArray.from_arrays(np.append(cuts, len(order)).astype(np.int32), ids.take(pa.array(order))),
                 pa.array([x[r].tobytes() for r in rows], pa.binary()), pa.array([grows[r].tobytes() for r in rows], pa.binary())],
                ["tree", "node", "level", "ids", "x", "fits"])


def _in_large_leaves(batches: Iterator[pa.RecordBatch], d: int, trees: int, tops: list[dict]) -> Iterator[pa.RecordBatch]:
    """id, level, size for a partition's records that end in a large leaf."""
    for ids, x, fits in _columns(batches, d, HELD):
        for tree in range(trees):
            at, level = _descend(x, tops, tree)
            size = _leaf_sizes(tops, tree, at, level)
            rows = np.flatnonzero(size >= 0)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(level[rows].astype(np.int32)), pa.array(size[rows])],
                                             ["id", "level", "size"])


def _finish_node(table: pa.Table, depth: int, seed: int) -> pa.Table:
    """The part of a tree below one node, from all records in it: a row for
    every node (no id) and one for every record (its leaf's level and size)."""
    ids = table["ids"].combine_chunks().flatten()
    n, level = len(ids), table["level"][0].as_py()
    x = np.frombuffer(b"".join(table["x"].to_pylist())).reshape(n, -1)
    fits = np.frombuffer(b"".join(table["fits"].to_pylist()), bool)
    tree, at = table["tree"][0].as_py(), np.full(n, table["node"][0].as_py(), np.int64)
    ended, size_of = np.full(n, -1), np.zeros(n, np.int64)
    live, nodes = np.arange(n), []
    while len(live):
        live = live[np.argsort(at[live], kind="stable")]
        start = np.flatnonzero(np.append(True, at[live][1:] != at[live][:-1]))
        node, of = at[live][start], np.repeat(np.arange(len(start)), np.diff(np.append(start, len(live))))
        size = np.add.reduceat(fits[live].astype(np.int64), start)
        seen = np.where(fits[live][:, None], x[live], np.nan)
        lo, hi = np.fmin.reduceat(seen, start, axis=0), np.fmax.reduceat(seen, start, axis=0)
        usable = (lo < hi) & (level < depth)
        count = usable.sum(axis=1)
        which, where = _draws(seed, tree, node)
        f = np.argmax(np.cumsum(usable, axis=1) > np.floor(which * count)[:, None], axis=1)
        k = np.arange(len(node))
        with np.errstate(invalid="ignore", over="ignore"):
            cut = lo[k, f] + where * (hi[k, f] - lo[k, f])
        cut = np.where(cut < hi[k, f], cut, lo[k, f])
        nodes.append((node, size, np.where(count > 0, f, -1), cut))
        leaf = count[of] == 0
        ended[live[leaf]], size_of[live[leaf]] = level, size[of[leaf]]
        live, of = live[~leaf], of[~leaf]
        at[live] = 2 * at[live] + ~(x[live, f[of]] <= cut[of])
        level += 1
    node, size, f, cut = (np.concatenate(c) for c in zip(*nodes))
    m = len(node)
    none = f < 0
    return pa.table({
        "id": pa.concat_arrays([ids, pa.nulls(m, ids.type)]), "is_node": np.arange(n + m) >= n,
        "tree": pa.array(np.full(n + m, tree, np.int32)), "node": np.append(at, node), "size": np.append(size_of, size),
        "feature": pa.array(np.append(np.zeros(n, np.int32), f.astype(np.int32)), mask=np.append(np.ones(n, bool), none)),
        "threshold": pa.array(np.append(np.zeros(n), cut), mask=np.append(np.ones(n, bool), none)),
        "level": pa.array(np.append(ended, np.zeros(m, int)).astype(np.int32))})


def _node_splits(rows: DataFrame, d: int, trees: int, tops: list[dict], last: bool, seed: int) -> DataFrame:
    """tree, node, size, records, feature (from 0), threshold of every node
    that holds a row on the level below ``tops``: of its features with two
    values or more one is drawn, and a threshold between its least and greatest
    value. A leaf has no feature."""
    parts = rows.mapInArrow(lambda it: _node_ranges(it, d, trees, tops),
                            "tree int, node long, size long, records long, lo array<double>, hi array<double>")
    stats = parts.groupBy("tree", "node").agg(
        F.sum("size").alias("size"), F.sum("records").alias("records"),
        F.array(*[F.struct(F.min(F.get("lo", k)).alias("lo"), F.max(F.get("hi", k)).alias("hi"), F.lit(k).alias("f"))
                  for k in range(d)]).alias("r"))
    which, where = isolation_draws(seed)
    open_ = F.filter("r", lambda r: (r["lo"] < r["hi"]) & F.lit(not last))
    pick = F.get(F.col("open"), F.floor(which * F.size("open")).cast("int"))
    cut = F.col("p.lo") + where * (F.col("p.hi") - F.col("p.lo"))
    return (stats.select("tree", "node", "size", "records", open_.alias("open")).withColumn("p", F.when(F.size("open") > 0, pick))
            .select("tree", "node", "size", "records", F.col("p.f").alias("feature"),
                    F.when(cut < F.col("p.hi"), cut).otherwise(F.col("p.lo")).alias("threshold")))


def grow_isolation_trees(df: DataFrame, features: list[str], id_col: str, trees: int = 100,
                         max_samples: int | None = None, seed: int = 0,
                         fits: Column | None = None) -> tuple[DataFrame, DataFrame, int]:
    """Grow ``trees`` random trees level by level over the rows where ``fits``
    holds (default: all). Returns (id, height: mean path length over the
    trees), (tree, node, size, feature, threshold) and the rows a tree grows from.

    A level is one pass over the rows: a task finds each row's node in every
    tree from the splits of the large nodes so far, and counts, minima and
    maxima of the nodes are combined. Nodes of more than ``LOCAL_ROWS`` records
    are split that way, and only their splits reach the driver (at most
    trees x rows / ``LOCAL_ROWS`` a level). Then the records of each node below
    them go, packed, to one task, which grows the rest of its tree with
    the same draws. With ``max_samples`` below their number a tree
    grows from the rows with the smallest seeded hashes of that tree.
    """
    spark = df.sparkSession
    x = [F.col(f"`{c}`").cast("double") for c in features]
    base = df.select(F.col(f"`{id_col}`").alias("id"),
                     F.array(*[F.when(~F.isnan(c), c) for c in x]).alias("x"),
                     (F.lit(True) if fits is None else F.coalesce(fits, F.lit(False))).alias("fits"))
    base = materialize(base, "isolation-rows")
    n = base.where("fits").count()
    psi = n if max_samples is None else min(max_samples, n)
    depth = math.ceil(math.log2(max(psi, 2)))
    if psi < n:
        live = (base.withColumn("row", F.monotonically_increasing_id())  # ids may repeat
                .withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))))
        hashed = live.withColumn("h", uniform_hash("id", seed, F.col("tree")))
        share = min(1.0, (psi + 6 * math.sqrt(psi) + 20) / n)
        near = hashed.where(F.col("fits") & (F.col("h") < share)).select("tree", "h", "id")
        if near.groupBy("tree").count().where(F.col("count") >= psi).count() < trees:
            near = hashed.where("fits").select("tree", "h", "id")
        last = _numbered_within(near, ["tree"], [F.col("h"), F.col("id")]).where(F.col("_pos") == psi)
        last = last.select("tree", F.struct("h", "id").alias("last"))
        chosen = (hashed.join(F.broadcast(last), "tree")
                  .select("row", "id", "x", "tree", (F.col("fits") & (F.struct("h", "id") <= F.col("last"))).alias("fits")))
        rows = chosen.groupBy("row").agg(F.first("id").alias("id"), F.first("x").alias("x"), F.array_sort(F.collect_list(F.struct("tree", "fits"))).alias("f"))
        rows = materialize(rows.select("id", "x", F.col("f.fits").alias("fits")), "isolation-chosen")
    else:
        rows = base.select("id", "x", F.array("fits").alias("fits"))
    d, nodes, tops = len(features), [], []
    kind = df.schema[id_col].dataType.simpleString()
    for level in range(depth + 1):
        splits = materialize(_node_splits(rows, d, trees, tops, level == depth, seed), "isolation-nodes")
        large = splits.where((F.col("records") > LOCAL_ROWS) | (F.lit(level) == depth))
        top: dict[int, list] = {}
        for r in large.orderBy("tree", "node").collect():
            top.setdefault(r["tree"], []).append((r["node"], -1 if r["feature"] is None else r["feature"], r["threshold"] or 0.0, r["size"]))
        if not top:
            break
        nodes.append(large.select("tree", "node", "size", "feature", "threshold"))
        tops.append({tree: tuple(np.array(c, t) for c, t in zip(zip(*of), (np.int64, np.int64, float, np.int64))) for tree, of in top.items()})
    grown = (f"id {kind}, is_node boolean, tree int, node long, size long, feature int, threshold double, level int")
    packed = rows.mapInArrow(lambda it: _sent_to_nodes(it, d, trees, tops),
                             f"tree int, node long, level int, ids array<{kind}>, x binary, fits binary")
    rest = packed.groupBy("tree", "node").applyInArrow(lambda table: _finish_node(table, depth, seed), grown)
    path = scratch_path(spark, "isolation-subtrees")
    rest.write.partitionBy("is_node").parquet(path)
    rest = spark.read.schema(rest.schema).parquet(path)
    nodes.append(rest.where("is_node").select("tree", "node", "size", "feature", "threshold"))
    ended = rest.where("not is_node").select("id", "level", "size")
    if any((feature < 0).any() for top in tops for _, feature, _, _ in top.values()):
        ended = ended.unionByName(materialize(rows.mapInArrow(
            lambda it: _in_large_leaves(it, d, trees, tops), f"id {kind}, level int, size long"), "isolation-leaves"))
    heights = ended.groupBy("id").agg((F.sum(F.col("level") + _path_length(F.col("size"))) / trees).alias("height"))
    discard(base)
    return (heights.withColumnRenamed("id", id_col), reduce(DataFrame.unionByName, nodes), psi)


def isolation_forest(df: DataFrame, features: list[str], id_col: str, trees: int = 100,
                     max_samples: int | None = None, contamination: float = 0.1,
                     seed: int = 0, fits: Column | None = None) -> DataFrame:
    """Isolation score in (0, 1] (higher = more isolated) and a 0/1 outlier
    flag for the top ``contamination`` share of the fitted rows' scores (L7).

    Trees grow from all rows unless ``max_samples`` says otherwise; ``fits``
    marks the rows that grow them, the others are only scored. Null and NaN
    features go to the right of every threshold. Ids have to be unique."""
    heights, _, psi = grow_isolation_trees(df, features, id_col, trees, max_samples, seed, fits)
    norm = float(avg_path_length(np.array([psi]))[0]) or 1.0
    scored = materialize(heights.select(id_col, F.pow(F.lit(2.0), -F.col("height") / norm).alias("score")), "isolation-scores")
    fitted = scored if fits is None else scored.join(df.where(fits).select(id_col), id_col, "left_semi")
    cut = exact_quantiles(fitted, "score", [1.0 - contamination], out="_cut")
    return (scored.withColumn("_cut", cut.select("_cut").scalar())
            .withColumn("outlier", (F.col("score") > F.col("_cut")).cast("int")).drop("_cut"))


# --- L8 local outlier factor -------------------------------------------------
def exact_knn(df: DataFrame, vec_col: str, id_col: str, k: int = 20, block_size: int = 1024) -> DataFrame:
    """Exact k nearest neighbours (see ``neighbors.nearest``): id, neighbor,
    distance, rank. In many dimensions (the 64-wide embeddings) distances
    concentrate and nearly every leaf is near: the work is quadratic then,
    the movement one copy of a point for each leaf it may meet."""
    return nearest(df, vec_col, id_col, k, block_size=block_size)


def local_outlier_factor(df: DataFrame, vec_col: str, id_col: str, k: int = 20,
                         contamination: float | None = None) -> DataFrame:
    """k-distance, reachability density and LOF per point (L8), from the
    exact k-nearest-neighbour table; optional 0/1 flag for the top
    ``contamination`` share of LOF values. ``k`` is cut to the number of
    other points. A point without neighbours (no whole vector, or alone)
    keeps its row, with nulls and flag 0."""
    knn = materialize(exact_knn(df, vec_col, id_col, k), "knn")
    last = Window.partitionBy(id_col)
    kdist = (knn.withColumn("_last", F.max("rank").over(last)).where(F.col("rank") == F.col("_last"))
             .select(F.col(id_col).alias("neighbor"), F.col("distance").alias("_kd")))
    reach = knn.join(kdist, "neighbor").withColumn("_reach", F.greatest("_kd", "distance"))
    lrd = reach.groupBy(id_col).agg((1.0 / (F.avg("_reach") + 1e-10)).alias("lrd"))
    nb_lrd = knn.join(lrd.select(F.col(id_col).alias("neighbor"), F.col("lrd").alias("_nl")), "neighbor")
    lof = nb_lrd.groupBy(id_col).agg(F.avg("_nl").alias("_m"))
    found = (lof.join(lrd, id_col).join(kdist.select(F.col("neighbor").alias(id_col),
                                                     F.col("_kd").alias("k_distance")), id_col)
             .select(id_col, "k_distance", "lrd", (F.col("_m") / F.col("lrd")).alias("lof")))
    out = df.select(id_col).join(found, id_col, "left")
    if contamination is not None:
        out = materialize(out, "lof")
        cut = exact_quantiles(out, "lof", [1.0 - contamination], out="_cut")
        out = (out.withColumn("_cut", cut.select("_cut").scalar())
               .withColumn("outlier", F.coalesce((F.col("lof") > F.col("_cut")).cast("int"), F.lit(0))).drop("_cut"))
    return out


# --- L9 one-class boundary ------------------------------------------------------
def least_norm(atoms: np.ndarray, rounds: int = 20_000) -> np.ndarray:
    """Weights (non-negative, sum 1) of the point of least norm in the hull
    of the atoms: pairwise steps until no exchange of weight helps."""
    g = atoms @ atoms.T
    x = np.zeros(len(atoms))
    x[int(np.argmin(np.diag(g)))] = 1.0
    slope = g @ x
    for _ in range(rounds):
        i = int(np.argmin(slope))
        j = int(np.argmax(np.where(x > 0, slope, -np.inf)))
        if slope[j] - slope[i] <= 1e-13 * abs(g).max():
            break
        step = min(x[j], (slope[j] - slope[i]) / max(g[i, i] + g[j, j] - 2 * g[i, j], 1e-300))
        x[i] += step
        x[j] -= step
        slope += step * (g[i] - g[j])
    return x


@dataclass
class OneClass:
    """A fitted boundary: random features cos(x W' + b), weights, offset, the
    relative duality gap that was reached and the passes it took."""

    features: list[str]
    W: np.ndarray
    b: np.ndarray
    w: np.ndarray
    rho: float
    gap: float
    passes: int

    def embed(self, df: DataFrame) -> DataFrame:
        """``df`` with the random features as the array ``_z``."""
        scale = math.sqrt(2.0 / len(self.b))
        comps = []
        for j in range(len(self.b)):
            dot = F.lit(float(self.b[j]))
            for i, c in enumerate(self.features):
                dot = dot + F.col(c).cast("double") * float(self.W[j, i])
            comps.append(F.cos(dot) * scale)
        return df.withColumn("_z", F.array(*comps))

    def margin(self) -> Column:
        return F.aggregate(F.zip_with("_z", F.array(*[F.lit(float(x)) for x in self.w]), lambda a, c: a * c),
                           F.lit(0.0), lambda acc, v: acc + v)

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with decision, verdict (+1 inside, -1 outside) and gap. The
        rows are written first: each feature occurs once in every component,
        and what computes it would be copied there, subqueries included."""
        return (self.embed(materialize(df, "one-class-rows")).withColumn("decision", self.margin() - F.lit(self.rho))
                .withColumn("verdict", F.when(F.col("decision") >= 0, 1).otherwise(-1)).drop("_z")
                .withColumn("gap", F.lit(self.gap)))


def fit_one_class(train: DataFrame, features: list[str], nu: float = 0.5, gamma: float = 0.1,
                  n_components: int = 100, tolerance: float = 1e-3, passes: int = 100, seed: int = 0) -> OneClass:
    """One-class boundary with an RBF kernel, approximated by random Fourier
    features: minimises |w|^2 / 2 - rho + sum max(0, rho - w.z) / (nu n).

    Its dual is the point of least norm in the hull of all weighted means of
    rows with weights up to 1 / (nu n). Each round sends w to the rows; the
    mean of the nu n rows with the smallest margins is a new corner of that
    hull, and the next w is the point of least norm among the corners so far (a
    problem of a few dozen vectors). The corner also bounds the optimum from
    below, so the search ends at a stated relative duality gap. A round is two
    aggregations: the margins around the nu-quantile, then sums on both sides
    of them; rows between them share the rest of the weight.
    """
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer
    rng = np.random.default_rng(seed)
    W = rng.normal(scale=math.sqrt(2 * gamma), size=(n_components, len(features)))
    model = OneClass(list(features), W, rng.uniform(0, 2 * math.pi, size=n_components), np.zeros(n_components), 0.0, math.inf, 0)
    rows = materialize(train.select(*features), "one-class-train")  # see score
    z = cut_lineage(model.embed(rows).select("_z").where(F.forall("_z", lambda x: x.isNotNull() & ~F.isnan(x))))
    n = z.count()
    discard(rows)
    if not n:
        raise ValueError("no row to learn from")
    target = nu * n
    mean = z.select(Summarizer.metrics("mean").summary(array_to_vector("_z")).alias("s")).first()["s"]["mean"]
    atoms = np.asarray(mean.toArray())[None, :]
    accuracy = 10_000
    for k in range(passes):
        model.w = least_norm(atoms) @ atoms
        model.passes = k + 1
        m = z.withColumn("_m", model.margin())
        shares = [max(0.0, nu - 2.0 / accuracy), min(1.0, nu + 2.0 / accuracy)]
        low, high = m.select(F.percentile_approx("_m", shares, accuracy)).first()[0]
        part = F.when(F.col("_m") < low, 0).when(F.col("_m") <= high, 1).otherwise(2)
        parts = {r["part"]: r for r in m.where(F.col("_m") <= high).groupBy(part.alias("part")).agg(
            F.count("*").alias("n"), F.sum("_m").alias("m"),
            Summarizer.metrics("sum").summary(array_to_vector("_z")).alias("s")).collect()}
        n_low, sum_low = (parts[0]["n"], parts[0]["m"]) if 0 in parts else (0, 0.0)
        share = (target - n_low) / max(parts[1]["n"], 1) if 1 in parts else math.inf
        if not 0 <= share <= 1:  # the quantile estimate was off: the mean of all rows is a corner as well
            break
        corner = sum(np.asarray(parts[p]["s"]["sum"].toArray()) * weight for p, weight in ((0, 1.0), (1, share)) if p in parts)
        norm = float(model.w @ model.w)
        least = (sum_low + (target - n_low) * low) / target  # no nu n rows have a smaller mean margin
        model.gap = (norm - least) / max(norm, 1e-300)
        model.rho = float(low)
        if model.gap <= tolerance:
            break
        atoms = np.vstack([atoms, corner / target])
    return model


def one_class_boundary(train: DataFrame, score: DataFrame, features: list[str], nu: float = 0.5,
                       gamma: float = 0.1, **options) -> DataFrame:
    """``score`` with decision, verdict (+1 inside, -1 outside, as scikit-learn
    reports it) and the fit's duality gap (L9), see ``fit_one_class``. A row
    with a null feature gets a null decision and verdict -1."""
    return fit_one_class(train, features, nu, gamma, **options).score(score)
