"""Near-duplicate embeddings by spherical-cap filters (operator 1)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

from .bucketjoin import bucket_links
from .common import bits, mix


def cap_share(height: float, dim: int) -> float:
    """Share of the unit sphere whose inner product with a fixed direction is
    at least ``height``."""
    s = np.linspace(height, 1, 20_001)
    tail = np.trapezoid((1 - s * s).clip(0) ** ((dim - 3) / 2), s)
    s = np.linspace(-1, 1, 200_001)
    return float(tail / np.trapezoid((1 - s * s).clip(0) ** ((dim - 3) / 2), s))


@dataclass(frozen=True)
class CapFilters:
    """Directions of random product codes. In each of ``tables`` codes the
    coordinates, after a random rotation, are cut into ``blocks`` parts, each
    with ``words`` random directions; a filter takes one word per part. A
    vector belongs to every filter whose inner product with it is at least
    ``height``. Several independent codes even out how many filters a vector gets."""

    dim: int
    tables: int
    blocks: int
    words: int
    height: float
    seed: int

    def codes(self) -> list[tuple[np.ndarray, list[np.ndarray]]]:
        rng = np.random.default_rng(self.seed)
        parts, out = np.array_split(np.arange(self.dim), self.blocks), []
        for _ in range(self.tables):
            turn, _ = np.linalg.qr(rng.standard_normal((self.dim, self.dim)))
            books = []
            for p in parts:
                c = rng.standard_normal((self.words, len(p)))
                books.append(c / np.linalg.norm(c, axis=1, keepdims=True) * math.sqrt(len(p) / self.dim))
            out.append((turn, books))
        return out

    def filters(self, units: np.ndarray, codes) -> list[np.ndarray]:
        """Per unit vector the numbers of its filters in all codes; a vector
        that reaches none gets its best filter of the first code."""
        size = self.words ** self.blocks
        each = [list(self.decode(units, code)) for code in codes]
        out = [np.concatenate([t * size + e[v] for t, e in enumerate(each)]) for v in range(len(units))]
        for v, f in enumerate(out):
            if not len(f):
                turn, books = codes[0]
                x, at, number = units[v] @ turn, 0, 0
                for b in books:
                    number = number * self.words + int((b @ x[at:at + b.shape[1]]).argmax())
                    at += b.shape[1]
                out[v] = np.array([number])
        return out

    def decode(self, units: np.ndarray, code) -> Iterator[np.ndarray]:
        """Per unit vector the numbers of its filters in one code: list
        decoding, part by part, dropping prefixes that cannot reach the height
        any more."""
        turn, books = code
        x = units @ turn
        ends = np.cumsum([b.shape[1] for b in books])
        dots = [x[:, e - b.shape[1]:e] @ b.T for b, e in zip(books, ends)]
        best = np.stack([d.max(1) for d in dots], 1)
        rest = np.cumsum(best[:, ::-1], 1)[:, ::-1]  # most that this and later parts can add
        for v in range(len(x)):
            sums, codes = np.zeros(1), np.zeros(1, np.int64)
            for k, d in enumerate(dots):
                total = (sums[:, None] + d[v][None, :]).ravel()
                more = rest[v, k + 1] if k + 1 < len(dots) else 0.0
                ok = np.flatnonzero(total + more >= self.height)
                sums = total[ok]
                codes = codes[ok // self.words] * self.words + ok % self.words
                if not len(ok):
                    break
            yield codes


def pairs_at(similarity: float, dim: int, n: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """``n`` random pairs of unit vectors with exactly this cosine."""
    x, e = rng.standard_normal((2, n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    e -= (e * x).sum(1, keepdims=True) * x
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    return x, similarity * x + math.sqrt(1 - similarity ** 2) * e


def none_shared(f: CapFilters, similarity: float, pairs: int = 1000, codes: int = 4) -> float:
    """Measured share of pairs at exactly ``similarity`` that have no filter
    in common in one code, plus two standard errors (fixed seed)."""
    x, y = pairs_at(similarity, f.dim, pairs, np.random.default_rng(2))
    some = replace(f, tables=codes, seed=f.seed + 1).codes()
    missed = np.mean([not len(np.intersect1d(a, b)) for code in some
                      for a, b in zip(f.decode(x, code), f.decode(y, code))])
    return float(missed + 2 * math.sqrt(missed * (1 - missed) / (pairs * codes)))


def choose_filters(dim: int, rows: int, similarity: float, shared: float = 10.0, seed: int = 5,
                   recall: float = 0.9999) -> CapFilters:
    """Filters for ``rows`` vectors: a cap holds about four unrelated vectors.
    The number of words is such that a pair at exactly ``similarity`` shares
    ``shared`` filters in 12 (24) codes on average. These come in clumps, so
    the mean says little about the pairs that share none: that is measured for
    one code, and there are as many codes, whose turns are independent, as it
    takes for a share ``recall`` of such pairs to meet (up to 0.999 missed in
    one code, far above what was seen: 0.65 to 0.98, the latter in 3 dimensions)."""
    share = min(0.02, 4.0 / max(rows, 1))
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if cap_share(mid, dim) > share else (low, mid)
    height = low
    # probability that the partner is in a cap too, by sampling (fixed seed)
    rng = np.random.default_rng(1)
    z = np.linspace(height, 1, 4001)
    w = (1 - z * z).clip(0) ** ((dim - 3) / 2)
    a = rng.choice(z, 20_000, p=w / w.sum())
    g = rng.standard_normal((20_000, dim - 1))
    side = g[:, 0] / np.linalg.norm(g, axis=1)
    both = similarity * a + math.sqrt(1 - similarity ** 2) * np.sqrt(1 - a * a) * side >= height
    filters = shared / (share * max(both.mean(), 1e-3))
    # two parts spread the filters more evenly than four, whose lists are cheaper for many words
    tables, blocks = (12, 2) if filters < 12 * 4096 ** 2 else (24, 4)
    blocks = min(dim, blocks)
    f = CapFilters(dim, tables, blocks, max(2, math.ceil((filters / tables) ** (1 / blocks))), height, seed)
    missed = none_shared(f, similarity)
    return replace(f, tables=max(tables, math.ceil(math.log(1 - recall) / math.log(min(max(missed, 1e-9), 0.999)))))


def _usable(values: np.ndarray | None) -> np.ndarray | None:
    if values is None or not len(values):
        return None
    x = np.asarray(values, np.float64)
    return x if np.isfinite(x).all() and np.any(x) else None


def cosine_links(threshold: float):
    def linked(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (np.stack(left), np.stack(right)))
        return (x @ y.T) / np.sqrt((x * x).sum(1))[:, None] / np.sqrt((y * y).sum(1))[None, :] >= threshold
    return linked


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(8-bit coordinates, scale, length of what is lost) of unit vectors."""
    scale = np.abs(units).max(axis=1) / 127
    q = np.rint(units / scale[:, None]).astype(np.int8)
    lost = np.linalg.norm(units - q * scale[:, None], axis=1) * (1 + 1e-9) + 1e-12
    return q, scale, lost


def near_members(members: DataFrame, similarity: float, block_rows: int = 512) -> DataFrame:
    """The (bucket, k) of ``members`` (bucket, k, q, scale, lost) that may link
    with another member of their bucket: those whose 8-bit vectors have a
    cosine of ``similarity`` less what both can have lost. No link is lost, and
    most rows leave before any whole vector is sent to a bucket. Buckets of
    more than ``block_rows`` rows are cut into blocks that meet in pairs."""
    sizes = (members.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > block_rows)
             .select("bucket", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks")))
    blk = F.pmod(F.xxhash64("k", F.lit(7)), F.col("blocks")).cast("int")
    dealt = (members.join(sizes, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("blk", blk)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("bucket", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"), "blk",
                     "k", "q", "scale", "lost"))

    def near(bucket, lo, hi, blk, k, q, scale, lost) -> pa.RecordBatch:
        start = np.ones(len(bucket), bool)
        start[1:] = (np.diff(bucket) != 0) | (np.diff(lo) != 0) | (np.diff(hi) != 0)
        at = np.flatnonzero(start)
        ends = np.repeat(np.append(at[1:], len(bucket)), np.diff(np.append(at, len(bucket))))
        width = np.array([len(x) for x in q])
        hit = np.zeros(len(bucket), bool)
        x = np.zeros((len(q), int(width.max())), np.float32)
        for w in np.unique(width):
            some = np.flatnonzero(width == w)
            x[some, :w] = np.frombuffer(b"".join(q[i] for i in some), np.int8).reshape(-1, w)
        i, step = np.arange(len(bucket)), 0
        while True:  # every row with the one `step` places behind it in its group
            step += 1
            i = i[i + step < ends[i]]
            if not len(i):
                break
            j = i + step
            for a in range(0, len(i), 65_536):
                l, r = i[a:a + 65_536], j[a:a + 65_536]
                ok = (width[l] == width[r]) & ((lo[l] == hi[l]) | (blk[l] != blk[r]))
                cosine = np.einsum("ij,ij->i", x[l], x[r]) * scale[l] * scale[r]
                ok &= cosine >= similarity - (lost[l] + lost[r] + lost[l] * lost[r]) - 1e-5
                hit[l[ok]] = hit[r[ok]] = True
        rows = np.flatnonzero(hit)
        return pa.RecordBatch.from_arrays([pa.array(bucket[rows]), pa.array([k[r] for r in rows], pa.binary())], names=["bucket", "k"])

    def scan(batches) -> Iterator[pa.RecordBatch]:
        held: list[list] | None = None
        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns[:4]] + [c.to_pylist() for c in b.columns[4:6]] + [
                c.to_numpy(zero_copy_only=False) for c in b.columns[6:]]
            if held is not None:
                cols = [[*x, *y] if isinstance(x, list) else np.concatenate([x, y]) for x, y in zip(held, cols)]
            n = len(cols[0])
            if not n:
                continue
            last = (cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]) | (cols[2] != cols[2][-1])
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0  # the last group may go on
            held = [c[cut:] for c in cols]
            if cut:
                yield near(*[c[:cut] for c in cols])
        if held is not None and len(held[0]):
            yield near(*held)

    return (dealt.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
            .mapInArrow(scan, "bucket long, k binary").distinct())


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    similarity: float = 0.95, shared: float = 10.0, seed: int = 5) -> DataFrame:
    """Links between vectors with a cosine of ``similarity`` or more.

    One row per input row: ``id_col``, n_links (other rows linked directly),
    component_id (smallest id reachable by links, itself included), kept
    (id = component_id). Equal vectors are compared once and count as often as
    they occur. Vectors of different lengths never link. Null, empty and zero
    vectors and those with a null or non-finite component link with nothing.
    A null id is kept as a row (component_id its own, null; kept false). An
    empty table gives no rows; other columns are ignored.
    """
    src = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    kind = src.schema["id"].dataType.simpleString()

    def keyed(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vs = [_usable(None if v is None or None in v else v) for v in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([None if v is None else xxhash.xxh3_128_digest((v + 0.0).tobytes()) for v in vs], pa.binary()),
                 pa.array(vs, pa.list_(pa.float64()))], names=["id", "k", "v"])

    rows = materialize(src.mapInArrow(keyed, f"id {kind}, k binary, v array<double>"), "vectors")
    classes = materialize(rows.where("k is not null").groupBy("k").agg(
        F.count("*").alias("copies"), F.min("id").alias("low"), F.first("v").alias("v")), "classes")
    sizes = {r["d"]: r["n"] for r in classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
             .orderBy("d").collect()}
    plans = {d: choose_filters(d, n, similarity, shared, seed) for d, n in sizes.items() if d > 2}

    def filters(batches) -> Iterator[pa.RecordBatch]:
        codes = {}
        for b in batches:
            ks, vs = b.column(0).to_pylist(), [np.array(v) for v in b.column(1).to_pylist()]
            out_k, out_f, out_q, out_s, out_l = [], [], [], [], []
            for d in {len(v) for v in vs}:
                some = [i for i, v in enumerate(vs) if len(v) == d]
                x = np.stack([vs[i] for i in some])
                x = x / np.abs(x).max(axis=1, keepdims=True)  # neither the largest nor the smallest doubles leave the range
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                q, scale, lost = quantised(x)
                if d in plans:
                    codes.setdefault(d, plans[d].codes())
                    found = plans[d].filters(x, codes[d])
                else:  # one or two dimensions: one bucket per quadrant is of no use, all meet
                    found = [np.zeros(1, np.int64)] * len(some)
                out_s.append(np.repeat(scale, [len(f) for f in found]))
                out_l.append(np.repeat(lost, [len(f) for f in found]))
                for row, (i, f) in enumerate(zip(some, found)):
                    out_k += [ks[i]] * len(f)
                    out_q += [q[row].tobytes()] * len(f)
                    out_f.append(bits(mix(f.astype(np.uint64) * np.uint64(64) + np.uint64(d % 64) + np.uint64(d) * np.uint64(1 << 50))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out_f) if out_f else [], pa.int64()), pa.array(out_k, pa.binary()), pa.array(out_q, pa.binary()),
                 *[pa.array(np.concatenate(x) if x else [], pa.float64()) for x in (out_s, out_l)]],
                names=["bucket", "k", "q", "scale", "lost"])

    members = materialize(classes.select("k", "v").mapInArrow(
        filters, "bucket long, k binary, q binary, scale double, lost double"), "filters")
    members = materialize(near_members(members, similarity), "near")
    links = bucket_links(members, classes.select("k", "copies", "v"), cosine_links(similarity), "v")
    joined = (classes.select("k", "copies", "low").join(links, "k", "left")
              .withColumn("root", F.coalesce("root", "k")))
    low = joined.groupBy("root").agg(F.min("low").alias("component_id"))
    found = joined.join(low, "root").select(
        "k", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return rows.select("id", "k").join(found, "k", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"))
