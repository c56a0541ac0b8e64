import math

import numpy as np
import pytest

from tessera.llm.components import connected_components
from tessera.llm.embedding_dedup import cap_share, choose_filters, embedding_dedup, pairs_at

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, t=0.95):
    good = {i: np.array(v, np.float64) for i, v in rows
            if v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    links = {i: [j for j, y in good.items() if j != i and len(y) == len(good[i])
                 and y @ good[i] / math.sqrt(y @ y) / math.sqrt(good[i] @ good[i]) >= t] if i in good else [] for i, _ in rows}
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (len(links[i]), min(seen), i == min(seen))
    return out


def groups(seed, dim=64, n=30):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        c = rng.standard_normal(dim)
        c /= np.linalg.norm(c)
        for _ in range(int(rng.integers(1, 9))):
            e = rng.standard_normal(dim)
            v = c + e / np.linalg.norm(e) * rng.uniform(0, 0.32)
            rows.append((v * rng.uniform(0.1, 9)).astype(np.float32).tolist())
    order = rng.permutation(len(rows))
    return [(int(k), rows[j]) for k, j in enumerate(order)]


def test_equals_brute_force(spark):
    rows = groups(1)
    n = len(rows)
    rows += [(n, None), (n + 1, []), (n + 2, [0.0] * 64), (n + 3, [float("nan")] * 64), (n + 4, [None] + [1.0] * 63),
             (n + 5, [float("inf")] + [1.0] * 63), (n + 6, rows[0][1]), (n + 7, rows[0][1]), (n + 8, [1.0, 0.0]),
             (n + 9, [2.0, 0.1]), (n + 10, [-1.0, 0.0]), (n + 11, [5.0]), (n + 12, [7.0])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as label", "2 as k", "3 as v", "4 as n_links")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup(df).collect()}
    want = brute(rows)
    assert got == want and any(w[0] for w in want.values())


def test_repeated_rows_null_ids_empty(spark):
    v = [1.0, 2.0, 3.0]
    df = spark.createDataFrame([(4, v), (4, v), (None, v), (6, [-1.0, 0.0, 0.0])], SCHEMA)
    got = sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup(df).collect())
    assert got == [("4", 2, 4, True), ("4", 2, 4, True), ("6", 0, 6, True), ("None", 2, 4, False)]
    assert embedding_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_list_decoding_finds_exactly_the_filters_above_the_height():
    f = choose_filters(16, 500, 0.95, shared=6)
    x = np.random.default_rng(2).standard_normal((40, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    parts, want, size = np.array_split(np.arange(16), f.blocks), [set() for _ in x], f.words ** f.blocks
    codes = f.codes()
    for t, (turn, books) in enumerate(codes):
        dots = [(x @ turn)[:, p] @ b.T for p, b in zip(parts, books)]
        total = dots[0]
        for d in dots[1:]:
            total = (total[:, :, None] + d[:, None, :]).reshape(len(x), -1)
        for v, row in enumerate(total):
            want[v] |= {t * size + int(k) for k in np.flatnonzero(row >= f.height)}
    for w, got in zip(want, f.filters(x, codes)):
        assert set(got.tolist()) == w if w else len(got) == 1


@pytest.mark.parametrize("dim,height", [(3, 0.5), (64, 0.3)])
def test_cap_share(dim, height):
    x = np.random.default_rng(0).standard_normal((200_000, dim))
    assert cap_share(height, dim) == pytest.approx((x[:, 0] / np.linalg.norm(x, axis=1) >= height).mean(), rel=0.1)


def test_recall_at_the_threshold(spark):
    """Pairs at a cosine just above 0.95: at least 0.99 of them share a filter."""
    rng = np.random.default_rng(3)
    f = choose_filters(64, 50_000, 0.95)
    codes, hit = f.codes(), 0
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    e = rng.standard_normal((400, 64))
    e -= (e * x).sum(1, keepdims=True) * x
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    y = 0.951 * x + math.sqrt(1 - 0.951 ** 2) * e
    for a, b in zip(f.filters(x, codes), f.filters(y, codes)):
        hit += bool(set(a.tolist()) & set(b.tolist()))
    assert hit >= 396


@pytest.mark.parametrize("rows,most", [(2_000, 3), (50_000, 3)])
def test_pairs_that_share_no_filter_are_one_in_ten_thousand(rows, most):
    f = choose_filters(64, rows, 0.95)
    codes, missed = f.codes(), 0
    x, y = pairs_at(0.95, 64, 3000, np.random.default_rng(11))
    for a, b in zip(f.filters(x, codes), f.filters(y, codes)):
        missed += not set(a.tolist()) & set(b.tolist())
    assert missed <= most


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(100 + k, 101 + k) for k in range(30)] + [(7, None)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e if x is not None}
    for _ in range(200):
        for a, b in edges:
            if b is not None:
                root[a] = root[b] = min(root[a], root[b])
    touched = {x for a, b in edges if b is not None and a != b for x in (a, b)}
    assert got == {x: root[x] for x in touched}


def test_eight_bit_vectors_lose_no_link(spark):
    from pyspark.sql import functions as F

    from tessera.llm.embedding_dedup import near_members, quantised
    rng = np.random.default_rng(8)
    base = rng.standard_normal((40, 16))
    x = np.vstack([base[rng.integers(0, 40, 900)] + rng.standard_normal((900, 16)) * rng.choice([0.05, 0.15, 0.3], (900, 1)),
                   rng.standard_normal((300, 16))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, scale, lost = quantised(x)
    assert (np.abs((q * scale[:, None]) @ x.T - x @ x.T) <= lost[:, None] + 1e-12).all()
    bucket = np.where(np.arange(1200) < 1000, 7, np.arange(1200) % 50)  # one bucket of many blocks
    rows = [(int(b), bytes([k // 256, k % 256]), v.tobytes(), float(s), float(e)) for k, (b, v, s, e) in enumerate(zip(bucket, q, scale, lost))]
    df = spark.createDataFrame(rows, "bucket long, k binary, q binary, scale double, lost double").repartition(5)
    got = {(r["bucket"], r["k"][0] * 256 + r["k"][1]) for r in near_members(df, 0.95, block_rows=100).collect()}
    cosine = x @ x.T
    np.fill_diagonal(cosine, 0)
    same = bucket[:, None] == bucket[None, :]
    want = {(int(bucket[k]), k) for k in np.flatnonzero((same & (cosine >= 0.95)).any(axis=1))}
    loose = {(int(bucket[k]), k) for k in np.flatnonzero((same & (cosine >= 0.9)).any(axis=1))}
    assert want <= got <= loose and len(want) > 100 and len(got) < 1000


def test_largest_and_smallest_doubles_link(spark):
    rows = [(1, [1e300, 1e300, 0.0]), (2, [1e-300, 1e-300, 1e-310]), (3, [1.0, 1.0, 0.01]), (4, [0.0, 0.0, 5e-324])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4)}
