import random
from collections import Counter
from math import comb

from tessera.llm.sharding import communication_matrix, hypergeometric, shard_rows, shard_sizes, write_shards


def test_hypergeometric_law():
    rng, n = random.Random(1), 20_000
    got = Counter(hypergeometric(rng, 5, 7, 6) for _ in range(n))
    chi2 = sum((got[k] - n * p) ** 2 / (n * p) for k in range(6)
               if (p := comb(5, k) * comb(7, 6 - k) / comb(12, 6)))
    assert chi2 < 25  # 5 degrees of freedom
    big = [hypergeometric(rng, 3 * 10**9, 45 * 10**9, 10**6) for _ in range(200)]
    assert abs(sum(big) / 200 - 62_500) < 100


def test_matrix_sums():
    m = communication_matrix([5, 0, 11, 4], [7, 7, 6], "s")
    assert [sum(r) for r in m] == [5, 0, 11, 4] and [sum(c) for c in zip(*m)] == [7, 7, 6]


def check(rows, shards):
    sizes = Counter(r["shard"] for r in rows)
    assert [sizes[s] for s in range(shards)] == shard_sizes(len(rows), shards)
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


def test_exact_sizes_and_all_rows(spark, tmp_path):
    data = [(i % 50 if i % 3 else None, "same" if i % 2 else None, i) for i in range(997)]
    df = spark.createDataFrame(data, "doc_id long, text string, slot long").selectExpr(
        "*", "slot as `a.b`", "1 as rid", "2 as part").repartition(7)
    out = shard_rows(df, 16)
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "a.b", "rid", "part", "shard", "slot"]
    check(rows, 16)
    assert sorted(r["a.b"] for r in rows) == list(range(997))
    # neighbours of the input are spread evenly: about 1/16 stay together
    by = {r["a.b"]: r["shard"] for r in rows}
    assert sum(by[i] == by[i + 1] for i in range(996)) < 110
    assert sorted(map(tuple, shard_rows(df, 16).select("shard", "slot").collect())) == sorted((r["shard"], r["slot"]) for r in rows)
    write_shards(out, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    check(back.collect(), 16)


def test_more_shards_than_rows_and_empty(spark):
    df = spark.createDataFrame([(1, "a")] * 3, "doc_id long, text string")
    check(shard_rows(df, 16).collect(), 16)
    empty = shard_rows(df.limit(0), 4)
    assert empty.collect() == [] and empty.columns == ["doc_id", "text", "shard", "slot"]
