import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import skew as K
from tessera.operators import text as TX
from tessera.operators.aggregates import group_collect_chunks


def tables(spark, n=6000):
    rng = random.Random(1)
    left = [(i, "the" if i % 3 == 0 else None if i % 50 == 1 else f"w{rng.randrange(800)}") for i in range(n)]
    right = [("the", 1), ("the", 2), ("w1", 3), ("w5", 4), ("w5", 5), (None, 6)] + [(f"w{k}", k) for k in range(10, 700)]
    return left, right, spark.createDataFrame(left, "id long, k string"), spark.createDataFrame(right, "k string, v long")


def test_heavy_hitters_are_found(spark):
    left, _, df, _ = tables(spark)
    assert K.heavy_hitters(df, "k", 0.2) == ["the"]
    assert set(K.heavy_hitters(df, "k", 0.0005)) >= {k for k, n in Counter(k for _, k in left if k).items() if n >= 0.0005 * len(left)}
    assert K.heavy_hitters(df.limit(0), "k", 0.1) == []


def test_split_join_equals_join(spark, monkeypatch):
    _, _, a, b = tables(spark)
    b = b.withColumn("w", F.col("v") * 2)
    for rows in (100_000, 1):  # broadcast, then salted
        monkeypatch.setattr(K, "BROADCAST_ROWS", rows)
        for how in ("inner", "left"):
            got = K.split_join(a, b, "k", how, share=0.1)
            assert got.columns == a.join(b, "k", how).columns
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, a.join(b, "k", how).collect()), key=str)
    assert K.split_join(a.limit(0), b, "k").count() == 0


def test_no_task_gets_the_hot_word(spark):
    rows = [(i, " ".join(["the"] * 20 + [f"w{(i * 7 + j) % 900}" for j in range(40)])) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, t string").repartition(8)
    vocab = TX.vocabulary(df, "t")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = K.split_join(TX.token_rows(df, "id", "t"), vocab.select("word", "word_index"), "word", share=0.05)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 600 * 60 and max(sizes) <= 2 * np.median(sizes)
    sequences = {r["id"]: r["sequence"] for r in TX.texts_to_sequences(df, "id", "t", vocab).collect()}
    index = {r["word"]: r["word_index"] for r in vocab.collect()}
    assert all(sequences[i] == [index[w] for w in t.split()] for i, t in rows)


def test_chunks_make_the_whole_list(spark):
    rows = [("hot", v % 950) for v in range(3000)] + [("b", 1), ("b", 1), ("b", None), (None, 5), ("c", None)]
    out = group_collect_chunks(spark.createDataFrame(rows, "k string, v int").repartition(7), "k", "v", size=100).collect()
    whole = {}
    for r in sorted(out, key=lambda r: (str(r["k"]), r["chunk"])):
        assert len(r["items"]) <= 100 and r["before"] == 100 * r["chunk"]
        whole.setdefault(r["k"], []).extend(r["items"])
        assert r["total"] == (950 if r["k"] == "hot" else 1)
    assert whole == {"hot": list(range(950)), "b": [1], None: [5]}


def test_small_right_side_moves_no_row_of_the_left(spark):
    _, _, a, b = tables(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = K.split_join(a, b, "k", share=0.1)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_heavy_keys_of_a_large_right_side(spark, monkeypatch):
    _, _, a, b = tables(spark)
    monkeypatch.setattr(K, "BROADCAST_ROWS", 50)  # fewer than the right side's rows, more than those of its heavy keys
    for how in ("inner", "left"):
        got = K.split_join(a, b, "k", how, share=0.1)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, a.join(b, "k", how).collect()), key=str)
