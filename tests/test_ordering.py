import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.ordering import exact_quantiles, rank_within, segmented_scan


def table(spark, seed, n=400):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["hot"] * 6 + ["a", "b", None] + [str(k) for k in range(20)]), rng.choice([1, 2, 2, 3, None, 7]) if rng.random() < 0.8 else i,
             rng.randrange(1, 5)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, k string, v long, w long")


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 7), (3, 40)])
def test_scan_equals_brute_force(spark, seed, parts):
    rows, df = table(spark, seed)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = {r["id"]: r for r in segmented_scan(df, ["k"], [F.col("v").asc_nulls_first(), F.col("id")], ["v"], "w").collect()}
        plain = {r["id"]: r for r in segmented_scan(df, [], [F.col("v"), F.col("id")], ["v"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    low = lambda v: (v is not None, v or 0)
    for i, k, v, w in rows:
        group = [r for r in rows if r[1] == k]
        smaller = [r for r in group if low(r[2]) < low(v)]
        want = (sum(r[3] for r in group if (low(r[2]), r[0]) < (low(v), i)), sum(r[3] for r in group),
                sum(r[3] for r in smaller), len({r[2] for r in smaller}))
        assert (out[i]["_before"], out[i]["_total"], out[i]["_tie"], out[i]["_dense"]) == want
        smaller = [r for r in rows if low(r[2]) < low(v)]
        assert (plain[i]["_total"], plain[i]["_tie"], plain[i]["_dense"]) == (len(rows), len(smaller), len({r[2] for r in smaller}))
        assert plain[i]["_before"] == sum((low(r[2]), r[0]) < (low(v), i) for r in rows)


def test_ranks_equal_window_functions(spark):
    _, df = table(spark, 5)
    df.createOrReplaceTempView("scan_rows")
    want = spark.sql("""SELECT id, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank, percent_rank() OVER w AS percent_rank
                        FROM scan_rows WINDOW w AS (PARTITION BY k ORDER BY v DESC)""").collect()
    got = {r["id"]: r for r in rank_within(df.repartition(9), ["k"], ["v"], False, kinds=("rank", "dense_rank", "percent_rank", "row_number")).collect()}
    for r in want:
        assert (got[r["id"]]["rank"], got[r["id"]]["dense_rank"], got[r["id"]]["percent_rank"]) == (r["rank"], r["dense_rank"], r["percent_rank"])
    assert len(got) == 400


def test_one_sort_and_no_join_in_the_plan(spark):
    _, df = table(spark, 6, 50)
    plans = [rank_within(df, ["k"], ["v"]), exact_quantiles(df, "v", [0.5], ["k"])]
    for plan in plans:
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in text and "Sort" not in text  # the sort is pinned before


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(7)
    rows = [(k, float(v)) for k, n in (("a", 1), ("b", 2), ("c", 301), (None, 7)) for v in rng.integers(0, 40, n)] + [("d", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.5, 0.95, 1.0]
    got = {}
    for r in exact_quantiles(df.repartition(6), "x", probs, ["k"]).collect():
        got.setdefault((r["k"], r["prob"]), []).append(r["value"])
    for k in ("a", "b", "c", None):
        x = [v for kk, v in rows if kk == k and v is not None]
        for p in set(probs):
            assert got[k, p] == pytest.approx([np.quantile(x, p)] * probs.count(p))
    assert ("d", 0.5) not in got and exact_quantiles(df.limit(0), "x", probs).count() == 0


def test_empty_tables(spark):
    _, df = table(spark, 8, 10)
    assert rank_within(df.limit(0), ["k"], ["v"]).count() == 0
