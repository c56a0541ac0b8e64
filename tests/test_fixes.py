"""Constant columns, empty groups, unknown values, wide tables: one small test each."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.functions.scalars import binomial_pmf, log_choose
from tessera.operators import aggregates as AG, charts as CH, features as FE, models as ML, stattests as ST
from tessera.session import ensure_checkpoint_dir, get_spark  # noqa: F401


def test_standardize_constant_column_is_centred(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id long, x double")
    (out,) = FE.standardize(df, [], ["x"])
    assert [r["x"] for r in out.collect()] == [0.0, 0.0]


def test_crosstab_shares_of_a_measure_sum_to_one(spark):
    df = spark.createDataFrame([("a", "x", 3.0), ("a", "y", 5.0), ("b", "x", 8.0)], "p string, q string, v double")
    out = AG.crosstab(df, "p", "q", normalize="all", values="v", aggfunc="sum")
    assert sum(r["share"] for r in out.collect()) == pytest.approx(1.0)


def test_histogram_of_a_constant_column(spark):
    df = spark.createDataFrame([(2.0,)] * 3, "x double")
    rows = CH.histogram(df, "x", 2, density=True).orderBy("bin").collect()
    assert [(r["lower"], r["upper"], r["count"]) for r in rows] == [(1.5, 2.0, 0), (2.0, 2.5, 3)]


def test_kde_keeps_going_with_one_constant_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 2.0), ("b", 4.0)], "g string, x double")
    rows = CH.kde(df, "x", ["g"], grid=11).collect()
    assert all(r["density"] is None for r in rows if r["g"] == "a")
    assert all(r["density"] > 0 for r in rows if r["g"] == "b")


def test_label_inverse_of_no_class(spark):
    df = spark.createDataFrame([("x",), ("z",), (None,)], "c string")
    out = FE.label_inverse(FE.label_binarize(df, "c", ["x", "y"]), "onehot", ["x", "y"]).collect()
    assert [r["label"] for r in out] == ["x", None, None]


def test_one_hot_rejects_unknown_and_too_many_values(spark):
    df = spark.createDataFrame([("x",), ("q",)], "c string")
    with pytest.raises(Exception, match="unknown value of c"):
        FE.one_hot_wide(df, ["c"], {"c": ["x", "y"]}).collect()
    with pytest.raises(ValueError):
        FE.category_values(spark.range(30), "id", most=20)


def test_chi_square_tail_at_large_dof(spark):
    df = spark.createDataFrame([(19_980.0, 20_000), (4.0, 4), (1e6, 10**6), (0.0, 3)], "s double, d long")
    got = [r[0] for r in df.select(ST.chi2_sf(F.col("s"), F.col("d"))).collect()]
    assert got[0] == pytest.approx(0.5385, abs=2e-4)
    assert got[1] == pytest.approx(math.exp(-2) * 3, rel=1e-9)
    assert got[2] == pytest.approx(0.5, abs=1e-3) and got[3] == 1.0


def test_binomial_with_large_counts(spark):
    df = spark.createDataFrame([(6_000_000_000, 3_000_000_000), (10, 3), (5, 0), (5, 5)], "n long, k long")
    got = df.select(binomial_pmf(F.col("n"), F.col("k"), 0.5).alias("p"), log_choose(F.col("n"), F.col("k")).alias("c")).collect()
    assert got[0]["p"] == pytest.approx(1 / math.sqrt(math.pi * 3e9), rel=1e-3)
    assert got[1]["p"] == pytest.approx(120 / 1024, rel=1e-9) and [r["c"] for r in got[2:]] == [0.0, 0.0]


@pytest.mark.parametrize("lam", [0.8, 5.0, 60.0])
def test_poisson_weights_reach_the_tail(spark, lam):
    u = spark.range(20_000).select(((F.col("id") + 0.5) / 20_000).alias("u"))
    m, v = u.select(FE.poisson_weight(F.col("u"), lam).alias("w")).agg(F.avg("w"), F.var_pop("w")).first()
    assert m == pytest.approx(lam, rel=0.01) and v == pytest.approx(lam, rel=0.03)


def test_als_tune_without_any_score(spark):
    df = spark.createDataFrame([(1, 1, 1.0)], "user_id_no int, item_id_no int, rating double")
    with pytest.raises(Exception):
        ML.als_tune(df, ranks=(2,), regs=(0.1,))


def test_the_package_reaches_executors(spark):
    from tessera.session import ship_package
    ship_package(spark)
    assert any("tessera_package" in f for f in spark.sparkContext.listFiles)


def test_binomial_keeps_its_digits(spark):
    from fractions import Fraction
    from math import comb, lgamma, log
    small = [(n, k, p) for n in (1, 2, 9, 16, 40) for k in range(n + 1) for p in (0.01, 0.3, 0.5, 0.97)]
    large = [(3_000_000_000, 5, 1e-9), (10**12, 5, 1e-12), (10**12, 500, 4e-10)]
    df = spark.createDataFrame(small + large, "n long, k long, p double")
    for r in df.select("n", "k", "p", binomial_pmf(F.col("n"), F.col("k"), F.col("p")).alias("v"), log_choose(F.col("n"), F.col("k")).alias("c")).collect():
        n, k, p = r["n"], r["k"], Fraction(r["p"])
        if n <= 40:
            assert r["v"] == pytest.approx(float(comb(n, k) * p**k * (1 - p)**(n - k)), rel=1e-12)
            assert r["c"] == pytest.approx(log(comb(n, k)), rel=1e-12, abs=1e-12)
        else:
            falling = sum(log(n - i) for i in range(k))
            assert r["c"] == pytest.approx(falling - lgamma(k + 1), rel=1e-13)
            want = falling - lgamma(k + 1) + k * log(r["p"]) - n * r["p"] * (1 + r["p"] / 2) + k * r["p"]
            assert log(r["v"]) == pytest.approx(want, abs=2e-9)
    edges = spark.createDataFrame([(4, 0, 0.0), (4, 1, 0.0), (4, 4, 1.0), (4, 5, 0.5)], "n long, k long, p double")
    assert [r[0] for r in edges.select(binomial_pmf(F.col("n"), F.col("k"), F.col("p"))).collect()] == [1.0, 0.0, 1.0, 0.0]


def test_expected_counts_cover_absent_pairs(spark):
    from tessera.operators.stattests import chi2_contingency, chi2_expected
    df = spark.createDataFrame([("a", "x")] * 3 + [("a", "y")] * 2 + [("b", "x")] * 5 + [(None, "x"), ("c", None)], "u string, v string")
    got = {(r["u"], r["v"]): (r["observed"], r["expected"]) for r in chi2_expected(df, "u", "v").collect()}
    assert got == {("a", "x"): (3, 4.0), ("a", "y"): (2, 1.0), ("b", "x"): (5, 4.0), ("b", "y"): (0, 1.0)}
    assert chi2_contingency(df.limit(0), "u", "v").first()["statistic"] is None
