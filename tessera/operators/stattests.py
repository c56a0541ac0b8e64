"""Distribution and independence statistics: skewness comparison (C2),
chi-square contingency test (M16), chi-square feature scores (M17) and
feature selection by p-value (M18).

p-values use the chi-square survival function, evaluated per row with
built-in expressions (regularised upper incomplete gamma by series /
continued fraction, as in Numerical Recipes; the number of terms grows with
the square root of the degrees of freedom), so no Python worker is involved.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.session import materialize


def skew_report(df: DataFrame, col: str) -> DataFrame:
    """Population skewness of x, ln x, sqrt x and ln(1+x) (C2): the numeric
    form of choosing the transform that makes a histogram most symmetric."""
    x = F.col(col).cast("double")
    t = df.select(x.alias("raw"), S.log_transform(x).alias("log"),
                  S.sqrt_transform(x).alias("sqrt"), S.log1p_transform(x).alias("log1p"))
    return t.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("transform"), F.col(n).alias("v")) for n in t.columns]))) \
        .groupBy("transform").agg(F.skewness("v").alias("skewness"), F.count("v").alias("n"))


# ---- chi-square survival function as a column expression -------------------
def chi2_sf(stat: Column, dof: Column) -> Column:
    """P(X > stat) for X ~ chi-square(dof) = Q(dof/2, stat/2)."""
    a = dof.cast("double") / 2
    x = stat.cast("double") / 2
    gln = S.log_gamma(a)
    # series for P(a, x) when x < a + 1
    # the terms fall like exp(-n^2 / 2a): 12 sqrt(a) of them reach 1e-16
    terms = F.sequence(F.lit(1), (F.lit(200) + F.ceil(12 * F.sqrt(a))).cast("int"))
    series = F.aggregate(
        terms, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda acc, n: F.struct((acc["term"] * x / (a + n)).alias("term"),
                                (acc["sum"] + acc["term"] * x / (a + n)).alias("sum")))
    p_series = series["sum"] / a * F.exp(-x + a * F.ln(x) - gln)
    # continued fraction for Q(a, x) when x >= a + 1 (modified Lentz)
    tiny = 1e-300
    b0 = x + 1 - a
    init = F.struct(b0.alias("b"), F.lit(1 / tiny).alias("c"), (1 / b0).alias("d"),
                    (1 / b0).alias("h"))

    def step(acc, i):
        an = -i * (i - a)
        b = acc["b"] + 2
        d = an * acc["d"] + b
        d = F.when(F.abs(d) < tiny, F.lit(tiny)).otherwise(d)
        c = b + an / acc["c"]
        c = F.when(F.abs(c) < tiny, F.lit(tiny)).otherwise(c)
        d = 1 / d
        return F.struct(b.alias("b"), c.alias("c"), d.alias("d"), (acc["h"] * d * c).alias("h"))

    cf = F.aggregate(terms, init, step)
    q_cf = F.exp(-x + a * F.ln(x) - gln) * cf["h"]
    return (F.when(stat.isNull() | dof.isNull(), F.lit(None))
            .when(x <= 0, F.lit(1.0))
            .when(x < a + 1, F.lit(1.0) - p_series)
            .otherwise(q_cf))


def chi2_contingency(df: DataFrame, a: str, b: str, correction: bool = True) -> DataFrame:
    """Pearson chi-square test of independence of two categorical columns
    (M16): statistic, dof, p-value; Yates' correction when dof = 1.

    Observed counts come from one grouping of the input, kept as a table of
    the present pairs; its totals, one row, are read from that table.
    Absent pairs are not materialised: with g(O, E) = (|O - E| - y)^2 / E the
    statistic is
    sum over all cells of g(0, E) + sum over present cells of (g(O, E) - g(0, E)).
    Without correction g(0, E) = E and the first sum is N; with correction
    (a 2 x 2 table) it runs over the four products of the two row and two
    column margins, which are the min and max of each margin.
    """
    cells = _cells(df, a, b)
    t = cells.agg(F.sum("o").alias("n"), F.count_distinct(a).alias("ka"), F.count_distinct(b).alias("kb"),
                  F.min("_ra").alias("rmin"), F.max("_ra").alias("rmax"),
                  F.min("_cb").alias("cmin"), F.max("_cb").alias("cmax")).first()
    if not t["n"]:
        return df.sparkSession.createDataFrame([(None, None, None)], "statistic double, dof long, p_value double")
    n, dof = t["n"], (t["ka"] - 1) * (t["kb"] - 1)
    use_y = dof == 1 and correction

    def g(o: Column, e: Column) -> Column:
        d = F.abs(o - e)
        adj = d - F.least(F.lit(0.5), d) if use_y else d
        return adj * adj / e

    zero = F.lit(0.0)
    all_absent = F.lit(float(n))
    if use_y:
        all_absent = reduce(add, [g(zero, F.lit(t[r] * t[c] / n)) for r in ("rmin", "rmax") for c in ("cmin", "cmax")])
    e = F.col("_ra") * F.col("_cb") / F.lit(n)
    # the statistic and dof leave the aggregation as plain columns, so the
    # p-value's higher-order functions see attributes
    out = cells.agg((F.sum(g(F.col("o"), e) - g(zero, e)) + all_absent).alias("statistic")).withColumn(
        "dof", F.lit(dof).cast("long"))
    return out.withColumn("p_value", chi2_sf(F.col("statistic"), F.col("dof")))


def _cells(df: DataFrame, a: str, b: str) -> DataFrame:
    """a, b, o (count) of the present pairs with the margins _ra and _cb;
    written once, so the input is read once."""
    base = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    obs = materialize(base.groupBy(a, b).agg(F.count(F.lit(1)).alias("o")), "cells")
    return obs.withColumns({"_ra": F.sum("o").over(Window.partitionBy(a)), "_cb": F.sum("o").over(Window.partitionBy(b))})


def chi2_expected(df: DataFrame, a: str, b: str) -> DataFrame:
    """a, b, observed, expected for every pair of values of the two columns
    (M16): expected = row margin * column margin / N, as the test of
    independence uses it. Absent pairs have observed 0. The second column's
    margins are one array (a row a value), given to each value of the first."""
    cells = _cells(df, a, b)
    columns = (cells.select(b, "_cb").distinct()
               .agg(F.array_sort(F.collect_list(F.struct(F.col(b).alias("b"), F.col("_cb").alias("c")))).alias("cols")))
    n = cells.select(F.sum("o")).scalar()
    rows = cells.select(a, "_ra").distinct().withColumn("_col", F.explode(columns.scalar()))
    grid = rows.select(a, F.col("_col.b").alias(b), (F.col("_ra") * F.col("_col.c") / n).alias("expected"))
    seen = cells.select(F.col(a).alias("_a"), F.col(b).alias("_b"), "o")
    return (grid.join(seen, (F.col(a) == F.col("_a")) & (F.col(b) == F.col("_b")), "left")
            .select(a, b, F.coalesce("o", F.lit(0)).alias("observed"), "expected"))


def chi2_feature_scores(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Chi-square score of non-negative features against a class label
    (M17): per feature, observed = per-class sums, expected = class share *
    feature total; dof = classes - 1."""
    base = df.where(F.col(label).isNotNull())
    long = base.select(F.col(label).alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("_x")) for f in features])))
    obs = long.groupBy("feature", "_y").agg(F.sum("_x").alias("o"), F.count(F.lit(1)).alias("_ny"))
    per_f = Window.partitionBy("feature")
    cells = obs.withColumns({"_n": F.sum("_ny").over(per_f), "_k": F.count(F.lit(1)).over(per_f),
                             "_tot": F.sum("o").over(per_f)})
    cells = cells.withColumn("e", F.col("_ny") / F.col("_n") * F.col("_tot"))
    g = cells.groupBy("feature").agg(
        F.sum(F.try_divide((F.col("o") - F.col("e")) * (F.col("o") - F.col("e")), F.col("e")))
        .alias("chi2"), (F.max("_k") - 1).cast("long").alias("dof"))
    return g.withColumn("p_value", chi2_sf(F.col("chi2"), F.col("dof")))


def select_features(scores: DataFrame, alpha: float = 0.01) -> DataFrame:
    """Keep / drop verdict per feature."""
    return scores.withColumn("selected", F.col("p_value") < alpha)
