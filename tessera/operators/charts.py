"""The statistics behind the notebooks' charts (A23–A29): box, density,
histogram, violin, mosaic, binned scatter and trend line. Drawing is out of
scope; each returns the table a chart would be drawn from."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordering import _attach_scalars, exact_quantiles, join_keys


def _attach(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Per-group statistics onto rows: an equi-join on the group keys (AQE
    broadcasts the one-row-per-group side when it is small), or scalar
    subqueries when there is no group."""
    return join_keys(df, stats, keys) if keys else _attach_scalars(df, stats)


def box_stats(df: DataFrame, x: str, group: list[str] = ()) -> DataFrame:
    """Quartiles, IQR, whiskers at the most extreme points within 1.5 IQR of
    the box, and the number of points outside (A23)."""
    keys = list(group)
    base = df.select(*keys, F.col(x).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    if keys:
        base = base.dropna(subset=keys)
    q = exact_quantiles(base, "_x", [0.25, 0.5, 0.75], keys, out="_q")
    qw = q.groupBy(*keys).agg(F.max(F.when(F.col("prob") == 0.25, F.col("_q"))).alias("q1"),
                              F.max(F.when(F.col("prob") == 0.5, F.col("_q"))).alias("median"),
                              F.max(F.when(F.col("prob") == 0.75, F.col("_q"))).alias("q3"))
    qw = qw.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo = F.col("q1") - 1.5 * F.col("iqr")
    hi = F.col("q3") + 1.5 * F.col("iqr")
    j = _attach(base, qw, keys)
    out = j.groupBy(*keys).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.first("iqr").alias("iqr"),
        F.min(F.when(F.col("_x") >= lo, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(F.col("_x") <= hi, F.col("_x"))).alias("whisker_high"),
        F.count_if((F.col("_x") < lo) | (F.col("_x") > hi)).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))
    return out


def kde(df: DataFrame, x: str, group: list[str] = (), grid: int = 200,
        bandwidth: float | None = None, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on ``grid`` evenly spaced points from
    min - cut*h to max + cut*h, per group (A24).

    h is Scott's rule (sample std * n^(-1/5)) unless given. Equal values are
    pre-counted, then each distinct value contributes to every grid point
    through a generated index (no join with a grid table); the sums are
    partially aggregated per (group, grid point) before the shuffle.
    """
    keys = list(group)
    base = df.select(*keys, F.col(x).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    if keys:
        base = base.dropna(subset=keys)
    stats = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_min"),
                                    F.max("_x").alias("_max"), F.stddev_samp("_x").alias("_sd"))
    h = F.lit(float(bandwidth)) if bandwidth else F.col("_sd") * F.pow(F.col("_n"), -0.2)
    stats = stats.withColumn("_h", h).withColumns({
        "_g0": F.col("_min") - cut * F.col("_h"),
        "_step": ((F.col("_max") - F.col("_min")) + 2 * cut * F.col("_h")) / (grid - 1)})
    distinct_vals = base.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_w"))
    j = _attach(distinct_vals, stats.select(*keys, "_n", "_h", "_g0", "_step"), keys)
    j = j.withColumn("grid_index", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    gx = F.col("_g0") + F.col("grid_index") * F.col("_step")
    z = F.try_divide(gx - F.col("_x"), F.col("_h"))  # no spread: no bandwidth, NULL density
    j = j.withColumn("_k", F.col("_w") * F.exp(-0.5 * z * z))
    out = j.groupBy(*keys, "grid_index").agg(
        F.first(gx).alias("x"),
        F.try_divide(F.sum("_k"), F.first("_n") * F.first("_h") * math.sqrt(2 * math.pi)).alias("density"))
    return out


def histogram(df: DataFrame, x: str, bins: int, density: bool = False) -> DataFrame:
    """Equal-width bins from min to max, last bin closed (numpy rule), every
    bin listed even when empty (A25)."""
    base = df.select(F.col(x).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    # a constant column gets a range of width 1 around it (numpy rule)
    pad = F.when(F.min("_x") == F.max("_x"), F.lit(0.5)).otherwise(F.lit(0.0))
    mn = base.select(F.min("_x") - pad).scalar()
    mx = base.select(F.max("_x") + pad).scalar()
    n = base.select(F.count(F.lit(1))).scalar()
    width = (mx - mn) / bins
    idx = F.least(F.floor((F.col("_x") - mn) / width), F.lit(bins - 1)).cast("int")
    counts = base.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = base.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = (all_bins.join(counts, "bin", "left")
           .select("bin", (mn + F.col("bin") * width).alias("lower"),
                   (mn + (F.col("bin") + 1) * width).alias("upper"),
                   F.coalesce(F.col("count"), F.lit(0).cast("long")).alias("count")))
    if density:
        out = out.withColumn("density", F.col("count") / (n * width))
    return out


def violin_stats(df: DataFrame, x: str, category: str, hue: str, grid: int = 100) -> DataFrame:
    """Density curve and quartiles per (category, hue)."""
    keys = [category, hue]
    dens = kde(df, x, keys, grid=grid)
    box = box_stats(df, x, keys).select(*keys, "q1", "median", "q3")
    return join_keys(dens, box, keys, "left")


def mosaic_shares(df: DataFrame, cols: list[str]) -> DataFrame:
    """Counts of the multi-way table with the share of each cell inside its
    parent at every level (share_1 = of the total, share_k = within the
    first k-1 columns) (A27)."""
    base = df.dropna(subset=cols)
    g = base.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))
    total = base.select(F.count(F.lit(1))).scalar()
    out = g
    for k in range(1, len(cols) + 1):
        num = F.sum("count").over(Window.partitionBy(*cols[:k]))
        den = F.sum("count").over(Window.partitionBy(*cols[:k - 1])) if k > 1 else total
        out = out.withColumn(f"share_{k}", num / den)
    return out


def binned_scatter(df: DataFrame, x: str, y: str, x_width: float, y_width: float,
                   label: str | None = None, size: str | None = None,
                   facets: list[str] = ()) -> DataFrame:
    """2-D bins of a point cloud with counts (and mean size) per label and
    facet (A28): what a scatter plot shows, at any row count."""
    keys = [*facets, *([label] if label else [])]
    bx = F.floor(F.col(x) / x_width).cast("long").alias("x_bin")
    by = F.floor(F.col(y) / y_width).cast("long").alias("y_bin")
    aggs = [F.count(F.lit(1)).alias("count")]
    if size:
        aggs.append(F.avg(size).alias("mean_size"))
    return (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(*keys, bx, by).agg(*aggs))


def linear_trend(df: DataFrame, x: str, y: str, group: list[str] = ()) -> DataFrame:
    """Least-squares line per group with the slope's standard error."""
    yy, xx = F.col(y).cast("double"), F.col(x).cast("double")
    g = df.groupBy(*group).agg(
        F.regr_count(yy, xx).alias("n"), F.regr_slope(yy, xx).alias("slope"),
        F.regr_intercept(yy, xx).alias("intercept"), F.regr_r2(yy, xx).alias("r2"),
        F.regr_sxx(yy, xx).alias("_sxx"), F.regr_syy(yy, xx).alias("_syy"),
        F.regr_sxy(yy, xx).alias("_sxy"))
    resid = F.col("_syy") - F.col("slope") * F.col("_sxy")
    se = F.sqrt(F.try_divide(F.try_divide(resid, F.col("n") - 2), F.col("_sxx")))
    return g.withColumn("slope_se", se).drop("_sxx", "_syy", "_sxy")
