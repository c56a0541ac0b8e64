"""Grouped and global aggregations.

Conventions: null group keys are dropped (pandas semantics, ``dropna=True``);
shares divide by a scalar subquery total instead of an un-partitioned window;
quantiles are exact and linear-interpolated via ``exact_quantiles``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordering import exact_quantiles, join_keys, segmented_scan

DESCRIBE_PROBS = [0.25, 0.5, 0.75]
PROFILE_PROBS = [0.0, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0]


def _drop_null_keys(df: DataFrame, keys: list[str], dropna: bool) -> DataFrame:
    if not dropna:
        return df
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond)


def value_counts(df: DataFrame, col: str, dropna: bool = True, sort: bool = True) -> DataFrame:
    """Count and share per value, most frequent first (ties by value) (A1).
    Partial aggregation first, so a value holding a third of the rows costs
    one row per map task; the sort runs on the small counted table."""
    base = _drop_null_keys(df.select(col), [col], dropna)
    counts = base.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = base.select(F.count(F.lit(1))).scalar()
    out = counts.withColumn("share", F.col("count") / total)
    return out.orderBy(F.col("count").desc(), F.col(col)) if sort else out


def count_by(df: DataFrame, col: str, hue: str, dropna: bool = True) -> DataFrame:
    """Counts per (category, class) (A2)."""
    base = _drop_null_keys(df, [col, hue], dropna)
    return base.groupBy(col, hue).agg(F.count(F.lit(1)).alias("count"))


def crosstab(df: DataFrame, a: str, b: str, normalize: str | None = None,
             values: str | None = None, aggfunc: str = "count", dropna: bool = True) -> DataFrame:
    """Long-form contingency table (A3–A6): one row per present (a, b) pair
    with ``count`` (or ``aggfunc`` of ``values``) and, when asked, the share
    within the row (``index``), column (``columns``) or table (``all``).

    The shares use windows over the aggregated pairs, whose partitions hold one
    row per category of the other variable.
    """
    base = _drop_null_keys(df, [a, b], dropna)
    if values is None:
        g = base.groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))
        measure = "count"
    else:
        fn = {"mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min, "count": F.count}[aggfunc]
        g = base.groupBy(a, b).agg(fn(values).alias(aggfunc))
        measure = aggfunc
    if normalize is None:
        return g
    if normalize == "index":
        denom = F.sum(measure).over(Window.partitionBy(a))
    elif normalize == "columns":
        denom = F.sum(measure).over(Window.partitionBy(b))
    elif normalize == "all":
        denom = g.select(F.sum(measure)).scalar()
    else:
        raise ValueError(normalize)
    return g.withColumn("share", F.col(measure) / denom)


def crosstab_wide(df: DataFrame, a: str, b: str, b_values: list, values: str | None = None,
                  aggfunc: str = "count", fill: float | int | None = 0) -> DataFrame:
    """Wide contingency table: one column per listed ``b`` value (the list
    fixes the schema and spares Spark a distinct pass), zero for absent pairs."""
    base = _drop_null_keys(df, [a, b], True)
    piv = base.groupBy(a).pivot(b, b_values)
    if values is None:
        out = piv.agg(F.count(F.lit(1)))
    else:
        fn = {"mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min}[aggfunc]
        out = piv.agg(fn(values))
    return out.fillna(fill) if fill is not None else out


def describe_numeric(df: DataFrame, cols: list[str], keys: list[str] = ()) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 %, max per column (A7), and per
    group when ``keys`` are given (A10). One row per (keys, column)."""
    keys = list(keys)
    stacked = df.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_x"))
        for c in cols])))
    gk = [*keys, "column_name"]
    moments = stacked.groupBy(*gk).agg(
        F.count("_x").alias("count"), F.avg("_x").alias("mean"),
        F.stddev_samp("_x").alias("std"), F.min("_x").alias("min"), F.max("_x").alias("max"))
    q = exact_quantiles(stacked, "_x", DESCRIBE_PROBS, gk, out="_q")
    qw = q.groupBy(*gk).agg(*[F.max(F.when(F.col("prob") == p, F.col("_q"))).alias(name)
                              for p, name in zip(DESCRIBE_PROBS, ["p25", "p50", "p75"])])
    return join_keys(moments, qw, gk, "left")


def describe_categorical(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, distinct, most frequent value (ties: smallest) and its
    frequency per column (A8)."""
    stacked = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in cols]))).where(F.col("value").isNotNull())
    counts = stacked.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("freq"))
    return counts.groupBy("column_name").agg(
        F.sum("freq").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("freq"), F.col("value"))).alias("top"),
        F.max("freq").alias("freq"))


def describe_timestamp(df: DataFrame, col: str) -> DataFrame:
    """count, distinct, first, last, most frequent (ties: earliest)."""
    counts = (df.select(col).where(F.col(col).isNotNull())
              .groupBy(col).agg(F.count(F.lit(1)).alias("freq")))
    return counts.agg(F.sum("freq").alias("count"), F.count(F.lit(1)).alias("unique"),
                      F.min(col).alias("first"), F.max(col).alias("last"),
                      F.min_by(col, F.struct(-F.col("freq"), F.col(col))).alias("top"),
                      F.max("freq").alias("freq"))


def describe_by(df: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """A7 per group (A10)."""
    return describe_numeric(df, cols, keys=[group])


def compare_sources(frames: dict[str, DataFrame], cols: list[str]) -> DataFrame:
    """A7 of several tables side by side, tagged by source name (A10)."""
    tagged = None
    for name, f in frames.items():
        t = f.select(*cols).withColumn("source_name", F.lit(name))
        tagged = t if tagged is None else tagged.unionByName(t)
    return describe_numeric(tagged, cols, keys=["source_name"])


def group_size(df: DataFrame, keys: list[str], out: str = "size") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def group_agg(df: DataFrame, keys: list[str], spec: dict[str, list[str]]) -> DataFrame:
    """General per-key aggregate: {column: [function names]} -> fn_column."""
    fns = {"mean": F.avg, "avg": F.avg, "max": F.max, "min": F.min, "sum": F.sum,
           "count": F.count, "std": F.stddev_samp, "var": F.var_samp,
           "nunique": F.count_distinct, "median": F.median}
    return df.groupBy(*keys).agg(*[fns[f](c).alias(f"{f}_{c}")
                                   for c, fl in spec.items() for f in fl])


def visits_per_customer(df: DataFrame, customer: str, ts: str, out: str = "visits") -> DataFrame:
    """Distinct (customer, time) pairs counted per customer."""
    return (df.select(customer, ts).distinct()
            .groupBy(customer).agg(F.count(F.lit(1)).alias(out)))


def group_collect(df: DataFrame, key: str, col: str, out: str = "items",
                  as_text: bool = False) -> DataFrame:
    """Sorted list of distinct values per key (A14). Values are de-duplicated
    by a shuffle on (key, value) before the per-key list is built."""
    d = df.select(key, col).where(F.col(col).isNotNull()).distinct()
    g = d.groupBy(key).agg(F.array_sort(F.collect_list(col)).alias(out))
    if as_text:
        g = g.withColumn(out, F.array_join(F.col(out).cast("array<string>"), " "))
    return g


def group_collect_chunks(df: DataFrame, key: str, col: str, size: int = 10_000, out: str = "items",
                         as_text: bool = False) -> DataFrame:
    """The sorted list of distinct values per key (A14) in chunks of ``size``:
    key, chunk (from 0), before (values in earlier chunks), total, items. Joined
    by chunk they are the whole list; no row holds more than ``size`` values and
    a key with very many of them is many tasks' work. Null values are left
    out; a null key is a key."""
    d = df.select(key, col).where(F.col(col).isNotNull()).distinct()
    placed = segmented_scan(d, [key], [F.col(col)]).withColumn("chunk", F.floor(F.col("_before") / size))
    g = placed.groupBy(key, "chunk").agg(F.array_sort(F.collect_list(col)).alias(out), F.min("_before").alias("before"),
                                         F.first("_total").alias("total"))
    if as_text:
        g = g.withColumn(out, F.array_join(F.col(out).cast("array<string>"), " "))
    return g.select(key, "chunk", "before", "total", out)


def filter_min_activity(df: DataFrame, key: str, rating: str, cutoff: int) -> DataFrame:
    """Rows of keys with strictly more than ``cutoff`` non-null ratings
    (A15), as a semi-join against the qualifying keys."""
    active = (df.groupBy(key).agg(F.count(rating).alias("_n"))
              .where(F.col("_n") > cutoff).select(key))
    return df.join(active, key, "left_semi")


def group_sum(df: DataFrame, key: str, col: str, out: str | None = None) -> DataFrame:
    return df.groupBy(key).agg(F.sum(col).alias(out or f"{col}_sum"))


def global_avg_of_ratio(df: DataFrame, num: str, den: str, out: str = "avg_ratio") -> DataFrame:
    """Mean over rows of num/den; rows with den = 0 give NULL and are skipped."""
    return df.agg(F.avg(F.try_divide(F.col(num), F.col(den))).alias(out))


def percentiles(df: DataFrame, col: str, probs: list[float] = PROFILE_PROBS) -> DataFrame:
    """Exact percentiles (A17): one row per probability."""
    return exact_quantiles(df, col, probs, out="value")


def percentiles_by(df: DataFrame, col: str, group: str,
                   probs: list[float] = PROFILE_PROBS) -> DataFrame:
    """Exact percentiles per class (A18): (group, prob, value)."""
    return exact_quantiles(df.where(F.col(group).isNotNull()), col, probs, [group], out="value")


def count_distinct(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """Distinct values per column (A19); ``approx`` uses HyperLogLog++."""
    fn = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    return df.agg(*[fn(c).alias(f"distinct_{c}") for c in cols])


def moments(df: DataFrame, col: str) -> DataFrame:
    """n, mean, population variance and deviation."""
    return df.agg(F.count(col).alias("n"), F.avg(col).alias("mean"),
                  F.var_pop(col).alias("var_pop"), F.stddev_pop(col).alias("std_pop"))


def argmin_rows(df: DataFrame, col: str) -> DataFrame:
    """All rows at the minimum of ``col`` (A21); the minimum is a scalar
    subquery, so no window or join over the table."""
    return df.where(F.col(col) == df.select(F.min(col)).scalar())


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Positive count and share, negative/positive ratio (the usual class
    weight) (A22)."""
    pos = F.count_if(F.col(label) == 1)
    neg = F.count_if(F.col(label) == 0)
    return df.agg(pos.alias("positives"), neg.alias("negatives"),
                  F.try_divide(pos, pos + neg).alias("positive_share"),
                  F.try_divide(neg, pos).alias("class_weight"))
