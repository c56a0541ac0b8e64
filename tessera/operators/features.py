"""Feature preparation and sampling.

Random choices are seeded hashes of a stable row id, so results do not
depend on partitioning or on re-running a task; per-label orderings use the
distributed numbering in ``tessera.operators.ordering`` rather than one window
task per label (a label is typically a third or more of the rows).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import _attach_scalars, global_row_number, segmented_scan

_TWO63 = float(2 ** 63)


def uniform_hash(id_col: str | Column, seed: int, salt: int | Column = 0) -> Column:
    """A repeatable uniform number in [0, 1) from (id, seed, salt)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    h = F.xxhash64(c, F.lit(seed), salt if isinstance(salt, Column) else F.lit(salt))
    return (F.abs(h.cast("double")) / F.lit(_TWO63))


# --- M1-M4 encoders ---------------------------------------------------------
def category_values(df: DataFrame, col: str, most: int = 1000) -> list:
    """Distinct non-null values of a categorical column, sorted (used to fix
    the output schema of ``one_hot_wide``). More than ``most`` values are an
    error: such a column does not fit a column per value."""
    values = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct()
              .orderBy(col).limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{col} has more than {most} values")
    return values


def one_hot_wide(df: DataFrame, cols: list[str], categories: dict[str, list] | None = None,
                 drop_first: bool = True, keep_original: bool = False) -> DataFrame:
    """0/1 column ``{col}_{value}`` per category in lexical order, first one
    dropped, null -> all zeros (M1). Pass ``categories`` to fix the schema
    without a distinct pass; a value outside them then fails the query."""
    categories = dict(categories or {})
    out = {}
    for c in cols:
        known = sorted(categories.get(c) or category_values(df, c))
        unknown = F.lit(False) if c not in categories else F.col(c).isNotNull() & ~F.col(c).isin(known)
        for v in known[1:] if drop_first else known:
            out[f"{c}_{v}"] = F.when(unknown, F.raise_error(F.lit(f"unknown value of {c}")).cast("int")).otherwise(
                F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)))
    res = df.withColumns(out)
    return res if keep_original else res.drop(*cols)


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Codes 0.. by lexical order of the distinct values (M2); nulls stay null."""
    out = out or f"{col}_code"
    codes = global_row_number(df.select(col).where(F.col(col).isNotNull()).distinct(),
                              [F.col(col)], out=out, start=0)
    return df.join(codes, col, "left")


def label_binarize(df: DataFrame, col: str, classes: list, out: str = "onehot") -> DataFrame:
    """One 0/1 array per row over ``classes`` (M3)."""
    return df.withColumn(out, F.array(*[(F.col(col) == F.lit(c)).cast("int") for c in classes]))


def label_inverse(df: DataFrame, arr: str, classes: list, out: str = "label") -> DataFrame:
    """Back from a score array to the class with the largest entry (first on
    ties) (M3); an array without a positive entry stands for no class: NULL."""
    pos = F.array_position(F.col(arr), F.array_max(F.col(arr)))
    name = F.element_at(F.array(*[F.lit(c) for c in classes]), pos.cast("int"))
    return df.withColumn(out, F.when(F.array_max(F.col(arr)) > 0, name))


def id_index(df: DataFrame, col: str, out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Dense 0-based integer ids for text ids, alphabetical (M4): the index
    table (id, index) and ``df`` with the index joined on. No label list
    passes through the driver, unlike ``StringIndexer.fit``."""
    out = out or f"{col}_index"
    ids = df.select(col).where(F.col(col).isNotNull()).distinct()
    index = global_row_number(ids, [F.col(col)], out=out, start=0).withColumn(out, F.col(out).cast("int"))
    return index, df.join(index, col, "inner")


# --- M5 ---------------------------------------------------------------------
def standardize(train: DataFrame, others: list[DataFrame], cols: list[str],
                suffix: str = "") -> list[DataFrame]:
    """Fit mean and population deviation on ``train`` and apply them to
    ``train`` and every frame in ``others`` (M5). A constant column is only
    centred (scale 1)."""
    stats = train.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                      *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    res = []
    for f in [train, *others]:
        g = _attach_scalars(f, stats)
        g = g.withColumns({f"{c}{suffix}": (F.col(c) - F.col(f"_m_{c}"))
                           / F.when(F.col(f"_s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_s_{c}"))
                           for c in cols})
        res.append(g.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols]))
    return res


# --- M6-M10 sampling --------------------------------------------------------
def random_split(df: DataFrame, weights: list[float], seed: int, id_col: str,
                 out: str = "split_part") -> DataFrame:
    """Tag rows 0..k-1 by a seeded hash against cumulative weights (M6)."""
    total = float(sum(weights))
    u = uniform_hash(id_col, seed)
    edges, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        edges.append(acc)
    expr = F.lit(len(weights) - 1)
    for i in reversed(range(len(edges))):
        expr = F.when(u < edges[i], F.lit(i)).otherwise(expr)
    return df.withColumn(out, expr)


def split_parts(df: DataFrame, weights: list[float], seed: int, id_col: str) -> list[DataFrame]:
    tagged = random_split(df, weights, seed, id_col, "_part")
    return [tagged.where(F.col("_part") == i).drop("_part") for i in range(len(weights))]


def _numbered_within(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Row number (from 1) and size of each key group, from one distributed
    sort; columns ``_pos`` and ``_gsize``."""
    scanned = segmented_scan(df, keys, order)
    return scanned.select(*df.columns, (F.col("_before") + 1).alias("_pos"), F.col("_total").alias("_gsize"))


def stratified_split(df: DataFrame, label: str, fraction: float, seed: int, id_col: str,
                     out: str = "is_train") -> DataFrame:
    """First ``round(fraction * n_label)`` rows of each label in seeded hash
    order go to the training side (M7): both sides keep the label share."""
    h = F.xxhash64(F.col(id_col), F.lit(seed))
    n = _numbered_within(df.withColumn("_h", h), [label], [F.col("_h"), F.col(id_col)])
    return (n.withColumn(out, F.col("_pos") <= F.round(F.col("_gsize") * fraction))
            .drop("_pos", "_gsize", "_h"))


def fold_column(df: DataFrame, label: str, folds: int, seed: int, id_col: str,
                out: str = "fold") -> DataFrame:
    """Stratified fold number 0..folds-1 (for ``CrossValidator(foldCol=)``)."""
    h = F.xxhash64(F.col(id_col), F.lit(seed))
    n = _numbered_within(df.withColumn("_h", h), [label], [F.col("_h"), F.col(id_col)])
    return n.withColumn(out, ((F.col("_pos") - 1) % folds).cast("int")).drop("_pos", "_gsize", "_h")


def undersample(df: DataFrame, label: str, ratio: float, seed: int, id_col: str) -> DataFrame:
    """All positive rows and ``ratio`` times as many negatives, chosen by a
    seeded hash, in a seeded shuffled order (M8). Whole rows are sampled.

    The kept negatives are exactly those with the smallest hashes. Only
    candidates under a hash threshold sized for the need (with a margin of
    about six standard deviations) are sorted; if too few pass, all
    negatives are sorted instead, which selects the same rows.
    """
    pos = df.where(F.col(label) == 1)
    neg = df.where(F.col(label) == 0).withColumn("_h", uniform_hash(id_col, seed))
    sizes = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    n_pos, n_neg = int(sizes["p"]), int(sizes["n"])
    need = int(math.floor(n_pos * ratio))
    p = min(1.0, (need + 6 * math.sqrt(need) + 20) / max(n_neg, 1))
    cand = neg.where(F.col("_h") < F.lit(p)) if p < 1.0 else neg
    if p < 1.0 and cand.count() < need:
        cand = neg
    keep = global_row_number(cand, [F.col("_h"), F.col(id_col)], out="_rn")
    keep = keep.where(F.col("_rn") <= need).drop("_rn", "_h")
    both = pos.unionByName(keep)
    return both.orderBy(F.xxhash64(F.col(id_col), F.lit(seed + 1)), F.col(id_col))


def sample_rows(df: DataFrame, n: int, replace: bool, seed: int, id_col: str) -> DataFrame:
    """Fixed-size sample (M9). Without replacement: the n smallest seeded
    hashes (a top-n, no full sort). With replacement: n seeded draws of a row
    position, joined to the numbered table (a row drawn twice appears twice)."""
    if not replace:
        return df.orderBy(F.xxhash64(F.col(id_col), F.lit(seed)), F.col(id_col)).limit(n)
    numbered = global_row_number(df, [F.col(id_col)], out="_rn")
    total = numbered.select(F.count(F.lit(1))).scalar()
    draws = df.sparkSession.range(n).select(
        F.col("id").alias("draw"),
        (F.floor(uniform_hash(F.col("id"), seed) * total) + 1).cast("long").alias("_rn"))
    return numbered.join(draws, "_rn").drop("_rn")


def poisson_weight(u: Column, lam: float) -> Column:
    """Inverse-CDF Poisson(lam) draw from a uniform u (bootstrap weight). The
    table reaches to where the tail is below 1e-15, so its length follows from lam."""
    kmax = math.ceil(lam + 10 * math.sqrt(lam) + 20)
    expr = F.lit(kmax)
    cdf, p = [], math.exp(-lam)
    acc = 0.0
    for k in range(kmax):
        acc += p
        cdf.append(acc)
        p *= lam / (k + 1)
    for k in reversed(range(kmax)):
        expr = F.when(u < cdf[k], F.lit(k)).otherwise(expr)
    return expr


def bootstrap_rows(df: DataFrame, rounds: int, fraction: float, seed: int, id_col: str,
                   replace: bool = True) -> DataFrame:
    """Every row once per round with a resampling weight (M10): Poisson
    weights approximate draws with replacement of ``fraction * n`` rows;
    without replacement the weight is 0/1 with P(1) = fraction. Rows of
    weight 0 are dropped."""
    exploded = df.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    u = uniform_hash(id_col, seed, F.col("round"))
    w = poisson_weight(u, fraction) if replace else (u < fraction).cast("int")
    return exploded.withColumn("weight", w).where(F.col("weight") > 0)


def bootstrap_metric(df: DataFrame, value: Column, rounds: int, fraction: float, seed: int,
                     id_col: str, replace: bool = True) -> DataFrame:
    """Weighted mean and total of ``value`` per resampling round (M10), in one
    grouping over (rows x rounds)."""
    b = bootstrap_rows(df.withColumn("_v", value), rounds, fraction, seed, id_col, replace)
    return b.groupBy("round").agg(
        (F.sum(F.col("_v") * F.col("weight")) / F.sum("weight")).alias("mean"),
        F.sum(F.col("_v") * F.col("weight")).alias("total"),
        F.sum("weight").alias("n"))
