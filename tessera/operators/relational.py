"""Projections, filters, joins, sorting and set operations (P*, J*, O*, U*).

Thin where Spark already has the operator; the value is in fixed semantics
(null handling, no Python per row, no cross joins) and plans Catalyst can
push down and prune.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.skew import split_join

from tessera.functions import scalars as S


# --- P1-P17 ---------------------------------------------------------------
def project(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def rename(df: DataFrame, mapping: dict[str, str] | list[str]) -> DataFrame:
    """Rename by name (dict) or by position (list of new names)."""
    if isinstance(mapping, dict):
        return df.withColumnsRenamed(mapping)
    return df.toDF(*mapping)


def tag(df: DataFrame, **constants) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Lenient casts: text that does not parse becomes NULL (ANSI-safe);
    booleans to int map true/false to 1/0."""
    out = {}
    for c, t in types.items():
        src = dict(df.dtypes)[c]
        out[c] = F.col(c).cast(t) if src == "boolean" else F.col(c).try_cast(t)
    return df.withColumns(out)


def filter_rows(df: DataFrame, predicate: Column | str) -> DataFrame:
    return df.where(predicate)


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=subset)


def non_finite_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: S.non_finite_to_null(c) for c in cols})


def drop_nan(df: DataFrame, col: str) -> DataFrame:
    """Drop NaN scores (P9). NULL is not NaN and is kept (``isnan(NULL)`` is false)."""
    return df.where(~F.isnan(F.col(col)))


def null_profile(df: DataFrame, only_with_nulls: bool = False) -> DataFrame:
    """Nulls per column in one pass (column_name, null_count, position)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    stacked = agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"),
                 F.lit(i).alias("position")) for i, c in enumerate(df.columns)])))
    return stacked.where(F.col("null_count") > 0) if only_with_nulls else stacked


def rows_with_nulls(df: DataFrame) -> DataFrame:
    any_null = F.lit(False)
    for c in df.columns:
        any_null = any_null | F.col(c).isNull()
    return df.agg(F.count_if(any_null).alias("rows_with_null"), F.count(F.lit(1)).alias("n_rows"))


def label_outcome(df: DataFrame, actual: str, predicted: str, out: str = "outcome") -> DataFrame:
    return df.withColumn(out, S.outcome_tag(actual, predicted))


def rule_flag(df: DataFrame, rule: Column, out: str) -> DataFrame:
    return df.withColumn(out, rule.cast("int"))


def row_features(df: DataFrame, cols: list[str], prefix: str = "") -> DataFrame:
    """Row-wise sum, max and nonzero count across ``cols``."""
    return df.withColumns({f"{prefix}total_delinquencies": S.row_sum(cols),
                           f"{prefix}max_delinquencies": S.row_max(cols),
                           f"{prefix}delinquency_cnt": S.row_nonzero_count(cols)})


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Column names whose Spark type name starts with ``kind``."""
    return [c for c, t in df.dtypes if t.startswith(kind)]


def count_where(df: DataFrame, predicate: Column | str) -> DataFrame:
    pred = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.agg(F.count_if(pred).alias("n_matching"), F.count(F.lit(1)).alias("n_rows"))


def preview(df: DataFrame, n: int, order_by: list[str], tail: bool = False) -> DataFrame:
    """First (or last) n rows by an explicit order: a top-n, not a full sort."""
    order = [F.col(c).desc() if tail else F.col(c).asc() for c in order_by]
    return df.orderBy(*order).limit(n)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def map_values(df: DataFrame, col: str, mapping: dict, out: str | None = None,
               default: Column | None = None) -> DataFrame:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == k, F.lit(v)) if expr is None
                else expr.when(F.col(col) == k, F.lit(v)))
    expr = expr.otherwise(default if default is not None else F.col(col))
    return df.withColumn(out or col, expr)


# --- J1-J8 ----------------------------------------------------------------
def inner_join(a: DataFrame, b: DataFrame, on: str | list[str]) -> DataFrame:
    """Equi-join; Catalyst/AQE choose broadcast (by measured size) or sort-merge."""
    return a.join(b, on, "inner")


def inner_join_expr(a: DataFrame, b: DataFrame, cond: Column) -> DataFrame:
    return a.join(b, cond, "inner")


def join_aggregates(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Join of two per-key aggregates; both are hash-partitioned by ``key`` so
    the join reuses their exchanges."""
    return a.join(b, key, "inner")


def semi_join(a: DataFrame, b: DataFrame, on: str | list[str]) -> DataFrame:
    return a.join(b, on, "left_semi")


def anti_join(a: DataFrame, b: DataFrame, on: str | list[str]) -> DataFrame:
    return a.join(b, on, "left_anti")


def left_lookup(df: DataFrame, dim: DataFrame, on: str | list[str],
                defaults: dict[str, Column]) -> DataFrame:
    """Left join with defaults for unmatched rows (J6). With a single key, keys
    that hold much of ``df`` are matched apart from the others (``split_join``)."""
    keys = [on] if isinstance(on, str) else list(on)
    j = split_join(df, dim, keys[0], "left") if len(keys) == 1 else df.join(dim, keys, "left")
    return j.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})


def attach_columns(a: DataFrame, b: DataFrame, row_id: str) -> DataFrame:
    """Align two tables by an explicit row id (pandas index alignment, J7)."""
    return a.join(b, row_id, "inner")


def grid_axes_size(axes: dict[str, tuple[float, float, float] | list]) -> int:
    size = 1
    for spec in axes.values():
        size *= len(_axis_values(spec))
    return size


def _axis_values(spec) -> list:
    if isinstance(spec, tuple):
        lo, hi, step = spec
        n = int(round((hi - lo) / step))
        return [round(lo + i * step, 10) for i in range(n + 1)]
    return list(spec)


def grid_point_columns(idx: Column, axes: dict[str, tuple | list]) -> dict[str, Column]:
    """Parameter values of grid point ``idx`` (row-major over ``axes``),
    computed arithmetically: the grid never exists as a table to join."""
    cols: dict[str, Column] = {}
    stride = 1
    sizes = [len(_axis_values(s)) for s in axes.values()]
    strides = []
    for n in reversed(sizes):
        strides.append(stride)
        stride *= n
    strides = list(reversed(strides))
    for (name, spec), n, st in zip(axes.items(), sizes, strides):
        pos = F.floor(idx / st) % n
        if isinstance(spec, tuple):
            lo, _, step = spec
            cols[name] = F.round(F.lit(float(lo)) + pos * F.lit(float(step)), 10)
        else:
            cols[name] = F.element_at(F.array(*[F.lit(v) for v in spec]), (pos + 1).cast("int"))
    return cols


def grid_cross_join(df: DataFrame, axes: dict[str, tuple | list]) -> DataFrame:
    """Every row with every point of a parameter grid.

    The grid is generated inside each row by ``sequence`` + arithmetic (its
    size is fixed by the arguments, not the data), so no join operator and no
    broadcast is involved; follow it with a grouping by the grid columns and
    Spark aggregates partially before any shuffle.
    """
    g = grid_axes_size(axes)
    exploded = df.withColumn("grid_idx", F.explode(F.sequence(F.lit(0), F.lit(g - 1))))
    return exploded.withColumns(grid_point_columns(F.col("grid_idx"), axes))


# --- O1-O3 ----------------------------------------------------------------
def sort_by(df: DataFrame, cols: list[str], ascending: bool | list[bool] = True) -> DataFrame:
    return df.orderBy(*cols, ascending=ascending)


def top_n(df: DataFrame, col: str, n: int, tiebreak: Iterable[str] = ()) -> DataFrame:
    """Largest n by ``col`` (TakeOrderedAndProject: per-partition top-n, then merge)."""
    return df.orderBy(F.col(col).desc(), *tiebreak).limit(n)


def shuffle_rows(df: DataFrame, seed: int, id_col: str) -> DataFrame:
    """Repeatable permutation: order by a seeded hash of a stable row id."""
    return df.orderBy(F.xxhash64(F.col(id_col), F.lit(seed)), F.col(id_col))


# --- U1-U3 ----------------------------------------------------------------
def union_rows(a: DataFrame, b: DataFrame, allow_missing: bool = True) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=allow_missing)


def distinct_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def overlap_report(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Sizes of both key sets and of their intersection and differences, from
    one shuffle of the two distinct key sets."""
    tagged = (a.select(F.col(key).alias("_k"), F.lit(1).alias("_l"), F.lit(0).alias("_r"))
              .unionByName(b.select(F.col(key).alias("_k"), F.lit(0).alias("_l"), F.lit(1).alias("_r"))))
    per_key = tagged.groupBy("_k").agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return per_key.agg(
        F.count_if(F.col("_l") == 1).alias("left_count"),
        F.count_if(F.col("_r") == 1).alias("right_count"),
        F.count_if((F.col("_l") == 1) & (F.col("_r") == 1)).alias("common"),
        F.count_if((F.col("_l") == 1) & (F.col("_r") == 0)).alias("only_left"),
        F.count_if((F.col("_l") == 0) & (F.col("_r") == 1)).alias("only_right"))

