"""Registered queries: composites and relational / aggregate operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.fixture_sql import with_fixtures as W
from tessera.plans.registry import register
from tessera.plans import reports as R
from tessera.sources import fixtures as FX


@register("Q1_repurchase_summary", W("""
SELECT stock_code, round(avg(stock_purchases), 6) AS mean_purchases,
       max(stock_purchases) AS max_purchases
FROM (SELECT customer_id, stock_code, count(*) AS stock_purchases FROM tx GROUP BY 1, 2) b
JOIN (SELECT customer_id, count(*) AS trips
      FROM (SELECT DISTINCT customer_id, invoice_ts FROM tx) GROUP BY 1) t USING (customer_id)
WHERE trips > 1 GROUP BY stock_code""", "tx"))
def q1(spark, d):
    return R.repurchase_summary(FX.transactions(spark, d))


# ---------------------------------------------------------------- P1-P17
from tessera.functions import scalars as S  # noqa: E402
from tessera.operators import relational as P  # noqa: E402
from tessera.plans.common import r6  # noqa: E402

M11 = [f"m{i}" for i in range(1, 12)]


@register("P1_project_drop", W("""
SELECT customer_id, invoice_no, stock_code, quantity FROM tx""", "tx"))
def p1(spark, d):
    tx = FX.transactions(spark, d)
    return P.drop_columns(P.project(tx, ["customer_id", "invoice_no", "stock_code", "quantity",
                                         "country"]), ["country"])


@register("P2_rename", W("""
SELECT customer_id AS CustomerID, stock_code AS StockCode, invoice_ts AS InvoiceDate FROM tx""", "tx"))
def p2(spark, d):
    tx = FX.transactions(spark, d).select("customer_id", "stock_code", "invoice_ts")
    return P.rename(tx, {"customer_id": "CustomerID", "stock_code": "StockCode",
                         "invoice_ts": "InvoiceDate"})


@register("P3_tag", W("""
SELECT loan_id, m13, 1 AS is_train, 'loan' AS entity_type FROM loans""", "loans"))
def p3(spark, d):
    return P.tag(FX.loans(spark, d).select("loan_id", "m13"), is_train=1, entity_type="loan")


@register("P4_cast_columns", W("""
SELECT TRY_CAST(user_id AS BIGINT) AS user_id, TRY_CAST(item_id AS INTEGER) AS item_id,
       CAST(rating AS VARCHAR) IS NOT NULL AS has_rating
FROM ratings""", "ratings"))
def p4(spark, d):
    r = FX.ratings(spark, d)
    r = P.cast_columns(r, {"user_id": "bigint", "item_id": "int"})
    return r.select("user_id", "item_id", F.col("rating").cast("string").isNotNull().alias("has_rating"))


@register("P5_filter_rows", W("""
SELECT loan_id, m1, m12, source FROM loans
WHERE m12 > 0 OR (m1 > 0 AND source = 'BUILDING')""", "loans"))
def p5(spark, d):
    lo = FX.loans(spark, d).select("loan_id", "m1", "m12", "source")
    return P.filter_rows(lo, (F.col("m12") > 0) | ((F.col("m1") > 0) & (F.col("source") == "BUILDING")))


@register("P7_drop_nulls", W("""
SELECT emp_id, attrition, round(monthly_income, 6) AS monthly_income, business_travel, education
FROM attrition
WHERE monthly_income IS NOT NULL AND business_travel IS NOT NULL AND education IS NOT NULL""",
                             "attrition"))
def p7(spark, d):
    a = FX.attrition(spark, d).select("emp_id", "attrition", "monthly_income", "business_travel",
                                      "education")
    return r6(P.drop_nulls(a))


@register("P8_non_finite_to_null", W("""
SELECT vec_id, round(CASE WHEN isnan(v) OR isinf(v) THEN NULL ELSE v END, 6) AS v
FROM (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN CAST('inf' AS DOUBLE)
                          WHEN vec_id % 11 = 0 THEN CAST('-inf' AS DOUBLE)
                          WHEN vec_id % 13 = 0 THEN CAST('NaN' AS DOUBLE) ELSE x1 END AS v
      FROM binary_pts)""", "binary"))
def p8(spark, d):
    b = FX.binary_points(spark, d)
    v = (F.when(F.col("vec_id") % 7 == 0, F.lit(float("inf")))
         .when(F.col("vec_id") % 11 == 0, F.lit(float("-inf")))
         .when(F.col("vec_id") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("x1")))
    return r6(P.non_finite_to_null(b.select("vec_id", v.alias("v")), ["v"]))


@register("P9_drop_nan", W("""
SELECT user_id, item_id, round(rating, 6) AS rating, round(prediction, 6) AS prediction
FROM ratings WHERE NOT isnan(prediction)""", "ratings"))
def p9(spark, d):
    return r6(P.drop_nan(FX.ratings(spark, d), "prediction"))


_ATTR_COLS = ["emp_id", "attrition", "monthly_income", "num_companies_worked", "business_travel",
              "education", "age", "years_at_company", "account_balance"]


@register("P10_null_profile", W(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, {i} AS position FROM attrition"
    for i, c in enumerate(_ATTR_COLS)), "attrition"))
def p10(spark, d):
    return P.null_profile(FX.attrition(spark, d).select(*_ATTR_COLS))


@register("P10_rows_with_nulls", W("""
SELECT count(*) FILTER (WHERE monthly_income IS NULL OR business_travel IS NULL OR education IS NULL)
       AS rows_with_null, count(*) AS n_rows FROM attrition""", "attrition"))
def p10b(spark, d):
    return P.rows_with_nulls(FX.attrition(spark, d).select(*_ATTR_COLS))


@register("P11_label_outcome", W("""
SELECT loan_id, CASE WHEN a = 1 AND p = 1 THEN 'tp' WHEN a = 0 AND p = 1 THEN 'fp'
                     WHEN a = 0 AND p = 0 THEN 'tn' WHEN a = 1 AND p = 0 THEN 'fn' END AS outcome
FROM (SELECT loan_id, CAST(m13 > 0 AS INTEGER) AS a, CAST(m12 > 0 AS INTEGER) AS p FROM loans)""",
                                 "loans"))
def p11(spark, d):
    lo = FX.loans(spark, d).select("loan_id", (F.col("m13") > 0).cast("int").alias("a"),
                                   (F.col("m12") > 0).cast("int").alias("p"))
    return P.label_outcome(lo, "a", "p").select("loan_id", "outcome")


_RULE_SQL = {
    "m12_or_history": "CAST(m12 > 0 OR greatest(" + ", ".join(M11) + ") > 0 AS INTEGER)",
    "m12_nonzero": "CAST(m12 <> 0 AS INTEGER)",
    "m12_positive": "CAST(m12 > 0 AS INTEGER)",
    "m11_or_m12": "CAST(greatest(m11, m12) > 0 AS INTEGER)",
    "m1_plus_m12": "CAST(m1 + m12 > 0 AS INTEGER)",
    "quiet_m12_heavy_history": "CASE WHEN m12 = 0 AND (" + " + ".join(M11) + ") > 10 THEN 1 ELSE CAST(m12 <> 0 AS INTEGER) END",
}


@register("P12_rule_flags", W("SELECT loan_id, " + ", ".join(
    f"{v} AS {k}" for k, v in _RULE_SQL.items()) + " FROM loans", "loans"))
def p12(spark, d):
    lo = FX.loans(spark, d)
    for name, rule in S.LOAN_RULES.items():
        lo = P.rule_flag(lo, rule(), name)
    return lo.select("loan_id", *S.LOAN_RULES)


@register("P13_row_features", W("SELECT loan_id, " + " + ".join(M11) + " AS total_delinquencies, greatest("
                                + ", ".join(M11) + ") AS max_delinquencies, "
                                + " + ".join(f"CAST({c} <> 0 AS INTEGER)" for c in M11)
                                + " AS delinquency_cnt FROM loans", "loans"))
def p13(spark, d):
    return P.row_features(FX.loans(spark, d), M11).select(
        "loan_id", "total_delinquencies", "max_delinquencies", "delinquency_cnt")


@register("P15_count_where", W("""
SELECT count(*) FILTER (WHERE customer_id <> invoice_no) AS n_matching, count(*) AS n_rows FROM tx""", "tx"))
def p15(spark, d):
    return P.count_where(FX.transactions(spark, d), F.col("customer_id") != F.col("invoice_no"))


@register("P16_preview_head", W("""
SELECT ts, count FROM hourly ORDER BY ts LIMIT 10""", "hourly"))
def p16(spark, d):
    return P.preview(FX.hourly_series(spark, d).select("ts", "count"), 10, ["ts"])


@register("P16_preview_tail", W("""
SELECT ts, count FROM hourly ORDER BY ts DESC LIMIT 5""", "hourly"))
def p16t(spark, d):
    return P.preview(FX.hourly_series(spark, d).select("ts", "count"), 5, ["ts"], tail=True)


@register("P16_shape", W("SELECT count(*) AS n_rows, 22 AS n_cols FROM loans", "loans"))
def p16s(spark, d):
    return P.shape(FX.loans(spark, d))


@register("P17_map_values", W("""
SELECT loan_id, CASE WHEN verdict = 1 THEN 0 WHEN verdict = -1 THEN 1 ELSE verdict END AS verdict
FROM (SELECT loan_id, CASE WHEN m12 > 0 THEN -1 ELSE 1 END AS verdict FROM loans)""", "loans"))
def p17(spark, d):
    lo = FX.loans(spark, d).select("loan_id", F.when(F.col("m12") > 0, -1).otherwise(1).alias("verdict"))
    return P.map_values(lo, "verdict", {1: 0, -1: 1})


# ---------------------------------------------------------------- J1-J8
@register("J1_inner_join", W("""
SELECT t.customer_id, t.lines, c.c_mktsegment
FROM (SELECT customer_id, count(*) AS lines FROM tx GROUP BY 1) t
JOIN customer c ON c.c_custkey = t.customer_id""", "tx"))
def j1(spark, d):
    from tessera.sources.tables import load_table
    from tessera.operators.aggregates import group_size
    t = group_size(FX.transactions(spark, d), ["customer_id"], out="lines")
    c = load_table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"), "c_mktsegment")
    return P.inner_join(t, c, "customer_id")


@register("J2_inner_join_expr", W("""
SELECT i.user_id_no, round(s.rating_sum, 6) AS rating_sum
FROM (SELECT user_id, sum(rating) AS rating_sum FROM ratings GROUP BY 1) s
JOIN (SELECT DISTINCT user_id AS id, CAST(user_id AS BIGINT) AS user_id_no FROM ratings) i
  ON s.user_id = i.id""", "ratings"))
def j2(spark, d):
    r = FX.ratings(spark, d)
    s = r.groupBy("user_id").agg(F.sum("rating").alias("rating_sum"))
    idx = r.select(F.col("user_id").alias("id"), F.col("user_id").cast("bigint").alias("user_id_no")).distinct()
    return r6(P.inner_join_expr(s, idx, s.user_id == idx.id).select("user_id_no", "rating_sum"))


@register("J3_join_aggregates", W("""
SELECT a.user_id, round(a.rating_sum, 6) AS rating_sum, b.n_items
FROM (SELECT user_id, sum(rating) AS rating_sum FROM ratings GROUP BY 1) a
JOIN (SELECT user_id, count(*) AS n_items FROM ratings GROUP BY 1) b USING (user_id)""", "ratings"))
def j3(spark, d):
    r = FX.ratings(spark, d)
    a = r.groupBy("user_id").agg(F.sum("rating").alias("rating_sum"))
    b = r.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_items"))
    return r6(P.join_aggregates(a, b, "user_id"))


@register("J4_semi_join", W("""
SELECT DISTINCT stock_code FROM tx a WHERE customer_id % 2 = 0
  AND EXISTS (SELECT 1 FROM tx b WHERE b.customer_id % 2 = 1 AND b.stock_code = a.stock_code)""", "tx"))
def j4(spark, d):
    tx = FX.transactions(spark, d)
    return P.semi_join(FX.train_part(tx).select("stock_code").distinct(),
                       FX.test_part(tx).select("stock_code"), "stock_code")


@register("J5_anti_join", W("""
SELECT DISTINCT stock_code FROM tx a WHERE customer_id % 2 = 1
  AND NOT EXISTS (SELECT 1 FROM tx b WHERE b.customer_id % 2 = 0 AND b.stock_code = a.stock_code)""", "tx"))
def j5(spark, d):
    tx = FX.transactions(spark, d)
    return P.anti_join(FX.test_part(tx).select("stock_code").distinct(),
                       FX.train_part(tx).select("stock_code"), "stock_code")


@register("J7_attach_columns", W("""
SELECT loan_id, m13, CAST(m12 > 0 AS INTEGER) AS pred FROM loans""", "loans"))
def j7(spark, d):
    lo = FX.loans(spark, d)
    preds = lo.select("loan_id", (F.col("m12") > 0).cast("int").alias("pred"))
    return P.attach_columns(lo.select("loan_id", "m13"), preds, "loan_id")


@register("J8_grid_cross_join", W("""
SELECT CAST(round(-5 + i * 0.1, 10) AS DOUBLE) AS w,
       round(sum(x1 * CAST(round(-5 + i * 0.1, 10) AS DOUBLE)), 6) AS total,
       count(*) AS n
FROM binary_pts, range(101) AS g(i) GROUP BY i""", "binary"))
def j8(spark, d):
    b = FX.binary_points(spark, d).select("x1")
    g = P.grid_cross_join(b, {"w": (-5.0, 5.0, 0.1)})
    return r6(g.groupBy("w").agg(F.sum(F.col("x1") * F.col("w")).alias("total"),
                                 F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- O1-O3, U1-U3
@register("O1_sort_by", W("SELECT ts, count FROM hourly ORDER BY ts", "hourly"))
def o1(spark, d):
    return P.sort_by(FX.hourly_series(spark, d).select("ts", "count"), ["ts"])


@register("O2_top_n", W("""
SELECT customer_id, lines FROM (SELECT customer_id, count(*) AS lines FROM tx GROUP BY 1)
ORDER BY lines DESC, customer_id LIMIT 10""", "tx"))
def o2(spark, d):
    from tessera.operators.aggregates import group_size
    return P.top_n(group_size(FX.transactions(spark, d), ["customer_id"], out="lines"), "lines", 10,
                   tiebreak=["customer_id"])


@register("O3_shuffle_rows", W("SELECT loan_id, m13 FROM loans", "loans"))  # a result set has no order
def o3(spark, d):
    return P.shuffle_rows(FX.loans(spark, d).select("loan_id", "m13"), 7, "loan_id")


@register("U1_union_rows", W("""
SELECT loan_id, m12, m13, 'train' AS part FROM loans WHERE loan_id % 2 = 0
UNION ALL SELECT loan_id, m12, NULL AS m13, 'test' AS part FROM loans WHERE loan_id % 2 = 1""", "loans"))
def u1(spark, d):
    lo = FX.loans(spark, d)
    train = lo.where(F.col("loan_id") % 2 == 0).select("loan_id", "m12", "m13", F.lit("train").alias("part"))
    test = lo.where(F.col("loan_id") % 2 == 1).select("loan_id", "m12", F.lit("test").alias("part"))
    return P.union_rows(train, test).select("loan_id", "m12", "m13", "part")


@register("U2_distinct_rows", W("SELECT DISTINCT customer_id, invoice_ts FROM tx", "tx"))
def u2(spark, d):
    return P.distinct_rows(FX.transactions(spark, d), ["customer_id", "invoice_ts"])


@register("U3_overlap_report", W("""
SELECT count(*) FILTER (WHERE l = 1) AS left_count, count(*) FILTER (WHERE r = 1) AS right_count,
       count(*) FILTER (WHERE l = 1 AND r = 1) AS common,
       count(*) FILTER (WHERE l = 1 AND r = 0) AS only_left,
       count(*) FILTER (WHERE l = 0 AND r = 1) AS only_right
FROM (SELECT stock_code, max(CAST(customer_id % 2 = 0 AS INTEGER)) AS l,
             max(CAST(customer_id % 2 = 1 AS INTEGER)) AS r FROM tx GROUP BY stock_code)""", "tx"))
def u3(spark, d):
    tx = FX.transactions(spark, d)
    return P.overlap_report(FX.train_part(tx), FX.test_part(tx), "stock_code")
