"""Registered queries: aggregations (A1–A22) and the model-free composites
(Q2, Q3, Q5, Q6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import aggregates as A
from tessera.plans import reports as R
from tessera.plans.common import r6
from tessera.plans.fixture_sql import with_fixtures as W
from tessera.plans.registry import register
from tessera.sources import fixtures as FX

PROBS = A.PROFILE_PROBS
_P_SQL = ", ".join(str(p) for p in PROBS)


def labelled_loans(spark, d):
    lo = FX.loans(spark, d)
    return lo.withColumn("delinquent", (F.col("m13") > 0).cast("int"))


LL = "(SELECT *, CAST(m13 > 0 AS INTEGER) AS delinquent FROM loans)"


@register("A1_value_counts", W(f"""
SELECT source, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM loans GROUP BY source""", "loans"))
def a1(spark, d):
    return r6(A.value_counts(FX.loans(spark, d), "source"))


@register("A2_count_by", W("""
SELECT business_travel, attrition, count(*) AS count FROM attrition
WHERE business_travel IS NOT NULL AND attrition IS NOT NULL GROUP BY 1, 2""", "attrition"))
def a2(spark, d):
    return A.count_by(FX.attrition(spark, d), "business_travel", "attrition")


@register("A3_crosstab", W(f"""
SELECT source, delinquent, count(*) AS count FROM {LL} GROUP BY 1, 2""", "loans"))
def a3(spark, d):
    return A.crosstab(labelled_loans(spark, d), "source", "delinquent")


@register("A3_crosstab_wide", W(f"""
SELECT financial_institution, count(*) FILTER (WHERE delinquent = 0) AS "0",
       count(*) FILTER (WHERE delinquent = 1) AS "1"
FROM {LL} GROUP BY 1""", "loans"))
def a3w(spark, d):
    return A.crosstab_wide(labelled_loans(spark, d), "financial_institution", "delinquent", [0, 1])


@register("A4_crosstab_index", W("""
SELECT education, attrition, count(*) AS count,
       round(count(*) / sum(count(*)) OVER (PARTITION BY education), 6) AS share
FROM attrition WHERE education IS NOT NULL GROUP BY 1, 2""", "attrition"))
def a4(spark, d):
    return r6(A.crosstab(FX.attrition(spark, d), "education", "attrition", normalize="index"))


@register("A5_crosstab_columns", W(f"""
SELECT source, delinquent, count(*) AS count,
       round(count(*) / sum(count(*)) OVER (PARTITION BY delinquent), 6) AS share
FROM {LL} GROUP BY 1, 2""", "loans"))
def a5(spark, d):
    return r6(A.crosstab(labelled_loans(spark, d), "source", "delinquent", normalize="columns"))


@register("A6_crosstab_mean", W(f"""
SELECT source, delinquent, round(avg(unpaid_principal_bal), 6) AS mean FROM {LL} GROUP BY 1, 2""", "loans"))
def a6(spark, d):
    return r6(A.crosstab(labelled_loans(spark, d), "source", "delinquent",
                         values="unpaid_principal_bal", aggfunc="mean"))


def _describe_sql(cols, from_sql, keys=""):
    k = (keys + ", ") if keys else ""
    g = f"GROUP BY {keys}" if keys else ""
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT {k}'{c}' AS column_name, count({x}) AS count, round(avg({x}), 6) AS mean,
  round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, round(max({x}), 6) AS max,
  round(quantile_cont({x}, 0.25), 6) AS p25, round(quantile_cont({x}, 0.5), 6) AS p50,
  round(quantile_cont({x}, 0.75), 6) AS p75 FROM {from_sql} {g}""")
    return " UNION ALL ".join(parts)


_BIN = ["x1", "x2", "x3", "x4"]


@register("A7_describe_numeric", W(_describe_sql(_BIN, "binary_pts"), "binary"))
def a7(spark, d):
    return r6(A.describe_numeric(FX.binary_points(spark, d), _BIN))


@register("A8_describe_categorical", W("""
SELECT column_name, CAST(sum(freq) AS BIGINT) AS count, count(*) AS unique,
       arg_min(value, (-freq, value)) AS top, max(freq) AS freq
FROM (SELECT column_name, value, count(*) AS freq
      FROM (SELECT 'country' AS column_name, country AS value FROM tx
            UNION ALL SELECT 'stock_code', CAST(stock_code AS VARCHAR) FROM tx)
      GROUP BY 1, 2) GROUP BY column_name""", "tx"))
def a8(spark, d):
    return A.describe_categorical(FX.transactions(spark, d), ["country", "stock_code"])


@register("A9_describe_timestamp", W("""
SELECT CAST(sum(freq) AS BIGINT) AS count, count(*) AS unique, min(invoice_ts) AS first, max(invoice_ts) AS last,
       arg_min(invoice_ts, (-freq, invoice_ts)) AS top, max(freq) AS freq
FROM (SELECT invoice_ts, count(*) AS freq FROM tx GROUP BY 1)""", "tx"))
def a9(spark, d):
    return A.describe_timestamp(FX.transactions(spark, d), "invoice_ts")


_LCOLS = ["unpaid_principal_bal", "loan_to_value", "m12"]


@register("A10_describe_by", W(_describe_sql(_LCOLS, LL, "delinquent"), "loans"))
def a10(spark, d):
    return r6(A.describe_by(labelled_loans(spark, d), "delinquent", _LCOLS))


@register("A10_compare_sources", W(_describe_sql(
    ["m12", "unpaid_principal_bal"],
    "(SELECT *, CASE WHEN loan_id % 2 = 0 THEN 'train' ELSE 'test' END AS source_name FROM loans)",
    "source_name"), "loans"))
def a10c(spark, d):
    lo = FX.loans(spark, d)
    return r6(A.compare_sources({"train": lo.where(F.col("loan_id") % 2 == 0),
                                 "test": lo.where(F.col("loan_id") % 2 == 1)},
                                ["m12", "unpaid_principal_bal"]))


@register("A11_group_size", W("""
SELECT customer_id, invoice_no, count(*) AS size FROM tx GROUP BY 1, 2""", "tx"))
def a11(spark, d):
    return A.group_size(FX.transactions(spark, d), ["customer_id", "invoice_no"])


@register("A12_group_agg", W("""
SELECT stock_code, round(avg(quantity), 6) AS mean_quantity, max(quantity) AS max_quantity
FROM tx GROUP BY 1""", "tx"))
def a12(spark, d):
    return r6(A.group_agg(FX.transactions(spark, d), ["stock_code"], {"quantity": ["mean", "max"]}))


@register("A13_visits_per_customer", W("""
SELECT customer_id, count(*) AS visits FROM (SELECT DISTINCT customer_id, invoice_ts FROM tx) GROUP BY 1""", "tx"))
def a13(spark, d):
    return A.visits_per_customer(FX.transactions(spark, d), "customer_id", "invoice_ts")


@register("A14_group_collect", W("""
SELECT customer_id, array_to_string(list_sort(list(DISTINCT stock_code)), ' ') AS items
FROM tx GROUP BY 1""", "tx"))
def a14(spark, d):
    return A.group_collect(FX.transactions(spark, d), "customer_id", "stock_code", as_text=True)


@register("A14_group_collect_chunks", W("""
SELECT customer_id, (r - 1) // 20 AS chunk, min(r) - 1 AS before, any_value(n) AS total, string_agg(CAST(stock_code AS VARCHAR), ' ' ORDER BY r) AS items
FROM (SELECT customer_id, stock_code, row_number() OVER (PARTITION BY customer_id ORDER BY stock_code) AS r,
             count(*) OVER (PARTITION BY customer_id) AS n FROM (SELECT DISTINCT customer_id, stock_code FROM tx))
GROUP BY 1, 2""", "tx"))
def a14c(spark, d):
    return A.group_collect_chunks(FX.transactions(spark, d), "customer_id", "stock_code", size=20, as_text=True)


@register("A15_filter_min_activity", W("""
SELECT user_id, item_id FROM ratings
WHERE user_id IN (SELECT user_id FROM ratings GROUP BY 1 HAVING count(rating) > 40)""", "ratings"))
def a15(spark, d):
    return A.filter_min_activity(FX.ratings(spark, d), "user_id", "rating", 40).select("user_id", "item_id")


@register("A16_group_sum", W("""
SELECT user_id, round(sum(rating), 6) AS rating_sum FROM ratings GROUP BY 1""", "ratings"))
def a16(spark, d):
    return r6(A.group_sum(FX.ratings(spark, d), "user_id", "rating", out="rating_sum"))


@register("A16_global_avg_of_ratio", W("""
SELECT round(avg(rating_sum / n_items), 6) AS avg_ratio
FROM (SELECT user_id, sum(rating) AS rating_sum, count(*) AS n_items FROM ratings GROUP BY 1)""", "ratings"))
def a16b(spark, d):
    r = FX.ratings(spark, d).groupBy("user_id").agg(F.sum("rating").alias("rating_sum"),
                                                    F.count(F.lit(1)).alias("n_items"))
    return r6(A.global_avg_of_ratio(r, "rating_sum", "n_items"))


@register("A17_percentiles", W(f"""
SELECT unnest(ps) AS prob, round(unnest(qs), 6) AS value
FROM (SELECT [{_P_SQL}]::DOUBLE[] AS ps, quantile_cont(visits, [{_P_SQL}]) AS qs
      FROM (SELECT customer_id, count(*) AS visits
            FROM (SELECT DISTINCT customer_id, invoice_ts FROM tx) GROUP BY 1))""", "tx"))
def a17(spark, d):
    v = A.visits_per_customer(FX.transactions(spark, d), "customer_id", "invoice_ts")
    return r6(A.percentiles(v, "visits"))


@register("A18_percentiles_by", W(f"""
SELECT attrition, unnest(ps) AS prob, round(unnest(qs), 6) AS value
FROM (SELECT attrition, [{_P_SQL}]::DOUBLE[] AS ps, quantile_cont(monthly_income, [{_P_SQL}]) AS qs
      FROM attrition WHERE monthly_income IS NOT NULL GROUP BY attrition)""", "attrition"))
def a18(spark, d):
    return r6(A.percentiles_by(FX.attrition(spark, d), "monthly_income", "attrition"))


@register("A19_count_distinct", W("""
SELECT count(DISTINCT customer_id) AS distinct_customer_id, count(DISTINCT country) AS distinct_country,
       count(DISTINCT stock_code) AS distinct_stock_code FROM tx""", "tx"))
def a19(spark, d):
    return A.count_distinct(FX.transactions(spark, d), ["customer_id", "country", "stock_code"])


@register("A20_moments", W("""
SELECT count(n) AS n, round(avg(n), 6) AS mean, round(var_pop(n), 6) AS var_pop,
       round(stddev_pop(n), 6) AS std_pop
FROM (SELECT len(string_split(review, ' ')) AS n FROM reviews)""", "reviews"))
def a20(spark, d):
    from tessera.functions.text import word_count
    r = FX.reviews(spark, d).select(word_count("review").alias("n"))
    return r6(A.moments(r, "n"))


@register("A21_argmin_rows", W("""
SELECT vec_id, round(x1, 6) AS x1 FROM binary_pts WHERE x1 = (SELECT min(x1) FROM binary_pts)""", "binary"))
def a21(spark, d):
    return r6(A.argmin_rows(FX.binary_points(spark, d).select("vec_id", "x1"), "x1"))


@register("A22_class_balance", W(f"""
SELECT count(*) FILTER (WHERE delinquent = 1) AS positives, count(*) FILTER (WHERE delinquent = 0) AS negatives,
       round(count(*) FILTER (WHERE delinquent = 1) / count(*), 6) AS positive_share,
       round(count(*) FILTER (WHERE delinquent = 0) / count(*) FILTER (WHERE delinquent = 1), 6) AS class_weight
FROM {LL}""", "loans"))
def a22(spark, d):
    return r6(A.class_balance(labelled_loans(spark, d), "delinquent"))


# ---------------------------------------------------------------- composites
@register("Q2_basket_profile", W(f"""
SELECT set, measure, unnest(ps) AS prob, round(unnest(qs), 6) AS value
FROM (SELECT set, measure, [{_P_SQL}]::DOUBLE[] AS ps, quantile_cont(value, [{_P_SQL}]) AS qs
FROM (SELECT CASE WHEN customer_id % 2 = 0 THEN 'train' ELSE 'test' END AS set, 'visits' AS measure,
             count(*) AS value
      FROM (SELECT DISTINCT customer_id, invoice_ts FROM tx) GROUP BY customer_id
      UNION ALL
      SELECT CASE WHEN customer_id % 2 = 0 THEN 'train' ELSE 'test' END, 'basket_size', count(*)
      FROM tx GROUP BY customer_id, invoice_no)
GROUP BY set, measure)""", "tx"))
def q2(spark, d):
    tx = FX.transactions(spark, d)
    return r6(R.basket_profile(FX.train_part(tx), FX.test_part(tx)))


@register("Q3_history_recommendation", W("""
SELECT customer_id, array_to_string(list_sort(list(DISTINCT stock_code)), ' ') AS items
FROM tx WHERE customer_id % 2 = 1 GROUP BY 1""", "tx"))
def q3(spark, d):
    return R.history_recommendation(FX.test_part(FX.transactions(spark, d)))


@register("Q3_history_chunks", W("""
SELECT customer_id, (r - 1) // 50 AS chunk, string_agg(CAST(stock_code AS VARCHAR), ' ' ORDER BY r) AS items
FROM (SELECT customer_id, stock_code, row_number() OVER (PARTITION BY customer_id ORDER BY stock_code) AS r
      FROM (SELECT DISTINCT customer_id, stock_code FROM tx WHERE customer_id % 2 = 1))
GROUP BY 1, 2""", "tx"))
def q3c(spark, d):
    return R.history_chunks(FX.test_part(FX.transactions(spark, d)), size=50)


def _q5_sql():
    from tessera.plans.queries_core import _RULE_SQL
    sel = " UNION ALL ".join(
        f"SELECT '{k}' AS rule, CAST(m13 > 0 AS INTEGER) AS actual, {v} AS pred FROM loans"
        for k, v in _RULE_SQL.items())
    return W(f"""
SELECT rule, tp, fp, tn, fn, round(tp / nullif(tp + fp, 0), 6) AS precision,
       round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1
FROM (SELECT rule, count(*) FILTER (WHERE actual = 1 AND pred = 1) AS tp,
             count(*) FILTER (WHERE actual = 0 AND pred = 1) AS fp,
             count(*) FILTER (WHERE actual = 0 AND pred = 0) AS tn,
             count(*) FILTER (WHERE actual = 1 AND pred = 0) AS fn
      FROM ({sel}) GROUP BY rule)""", "loans")


@register("Q5_rule_leaderboard", _q5_sql())
def q5(spark, d):
    return r6(R.rule_leaderboard(FX.loans(spark, d)))


_Q6_COLS = ["source", "financial_institution", "loan_purpose", "insurance_type"]


@register("Q6_categorical_risk_report", W("""
SELECT column_name, value, part, count(*) AS count,
       round(count(*) / sum(count(*)) OVER (PARTITION BY column_name, part), 6) AS share,
       round(count(*) FILTER (WHERE y > 0) / nullif(count(y), 0), 6) AS positive_share
FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, CASE WHEN loan_id % 2 = 0 THEN 'train' ELSE 'test' END AS part, "
    f"CASE WHEN loan_id % 2 = 0 THEN m13 END AS y FROM loans WHERE {c} IS NOT NULL" for c in _Q6_COLS)
    + ") GROUP BY column_name, value, part", "loans"))
def q6(spark, d):
    lo = FX.loans(spark, d)
    is_train = F.col("loan_id") % 2 == 0
    frame = lo.select(*_Q6_COLS, F.when(is_train, "train").otherwise("test").alias("part"),
                      F.when(is_train, F.col("m13")).alias("m13"))
    return r6(R.categorical_risk_report(frame, _Q6_COLS, "m13"))


@register("P14_columns_of_type", W("""
SELECT column_name, CAST(sum(freq) AS BIGINT) AS count, count(*) AS unique,
       arg_min(value, (-freq, value)) AS top, max(freq) AS freq
FROM (SELECT column_name, value, count(*) AS freq FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value FROM loans"
    for c in ["source", "financial_institution", "loan_purpose", "insurance_type"]) + """)
      WHERE value IS NOT NULL GROUP BY 1, 2) GROUP BY column_name""", "loans"))
def p14(spark, d):
    from tessera.operators.relational import columns_of_type
    lo = FX.loans(spark, d)
    return A.describe_categorical(lo, columns_of_type(lo, "string"))
