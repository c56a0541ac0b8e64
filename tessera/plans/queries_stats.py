"""Registered queries: chart statistics (A23–A29), windows (W1–W5),
scalar functions (C1–C13) and chi-square tests (M16–M18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.functions import text as T
from tessera.operators import charts as CH
from tessera.operators import stattests as ST
from tessera.operators import windows as WN
from tessera.plans.common import r6
from tessera.plans.fixture_sql import with_fixtures as W
from tessera.plans.registry import register
from tessera.sources import fixtures as FX


def _box_sql(x, src, keys):
    k = ", ".join(keys)
    on = " AND ".join(f"b.{c} = q.{c}" for c in keys)
    return f"""
SELECT {', '.join('b.' + c for c in keys)}, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(q3 - q1, 6) AS iqr,
       round(min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END), 6) AS whisker_low,
       round(max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END), 6) AS whisker_high,
       count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_outliers,
       count(*) AS n
FROM (SELECT {k}, CAST({x} AS DOUBLE) AS x FROM {src}
      WHERE {x} IS NOT NULL AND {' AND '.join(c + ' IS NOT NULL' for c in keys)}) b
JOIN (SELECT {k}, quantile_cont(CAST({x} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({x} AS DOUBLE), 0.5) AS median,
             quantile_cont(CAST({x} AS DOUBLE), 0.75) AS q3 FROM {src}
      WHERE {x} IS NOT NULL AND {' AND '.join(c + ' IS NOT NULL' for c in keys)} GROUP BY {k}) q ON {on}
GROUP BY {', '.join('b.' + c for c in keys)}, q1, median, q3"""


def _kde_sql(x, src, keys, grid, cut=3.0):
    k = ", ".join(keys)
    using = ", ".join(keys)
    notnull = " AND ".join([f"{x} IS NOT NULL"] + [f"{c} IS NOT NULL" for c in keys])
    return f"""
SELECT {', '.join('s.' + c for c in keys)}, CAST(g.i AS INTEGER) AS grid_index,
       round(s.g0 + g.i * s.step, 6) AS x,
       round(sum(v.w * exp(-0.5 * pow((s.g0 + g.i * s.step - v.x) / s.h, 2))) / (s.n * s.h * sqrt(2 * pi())), 6) AS density
FROM (SELECT {k}, CAST({x} AS DOUBLE) AS x, count(*) AS w FROM {src} WHERE {notnull} GROUP BY {k}, CAST({x} AS DOUBLE)) v
JOIN (SELECT {k}, n, h, mn - {cut} * h AS g0, (mx - mn + 2 * {cut} * h) / ({grid} - 1) AS step
      FROM (SELECT {k}, count(*) AS n, min(CAST({x} AS DOUBLE)) AS mn, max(CAST({x} AS DOUBLE)) AS mx,
                   stddev_samp(CAST({x} AS DOUBLE)) * pow(count(*), -0.2) AS h
            FROM {src} WHERE {notnull} GROUP BY {k})) s USING ({using})
CROSS JOIN range({grid}) AS g(i)
GROUP BY {', '.join('s.' + c for c in keys)}, g.i, s.g0, s.step, s.n, s.h"""


@register("A23_box_stats", W(_box_sql("monthly_income", "attrition", ["attrition"]), "attrition"))
def a23(spark, d):
    return r6(CH.box_stats(FX.attrition(spark, d), "monthly_income", ["attrition"]))


@register("A24_kde", W(_kde_sql("age", "attrition", ["attrition"], 50), "attrition"))
def a24(spark, d):
    return r6(CH.kde(FX.attrition(spark, d), "age", ["attrition"], grid=50))


@register("A25_histogram", W("""
SELECT b.bin, round(s.mn + b.bin * s.w, 6) AS lower, round(s.mn + (b.bin + 1) * s.w, 6) AS upper,
       coalesce(c.count, 0) AS count, round(coalesce(c.count, 0) / (s.n * s.w), 6) AS density
FROM (SELECT CAST(i AS INTEGER) AS bin FROM range(20) t(i)) b
CROSS JOIN (SELECT min(monthly_income) AS mn, (max(monthly_income) - min(monthly_income)) / 20 AS w,
                   count(monthly_income) AS n FROM attrition) s
LEFT JOIN (SELECT CAST(least(floor((a.monthly_income - s2.mn) / s2.w), 19) AS INTEGER) AS bin, count(*) AS count
           FROM attrition a, (SELECT min(monthly_income) AS mn,
                                     (max(monthly_income) - min(monthly_income)) / 20 AS w FROM attrition) s2
           WHERE a.monthly_income IS NOT NULL GROUP BY 1) c ON c.bin = b.bin""", "attrition"))
def a25(spark, d):
    return r6(CH.histogram(FX.attrition(spark, d), "monthly_income", 20, density=True))


@register("A26_violin_stats", W(f"""
SELECT k.*, round(bx.q1, 6) AS q1, round(bx.median, 6) AS median, round(bx.q3, 6) AS q3
FROM ({_kde_sql('age', 'attrition', ['business_travel', 'attrition'], 30)}) k
LEFT JOIN ({_box_sql('age', 'attrition', ['business_travel', 'attrition'])}) bx
  ON k.business_travel = bx.business_travel AND k.attrition = bx.attrition""", "attrition"))
def a26(spark, d):
    return r6(CH.violin_stats(FX.attrition(spark, d), "age", "business_travel", "attrition", grid=30))


@register("A27_mosaic_shares", W("""
SELECT business_travel, education, attrition, count(*) AS count,
       round(sum(count(*)) OVER (PARTITION BY business_travel) / sum(count(*)) OVER (), 6) AS share_1,
       round(sum(count(*)) OVER (PARTITION BY business_travel, education)
             / sum(count(*)) OVER (PARTITION BY business_travel), 6) AS share_2,
       round(count(*) / sum(count(*)) OVER (PARTITION BY business_travel, education), 6) AS share_3
FROM attrition WHERE business_travel IS NOT NULL AND education IS NOT NULL AND attrition IS NOT NULL
GROUP BY 1, 2, 3""", "attrition"))
def a27(spark, d):
    return r6(CH.mosaic_shares(FX.attrition(spark, d), ["business_travel", "education", "attrition"]))


@register("A28_binned_scatter", W("""
SELECT cyl, CAST(floor(wt / 100.0) AS BIGINT) AS x_bin, CAST(floor(mpg / 5.0) AS BIGINT) AS y_bin,
       count(*) AS count, round(avg(wt), 6) AS mean_size
FROM parts GROUP BY 1, 2, 3""", "parts"))
def a28(spark, d):
    return r6(CH.binned_scatter(FX.parts(spark, d), "wt", "mpg", 100.0, 5.0, label="cyl", size="wt"))


@register("A29_linear_trend", W("""
SELECT cyl, CAST(regr_count(mpg, wt) AS BIGINT) AS n, round(regr_slope(mpg, wt), 6) AS slope,
       round(regr_intercept(mpg, wt), 6) AS intercept, round(regr_r2(mpg, wt), 6) AS r2,
       round(sqrt((regr_syy(mpg, wt) - regr_slope(mpg, wt) * regr_sxy(mpg, wt))
                  / (regr_count(mpg, wt) - 2) / regr_sxx(mpg, wt)), 6) AS slope_se
FROM parts GROUP BY cyl""", "parts"))
def a29(spark, d):
    return r6(CH.linear_trend(FX.parts(spark, d), "wt", "mpg", ["cyl"]))


# ---------------------------------------------------------------- windows
@register("W1_percent_rank_by", W("""
SELECT user_id, item_id, round(percent_rank() OVER (PARTITION BY user_id ORDER BY prediction DESC), 6) AS percent_rank
FROM ratings WHERE NOT isnan(prediction)""", "ratings"))
def w1(spark, d):
    r = FX.ratings(spark, d).where(~F.isnan("prediction")).select("user_id", "item_id", "prediction")
    return r6(WN.percent_rank_by(r, "user_id", "prediction").select("user_id", "item_id", "percent_rank"))


@register("W2_dense_rank_by", W("""
SELECT user_id, item_id, dense_rank() OVER (PARTITION BY user_id ORDER BY rating DESC) AS dense_rank
FROM ratings""", "ratings"))
def w2(spark, d):
    r = FX.ratings(spark, d).select("user_id", "item_id", "rating")
    return WN.dense_rank_by(r, "user_id", "rating").select("user_id", "item_id", "dense_rank")


_ROLL = """
SELECT ts, {key}count,
  round(CASE WHEN count(count) OVER w = 6 THEN avg(count) OVER w END, 6) AS rolling_mean,
  round(CASE WHEN count(count) OVER w = 6 THEN stddev_samp(count) OVER w END, 6) AS rolling_std
FROM {src} WINDOW w AS ({part}ORDER BY ts ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"""


@register("W3_rolling_stats", W(_ROLL.format(key="", src="hourly", part=""), "hourly"))
def w3(spark, d):
    h = FX.hourly_series(spark, d).select("ts", "count")
    return r6(WN.rolling_stats(h, "ts", "count", 6, block_rows=100))


@register("W3_rolling_stats_by_key", W(_ROLL.format(key="series_id, ", src="hourly_by_type",
                                                   part="PARTITION BY series_id "), "hourly_by_type"))
def w3k(spark, d):
    h = FX.hourly_series(spark, d, by_type=True).select("ts", "series_id", "count")
    return r6(WN.rolling_stats(h, "ts", "count", 6, key="series_id", block_rows=100))


@register("W4_lag_features", W("""
SELECT ts, count, lvl AS level_lag_1, diff, lag(diff, 1) OVER w AS diff_lag_1, lag(diff, 2) OVER w AS diff_lag_2
FROM (SELECT ts, count, lag(count, 1) OVER w0 AS lvl, count - lag(count, 1) OVER w0 AS diff
      FROM hourly WINDOW w0 AS (ORDER BY ts))
WINDOW w AS (ORDER BY ts)""", "hourly"))
def w4(spark, d):
    h = FX.hourly_series(spark, d).select("ts", "count")
    return WN.lag_features(h, "ts", "count", [1, 2], block_rows=100)


@register("W5_top_k_by", W("""
SELECT user_id, item_id, round(rating, 6) AS rating, rank FROM (
  SELECT user_id, item_id, rating,
         row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank FROM ratings)
WHERE rank <= 5""", "ratings"))
def w5(spark, d):
    r = FX.ratings(spark, d).select("user_id", "item_id", "rating")
    return r6(WN.top_k_by(r, "user_id", "rating", 5, tiebreak=["item_id"]))


# ---------------------------------------------------------------- scalars
@register("C1_transforms", W("""
SELECT emp_id, round(CASE WHEN monthly_income > 0 THEN ln(monthly_income) END, 6) AS log_income,
       round(sqrt(monthly_income), 6) AS sqrt_income,
       round(CASE WHEN monthly_income > -1 THEN ln(1 + monthly_income) END, 6) AS log1p_income
FROM attrition""", "attrition"))
def c1(spark, d):
    a = FX.attrition(spark, d)
    return r6(a.select("emp_id", S.log_transform("monthly_income").alias("log_income"),
                       S.sqrt_transform("monthly_income").alias("sqrt_income"),
                       S.log1p_transform("monthly_income").alias("log1p_income")))


@register("C2_skew_report", W("""
SELECT transform, round(avg(pow(v - m, 3)) / pow(avg(pow(v - m, 2)), 1.5), 6) AS skewness, count(v) AS n
FROM (SELECT transform, v, avg(v) OVER (PARTITION BY transform) AS m FROM (
  SELECT 'raw' AS transform, monthly_income AS v FROM attrition
  UNION ALL SELECT 'log', CASE WHEN monthly_income > 0 THEN ln(monthly_income) END FROM attrition
  UNION ALL SELECT 'sqrt', sqrt(monthly_income) FROM attrition
  UNION ALL SELECT 'log1p', CASE WHEN monthly_income > -1 THEN ln(1 + monthly_income) END FROM attrition)
  WHERE v IS NOT NULL)
GROUP BY transform""", "attrition"))
def c2(spark, d):
    return r6(ST.skew_report(FX.attrition(spark, d), "monthly_income"))


@register("C3_sigmoid_cross_entropy", W("""
SELECT vec_id, round(p, 6) AS p, round(-(y * ln(p)) - (1 - y) * ln(1 - p), 6) AS loss
FROM (SELECT vec_id, y, 1 / (1 + exp(-(x1 * 1.0 - 0.5 * x2))) AS p FROM binary_pts)""", "binary"))
def c3(spark, d):
    b = FX.binary_points(spark, d)
    p = S.sigmoid(F.col("x1") * 1.0 - 0.5 * F.col("x2"))
    return r6(b.select("vec_id", "y", p.alias("p")).select(
        "vec_id", "p", S.cross_entropy(F.col("y").cast("double"), F.col("p")).alias("loss")))


@register("C4_squared_norm", W("""
SELECT vec_id, round(list_sum(list_transform(features, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 6) AS sq_norm,
       round(x1 * x1 + x2 * x2 + x3 * x3 + x4 * x4, 6) AS sq_norm_4
FROM points JOIN binary_pts USING (vec_id)""", "points", "binary"))
def c4(spark, d):
    p = FX.points(spark, d)
    b = FX.binary_points(spark, d)
    return r6(p.join(b, "vec_id").select("vec_id", S.array_squared_norm("features").alias("sq_norm"),
                                         S.squared_norm(["x1", "x2", "x3", "x4"]).alias("sq_norm_4")))


@register("C5_binomial_by_group", W("""
SELECT lang, n, k, round(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(p) + (n - k) * ln(1 - p)), 6) AS pmf
FROM (SELECT d.lang, count(*) AS n, count(*) FILTER (WHERE m.v1 = 'spam') AS k
      FROM messages m JOIN documents d USING (doc_id) GROUP BY d.lang),
     (SELECT avg(CAST(v1 = 'spam' AS DOUBLE)) AS p FROM messages)""", "messages"))
def c5(spark, d):
    from tessera.sources.tables import load_table
    m = FX.messages(spark, d)
    docs = load_table(spark, d, "documents").select("doc_id", "lang")
    rate = m.select(F.avg((F.col("v1") == "spam").cast("double"))).scalar()
    g = m.join(docs, "doc_id").groupBy("lang").agg(F.count(F.lit(1)).alias("n"),
                                                   F.count_if(F.col("v1") == "spam").alias("k"))
    return r6(g.withColumn("pmf", S.binomial_pmf(F.col("n"), F.col("k"), rate)))


@register("C6_parse_timestamp", W("""
SELECT ts, strptime(datetime_text, '%d-%m-%Y %H:%M') AS parsed FROM hourly""", "hourly"))
def c6(spark, d):
    h = FX.hourly_series(spark, d)
    return h.select("ts", S.parse_timestamp("datetime_text", "dd-MM-yyyy HH:mm")
                    .cast("timestamp_ntz").alias("parsed"))


@register("C7_date_gap", W("""
SELECT loan_id, CAST(date_diff('day', CAST(origination_date AS DATE), CAST(first_payment_date AS DATE)) AS INTEGER) AS gap_days,
  round((year(first_payment_date) - year(origination_date)) * 12 + month(first_payment_date) - month(origination_date)
   + CASE WHEN day(first_payment_date) = day(origination_date)
               OR (day(first_payment_date) = day(last_day(first_payment_date))
                   AND day(origination_date) = day(last_day(origination_date))) THEN 0
          ELSE (day(first_payment_date) - day(origination_date)) / 31.0 END, 8) AS gap_months
FROM loans""", "loans"))
def c7(spark, d):
    lo = FX.loans(spark, d)
    return lo.select("loan_id", S.date_gap_days("origination_date", "first_payment_date").alias("gap_days"),
                     S.date_gap_months("origination_date", "first_payment_date").alias("gap_months"))


@register("C8_word_count", W("""
SELECT doc_id, CAST(len(string_split(review, ' ')) AS INTEGER) AS n_words FROM reviews""", "reviews"))
def c8(spark, d):
    r = FX.reviews(spark, d)
    return r.select("doc_id", T.word_count("review").alias("n_words"))


@register("C9_tokenize", W("""
SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, array_to_string(tokens, ' ') AS tokens_text FROM review_tokens""",
                           "review_tokens"))
def c9(spark, d):
    r = FX.reviews(spark, d).select("doc_id", T.tokenize("review").alias("t"))
    return r.select("doc_id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens_text"))


@register("C11_array_to_string", W("""
SELECT customer_id, '[' || array_to_string(list_sort(list(DISTINCT stock_code)), ',') || ']' AS items
FROM tx GROUP BY 1""", "tx"))
def c11(spark, d):
    from tessera.operators.aggregates import group_collect
    g = group_collect(FX.transactions(spark, d), "customer_id", "stock_code")
    return g.select("customer_id", S.array_to_string("items").alias("items"))


@register("C12_explode_pairs", W("""
SELECT user_id, item_id, round(rating, 6) AS rating FROM (
  SELECT user_id, item_id, rating,
         row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rn FROM ratings)
WHERE rn <= 3""", "ratings"))
def c12(spark, d):
    r = FX.ratings(spark, d).select("user_id", "item_id", "rating")
    top = WN.top_k_by(r, "user_id", "rating", 3, tiebreak=["item_id"])
    nested = top.groupBy("user_id").agg(
        F.collect_list(F.struct("item_id", "rating")).alias("recommendations"))
    return r6(explode_pairs(nested, "user_id", "recommendations"))


def explode_pairs(df, key, col):
    """Array of (id, score) structs to one row per pair with the fields
    split out (C12), with built-ins instead of Python field getters."""
    return df.select(key, F.inline(col))


_POSITIONS = ", ".join(f"round(CAST(features[{i + 1}] AS DOUBLE), 6) AS f{i}" for i in range(64))


@register("C13_array_to_columns", W(f"SELECT vec_id, {_POSITIONS} FROM points", "points"))
def c13(spark, d):
    return r6(array_to_columns(FX.points(spark, d).select("vec_id", "features"), "features", 64, "f"))


def array_to_columns(df, col, size, prefix):
    """One double column per position of an array column (C13); positions
    beyond a shorter array are NULL."""
    return df.select(*[c for c in df.columns if c != col],
                     *[F.get(col, i).cast("double").alias(f"{prefix}{i}") for i in range(size)])


# ---------------------------------------------------------------- chi-square
# statistic and dof over all cells, absent pairs included
_CHI2_SQL = """SELECT sum(pow(abs(o - e) - CASE WHEN dof = 1 THEN least(0.5, abs(o - e)) ELSE 0 END, 2) / e) AS statistic,
       max(dof) AS dof
FROM (SELECT a.education, b.attrition, coalesce(c.o, 0) AS o, ra.m * cb.m / n.n AS e,
             (nra.k - 1) * (ncb.k - 1) AS dof
      FROM (SELECT DISTINCT education FROM attrition WHERE education IS NOT NULL AND attrition IS NOT NULL) a
      CROSS JOIN (SELECT DISTINCT attrition FROM attrition WHERE education IS NOT NULL AND attrition IS NOT NULL) b
      LEFT JOIN (SELECT education, attrition, count(*) AS o FROM attrition
                 WHERE education IS NOT NULL AND attrition IS NOT NULL GROUP BY 1, 2) c
        ON c.education = a.education AND c.attrition = b.attrition
      JOIN (SELECT education, count(*) AS m FROM attrition WHERE education IS NOT NULL AND attrition IS NOT NULL GROUP BY 1) ra
        ON ra.education = a.education
      JOIN (SELECT attrition, count(*) AS m FROM attrition WHERE education IS NOT NULL AND attrition IS NOT NULL GROUP BY 1) cb
        ON cb.attrition = b.attrition,
      (SELECT count(*) AS n FROM attrition WHERE education IS NOT NULL AND attrition IS NOT NULL) n,
      (SELECT count(DISTINCT education) AS k FROM attrition WHERE education IS NOT NULL AND attrition IS NOT NULL) nra,
      (SELECT count(DISTINCT attrition) AS k FROM attrition WHERE education IS NOT NULL AND attrition IS NOT NULL) ncb)"""


@register("M16_chi2_contingency", W(f"SELECT round(statistic, 6) AS statistic, dof FROM ({_CHI2_SQL})", "attrition"))
def m16(spark, d):
    return r6(ST.chi2_contingency(FX.attrition(spark, d), "education", "attrition")
              .select("statistic", "dof"))


# five education levels: dof 4, whose tail has a closed form
@register("M16_chi2_contingency_p", W(f"""
SELECT round(statistic, 6) AS statistic, dof,
       round(CASE WHEN dof = 4 THEN exp(-statistic / 2) * (1 + statistic / 2) END, 6) AS p_value
FROM ({_CHI2_SQL})""", "attrition"))
def m16p(spark, d):
    return r6(ST.chi2_contingency(FX.attrition(spark, d), "education", "attrition"))


_CHI_FEATS = ["num_companies_worked", "age", "years_at_company"]


@register("M16_expected_counts", W("""
SELECT r.education, c.attrition, count(a.education) AS observed, round(any_value(r.n) * any_value(c.n) / any_value(t.n), 6) AS expected
FROM (SELECT education, CAST(count(*) AS DOUBLE) AS n FROM attrition WHERE attrition IS NOT NULL AND education IS NOT NULL GROUP BY 1) r
CROSS JOIN (SELECT attrition, CAST(count(*) AS DOUBLE) AS n FROM attrition WHERE attrition IS NOT NULL AND education IS NOT NULL GROUP BY 1) c
CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) AS n FROM attrition WHERE attrition IS NOT NULL AND education IS NOT NULL) t
LEFT JOIN attrition a ON a.education = r.education AND a.attrition = c.attrition
GROUP BY r.education, c.attrition""", "attrition"))
def m16e(spark, d):
    return r6(ST.chi2_expected(FX.attrition(spark, d), "education", "attrition"))


@register("M17_chi2_feature_scores", W("""
SELECT feature, round(sum(pow(o - e, 2) / e), 6) AS chi2, max(k) - 1 AS dof
FROM (SELECT feature, y, o, ny * 1.0 / n * sum(o) OVER (PARTITION BY feature) AS e, k, n
      FROM (SELECT feature, y, sum(x) AS o, count(*) AS ny FROM (""" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, attrition AS y, CAST({f} AS DOUBLE) AS x FROM attrition" for f in _CHI_FEATS) + """)
            GROUP BY feature, y),
           (SELECT count(*) AS n, count(DISTINCT attrition) AS k FROM attrition))
GROUP BY feature""", "attrition"))
def m17(spark, d):
    return r6(ST.chi2_feature_scores(FX.attrition(spark, d), _CHI_FEATS, "attrition")
              .select("feature", "chi2", "dof"))


# 6.6348966: the point that a chi-square variable with dof 1 exceeds with probability 0.01
@register("M18_select_features", W("""
SELECT feature, round(sum(pow(o - e, 2) / e), 6) AS chi2, max(k) - 1 AS dof, sum(pow(o - e, 2) / e) > 6.6348966010212145 AS selected
FROM (SELECT feature, y, o, ny * 1.0 / n * sum(o) OVER (PARTITION BY feature) AS e, k, n
      FROM (SELECT feature, y, sum(x) AS o, count(*) AS ny FROM (""" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, attrition AS y, CAST({f} AS DOUBLE) AS x FROM attrition" for f in _CHI_FEATS) + """)
            GROUP BY feature, y),
           (SELECT count(*) AS n, count(DISTINCT attrition) AS k FROM attrition))
GROUP BY feature""", "attrition"))
def m18(spark, d):
    s = ST.chi2_feature_scores(FX.attrition(spark, d), _CHI_FEATS, "attrition")
    return r6(ST.select_features(s, 0.01).drop("p_value"))
