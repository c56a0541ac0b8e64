"""Registered queries: feature preparation and sampling (M1–M10), Q4."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.plans import reports as R
from tessera.plans.common import r6
from tessera.plans.fixture_sql import with_fixtures as W
from tessera.plans.registry import register
from tessera.sources import fixtures as FX

# The market segments, region and nation names and order
# priorities of the driver's tables (used to fix the one-hot schema).
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
NATIONS = [f"NATION_{k}" for k in range(25)]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
LANGS = ["de", "en", "es", "fr"]


def _onehot_sql(col, values):
    return ", ".join(f"coalesce(CAST({col} = '{v}' AS INTEGER), 0) AS \"{col}_{v}\"" for v in values[1:])


@register("M1_one_hot_wide", W(f"""
SELECT loan_id, {_onehot_sql('source', SEGMENTS)}, {_onehot_sql('insurance_type', REGIONS)} FROM loans""", "loans"))
def m1(spark, d):
    lo = FX.loans(spark, d).select("loan_id", "source", "insurance_type")
    return FE.one_hot_wide(lo, ["source", "insurance_type"],
                           {"source": SEGMENTS, "insurance_type": REGIONS})


@register("M1_one_hot_discovered", W(f"""
SELECT loan_id, {_onehot_sql('source', SEGMENTS)} FROM loans""", "loans"))
def m1b(spark, d):
    lo = FX.loans(spark, d).select("loan_id", "source")
    return FE.one_hot_wide(lo, ["source"])


@register("M2_label_encode", W("""
SELECT doc_id, v1, dense_rank() OVER (ORDER BY v1) - 1 AS v1_code FROM messages""", "messages"))
def m2(spark, d):
    return FE.label_encode(FX.messages(spark, d).select("doc_id", "v1"), "v1")


@register("M3_label_binarize", W("""
SELECT doc_id, array_to_string([CAST(label = 'de' AS INTEGER), CAST(label = 'en' AS INTEGER),
                                CAST(label = 'es' AS INTEGER), CAST(label = 'fr' AS INTEGER)], ' ') AS onehot,
       label AS decoded FROM reviews""", "reviews"))
def m3(spark, d):
    r = FE.label_binarize(FX.reviews(spark, d).select("doc_id", "label"), "label", LANGS)
    r = FE.label_inverse(r, "onehot", LANGS, out="decoded")
    return r.select("doc_id", F.array_join("onehot", " ").alias("onehot"), "decoded")


@register("M4_id_index", W("""
SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS INTEGER) AS user_id_index
FROM (SELECT DISTINCT user_id FROM ratings)""", "ratings"))
def m4(spark, d):
    index, _ = FE.id_index(FX.ratings(spark, d), "user_id")
    return index


_STD_COLS = ["unpaid_principal_bal", "m12"]


@register("M5_standardize", W("""
SELECT loan_id, loan_id % 2 = 0 AS is_train,
       round((unpaid_principal_bal - mu1) / s1, 6) AS unpaid_principal_bal_z, round((m12 - mu2) / s2, 6) AS m12_z
FROM loans, (SELECT avg(unpaid_principal_bal) AS mu1, stddev_pop(unpaid_principal_bal) AS s1,
                    avg(m12) AS mu2, stddev_pop(m12) AS s2 FROM loans WHERE loan_id % 2 = 0)""", "loans"))
def m5(spark, d):
    lo = FX.loans(spark, d).select("loan_id", *_STD_COLS)
    train, test = FE.standardize(lo.where(F.col("loan_id") % 2 == 0), [lo.where(F.col("loan_id") % 2 == 1)],
                                 _STD_COLS, suffix="_z")
    both = train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))
    return r6(both.select("loan_id", "is_train", "unpaid_principal_bal_z", "m12_z"))


# Seeded hashes have no SQL form: these return what a right sample must satisfy.
@register("M6_random_split", W("""
SELECT CAST(unnest(range(3)) AS INTEGER) AS split_part, (SELECT count(*) FROM ratings) AS n_rows, true AS near_share""", "ratings"))
def m6(spark, d):
    """Parts of 60, 20 and 20 %: rows of all parts, each part's size within
    five standard deviations of its share."""
    r = FX.ratings(spark, d).withColumn("row_key", F.concat_ws(":", "user_id", "item_id"))
    parts = FE.random_split(r, [0.6, 0.2, 0.2], 42, "row_key").groupBy("split_part").agg(F.count("*").alias("k"))
    n = parts.select(F.sum("k")).scalar()
    share = F.when(F.col("split_part") == 0, 0.6).otherwise(0.2)
    return parts.select("split_part", n.alias("n_rows"),
                        (F.abs(F.col("k") - n * share) <= 5 * F.sqrt(n * share * (1 - share))).alias("near_share"))


@register("M7_stratified_split", W("""
SELECT delinquent, is_train, count FROM (
  SELECT delinquent, unnest([true, false]) AS is_train, unnest([CAST(round(0.75 * n) AS BIGINT), n - CAST(round(0.75 * n) AS BIGINT)]) AS count
  FROM (SELECT CAST(m13 > 0 AS INTEGER) AS delinquent, count(*) AS n FROM loans GROUP BY 1)) WHERE count > 0""", "loans"))
def m7(spark, d):
    lo = FX.loans(spark, d).withColumn("delinquent", (F.col("m13") > 0).cast("int"))
    s = FE.stratified_split(lo, "delinquent", 0.75, 42, "loan_id")
    return s.groupBy("delinquent", "is_train").count()


@register("M8_undersample", W("""
SELECT delinquent, n AS n_rows, n AS n_loans FROM (
  SELECT 1 AS delinquent, count(*) FILTER (m13 > 0) AS n FROM loans
  UNION ALL SELECT 0, least(10 * count(*) FILTER (m13 > 0), count(*) FILTER (m13 = 0)) FROM loans) WHERE n > 0""", "loans"))
def m8(spark, d):
    lo = FX.loans(spark, d).withColumn("delinquent", (F.col("m13") > 0).cast("int"))
    s = FE.undersample(lo, "delinquent", 10.0, 42, "loan_id")
    return s.groupBy("delinquent").agg(F.count("*").alias("n_rows"), F.count_distinct("loan_id").alias("n_loans"))


@register("M9_sample_rows", "SELECT replaced, 100 AS n_rows, 100 AS n_known FROM (VALUES (true), (false)) t(replaced)")
def m9(spark, d):
    """100 draws with and without replacement, each of them a row of the table."""
    b = FX.binary_points(spark, d).select("vec_id", "x1")
    out = None
    for replaced in (True, False):
        s = FE.sample_rows(b, 100, replaced, 42, "vec_id").select("vec_id", F.col("x1").alias("drawn"))
        j = s.join(b, "vec_id").agg(F.count("*").alias("n_rows"), F.count_if(F.col("drawn") == F.col("x1")).alias("n_known"))
        j = j.select(F.lit(replaced).alias("replaced"), F.col("n_rows").cast("int"), F.col("n_known").cast("int"))
        out = j if out is None else out.unionByName(j)
    return out


@register("M10_bootstrap_metric", "SELECT CAST(unnest(range(10)) AS INTEGER) AS round, true AS right_size, true AS mean_inside")
def m10(spark, d):
    """Ten rounds: size within five standard deviations of 0.8 n, mean between the extremes."""
    from tessera.functions.scalars import cross_entropy, sigmoid
    b = FX.binary_points(spark, d)
    p = sigmoid(F.col("x1") * -1.0 + F.col("x2") * -0.2)
    loss = cross_entropy(F.col("y").cast("double"), p)
    whole = b.agg(F.count("*").alias("n"), F.min(loss).alias("low"), F.max(loss).alias("high"))
    n, low, high = (whole.select(c).scalar() for c in ("n", "low", "high"))
    rounds = FE.bootstrap_metric(b, loss, 10, 0.8, 42, "vec_id")
    return rounds.select("round", (F.abs(F.col("n") - 0.8 * n) <= 5 * F.sqrt(0.8 * n)).alias("right_size"),
                         F.col("mean").between(low, high).alias("mean_inside"))


# all four categorical columns of the loan table
_CATEGORICAL = {"source": SEGMENTS, "financial_institution": NATIONS, "loan_purpose": PRIORITIES, "insurance_type": REGIONS}
_M11_SQL = " + ".join(f"m{i}" for i in range(1, 12))


@register("Q4_delinquency_features", W(f"""
SELECT loan_id, is_train, m13, {', '.join(_onehot_sql(c, v) for c, v in _CATEGORICAL.items())},
       {_M11_SQL} AS total_delinquencies, greatest({', '.join(f'm{i}' for i in range(1, 12))}) AS max_delinquencies,
       {' + '.join(f'CAST(m{i} <> 0 AS INTEGER)' for i in range(1, 12))} AS delinquency_cnt
FROM (SELECT *, 1 AS is_train FROM loans WHERE loan_id % 2 = 0
      UNION ALL SELECT * REPLACE (NULL AS m13), 0 AS is_train FROM loans WHERE loan_id % 2 = 1)""", "loans"))
def q4(spark, d):
    lo = FX.loans(spark, d).select("loan_id", *_CATEGORICAL, *FX.M_COLS)
    out = R.delinquency_features(lo.where(F.col("loan_id") % 2 == 0), lo.where(F.col("loan_id") % 2 == 1),
                                 list(_CATEGORICAL), _CATEGORICAL)
    keep = ["loan_id", "is_train", "m13"] + [c for c in out.columns if c.startswith(tuple(f"{k}_" for k in _CATEGORICAL))] \
        + ["total_delinquencies", "max_delinquencies", "delinquency_cnt"]
    return out.select(*keep)
