"""Registered queries: models and the recommender job (L1–L6, L10–L16,
S8, Q7). Fitted models are checked rows-only by the driver; tests compare
them with direct computations on small inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.operators import metrics as E
from tessera.operators import models as ML
from tessera.plans.common import r6
from tessera.plans.fixture_sql import with_fixtures as W
from tessera.plans.registry import register
from tessera.session import materialize, scratch_path
from tessera.sources import files as IO
from tessera.sources import fixtures as FX

LOAN_FEATURES = ["unpaid_principal_bal"] + [f"m{i}" for i in range(1, 13)] + \
    ["total_delinquencies", "max_delinquencies", "delinquency_cnt"]
GRID = {"w1": (-5.0, 5.0, 0.1), "w2": (-5.0, 5.0, 0.1)}


def _loan_frame(spark, d):
    from tessera.operators.relational import row_features
    lo = FX.loans(spark, d)
    lo = row_features(lo, [f"m{i}" for i in range(1, 12)])
    return lo.withColumn("delinquent", (F.col("m13") > 0).cast("int"))


@register("L1_logistic_fit_predict")
def l1(spark, d):
    pred, coef, intercept = ML.logistic_fit_predict(FX.binary_points(spark, d), ["x1", "x2"], "y",
                                                    fit_intercept=False)
    return r6(pred.select("vec_id", "y", "prediction", "probability"))


_L2_SQL = """
SELECT CAST(round(-5 + floor(i / 101) * 0.1, 10) AS DOUBLE) AS w1, CAST(round(-5 + (i % 101) * 0.1, 10) AS DOUBLE) AS w2,
       sum(CASE WHEN p > 0 AND p < 1 THEN -(y * ln(p)) - (1 - y) * ln(1 - p) END) AS loss
FROM (SELECT g.i, CAST(b.y AS DOUBLE) AS y,
             1 / (1 + exp(-(round(-5 + floor(g.i / 101) * 0.1, 10) * b.x1 + round(-5 + (g.i % 101) * 0.1, 10) * b.x2))) AS p
      FROM binary_pts b CROSS JOIN range(10201) AS g(i))
GROUP BY i HAVING count(*) FILTER (WHERE NOT (p > 0 AND p < 1)) = 0"""


@register("L2_loss_surface", W(f"SELECT w1, w2, round(loss, 6) AS loss FROM ({_L2_SQL})", "binary"))
def l2(spark, d):
    return r6(ML.loss_surface(FX.binary_points(spark, d), ["x1", "x2"], "y", GRID))


@register("L2_loss_minimum", W(f"""
SELECT w1, w2, round(loss, 6) AS loss FROM ({_L2_SQL}) s WHERE loss = (SELECT min(loss) FROM ({_L2_SQL}))""", "binary"))
def l2m(spark, d):
    from tessera.operators.aggregates import argmin_rows
    surf = ML.loss_surface(FX.binary_points(spark, d), ["x1", "x2"], "y", GRID)
    return r6(argmin_rows(surf, "loss"))


# The notebook's settings of a single boosted model: shares of rows and columns, least child weight.
SAMPLING = {"row_share": 0.8, "column_share": 0.7, "min_child_weight": 5.0}


@register("L3_boosted_trees")
def l3(spark, d):
    lo = _loan_frame(spark, d)
    train = lo.where(F.col("loan_id") % 4 != 0)
    test = lo.where(F.col("loan_id") % 4 == 0)
    balance = train.agg(F.avg("delinquent")).first()[0] or 1.0
    spec = ML.Boosting(depth=6, rounds=100, eta=0.05, pos_weight=1 / balance / 20, seed=1337, **SAMPLING)
    model = ML.fit_boosted(train, LOAN_FEATURES, "delinquent", "loan_id", [spec])
    votes = ML.ensemble_vote(model, test, "loan_id").join(test.select("loan_id", "delinquent"), "loan_id")
    return r6(E.binary_scores(votes, "delinquent", "prediction"))


@register("L3_boosted_nodes")
def l3n(spark, d):
    lo = _loan_frame(spark, d)
    spec = ML.Boosting(depth=3, rounds=20, seed=1337, **SAMPLING)
    return r6(ML.fit_boosted(lo, LOAN_FEATURES, "delinquent", "loan_id", [spec]).nodes(spark))


@register("L4_grid_search")
def l4(spark, d):
    lo = _loan_frame(spark, d)
    scores, _ = ML.grid_search(lo, LOAN_FEATURES, "delinquent", "loan_id",
                               {"depth": [3, 6], "rounds": [50, 100, 200], "eta": [0.05],
                                "pos_weight": [5.0, 10.0, 20.0, 50.0]}, folds=5, **SAMPLING)
    return r6(scores)


@register("L5_undersampled_ensemble")
def l5(spark, d):
    lo = _loan_frame(spark, d)
    models = ML.undersampled_ensemble(lo, LOAN_FEATURES, "delinquent", "loan_id", n_models=20,
                                      ratio=1.0, depth=5, rounds=100)
    votes = ML.ensemble_vote(models, lo, "loan_id")
    return r6(votes.join(lo.select("loan_id", "delinquent"), "loan_id"))


@register("L5_undersampled_ten_to_one")
def l5w(spark, d):
    lo = _loan_frame(spark, d)
    train, test = lo.where(F.col("loan_id") % 4 != 0), lo.where(F.col("loan_id") % 4 == 0)
    model = ML.undersampled_ensemble(train, LOAN_FEATURES, "delinquent", "loan_id", n_models=1, ratio=10.0,
                                     depth=5, rounds=100, pos_weight=5.0)
    votes = ML.ensemble_vote(model, test, "loan_id").join(test.select("loan_id", "delinquent"), "loan_id")
    return r6(E.binary_scores(votes, "delinquent", "prediction"))


@register("L6_tree_nodes")
def l6(spark, d):
    a = FX.attrition(spark, d).withColumn("left", (F.col("attrition") == "Yes").cast("int"))
    feats = ["monthly_income", "num_companies_worked", "age", "years_at_company", "account_balance"]
    model = ML.decision_tree(a, feats, "left", depth=3)
    return r6(ML.tree_nodes(model, feats))


@register("L10_pca_project")
def l10(spark, d):
    return r6(ML.pca_project(FX.points(spark, d), "features", 2, "vec_id"))


@register("L11_svd_project")
def l11(spark, d):
    return r6(ML.svd_project(FX.points(spark, d), "features", 2, "vec_id"))


def _indexed_ratings(spark, d):
    r = FX.ratings(spark, d).select("user_id", "item_id", "rating")
    return ML.index_ratings(r)


@register("L12_als_fit")
def l12(spark, d):
    r, uidx, iidx = _indexed_ratings(spark, d)
    model = ML.als_fit(r, rank=25, reg=0.1)
    return r6(model.transform(r).select("user_id", "item_id", "rating", "prediction"))


@register("L13_als_tune")
def l13(spark, d):
    r, _, _ = _indexed_ratings(spark, d)
    scores, _, _ = ML.als_tune(r)
    return r6(scores)


@register("L14_recommend_top")
def l14(spark, d):
    r, uidx, iidx = _indexed_ratings(spark, d)
    model = ML.als_fit(r, rank=25, reg=0.1)
    return r6(ML.recommend_top(model, uidx, iidx, k=100, entity_type="stock_code"))


@register("L14_search_report")
def l14r(spark, d):
    from tessera.operators.topitems import top_items
    r, _, _ = _indexed_ratings(spark, d)
    model = ML.als_fit(r, rank=25, reg=0.1)
    found, report = top_items(model.userFactors, model.itemFactors, 100, block=128)
    skipped = 1 - report["visited"] / max(report["pairs"], 1)
    return found.agg(F.count("*").alias("n_rows"), F.count_distinct("user").alias("n_users")).withColumns(
        {c: F.lit(report[c]) for c in ("items", "blocks")}).withColumn("skipped_share", F.lit(round(skipped, 4)))


@register("P12_model_rules")
def p12_model(spark, d):
    """The notebook's rules on top of the isolation forest's verdict, over
    the loans that did not grow it: F1 of each against the outcome."""
    from tessera.functions.scalars import LOAN_RULES, rule_with_model
    from tessera.operators.anomaly import isolation_forest
    lo = _loan_frame(spark, d)
    train = F.col("loan_id") % 4 != 0
    share = lo.where(train).agg(F.avg("delinquent")).first()[0] or 0.0
    verdict = isolation_forest(lo, ["unpaid_principal_bal"] + [f"m{i}" for i in range(1, 13)], "loan_id", trees=50,
                               contamination=share, seed=42, fits=train)
    seen = lo.where(~train).join(verdict.select("loan_id", F.col("outlier").alias("model")), "loan_id")
    rules = {"model": F.col("model"), "m12_positive": LOAN_RULES["m12_positive"](),
             "m12_or_model": rule_with_model("model", "m12_or_model"),
             "model_vetoes_single": rule_with_model("model", "model_vetoes_single"),
             "quiet_m12_heavy_history": LOAN_RULES["quiet_m12_heavy_history"]()}
    flagged = seen.select("delinquent", F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), v.cast("int").alias("flag"))
                                                           for k, v in rules.items()])).alias("r")).select("delinquent", "r.*")
    tp, fp, fn = (F.count_if((F.col("flag") == a) & (F.col("delinquent") == b)) for a, b in ((1, 1), (1, 0), (0, 1)))
    return r6(flagged.groupBy("rule").agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"),
                                          F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1")))


@register("L15_export_factors")
def l15(spark, d):
    r, uidx, iidx = _indexed_ratings(spark, d)
    model = ML.als_fit(r, rank=25, reg=0.1)
    users, items = ML.export_factors(model, uidx, iidx)
    return users.select(F.lit("user").alias("entity"), F.col("user_id").alias("id"), "features_string") \
        .unionByName(items.select(F.lit("item").alias("entity"), F.col("item_id").alias("id"), "features_string"))


@register("L16_text_classifier")
def l16(spark, d):
    r = FX.reviews(spark, d)
    r = FE.random_split(r, [0.8, 0.2], 42, "doc_id")
    train, test = r.where("split_part = 0"), r.where("split_part = 1")
    model, labels = ML.text_classifier(train, "review", "label", num_features=1 << 18, max_iter=100)
    pred = ML.classify_text(model, labels, test)
    return r6(E.classification_report(pred, "label", "predicted"))


@register("S8_save_load_model", W("SELECT count(*) AS n_rows, 0.0::DOUBLE AS max_difference FROM binary_pts", "binary"))
def s8(spark, d):
    a = FX.binary_points(spark, d)
    model = ML.boosted_trees(a, ["x1", "x2", "x3", "x4"], "y", depth=3, rounds=10)
    path = scratch_path(spark, "model")
    IO.save_model(model, path)
    back = IO.load_model(path)
    p1 = ML.predict(model, a).select("vec_id", F.col("probability").alias("p_before"))
    p2 = ML.predict(back, a).select("vec_id", F.col("probability").alias("p_after"))
    return p1.join(p2, "vec_id").agg(F.count("*").alias("n_rows"),
                                     F.max(F.abs(F.col("p_before") - F.col("p_after"))).alias("max_difference"))


@register("Q7_affinity_job")
def q7(spark, d):
    from tessera.plans.reports import affinity_job
    src = scratch_path(spark, "q7-in")
    r = FX.ratings(spark, d)
    IO.write_text_lines(r.select(F.concat_ws(",", "user_id", "item_id", F.col("rating").cast("string"))), src)
    out = scratch_path(spark, "q7-out")
    scores = affinity_job(spark, src, f"{out}/recs", f"{out}/users", f"{out}/items", cutoff=5,
                          entity_type="stock_code", k=100)
    recs = IO.scan_csv(spark, f"{out}/recs", schema="user_id string, entity_type string, item_id string, affinity double",
                       header=False)
    best = scores.where("chosen").first()
    return recs.withColumns({c: F.lit(best[c]) for c in ("rank", "reg", "test_rmse", "test_mpr")})


@register("L17_adf_test")
def l17(spark, d):
    from tessera.operators.timeseries import adf_test
    return r6(adf_test(FX.hourly_series(spark, d), "ts", "count"))


@register("L17_adf_lag0", W("""
SELECT round(regr_slope(dx, xl) / sqrt((regr_syy(dx, xl) - regr_slope(dx, xl) * regr_sxy(dx, xl))
             / (regr_count(dx, xl) - 2) / regr_sxx(dx, xl)), 6) AS statistic,
       0 AS used_lag, CAST(regr_count(dx, xl) AS BIGINT) AS nobs
FROM (SELECT count - lag(count) OVER (ORDER BY ts) AS dx, CAST(lag(count) OVER (ORDER BY ts) AS DOUBLE) AS xl
      FROM hourly)""", "hourly"))
def l17z(spark, d):
    from tessera.operators.timeseries import adf_test
    return r6(adf_test(FX.hourly_series(spark, d), "ts", "count", maxlag=0)
              .select("statistic", "used_lag", "nobs"))


@register("Q8_stationarity_report")
def q8(spark, d):
    from tessera.operators.timeseries import stationarity_report
    return r6(stationarity_report(FX.hourly_series(spark, d, by_type=True), "ts", "count", "series_id"))


_LOF_CTES = [
    """pairs AS (SELECT a.vec_id AS x, b.vec_id AS y,
        sqrt(list_sum(list_transform(list_zip(a.features, b.features),
             lambda t: (CAST(t[1] AS DOUBLE) - CAST(t[2] AS DOUBLE)) * (CAST(t[1] AS DOUBLE) - CAST(t[2] AS DOUBLE))))) AS d
      FROM points a JOIN points b ON a.vec_id <> b.vec_id)""",
    """knn AS (SELECT * FROM (SELECT x, y, d, row_number() OVER (PARTITION BY x ORDER BY d, y) AS rk FROM pairs)
      WHERE rk <= 20)""",
    """kd AS (SELECT x, d AS kdist FROM knn WHERE rk = 20)""",
    """lrd AS (SELECT k.x, 1.0 / (avg(greatest(kd.kdist, k.d)) + 1e-10) AS lrd FROM knn k JOIN kd ON kd.x = k.y GROUP BY k.x)""",
]


@register("L8_local_outlier_factor", W("""
SELECT k.x AS vec_id, round(kd.kdist, 6) AS k_distance, round(l.lrd, 6) AS lrd, round(avg(ln.lrd) / l.lrd, 6) AS lof
FROM knn k JOIN lrd ln ON ln.x = k.y JOIN lrd l ON l.x = k.x JOIN kd ON kd.x = k.x
GROUP BY k.x, kd.kdist, l.lrd""", "points", ctes=_LOF_CTES))
def l8(spark, d):
    from tessera.operators.anomaly import local_outlier_factor
    return r6(local_outlier_factor(FX.points(spark, d), "features", "vec_id", k=20))


@register("L8_knn", W("SELECT x AS vec_id, y AS neighbor, round(d, 6) AS distance, rk AS rank FROM knn",
                      "points", ctes=_LOF_CTES[:2]))
def l8k(spark, d):
    from tessera.operators.anomaly import exact_knn
    return r6(exact_knn(FX.points(spark, d), "features", "vec_id", k=20)).withColumn("rank", F.col("rank").cast("long"))


_LOAN_POINTS = "loan_pts AS (SELECT loan_id AS vec_id, [" + ", ".join(
    f"CAST({c} AS DOUBLE)" for c in ["unpaid_principal_bal"] + [f"m{i}" for i in range(1, 13)]) + "] AS features, m13 FROM loans)"


_LOF_CUT = ["""lofs AS (SELECT k.x, kd.kdist, l.lrd, avg(ln.lrd) / l.lrd AS lof
  FROM knn k JOIN lrd ln ON ln.x = k.y JOIN lrd l ON l.x = k.x JOIN kd ON kd.x = k.x GROUP BY k.x, kd.kdist, l.lrd)""",
    """ranked AS (SELECT lof, row_number() OVER (ORDER BY lof) - 1 AS i, (count(*) OVER () - 1) * (
  1 - (SELECT avg(CAST(m13 > 0 AS INT)) FROM loans)) AS pos FROM lofs)""",
    """cut AS (SELECT min(CASE WHEN i = floor(pos) THEN lof END) + (min(CASE WHEN i = ceil(pos) THEN lof END)
  - min(CASE WHEN i = floor(pos) THEN lof END)) * (min(pos) - floor(min(pos))) AS c FROM ranked)"""]


@register("L8_loan_outliers", W("""
SELECT x AS loan_id, round(kdist, 6) AS k_distance, round(lrd, 6) AS lrd, round(lof, 6) AS lof,
  CAST(lof > (SELECT c FROM cut) AS INT) AS outlier FROM lofs""", "loans",
          ctes=[_LOAN_POINTS, _LOF_CTES[0].replace("points", "loan_pts"), *_LOF_CTES[1:], *_LOF_CUT]))
def l8_loans(spark, d):
    from tessera.operators.anomaly import local_outlier_factor
    lo = _loan_frame(spark, d)
    share = lo.agg(F.avg("delinquent")).first()[0] or 0.0
    x = F.array(*[F.col(c).cast("double") for c in ["unpaid_principal_bal"] + [f"m{i}" for i in range(1, 13)]])
    return r6(local_outlier_factor(lo.select("loan_id", x.alias("x")), "x", "loan_id", k=20, contamination=share))


@register("L7_isolation_forest")
def l7(spark, d):
    from tessera.operators.anomaly import isolation_forest
    lo = _loan_frame(spark, d)
    share = lo.agg(F.avg("delinquent")).first()[0] or 0.0
    return r6(isolation_forest(lo, ["unpaid_principal_bal"] + [f"m{i}" for i in range(1, 13)], "loan_id",
                               trees=100, contamination=share, seed=42))


@register("L9_one_class_boundary")
def l9(spark, d):
    from tessera.operators.anomaly import one_class_boundary
    from tessera.operators.features import standardize
    feats = ["unpaid_principal_bal", "m10", "m11", "m12", "total_delinquencies"]
    lo = materialize(_loan_frame(spark, d).select("loan_id", "delinquent", *feats), "one-class-loans")
    normal = lo.where(F.col("delinquent") == 0)
    train, allrows = standardize(normal, [lo], feats)
    out = None
    for g in (0.01, 0.1, 1.0):
        v = one_class_boundary(train, allrows.select("loan_id", "delinquent", *feats), feats, nu=0.05, gamma=g)
        v = v.select("loan_id", "delinquent", F.lit(g).alias("gamma"), "verdict", (F.col("gap") <= 1e-3).alias("converged"))
        out = v if out is None else out.unionByName(v)
    return out


@register("L16_mean_vector_classifier")
def l16v(spark, d):
    r = FX.reviews(spark, d)
    feats = ML.mean_word_vectors(r, "doc_id", "review", FX.word_vectors(spark, d))
    feats = materialize(feats, "mean-vectors")
    data = FE.random_split(feats.join(r.select("doc_id", "label"), "doc_id"), [0.8, 0.2], 42, "doc_id")
    train, test = data.where("split_part = 0"), data.where("split_part = 1")
    model, labels = ML.vector_classifier(train, "features", "label", hidden=(32,), max_iter=100)
    names = F.array(*[F.lit(v) for v in labels])
    pred = model.transform(test).withColumn("predicted", F.element_at(names, (F.col("prediction") + 1).cast("int")))
    return r6(E.classification_report(pred, "label", "predicted"))
