"""Models and anomaly scores against direct NumPy computations on small
inputs, plus the invariants the reference states in its notes."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import anomaly as AN
from tessera.operators import features as FE
from tessera.operators import models as ML
from tessera.operators import stattests as ST


def test_lof_and_knn_match_bruteforce_with_skewed_cluster(spark):
    rng = np.random.default_rng(0)
    hot = rng.normal(0, 0.01, size=(60, 3))          # a dense cluster: a third of the rows
    rest = rng.normal(0, 1.0, size=(118, 3))
    far = np.array([[8.0, 8.0, 8.0], [-9.0, 0.0, 4.0]])
    x = np.vstack([hot, rest, far])
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)],
                               "id long, v array<double>")
    k = 5
    got = {r["id"]: r for r in AN.local_outlier_factor(df, "v", "id", k=k).collect()}
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    nbrs = np.array([np.lexsort((np.arange(len(x)), d[i]))[:k] for i in range(len(x))])
    kd = np.array([d[i, nbrs[i][-1]] for i in range(len(x))])
    reach = np.array([[max(kd[o], d[i, o]) for o in nbrs[i]] for i in range(len(x))])
    lrd = 1.0 / (reach.mean(1) + 1e-10)
    lof = np.array([lrd[nbrs[i]].mean() / lrd[i] for i in range(len(x))])
    for i in range(len(x)):
        assert math.isclose(got[i]["lof"], lof[i], rel_tol=1e-9)
    assert got[len(x) - 2]["lof"] > 2 and got[len(x) - 1]["lof"] > 2


def _brute_neighbors(x, k):
    d = np.sqrt(sum((x[:, None, c] - x[None, :, c]) ** 2 for c in range(x.shape[1])))
    np.fill_diagonal(d, np.inf)
    return [[(j, d[i, j]) for j in np.lexsort((np.arange(len(x)), d[i]))[:k] if np.isfinite(d[i, j])] for i in range(len(x))]


@pytest.mark.parametrize("block, dims", [(16, 2), (1024, 2), (40, 13)])
def test_neighbors_with_many_equal_points_and_leaves(spark, monkeypatch, block, dims):
    from tessera.operators import neighbors as N
    monkeypatch.setattr(N, "TILE", 32)  # leaves and query lists of several tiles
    rng = np.random.default_rng(block)
    x = np.vstack([np.zeros((90, dims)), rng.integers(0, 3, (80, dims)), rng.normal(size=(100, dims)), rng.normal(size=(30, dims)) * 50])
    x = x[rng.permutation(len(x))].astype(float)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id int, v array<double>").repartition(5)
    got = {}
    for r in N.nearest(df, "v", "id", 7, block_size=block).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["neighbor"], r["distance"]))
    for i, want in enumerate(_brute_neighbors(x, 7)):
        have = [(j, d) for _, j, d in sorted(got[i])]
        assert [j for j, _ in have] == [j for j, _ in want], i
        assert np.allclose([d for _, d in have], [d for _, d in want], rtol=1e-12)


def test_neighbors_prune_leaves(spark):
    from tessera.operators import neighbors as N
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rng.random((3000, 2)))], "id long, v array<double>")
    *_, report = N.neighbor_classes(df, "v", "id", 5, block_size=100)
    assert report["points"] == 3000 and report["leaves"] >= 25
    assert report["copies"] < 3 * 3000  # of 30 leaves


def test_neighbors_of_odd_points(spark):
    rows = [("a", [0.0, 0.0]), ("b", [1.0, 0.0]), ("c", [0.0, float("nan")]), ("d", None), ("e", []), ("f", [-0.0, 0.0]), (None, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "id string, v array<double>")
    out = {r["id"]: r for r in AN.local_outlier_factor(df, "v", "id", k=20, contamination=0.4).collect()}
    assert set(out) == {"a", "b", "c", "d", "e", "f", None}
    assert all(out[i]["lof"] is None and out[i]["outlier"] == 0 for i in ("c", "d", "e", None))
    assert [out[i]["k_distance"] for i in ("a", "b", "f")] == [1.0, 1.0, 1.0]
    few = spark.createDataFrame([(i, [float(i)]) for i in range(8)], "id long, v array<double>")
    assert AN.exact_knn(few, "v", "id", 20).count() == 56
    assert AN.local_outlier_factor(few, "v", "id", k=20).where("lof is not null").count() == 8
    assert AN.exact_knn(few.limit(0), "v", "id", 3).count() == 0 and AN.exact_knn(few.limit(1), "v", "id", 3).count() == 0


def test_isolation_forest_flags_planted_outliers(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, size=(400, 2)), [[9, 9], [-9, 8], [10, -10]]])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)],
                               "id long, a double, b double")
    out = {r["id"]: r for r in AN.isolation_forest(df, ["a", "b"], "id", trees=50, max_samples=128,
                                                   contamination=0.02).collect()}
    assert all(out[i]["outlier"] == 1 for i in (400, 401, 402))
    assert sum(r["outlier"] for r in out.values()) == pytest.approx(0.02 * 403, abs=1)
    again = {r["id"]: r["score"] for r in AN.isolation_forest(df.repartition(5), ["a", "b"], "id", trees=50,
                                                                max_samples=128).collect()}
    assert all(math.isclose(again[i], out[i]["score"]) for i in out)


@pytest.mark.parametrize("max_samples", [None, 16])
def test_isolation_trees_equal_a_plain_rerun(spark, max_samples):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=50).round(1), rng.integers(0, 3, 50), np.full(50, 7.0)]).astype(float)
    x[3, 0], x[4, 1] = np.nan, np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], i % 10 != 9) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, ok boolean")
    heights, nodes, psi = AN.grow_isolation_trees(df, ["a", "b", "c"], "id", trees=5, max_samples=max_samples, seed=3, fits=F.col("ok"))
    assert psi == (max_samples or 45)
    got = {(r["tree"], r["node"]): (r["size"], r["feature"], r["threshold"]) for r in nodes.collect()}
    draws = {(r["tree"], r["node"]): (r["u"], r["v"]) for r in spark.range(1, 130).selectExpr(
        "id as node", "explode(sequence(0, 4)) as tree").select(
        "tree", "node", *[c.alias(n) for c, n in zip(AN.isolation_draws(3), "uv")]).collect()}
    hashes = {(r["id"], r["tree"]): r["h"] for r in df.selectExpr("id", "explode(sequence(0, 4)) as tree").select(
        "id", "tree", AN.uniform_hash("id", 3, F.col("tree")).alias("h")).collect()}
    limit, seen, want = math.ceil(math.log2(psi)), {}, np.zeros(50)

    def grow(tree, node, depth, here, fit):
        inside = x[[i for i in here if i in fit]]
        lo, hi = np.nanmin(inside, axis=0), np.nanmax(inside, axis=0)
        usable = [f for f in range(3) if lo[f] < hi[f]] if depth < limit else []
        if not usable:
            seen[tree, node] = (len(inside), None, None)
            for i in here:
                want[i] += depth + AN.avg_path_length(np.array([len(inside)]))[0]
            return
        u, v = draws[tree, node]
        f = usable[int(u * len(usable))]
        cut = lo[f] + v * (hi[f] - lo[f])
        seen[tree, node] = (len(inside), f, cut)
        left = [i for i in here if x[i, f] <= cut]
        grow(tree, 2 * node, depth + 1, left, fit)
        grow(tree, 2 * node + 1, depth + 1, [i for i in here if i not in left], fit)

    for tree in range(5):
        fit = set(sorted((i for i in range(50) if i % 10 != 9), key=lambda i: (hashes[i, tree], i))[:psi])
        grow(tree, 1, 0, list(range(50)), fit)
    assert got.keys() == seen.keys()
    for k in seen:
        assert got[k][:2] == seen[k][:2] and (seen[k][2] is None or math.isclose(got[k][2], seen[k][2]))
    assert all(math.isclose(r["height"], want[r["id"]] / 5) for r in heights.collect())


def test_isolation_forest_is_no_grouped_python(spark):
    df = spark.range(20).selectExpr("id", "cast(id as double) a")
    plan = AN.isolation_forest(df, ["a"], "id", trees=3)._jdf.queryExecution().toString()
    assert "InPandas" not in plan and "Python" not in plan


def test_avg_path_length():
    assert list(AN.avg_path_length(np.array([1, 2]))) == [0.0, 1.0]
    assert math.isclose(AN.avg_path_length(np.array([256]))[0], 10.244770920116851, rel_tol=1e-9)


def test_grid_minimum_within_one_step_of_fit(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 2))
    p = 1 / (1 + np.exp(-(x @ np.array([-1.0, 0.3]))))
    y = (rng.uniform(size=400) < p).astype(int)
    df = spark.createDataFrame([(i, float(a), float(b), int(t)) for i, ((a, b), t) in enumerate(zip(x, y))],
                               "vec_id long, x1 double, x2 double, y int")
    _, coef, _ = ML.logistic_fit_predict(df, ["x1", "x2"], "y", C=1e6, fit_intercept=False)
    surf = ML.loss_surface(df, ["x1", "x2"], "y", {"w1": (-3.0, 3.0, 0.1), "w2": (-3.0, 3.0, 0.1)})
    best = surf.orderBy("loss").first()
    assert abs(best["w1"] - coef[0]) <= 0.1 + 1e-9 and abs(best["w2"] - coef[1]) <= 0.1 + 1e-9


def test_loss_surface_drops_overflowing_points(spark):
    df = spark.createDataFrame([(0, 50.0, 1), (1, -50.0, 0)], "vec_id long, x1 double, y int")
    surf = {r["w"]: r["loss"] for r in ML.loss_surface(df, ["x1"], "y", {"w": (-1.0, 1.0, 1.0)}).collect()}
    assert 0.0 in surf and -1.0 not in surf and 1.0 not in surf


@pytest.mark.parametrize("stat,dof,p", [(3.841458820694124, 1, 0.05), (11.070497693516351, 5, 0.05),
                                        (0.5, 2, 0.7788007830714049), (30.0, 10, 0.0008566412)])
def test_chi2_sf_known_values(spark, stat, dof, p):
    got = spark.range(1).select(ST.chi2_sf(F.lit(stat), F.lit(dof))).first()[0]
    assert math.isclose(got, p, rel_tol=1e-6)


def test_chi2_contingency_yates_2x2_with_empty_cell(spark):
    rows = [("a", "x")] * 10 + [("a", "y")] * 5 + [("b", "x")] * 7
    df = spark.createDataFrame(rows, "u string, v string")
    got = ST.chi2_contingency(df, "u", "v").first()
    obs = np.array([[10, 5], [7, 0]], dtype=float)
    e = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    want = (((np.abs(obs - e) - np.minimum(0.5, np.abs(obs - e))) ** 2) / e).sum()
    assert got["dof"] == 1 and math.isclose(got["statistic"], want, rel_tol=1e-12)


def test_svd_projection_matches_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 5)) + 2.0
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, f array<double>")
    got = {r["id"]: (r["sv1"], r["sv2"]) for r in ML.svd_project(df, "f", 2, "id").collect()}
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    proj = x @ vt[:2].T
    for j in range(2):
        sign = np.sign(vt[j][np.argmax(np.abs(vt[j]))])
        for i in range(60):
            assert math.isclose(got[i][j], sign * proj[i, j], rel_tol=1e-7, abs_tol=1e-9)


def test_tree_nodes_table(spark):
    df = spark.createDataFrame([(float(i), int(i > 10)) for i in range(30)], "x double, y int")
    model = ML.decision_tree(df, ["x"], "y", depth=2)
    nodes = ML.tree_nodes(model, ["x"]).collect()
    root = [n for n in nodes if n["id"] == 0][0]
    assert root["feature"] == "x" and 10.0 <= root["threshold"] <= 11.0


def test_als_recommendations_use_original_ids(spark):
    rows = [(f"u{u}", f"i{i}", float((u * i) % 5 + 1)) for u in range(12) for i in range(9) if (u + i) % 3]
    r = spark.createDataFrame(rows, "user_id string, item_id string, rating double")
    indexed, uidx, iidx = ML.index_ratings(r)
    model = ML.als_fit(indexed, rank=3, reg=0.1, max_iter=5)
    recs = ML.recommend_top(model, uidx, iidx, k=3, entity_type="item").collect()
    assert len(recs) == 12 * 3 and all(x["user_id"].startswith("u") and x["item_id"].startswith("i") for x in recs)


def test_exact_knn_across_many_blocks_with_ties(spark):
    rng = np.random.default_rng(9)
    x = np.vstack([rng.integers(0, 4, size=(40, 3)).astype(float), [[1.0, 1.0, 1.0]] * 6])
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)],
                               "id long, v array<double>")
    k = 4
    got = {}
    for r in AN.exact_knn(df, "v", "id", k=k, block_size=7).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["neighbor"], r["distance"]))
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for i in range(len(x)):
        want = np.lexsort((np.arange(len(x)), d[i]))[:k]
        have = [nb for _, nb, _ in sorted(got[i])]
        assert have == list(want), (i, have, list(want))


def test_registered_search_and_ensemble_have_the_notebooks_settings(monkeypatch):
    from tessera.plans import queries_models as Q
    seen = {}

    def keep(name):
        def call(*args, **options):
            seen[name] = (args, options)
            raise StopIteration
        return call

    monkeypatch.setattr(Q, "_loan_frame", lambda spark, d: None)
    monkeypatch.setattr(Q.ML, "grid_search", keep("L4"))
    monkeypatch.setattr(Q.ML, "undersampled_ensemble", keep("L5"))
    for query in (Q.l4, Q.l5):
        with pytest.raises(StopIteration):
            query(None, None)
    args, options = seen["L4"]
    assert args[4] == {"depth": [3, 6], "rounds": [50, 100, 200], "eta": [0.05],
                       "pos_weight": [5.0, 10.0, 20.0, 50.0]} and options["folds"] == 5
    options = seen["L5"][1]
    assert (options["n_models"], options["depth"], options["rounds"], options["ratio"]) == (20, 5, 100, 1.0)


def test_one_class_reaches_its_gap(spark):
    rng = np.random.default_rng(11)
    x = np.vstack([rng.normal(size=(280, 2)), rng.normal(size=(20, 2)) * 4])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    nu = 0.1
    fit = AN.fit_one_class(df, ["a", "b"], nu=nu, gamma=0.5, n_components=40, tolerance=1e-3)
    assert fit.gap <= 1e-3 and fit.passes < 80
    z = np.cos(x @ fit.W.T + fit.b) * math.sqrt(2 / 40)

    def objective(w):
        lowest = np.sort(z @ w)[:int(nu * len(z))]
        return w @ w / 2 - lowest.mean()

    w = z.mean(axis=0)  # plain conditional gradient, many steps
    for t in range(20_000):
        corner = z[np.argsort(z @ w)[:int(nu * len(z))]].mean(axis=0)
        d = corner - w
        step = min(1.0, max(0.0, -(w @ d) / max(d @ d, 1e-300)))
        w = w + step * d
    assert objective(fit.w) <= objective(w) + 2e-3 * (w @ w)
    out = {r["id"]: r["verdict"] for r in fit.score(df).collect()}
    assert 0.07 <= np.mean([v == -1 for v in out.values()]) <= 0.13
    assert np.mean([out[i] for i in range(280, 300)]) < 0


def test_text_classifier_reads_each_text_once(spark):
    rows = [(i, f"wort{i % 3} und noch" if i % 2 else f"word{i % 3} and more", "de" if i % 2 else "en") for i in range(40)]
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    df = spark.createDataFrame(rows, "id long, review string, label string")
    model, labels = ML.text_classifier(df.withColumn("review", counted("review")), "review", "label",
                                       num_features=64, max_iter=20)
    assert labels == ["de", "en"] and read.value == 40
    assert ML.classify_text(model, labels, df).where("predicted <> label").count() == 0


def test_one_class_does_not_copy_what_computes_its_features(spark):
    raw = spark.createDataFrame([(i, float(i % 7), float(i % 5)) for i in range(60)], "id long, a double, b double")
    train, rows = FE.standardize(raw.where("id % 10 <> 0"), [raw], ["a", "b"])
    out = AN.one_class_boundary(train, rows, ["a", "b"], nu=0.1, gamma=0.5, n_components=20, passes=3)
    assert "subquery" in rows._jdf.queryExecution().optimizedPlan().toString()
    assert "subquery" not in out._jdf.queryExecution().optimizedPlan().toString()
    m, s = np.mean([i % 7 for i in range(60) if i % 10]), np.std([i % 7 for i in range(60) if i % 10])
    got = {r["id"]: r["a"] for r in out.collect()}
    assert len(got) == 60 and all(abs(got[i] - (i % 7 - m) / s) < 1e-9 for i in range(60))


def test_least_norm_of_a_hull():
    assert np.allclose(AN.least_norm(np.array([[1.0, 1.0], [1.0, -1.0], [5.0, 0.0]])), [0.5, 0.5, 0.0])
    rng = np.random.default_rng(12)
    a = rng.normal(size=(12, 5)) + 1
    v = AN.least_norm(a) @ a
    assert (a @ v >= v @ v - 1e-9).all()


@pytest.mark.parametrize("k, block", [(3, 4), (10, 4), (5, 1000), (60, 8)])
def test_top_items_equal_all_scores(spark, monkeypatch, k, block):
    from tessera.operators import topitems as T
    monkeypatch.setattr(T, "TILE", 16)
    rng = np.random.default_rng(block)
    u, v = rng.gamma(1.0, size=(70, 4)), rng.gamma(1.0, size=(50, 4)) * rng.choice([0.1, 1.0, 5.0], size=(50, 1))
    v[7] = v[3]
    v[9] = 0.0
    make = lambda m: spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(m)], "id int, features array<float>")
    found, report = T.top_items(make(u), make(v), k, block)
    u, v = u.astype(np.float32).astype(float), v.astype(np.float32).astype(float)
    got = {}
    for r in found.collect():
        got.setdefault(r["user"], []).append((r["rank"], r["item"]))
    for i in range(70):
        want = np.lexsort((np.arange(50), -(u[i] @ v.T)))[:k]
        assert [j for _, j in sorted(got[i])] == want.tolist()
    assert report["pairs"] == 70 * -(-50 // block)
    if (k, block) == (3, 4):
        assert report["visited"] < report["pairs"] / 2
    assert T.top_items(make(u).limit(0), make(v), 3)[0].count() == 0


def test_top_items_equal_sparks_recommendations(spark):
    rng = np.random.default_rng(13)
    rows = [(int(a), int(b), float(c)) for a, b, c in zip(rng.integers(0, 40, 500), rng.integers(0, 60, 500), rng.integers(1, 9, 500))]
    model = ML.als_fit(spark.createDataFrame(rows, "user_id_no int, item_id_no int, rating double"), rank=4, max_iter=3)
    from tessera.operators.topitems import top_items
    want = {(r["user_id_no"], r["item_id_no"]): r["rating"] for r in model.recommendForAllUsers(6).selectExpr(
        "user_id_no", "inline(recommendations)").collect()}
    got = {(r["user"], r["item"]): r["score"] for r in top_items(model.userFactors, model.itemFactors, 6, block=8)[0].collect()}
    assert len(got) == len(want) and len(got.keys() & want.keys()) >= 0.98 * len(want)  # single precision may swap near ties
    assert all(math.isclose(got[x], want[x], rel_tol=1e-4, abs_tol=1e-6) for x in got.keys() & want.keys())


def test_rules_with_a_models_verdict(spark):
    from tessera.functions.scalars import rule_with_model
    rows = [(m12, p) for m12 in (0, 1, 2) for p in (0, 1)]
    df = spark.createDataFrame(rows, "m12 int, pred int").select(
        "m12", "pred", rule_with_model("pred", "m12_or_model").alias("a"), rule_with_model("pred", "model_vetoes_single").alias("b"))
    for r in df.collect():
        assert r["a"] == int(r["m12"] > 0 or r["pred"] > 0)
        assert r["b"] == (0 if r["m12"] == 1 and r["pred"] == 0 else int(bool(r["m12"])))


def test_top_items_send_slabs_not_blocks(spark):
    from tessera.operators import topitems as T
    rng = np.random.default_rng(3)
    make = lambda n: spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rng.normal(size=(n, 3)))], "id int, features array<double>")
    sent = []
    kept = T.materialize
    T.materialize = lambda df, name: (sent.append(out := kept(df, name)) if name == "top-asked" else None) or (out if name == "top-asked" else kept(df, name))
    try:
        found, report = T.top_items(make(40), make(200), 2, block=2)
    finally:
        T.materialize = kept
    assert found.count() == 80 and report["blocks"] == 100 and report["visited"] > 10 * 40
    assert sent[0].count() <= 40  # one slab of 99 blocks: a user goes there once


def test_near_pairs_are_all_pairs_within_the_radius():
    from tessera.operators import neighbors as N
    rng = np.random.default_rng(5)
    for shift, scale in ((0.0, 1.0), (1e6, 1e-3), (0.0, 1e160)):
        a, b = rng.normal(size=(40, 8)) * scale + shift, rng.normal(size=(60, 8)) * scale + shift
        b[:5] = a[:5]
        with np.errstate(over="ignore", invalid="ignore"):
            dist = N._distances(a, b)
            r = np.sort(dist, axis=1)[:, 3]  # exactly a pair's distance
            i, j, far = N._near_pairs(a, b, r)
        assert np.array_equal(far, dist[i, j])
        assert set(zip(*np.nonzero(dist <= r[:, None]))) <= set(zip(i, j))
        assert scale > 1e100 or len(i) < 40 * 8


def test_mean_word_vectors_sum_tokens_where_the_text_is(spark, monkeypatch):
    from tessera.operators import skew as K
    rows = [(i, " ".join(f"w{(i * 7 + j) % 11}" for j in range(i % 9))) for i in range(30)] + [(None, "w1 w1 w3"), (31, None)]
    df = spark.createDataFrame(rows, "id long, t string")
    vectors = {f"w{k}": [float(k), k / 7, -1.0] for k in range(9)}
    table = spark.createDataFrame(list(vectors.items()), "word string, vector array<float>")
    want = {}
    for i, t in rows:
        known = [np.array(vectors[w], np.float32).astype(float) for w in (t or "").split() if w in vectors]
        if known:
            want[i] = np.mean(known, axis=0)
    for most in (100, 4):  # broadcast whole, then only the most frequent words
        monkeypatch.setattr(K, "BROADCAST_ROWS", most)
        out = ML.mean_word_vectors(df, "id", "t", table)
        got = {r["id"]: r["features"].toArray() for r in out.collect()}
        assert got.keys() == want.keys() and all(np.allclose(got[i], want[i], atol=1e-12) for i in want)
        if most == 100:
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert ML.mean_word_vectors(df, "id", "t", table.limit(0)).count() == 0


def test_tuning_returns_the_scored_model(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(int(a), int(b), float(c)) for a, b, c in zip(rng.integers(0, 15, 300), rng.integers(0, 20, 300), rng.integers(1, 9, 300))]
    fits, fit = [], ML.als_fit
    monkeypatch.setattr(ML, "als_fit", lambda *a, **k: fits.append(a[1:3]) or fit(*a, **k))
    scores, model, test = ML.als_tune(spark.createDataFrame(rows, "user_id_no int, item_id_no int, rating double"), (2, 3), (0.1, 0.01), max_iter=2)
    test.unpersist()
    best = min(scores.collect(), key=lambda r: r["mpr"])
    assert len(fits) == 4 and scores.count() == 4  # the winner is not fitted again
    assert model.rank == best["rank"] and model._java_obj.parent().getRegParam() == best["reg"]


@pytest.mark.parametrize("local", [0, 7, 1 << 17])
def test_isolation_trees_are_the_same_wherever_they_grow(spark, monkeypatch, local):
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.normal(size=60).round(1), rng.integers(0, 3, 60), np.full(60, 7.0)])
    rows = [(f"n{i}", *[None if i % 17 == 3 else float(v) for v in r], i % 10 != 9) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id string, a double, b double, c double, ok boolean")
    levels = []
    kept = AN._node_splits
    monkeypatch.setattr(AN, "_node_splits", lambda *a: levels.append(1) or kept(*a))

    def grown(at):
        monkeypatch.setattr(AN, "LOCAL_ROWS", at)
        heights, nodes, _ = AN.grow_isolation_trees(df, ["a", "b", "c"], "id", trees=4, seed=11, fits=F.col("ok"))
        return sorted(map(tuple, nodes.collect()), key=str), {r["id"]: r["height"] for r in heights.collect()}

    nodes, heights = grown(local)
    if local > 60:
        assert len(levels) == 1  # no job a level
    want_nodes, want_heights = grown(0)
    assert nodes == want_nodes and heights.keys() == want_heights.keys() and len(heights) == 60
    assert all(math.isclose(heights[i], want_heights[i]) for i in heights)


def test_ids_that_repeat_keep_all_their_neighbours(spark):
    from tessera.operators import neighbors as N
    x = np.random.default_rng(7).normal(size=(30, 2)).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)] + [(0, x[0])], "id long, v array<double>")
    near = {r["cls"]: len(r["near"]) for r in N.neighbor_classes(df, "v", "id", 5)[2].collect()}
    assert near == {i: 5 for i in range(30)}


@pytest.mark.parametrize("slab", [1 << 16, 90])
def test_neighbors_send_slabs_not_leaves(spark, monkeypatch, slab):
    from tessera.operators import neighbors as N
    x = np.random.default_rng(9).normal(size=(400, 24))  # so many dimensions that a point meets every leaf
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>")
    sent, kept = [], N.materialize
    monkeypatch.setattr(N, "SLAB", slab, raising=False)
    monkeypatch.setattr(N, "SLAB_QUERIES", 150, raising=False)

    def counted(table, name):
        out = kept(table, name)
        if name == "knn-queries":
            sent.append(out.count())
        return out

    monkeypatch.setattr(N, "materialize", counted)
    got = {}
    for r in N.nearest(df, "v", "id", 6, block_size=40).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["neighbor"]))
    assert [[j for _, j in sorted(got[i])] for i in range(400)] == [[j for j, _ in near] for near in _brute_neighbors(x, 6)]
    assert sent[0] <= 400 * -(-400 // (slab - 40))  # of 10 leaves


def test_isolation_levels_move_no_record(spark, monkeypatch):
    df = spark.range(300).selectExpr("id", "cast((id * 37) % 301 as double) a", "cast(id % 5 as double) b")
    written, kept = {}, AN.scratch_path
    monkeypatch.setattr(AN, "LOCAL_ROWS", 20)
    monkeypatch.setattr(AN, "scratch_path", lambda spark, name: written.setdefault(name, kept(spark, name)))
    heights, nodes, _ = AN.grow_isolation_trees(df, ["a", "b"], "id", trees=6, seed=2)
    assert set(written) == {"isolation-subtrees"}  # large nodes wrote the records of every level
    assert heights.count() == 300 and nodes.where("feature is null").groupBy("tree").agg(F.sum("size").alias("s")).where("s <> 300").count() == 0


def test_isolation_keeps_rows_whose_ids_repeat(spark):
    rows = [(i // 2, float(i % 3), float(i // 4)) for i in range(40)] + [(None, 1.0, 2.0), (None, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    for most in (None, 16):
        heights, nodes, _ = AN.grow_isolation_trees(df, ["a", "b"], "id", trees=3, max_samples=most, seed=2)
        leaves = nodes.where("feature is null").agg(F.sum("size")).first()[0]
        assert heights.count() == 21 and leaves == 3 * (most or 42)


def test_top_items_do_not_broadcast_who_asks(spark):
    from tessera.operators import topitems as T
    rng = np.random.default_rng(4)
    make = lambda n: spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rng.normal(size=(n, 3)))], "id int, features array<double>")
    found, report = T.top_items(make(40), make(200), 2, block=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert report["visited"] > 40 and "SortMergeJoin [id" in plan and "BroadcastHashJoin [id" not in plan
