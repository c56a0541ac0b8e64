"""Models on spark.ml (L1–L6, L10–L16) plus the loss surface (L2).

Fitting is distributed by spark.ml; only model parameters (coefficients,
a d x d Gram matrix, tuning scores) ever reach the driver.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import IDF, PCA, HashingTF, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators import features as FE
from tessera.operators.boosting import BoostedModels, Boosting, fit_boosted
from tessera.operators.metrics import mean_percentile_rank, rmse
from tessera.operators.topitems import top_items
from tessera.session import discard, ensure_checkpoint_dir, materialize, scratch_path


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep").transform(df)


# --- L1 ---------------------------------------------------------------------
def logistic_fit_predict(df: DataFrame, features: list[str], label: str, C: float = 1.0,
                         fit_intercept: bool = True):
    """L2-regularised logistic regression with the scikit-learn objective
    C * sum(loss) + ||w||^2 / 2, i.e. regParam = 1 / (C * n) (L1).
    Returns (predictions, coefficients, intercept)."""
    data = assemble(df, features).withColumn("_label", F.col(label).cast("double"))
    n = data.count()
    lr = LogisticRegression(featuresCol="features", labelCol="_label", regParam=1.0 / (C * n),
                            elasticNetParam=0.0, standardization=False, fitIntercept=fit_intercept,
                            maxIter=200, tol=1e-10)
    model = lr.fit(data)
    pred = model.transform(data).drop("features", "rawPrediction", "_label")
    pred = pred.withColumn("probability", vector_to_array("probability")[1])
    return pred, list(model.coefficients.toArray()), float(model.intercept)


# --- L2 ---------------------------------------------------------------------
def loss_surface(df: DataFrame, x_cols: list[str], label: str,
                 axes: dict[str, tuple[float, float, float]]) -> DataFrame:
    """Total cross-entropy of a logistic model without intercept at every
    point of a weight grid (L2); grid points where any row's loss is not
    finite (probability at exactly 0 or 1) are dropped, as the notebook does.

    Each row is paired with every grid index by a generator (no join); the
    weights are ``start + i * step`` (as ``numpy.arange`` makes them) and the
    sums are grouped by the integer grid index, partially aggregated before
    the shuffle; the weight columns are attached after the aggregation.
    """
    if len(axes) != len(x_cols):
        raise ValueError("one grid axis per feature")
    specs = list(axes.items())
    sizes = [int(round((hi - lo) / st)) + 1 for _, (lo, hi, st) in specs]
    strides, acc = [], 1
    for n in reversed(sizes):
        strides.append(acc)
        acc *= n
    strides = strides[::-1]
    idx = F.col("_g")

    def weight(k):
        lo, _, st = specs[k][1]
        return F.lit(float(lo)) + ((idx / strides[k]).cast("long") % sizes[k]) * F.lit(float(st))

    g = df.select(*x_cols, F.col(label).cast("double").alias("_y"),
                  F.explode(F.sequence(F.lit(0), F.lit(acc - 1))).alias("_g"))
    z = None
    for k, x in enumerate(x_cols):
        term = weight(k) * F.col(x)
        z = term if z is None else z + term
    p = S.sigmoid(z)
    finite = (p > 0) & (p < 1)
    loss = F.when(finite, S.cross_entropy(F.col("_y"), p))
    out = g.groupBy("_g").agg(F.sum(loss).alias("loss"), F.count_if(~finite).alias("_bad"))
    out = out.where(F.col("_bad") == 0)
    return out.select(*[F.round(weight(k), 10).alias(name) for k, (name, _) in enumerate(specs)], "loss")


# --- L3-L5 ------------------------------------------------------------------
def boosted_trees(df: DataFrame, features: list[str], label: str, depth: int = 5, rounds: int = 100,
                  eta: float = 0.05, pos_weight: float = 1.0, seed: int = 1337):
    """Gradient-boosted trees with a weight on the positive class (L3).
    Returns the fitted pipeline model."""
    data = df.withColumn("_label", F.col(label).cast("double")).withColumn(
        "_w", F.when(F.col(label) == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0)))
    gbt = GBTClassifier(featuresCol="features", labelCol="_label", weightCol="_w", maxDepth=depth,
                        maxIter=rounds, stepSize=eta, seed=seed)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features",
                                            handleInvalid="keep"), gbt])
    return pipe.fit(data)


def predict(model, df: DataFrame) -> DataFrame:
    out = model.transform(df)
    return (out.withColumn("probability", vector_to_array("probability")[1])
            .drop("features", "rawPrediction"))


def grid_search(df: DataFrame, features: list[str], label: str, id_col: str,
                grid: dict[str, list], folds: int = 5, seed: int = 1337, **settings):
    """Cross-validated search by positive-class F1 over ``depth``, ``rounds``,
    ``eta`` and ``pos_weight`` (L4), with stratified folds from a seeded hash;
    ``settings`` are those of ``Boosting`` that every model shares. Returns the
    table of mean scores and the best model (fitted on all rows).

    A model of fewer rounds is the start of a longer one, so each (depth,
    eta, weight, fold) is fitted once at the most rounds and scored on the
    way; all of these fits, and the candidates for the refit, grow together.
    """
    spark = df.sparkSession
    folded = FE.fold_column(df, label, folds, seed, id_col)
    rounds = sorted(grid.get("rounds", [50]))
    points = [Boosting(depth=d, eta=e, pos_weight=float(w), rounds=rounds[-1], seed=seed, **settings)
              for d in grid.get("depth", [5]) for e in grid.get("eta", [0.05]) for w in grid.get("pos_weight", [1.0])]
    specs = [p for p in points for _ in range(folds)] + points  # the last ones learn from all rows
    uses = [F.col("fold") != k for _ in points for k in range(folds)] + [F.lit(True)] * len(points)
    holds = [F.col("fold") == k for _ in points for k in range(folds)] + [F.lit(False)] * len(points)
    fitted = fit_boosted(folded, features, label, id_col, specs, uses, holds, tuple(rounds))

    def f1(counts: tuple) -> float:
        tp, fp, fn = counts
        return 2.0 * tp / (2.0 * tp + fp + fn) if tp else 0.0

    results = []
    for p, point in enumerate(points):
        for r in rounds:
            by_fold = [f1(fitted.counts[r].get(p * folds + k, (0, 0, 0))) for k in range(folds)]
            results.append({"depth": point.depth, "rounds": r, "eta": point.eta, "pos_weight": point.pos_weight,
                            "f1": float(np.mean(by_fold))})
    best = max(range(len(results)), key=lambda k: results[k]["f1"])
    model = fitted.only(len(points) * folds + best // len(rounds), results[best]["rounds"])
    return spark.createDataFrame(results), model


def undersampled(df: DataFrame, label: str, ratio: float, seeds: list[int], id_col: str) -> list[Column]:
    """For each seed a condition that holds for all positives and for
    ``ratio`` times as many negatives, those with the smallest seeded hashes:
    the rows of ``features.undersample``, all draws found with one sort of the
    negatives near the cut."""
    sizes = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    need = int(sizes["p"] * ratio)
    positive, negative = F.col(label) == 1, F.col(label) == 0
    if need >= sizes["n"]:
        return [positive | negative for _ in seeds]
    if need == 0:
        return [positive for _ in seeds]
    share = min(1.0, (need + 6 * math.sqrt(need) + 20) / max(sizes["n"], 1))
    draws = F.array(*[F.struct(F.lit(k).alias("k"), FE.uniform_hash(id_col, s).alias("h")) for k, s in enumerate(seeds)])
    base = df.where(negative).select(F.col(id_col).alias("id"), F.explode(draws).alias("x")).select("id", "x.k", "x.h")
    near = base.where(F.col("h") < share)
    short = near.groupBy("k").count().where(F.col("count") >= need).count() < len(seeds)
    numbered = FE._numbered_within(base if short else near, ["k"], [F.col("h"), F.col("id")])
    cuts = {r["k"]: (r["h"], r["id"]) for r in numbered.where(F.col("_pos") == need).select("k", "h", "id").collect()}
    out = []
    for k, s in enumerate(seeds):
        h, at = cuts[k]
        u = FE.uniform_hash(id_col, s)
        out.append(positive | (negative & ((u < h) | ((u == h) & (F.col(id_col) <= F.lit(at))))))
    return out


def undersampled_ensemble(df: DataFrame, features: list[str], label: str, id_col: str,
                          n_models: int = 20, ratio: float = 1.0, depth: int = 5,
                          rounds: int = 100, eta: float = 0.05, seed: int = 1337, **settings) -> BoostedModels:
    """``n_models`` boosted models, each on all positives plus a seeded draw of
    ``ratio`` x as many negatives (L5), all fitted together."""
    seeds = [seed + i for i in range(n_models)]
    specs = [Boosting(depth=depth, rounds=rounds, eta=eta, seed=s, **settings) for s in seeds]
    return fit_boosted(df, features, label, id_col, specs, undersampled(df, label, ratio, seeds, id_col))


def ensemble_vote(models: BoostedModels, df: DataFrame, id_col: str, threshold: float = 0.5) -> DataFrame:
    """Mean positive probability of the ensemble and the 0/1 vote, in one pass."""
    mean = F.aggregate("probabilities", F.lit(0.0), lambda a, p: a + p) / F.size("probabilities")
    return (models.transform(df, id_col).select(id_col, mean.alias("probability"))
            .withColumn("prediction", (F.col("probability") >= threshold).cast("int")))


# --- L6 ---------------------------------------------------------------------
def decision_tree(df: DataFrame, features: list[str], label: str, depth: int = 3, seed: int = 0):
    data = assemble(df.dropna(subset=[*features, label]), features).withColumn(
        "_label", F.col(label).cast("double"))
    return DecisionTreeRegressor(featuresCol="features", labelCol="_label", maxDepth=depth,
                                 seed=seed).fit(data)


def tree_nodes(model, features: list[str]) -> DataFrame:
    """The fitted tree as a node table (L6): id, prediction, impurity, gain,
    children, split feature and threshold, read from the model's saved data."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "tree")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    names = F.array(*[F.lit(f) for f in features])
    feat = F.when(F.col("split.featureIndex") >= 0,
                  F.element_at(names, (F.col("split.featureIndex") + 1).cast("int")))
    return nodes.select("id", "prediction", "impurity", "gain", "leftChild", "rightChild",
                        feat.alias("feature"),
                        F.when(F.col("leftChild") >= 0,
                               F.element_at("split.leftCategoriesOrThreshold", 1)).alias("threshold"))


# --- L10, L11 ----------------------------------------------------------------
def pca_project(df: DataFrame, vec_col: str, k: int = 2, id_col: str | None = None) -> DataFrame:
    """Centred projection on the first k principal components."""
    d = df.select(F.size(vec_col)).first()[0]
    cols = [f"_x{i}" for i in range(d)]
    wide = df.select(*( [id_col] if id_col else []),
                     *[F.col(vec_col)[i].cast("double").alias(c) for i, c in enumerate(cols)])
    centred = _centre(wide, cols)
    vec = assemble(centred, cols, "_v")
    model = PCA(k=k, inputCol="_v", outputCol="_pc").fit(vec)
    out = model.transform(vec).withColumn("_pc", vector_to_array("_pc"))
    return out.select(*([id_col] if id_col else []),
                      *[F.col("_pc")[i].alias(f"pc{i + 1}") for i in range(k)])


def _centre(df: DataFrame, cols: list[str]) -> DataFrame:
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return df.withColumns({c: F.col(c) - F.lit(means[c]) for c in cols})


def gram_matrix(df: DataFrame, vec_col: str, d: int) -> np.ndarray:
    """X^T X of an array column, rebuilt from the JVM-side column statistics
    (Pearson correlation, mean and sample variance, two distributed passes):
    X^T X = (n - 1) Cov + n mu mu^T. Only d x d numbers reach the driver."""
    from pyspark.ml.stat import Correlation, Summarizer
    v = df.select(array_to_vector(F.transform(vec_col, lambda x: x.cast("double"))).alias("_v"))
    corr = Correlation.corr(v, "_v").first()[0].toArray()
    st = v.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("_v")).alias("s")).first()["s"]
    mu = np.asarray(st["mean"].toArray())
    sd = np.sqrt(np.asarray(st["variance"].toArray()))
    n = float(st["count"])
    cov = np.nan_to_num(corr) * np.outer(sd, sd)
    return (n - 1.0) * cov + n * np.outer(mu, mu)


def svd_project(df: DataFrame, vec_col: str, k: int = 2, id_col: str | None = None) -> DataFrame:
    """Uncentred truncated SVD projection X V_k (L11): V from the
    eigenvectors of the Gram matrix, signs fixed so each component's
    largest-magnitude loading is positive; projection is a built-in
    expression per row."""
    d = df.select(F.size(vec_col)).first()[0]
    g = gram_matrix(df, vec_col, d)
    vals, vecs = np.linalg.eigh(g)
    order = np.argsort(vals)[::-1][:k]
    v = vecs[:, order]
    for j in range(k):
        if v[np.argmax(np.abs(v[:, j])), j] < 0:
            v[:, j] = -v[:, j]
    comps = []
    for j in range(k):
        terms = [F.col(vec_col)[i].cast("double") * float(v[i, j]) for i in range(d)]
        expr = terms[0]
        for t in terms[1:]:
            expr = expr + t
        comps.append(expr.alias(f"sv{j + 1}"))
    return df.select(*([id_col] if id_col else []), *comps)


# --- L12-L15 recommender ----------------------------------------------------
def index_ratings(ratings: DataFrame, user: str = "user_id", item: str = "item_id"):
    """Dense integer ids for users and items (M4) joined onto the ratings. The
    ratings are written before and after, as every fit and score reads them."""
    plain = materialize(ratings, "ratings")
    uidx, r = FE.id_index(plain, user, "user_id_no")
    iidx, r = FE.id_index(r, item, "item_id_no")
    indexed = materialize(r, "indexed-ratings")
    discard(plain)
    return indexed, uidx, iidx


def als_fit(ratings: DataFrame, rank: int = 25, reg: float = 0.1, max_iter: int = 10,
            seed: int = 0, checkpoint_interval: int = 5):
    """Implicit, non-negative ALS, cold-start rows dropped (L12). Lineage is
    cut every ``checkpoint_interval`` iterations into the shared checkpoint
    folder."""
    ensure_checkpoint_dir(ratings.sparkSession)
    als = ALS(rank=rank, regParam=reg, maxIter=max_iter, nonnegative=True, implicitPrefs=True,
              userCol="user_id_no", itemCol="item_id_no", ratingCol="rating",
              coldStartStrategy="drop", checkpointInterval=checkpoint_interval, seed=seed)
    return als.fit(ratings)


def als_tune(indexed: DataFrame, ranks=(25, 50, 100), regs=(0.1, 0.01, 0.001), seed: int = 42,
             id_col: str = "_rid", max_iter: int = 10):
    """Rank x regularisation search on a 60/20/20 split; the model with the
    lowest validation MPR, fitted on the training part, wins (L13). Returns
    (scores, model, test part). The fits of a rank run side by side: none of
    them has enough tasks for all cores at every step."""
    from multiprocessing.pool import ThreadPool
    from pyspark import inheritable_thread_target
    spark = indexed.sparkSession
    keyed = indexed.withColumn(id_col, F.concat_ws(":", "user_id_no", "item_id_no"))
    train, valid, test = [p.persist() for p in FE.split_parts(keyed, [0.6, 0.2, 0.2], seed, id_col)]
    rows, best = [], None

    def scored(rank: int, reg: float) -> tuple:
        model = als_fit(train, rank, reg, max_iter, seed)
        pred = materialize(model.transform(valid).select("user_id_no", "rating", "prediction"), "als-scores")
        m = mean_percentile_rank(pred, "user_id_no", "rating", "prediction").first()[0]
        e = rmse(pred, "rating", "prediction").first()[0]
        discard(pred)
        return model, m, e

    for rank in ranks:
        with ThreadPool(max(1, len(regs))) as pool:
            found = pool.map(inheritable_thread_target(spark)(lambda reg, rank=rank: scored(rank, reg)), list(regs))
        for reg, (model, m, e) in zip(regs, found):
            rows.append({"rank": rank, "reg": reg, "mpr": m, "rmse": e})
            if m is not None and (best is None or m < best[0]):
                best = (m, model)
    if best is None:
        raise ValueError("no setting could be scored: the validation part has no user with a rated item")
    scores = spark.createDataFrame(rows)
    valid.unpersist()
    train.unpersist()
    return scores, best[1], test  # test stays cached for the caller's final scoring


def recommend_top(model, uidx: DataFrame, iidx: DataFrame, k: int = 100,
                  entity_type: str | None = None, keep_rank: bool = True) -> DataFrame:
    """Best k items per user with affinity, in original ids (L14), from an
    exact search that skips blocks of items by their norms (``topitems``)."""
    recs, _ = top_items(model.userFactors, model.itemFactors, k)
    recs = recs.select(F.col("user").cast("int").alias("user_id_no"), F.col("item").cast("int").alias("item_id_no"),
                       F.col("score").cast("float").alias("affinity"))
    out = recs.join(uidx, "user_id_no").join(iidx, "item_id_no")
    if keep_rank:
        from pyspark.sql import Window
        w = Window.partitionBy("user_id_no").orderBy(F.col("affinity").desc(), "item_id_no")
        out = out.withColumn("rank", F.dense_rank().over(w))
    cols = ["user_id", *(["entity_type"] if entity_type else []), "item_id", "affinity",
            *(["rank"] if keep_rank else [])]
    if entity_type:
        out = out.withColumn("entity_type", F.lit(entity_type))
    return out.select(*cols)


def export_factors(model, uidx: DataFrame, iidx: DataFrame) -> tuple[DataFrame, DataFrame]:
    """User and item factor vectors as text `[a,b,...]` with original ids."""
    users = (model.userFactors.join(uidx, uidx.user_id_no == model.userFactors.id)
             .select("user_id", S.array_to_string("features").alias("features_string")))
    items = (model.itemFactors.join(iidx, iidx.item_id_no == model.itemFactors.id)
             .select("item_id", S.array_to_string("features").alias("features_string")))
    return users, items


# --- L16 --------------------------------------------------------------------
def text_classifier(train: DataFrame, text: str, label: str, num_features: int = 1 << 18,
                    reg: float = 0.0, max_iter: int = 100):
    """Bag-of-words TF-IDF into multinomial logistic regression (L16, the
    Spark re-aim of the notebooks' word-vector networks). Labels are
    indexed alphabetically. Returns (pipeline model, label list).

    Texts are tokenised once: the two fits read them three times, so the term
    counts are kept on disk, in the texts' partitions and order."""
    labels = FE.category_values(train, label)
    data = train.withColumn("_y", F.array_position(F.array(*[F.lit(v) for v in labels]),
                                                   F.col(label)).cast("double") - 1)
    terms = Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tok", pattern=r"[\p{L}\p{N}_]{2,}", gaps=False,
                       toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features)]).fit(data)
    counted = terms.transform(data).select("_y", "_tf").persist(StorageLevel.DISK_ONLY)
    fits = Pipeline(stages=[
        IDF(inputCol="_tf", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="_y", regParam=reg, maxIter=max_iter,
                           family="multinomial")]).fit(counted)
    counted.unpersist()
    return PipelineModel([*terms.stages, *fits.stages]), labels


def classify_text(model, labels: list, df: DataFrame) -> DataFrame:
    out = model.transform(df)
    names = F.array(*[F.lit(v) for v in labels])
    return (out.withColumn("predicted", F.element_at(names, (F.col("prediction") + 1).cast("int")))
            .drop("_tok", "_tf", "features", "rawPrediction", "probability", "prediction"))


def mean_word_vectors(df: DataFrame, id_col: str, text_col: str, vectors: DataFrame,
                      out: str = "features") -> DataFrame:
    """Mean word vector per text (the embedding-layer re-aim of L16): tokens
    joined to the (word, vector) table, averaged per text component by
    component. Texts with no known word get no row.

    The vectors of the most frequent words (``BROADCAST_ROWS`` at most) are
    broadcast, so that a text's tokens are summed where the text is and one
    row of sums a text is shuffled; only tokens of other words are joined
    through a shuffle."""
    from tessera.operators.skew import BROADCAST_ROWS
    from tessera.operators.text import token_rows
    toks = token_rows(df, id_col, text_col).select(id_col, "word")
    vec = materialize(vectors.where(F.col("word").isNotNull() & F.col("vector").isNotNull())
                      .select("word", F.transform("vector", lambda x: x.cast("double")).alias("vector")), "word-vectors")
    sizes = vec.agg(F.count("*").alias("n"), F.min(F.size("vector")).alias("low"), F.max(F.size("vector")).alias("high")).first()
    if sizes["low"] != sizes["high"]:
        raise ValueError("word vectors of different lengths")
    if sizes["n"] <= BROADCAST_ROWS:
        known = toks.join(F.broadcast(vec), "word")
    else:
        counts = materialize(toks.groupBy("word").count().join(vec.select("word").distinct(), "word", "left_semi"), "word-counts")
        most = materialize(counts.orderBy(F.desc("count"), "word").limit(BROADCAST_ROWS // 2).select("word"), "words-most")
        few = vec.join(F.broadcast(most), "word", "left_semi")
        known = toks.join(F.broadcast(few), "word").unionByName(
            toks.join(F.broadcast(most), "word", "left_anti").join(vec.join(F.broadcast(most), "word", "left_anti"), "word"))
    d = sizes["high"] or 0
    means = known.groupBy(id_col).agg(F.count("*").alias("_n"), *[F.avg(F.get("vector", k)).alias(f"_{k}") for k in range(d)])
    return means.select(id_col, array_to_vector(F.array(*[f"_{k}" for k in range(d)]).cast("array<double>")).alias(out))


def vector_classifier(train: DataFrame, features: str, label: str, hidden: tuple[int, ...] = (32,),
                      max_iter: int = 100, seed: int = 0):
    """Dense layers on mean word vectors (L16): a multilayer perceptron with
    softmax output; labels indexed alphabetically. Returns (model, labels)."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    labels = FE.category_values(train, label)
    dim = len(train.select(features).first()[0])
    data = train.withColumn("_y", F.array_position(F.array(*[F.lit(v) for v in labels]),
                                                   F.col(label)).cast("double") - 1)
    mlp = MultilayerPerceptronClassifier(featuresCol=features, labelCol="_y",
                                         layers=[dim, *hidden, len(labels)], maxIter=max_iter, seed=seed)
    return mlp.fit(data), labels
