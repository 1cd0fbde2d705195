"""Supervised estimators on ``pyspark.ml`` plus kernel feature maps, sweeps, CV, learning curves.

Kernel SVMs become linear SVMs over explicit feature maps computed as JVM
column expressions: random Fourier features for the RBF kernel (Rahimi &
Recht, 2007) and landmark (Nystroem-style) features for the sigmoid kernel.
"""

from __future__ import annotations

import math
import time
from typing import Callable, Sequence

import numpy as np
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash32
from ..functions.vectors import dot, lit_matrix, lit_vector
from . import metrics as M
from .machines import fourier_normals
from .prep import levels


def ml_frame(df: DataFrame, vec: str, label: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, array_to_vector(F.col(vec)).alias("features"), F.col(label).cast("double").alias("label"))


def tree(max_depth: int = 5, min_leaf: int = 1, seed: int = 100):
    return DecisionTreeClassifier(impurity="entropy", maxDepth=max_depth, minInstancesPerNode=min_leaf, seed=seed)


def gbt(n_estimators: int = 20, max_depth: int = 3, min_leaf: int = 1, learning_rate: float = 0.1, seed: int = 100):
    return GBTClassifier(maxIter=n_estimators, maxDepth=max_depth, minInstancesPerNode=min_leaf,
                         stepSize=learning_rate, seed=seed)


MAX_DEPTH = 30   # the engine's limit; the studied forests grow without one


def random_forest(n_trees: int = 100, min_leaf: int = 1, seed: int = 100, max_depth: int = MAX_DEPTH):
    return RandomForestClassifier(numTrees=n_trees, minInstancesPerNode=min_leaf, maxDepth=max_depth, seed=seed)


def mlp(layers: Sequence[int], max_iter: int = 200, step: float = 0.03, seed: int = 100, solver: str = "l-bfgs"):
    """Sigmoid hidden layers + softmax output (Spark has no Adam; l-bfgs or gd)."""
    return MultilayerPerceptronClassifier(layers=list(layers), maxIter=max_iter, stepSize=step, seed=seed, solver=solver)


def linear_svc(c: float = 1.0, n: int = 1, max_iter: int = 100):
    """``C`` (soft margin) maps to ``regParam = 1 / (C n)``."""
    return LinearSVC(regParam=1.0 / (c * max(n, 1)), maxIter=max_iter)


def rff_map(df: DataFrame, vec: str, d: int, n_features: int = 128, gamma: float = 1.0, seed: int = 0,
            out: str = "rff") -> DataFrame:
    """Random Fourier features ``sqrt(2/D) cos(W x + b)``, ``W ~ N(0, 2 gamma)``, ``b ~ U(0, 2 pi)``."""
    W, b = fourier_normals(d, n_features, seed)
    W = math.sqrt(2 * gamma) * W
    Wl, bl = lit_matrix(W.tolist()), lit_vector(b.tolist())
    scale = math.sqrt(2.0 / n_features)
    return df.withColumn(out, F.transform(Wl, lambda w, i: F.lit(scale) * F.cos(dot(w, vec) + F.element_at(bl, i + 1))))


def sigmoid_map(df: DataFrame, vec: str, id_col: str, n_landmarks: int = 32, gamma: float = 0.1, coef0: float = 0.0,
                seed: int = 0, out: str = "sigf") -> DataFrame:
    """Kernel features ``tanh(gamma x.l + coef0)`` against landmarks chosen by lowest row hash (bounded count)."""
    lm = [list(r[vec]) for r in df.select(vec, hash32(F.lit(f"lm{seed}"), F.col(id_col)).alias("_h"), id_col)
          .orderBy("_h", id_col).limit(n_landmarks).collect()]
    L = lit_matrix(lm)
    return df.withColumn(out, F.transform(L, lambda l: F.tanh(F.lit(gamma) * dot(l, vec) + F.lit(coef0))))


def fit_predict(est, train: DataFrame, test: DataFrame, keep: Sequence[str] = ()):
    t0 = time.time()
    model = est.fit(train)
    fit_s = time.time() - t0
    pred = model.transform(test).select(*keep, "label", F.col("prediction"))
    return model, pred, fit_s


def complexity_curve(make: Callable[[object], object], values: Sequence, train: DataFrame, test: DataFrame,
                     param: str = "param") -> DataFrame:
    """F1 on the train and test split for each hyper-parameter value (long table)."""
    spark = train.sparkSession
    rows = []
    for v in values:
        model = make(v).fit(train)
        for split, frame in (("train", train), ("test", test)):
            r = M.metric_report(model.transform(frame), "label", "prediction", positive=1.0).first()
            rows.append((str(v), split, float(r["f1"]), float(r["accuracy"])))
    return spark.createDataFrame(rows, f"{param} string, split string, f1 double, accuracy double")


def grid_search_cv(est, grid: dict, data: DataFrame, k: int, fold_col: str = "fold", parallelism: int = 4) -> DataFrame:
    """Exhaustive CV with a precomputed (stratified, hashed) fold column; accuracy is the score.

    Returns one row per grid point with its mean accuracy and a ``best`` flag
    (first grid point on ties).
    """
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(name), list(values))
    maps = b.build()
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps,
                        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
                        numFolds=k, foldCol=fold_col, parallelism=parallelism)
    model = cv.fit(data)
    best = int(np.argmax(model.avgMetrics))
    rows = [(i, ", ".join(f"{p.name}={v}" for p, v in m.items()), float(s), i == best)
            for i, (m, s) in enumerate(zip(maps, model.avgMetrics))]
    return data.sparkSession.createDataFrame(rows, "grid_idx int, params string, mean_accuracy double, best boolean")


def learning_curve(make: Callable[[], object], data: DataFrame, id_col: str, fractions: Sequence[float],
                   k: int = 3, seed: int = 0) -> DataFrame:
    """Train / CV F1 (mean, population std) and fit seconds per training-set size.

    Each size is an exact-size bootstrap draw; folds are assigned on the *source*
    row id, so copies of one row never sit on both sides of a split.
    """
    from .sampling import bootstrap_sample, kfold_assign
    spark = data.sparkSession
    n = data.count()
    folds = kfold_assign(data, id_col, k, label_col="label", seed=seed).persist()
    rows = []
    for frac in fractions:
        size = max(2, int(n * frac))
        sample = bootstrap_sample(folds, id_col, size=size, seed=seed + 1).persist()
        tr_scores, cv_scores, fit_times = [], [], []
        for f in range(k):
            tr = sample.where(F.col("fold") != f)
            te = folds.where(F.col("fold") == f)
            t0 = time.time()
            model = make().fit(tr)
            fit_times.append(time.time() - t0)
            tr_scores.append(float(M.metric_report(model.transform(tr), "label", "prediction", 1.0).first()["f1"]))
            cv_scores.append(float(M.metric_report(model.transform(te), "label", "prediction", 1.0).first()["f1"]))
        rows.append((size, float(np.mean(tr_scores)), float(np.std(tr_scores)), float(np.mean(cv_scores)),
                     float(np.std(cv_scores)), float(np.mean(fit_times))))
    return spark.createDataFrame(rows, "train_size int, train_f1_mean double, train_f1_std double, "
                                       "cv_f1_mean double, cv_f1_std double, fit_seconds double")


def knn_grid_search_cv(df: DataFrame, id_col: str, vec: str, label: str, fold_col: str, ks: Sequence[int]) -> DataFrame:
    """Exact k-fold CV accuracy of the kNN vote for every ``k`` in ``ks``.

    One exact kNN join per fold at ``max(ks)``; the vote for each smaller k is
    read off the same ranked neighbour lists (ties -> lowest label).  Output
    ``(k, mean_accuracy, best)`` with the first k winning ties.
    """
    from .neighbors import knn_join

    kmax = max(ks)
    folds = levels(df, fold_col)
    per_fold = []
    for f in folds:
        qy = df.where(F.col(fold_col) == f).select(F.col(id_col).alias("qid"), F.col(vec).alias("vec"),
                                                   F.col(label).alias("truth"))
        base = df.where(F.col(fold_col) != f).select(F.col(id_col).alias("bid"), F.col(vec).alias("vec"),
                                                     F.col(label).alias("nl"))
        nb = knn_join(qy.select("qid", "vec"), base.select("bid", "vec"), kmax).join(base.select("bid", "nl"), "bid")
        pred = knn_votes_by_k(nb, ks)
        acc = pred.join(qy.select("qid", "truth"), "qid").groupBy("k").agg(
            F.avg((F.col("pred") == F.col("truth")).cast("double")).alias("acc"))
        per_fold.append(acc.withColumn("fold", F.lit(f)))
    allf = per_fold[0]
    for a in per_fold[1:]:
        allf = allf.unionByName(a)
    res = allf.groupBy("k").agg(F.avg("acc").alias("mean_accuracy"))
    best = res.agg(F.min_by("k", F.struct((-F.col("mean_accuracy")).alias("a"), F.col("k"))).alias("bk")).first()["bk"]
    return res.withColumn("best", F.col("k") == F.lit(best))


def knn_votes_by_k(nb: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Majority label among the first ``k`` ranked neighbours for every ``k`` in ``ks``.

    ``nb`` holds ``(qid, rank, nl)`` (neighbour label).  Each neighbour row fans
    out to the k values it counts for (bounded by ``len(ks)``); ties go to the
    lowest label.  Output ``(k, qid, pred)``.
    """
    fan = nb.select("qid", "rank", "nl", F.explode(F.array(*[F.lit(int(k)) for k in ks])).alias("k")).where(
        F.col("rank") <= F.col("k"))
    votes = fan.groupBy("k", "qid", "nl").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy("k", "qid").agg(F.max_by("nl", F.struct("n", (-F.col("nl")).alias("_l"))).alias("pred"))


def knn_complexity_curve(train: DataFrame, test: DataFrame, id_col: str, vec: str, label: str,
                         ks: Sequence[int]) -> DataFrame:
    """F1 (positive = 1) of the kNN vote on the train and the test rows for every ``k``; base = train rows.

    One exact kNN join per split at ``max(ks)``.  Output ``(k, split, f1)``.
    """
    from .neighbors import knn_join

    kmax = max(ks)
    base = train.select(F.col(id_col).alias("bid"), F.col(vec).alias("vec"), F.col(label).alias("nl"))
    out = None
    for split, frame in (("train", train), ("test", test)):
        qy = frame.select(F.col(id_col).alias("qid"), F.col(vec).alias("vec"), F.col(label).alias("truth"))
        nb = knn_join(qy.select("qid", "vec"), base.select("bid", "vec"), kmax).join(base.select("bid", "nl"), "bid")
        pred = knn_votes_by_k(nb, ks).join(qy.select("qid", "truth"), "qid")
        t, p = F.col("truth") == 1, F.col("pred") == 1
        f1 = pred.groupBy("k").agg(
            F.sum((t & p).cast("bigint")).alias("tp"), F.sum((~t & p).cast("bigint")).alias("fp"),
            F.sum((t & ~p).cast("bigint")).alias("fn")).select(
            "k", F.lit(split).alias("split"),
            F.coalesce(F.try_divide((2 * F.col("tp")).cast("double"),
                                    (2 * F.col("tp") + F.col("fp") + F.col("fn")).cast("double")), F.lit(0.0)).alias("f1"))
        out = f1 if out is None else out.unionByName(f1)
    return out


def knn_learning_curve(data: DataFrame, id_col: str, vec: str, label: str, fractions: Sequence[float],
                       k: int = 5, folds: int = 3, seed: int = 0) -> DataFrame:
    """Exact kNN learning curve: train / CV F1 (mean, population std) per training size.

    Folds are assigned on the source rows (stratified); each size is an
    exact-size hashed bootstrap draw; the CV side scores the source rows of the
    held-out fold, the train side scores every draw of the training sample.
    """
    from .neighbors import knn_join
    from .sampling import bootstrap_sample, kfold_assign

    src = kfold_assign(data.select(id_col, vec, label), id_col, folds, label_col=label, seed=seed).persist()
    n = src.count()
    out = []
    for frac in fractions:
        size = max(2, int(n * frac))
        sample = bootstrap_sample(src, id_col, size=size, seed=seed + 1).persist()
        for f in range(folds):
            tr = sample.where(F.col("fold") != f).select(F.col("draw").alias("bid"), F.col(vec).alias("vec"),
                                                         F.col(label).alias("nl"))
            # both sides in one join: train draws get even query ids, held-out source rows odd ones
            qy = tr.select((F.col("bid") * 2).alias("qid"), "vec", F.col("nl").alias("truth"),
                           F.lit("train").alias("side")).unionByName(
                src.where(F.col("fold") == f).select((F.col(id_col) * 2 + 1).alias("qid"), F.col(vec).alias("vec"),
                                                     F.col(label).alias("truth"), F.lit("cv").alias("side")))
            nb = knn_join(qy.select("qid", "vec"), tr.select("bid", "vec"), k).join(tr.select("bid", "nl"), "bid")
            pred = knn_votes_by_k(nb, [k]).join(qy.select("qid", "truth", "side"), "qid")
            t, p = F.col("truth") == 1, F.col("pred") == 1
            out.append(pred.groupBy("side").agg(
                F.sum((t & p).cast("bigint")).alias("tp"), F.sum((~t & p).cast("bigint")).alias("fp"),
                F.sum((t & ~p).cast("bigint")).alias("fn")).select(
                F.lit(size).alias("train_size"), F.lit(f).alias("fold"), "side",
                F.coalesce(F.try_divide((2 * F.col("tp")).cast("double"),
                                        (2 * F.col("tp") + F.col("fp") + F.col("fn")).cast("double")),
                           F.lit(0.0)).alias("f1")))
    allf = out[0]
    for o in out[1:]:
        allf = allf.unionByName(o)
    g = allf.groupBy("train_size", "side").agg(F.avg("f1").alias("m"), F.stddev_pop("f1").alias("s"))
    return g.groupBy("train_size").agg(
        F.max(F.when(F.col("side") == "train", F.col("m"))).alias("train_f1_mean"),
        F.max(F.when(F.col("side") == "train", F.col("s"))).alias("train_f1_std"),
        F.max(F.when(F.col("side") == "cv", F.col("m"))).alias("cv_f1_mean"),
        F.max(F.when(F.col("side") == "cv", F.col("s"))).alias("cv_f1_std"))
