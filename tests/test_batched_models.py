"""Batched model loops against plain numpy or the single versions."""

import numpy as np
from pyspark.sql import functions as F

from vantage.operators import clustering as CU
from vantage.operators import neighbors as NB
from vantage.operators import projection as PJ
from vantage.operators.linalg import BLOCK, reduce_partials
from vantage.plans import fixtures as FX


def _data(spark, sf):
    e = FX.emb(spark, sf).select("vec_id", "vec", "label", "y")
    return e, np.array([r["vec"] for r in e.orderBy("vec_id").collect()])


def test_long_partials_are_summed_in_blocks(spark):
    n = 3 * BLOCK + 5
    got = reduce_partials(spark.range(100).repartition(7), lambda pdf: np.arange(n) * float(len(pdf)), n)
    assert np.array_equal(got, np.arange(n) * 100.0)


def test_kmeans_batch_reaches_fixed_points(spark, sf):
    e, x = _data(spark, sf)
    fits = CU.kmeans_batch(e, "vec", "vec_id", [2, 5, 9], n_init=3, tol=0.0)
    costs = []
    for k, m in fits.items():
        d2 = ((x[:, None, :] - m["c"][None]) ** 2).sum(-1)
        lab = d2.argmin(1)
        assert abs(d2.min(1).sum() - m["cost"]) < 1e-6
        for c in range(k):
            if (lab == c).any():
                assert np.allclose(x[lab == c].mean(0), m["c"][c], atol=1e-9)
        costs.append(m["cost"])
    assert costs == sorted(costs, reverse=True)


def test_gmm_batch_raises_the_likelihood(spark, sf):
    e, x = _data(spark, sf)
    start = {k: x[:k] for k in (2, 4)}
    short, long = CU.gmm_batch(e, "vec", start, max_iter=2, tol=0.0), CU.gmm_batch(e, "vec", start, max_iter=15, tol=0.0)
    for k in (2, 4):
        p = long[k]
        ld = CU._log_dens(x, p["weights"], p["means"], p["vars"])
        assert abs(np.logaddexp.reduce(ld, axis=1).sum() - p["loglik"]) < 1e-6 * abs(p["loglik"])
        assert long[k]["loglik"] > short[k]["loglik"]


def test_scores_match_the_single_operators(spark, sf):
    from vantage.functions.vectors import argmin_dist, lit_matrix
    from vantage.operators import metrics as M
    e, _ = _data(spark, sf)
    fits = CU.kmeans_batch(e, "vec", "vec_id", [4, 7], n_init=2)
    scores = CU.clustering_scores(e, "vec", "label", "y", fits, CU.assign_centres)
    for k, m in fits.items():
        a = e.withColumn("c", argmin_dist(lit_matrix(m["c"].tolist()), "vec"))
        assert abs(M.homogeneity(a, "c", "label").first()[0] - scores[k]["homogeneity"]) < 1e-9
        assert abs(NB.silhouette_sq(a, "c", "vec").first()[0] - scores[k]["silhouette"]) < 1e-9


def test_rca_sweep_matches_the_pair_statistic(spark, sf):
    e, _ = _data(spark, sf)
    got = {(r["dim"], r["seed"]): r["r"] for r in PJ.rca_sweep(e, "vec", [2, 8], [0, 1]).collect()}
    for (k, s), r in got.items():
        p = PJ.project(e, "vec", PJ.sparse_projection_matrix(64, k, seed=s), out="p")
        assert abs(NB.distance_correlation_sq(p, "vec", "p").first()[0] - r) < 1e-8


def test_kurtosis_curve_matches_pandas(spark, sf):
    import pandas as pd
    e, x = _data(spark, sf)
    fits = PJ.ica_sweep(e, "vec", [2, 5], max_iter=30)
    for r in PJ.kurtosis_curve(e, "vec", fits).collect():
        y = (x - fits[r["dim"]]["mean"]) @ fits[r["dim"]]["unmixing"].T
        assert abs(pd.DataFrame(y).kurt(axis=0).abs().mean() - r["kurtosis_abs_mean"]) < 1e-6
        assert np.allclose(np.cov(y.T), np.eye(r["dim"]), atol=1e-6)
    assert e.where(F.col("vec").isNull()).count() == 0


def test_network_search_scores_and_improves(spark, sf):
    from vantage.operators import search as SE
    e, x = _data(spark, sf)
    y = np.array([r["y"] for r in e.orderBy("vec_id").collect()], float)
    pop = np.random.default_rng(1).normal(size=(3, SE.network_size(64, 4)))
    sse, acc = SE.network_scores(e, "vec", "y", pop, 4)
    for i in range(3):
        p = SE.network_forward(x, pop[i], 4)
        assert abs(((p - y) ** 2).sum() - sse[i]) < 1e-8 and abs((np.abs(p - y) < 0.5).mean() - acc[i]) < 1e-12
    r = SE.search_report(e, e, "vec", "y", 64, 4, [1, 6], [(10.0, 0.9)], [(8, 4, 2)]).where("split = 'train'").collect()
    by = {(x["algo"], x["budget"]): x["sse"] for x in r}
    assert len(by) == 6 and all(by[a, 6] <= by[a, 1] for a in ("hill_climb", "anneal", "genetic"))
