"""Fitted models checked by invariants (their exact values have no SQL twin)."""

import numpy as np
from pyspark.sql import functions as F

from vantage.operators import clustering as CU
from vantage.operators import projection as PJ
from vantage.operators.linalg import covariance
from vantage.plans import fixtures as FX


def test_em_loglik_does_not_decrease(spark, sf):
    e = FX.emb(spark, sf).persist()
    p = CU.gmm_diag_fit(e, "vec", 3, max_iter=1)
    lls = []
    w, mu, var = p["weights"], p["means"], p["vars"]
    for _ in range(4):
        nk, sk, qk, ll, n = CU.gmm_stats(e, "vec", w, mu, var)
        lls.append(ll)
        w, mu, var = CU.gmm_m_step(nk, sk, qk, n)
    assert all(b >= a - 1e-6 * abs(a) for a, b in zip(lls, lls[1:]))


def test_lloyd_step_does_not_increase_cost(spark, sf):
    e = FX.emb(spark, sf)
    cen = [r["vec"] for r in e.orderBy("vec_id").limit(5).collect()]
    s1 = CU.kmeans_step(e, "vec", cen)
    c1 = s1.groupBy("cluster").agg(F.first("cost").alias("c")).agg(F.sum("c")).first()[0]
    new = {}
    for r in s1.collect():
        new.setdefault(r["cluster"], {})[r["dim"]] = r["value"]
    cen2 = [[new[k][j] for j in sorted(new[k])] for k in sorted(new)]
    c2 = CU.kmeans_step(e, "vec", cen2).groupBy("cluster").agg(F.first("cost").alias("c")).agg(F.sum("c")).first()[0]
    assert c2 <= c1 + 1e-9


def test_pca_ratios_sum_to_one_and_match_numpy(spark, sf):
    e = FX.emb(spark, sf)
    fit = PJ.pca_fit(e, "vec")
    assert abs(fit["explained_ratio"].sum() - 1) < 1e-9
    x = np.array([r["vec"] for r in e.collect()])
    lam = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert np.allclose(fit["explained_variance"], lam, atol=1e-10)


def test_covariance_matches_numpy(spark, sf):
    e = FX.emb(spark, sf)
    n, mu, cov = covariance(e, "vec")
    x = np.array([r["vec"] for r in e.collect()])
    assert n == len(x) and np.allclose(cov, np.cov(x.T), atol=1e-12)


def test_ica_components_are_whitened(spark, sf):
    e = FX.emb(spark, sf)
    fit = PJ.ica_fit(e, "vec", 4, max_iter=50)
    p = PJ.project(e, "vec", fit["unmixing"], fit["mean"], "ic")
    z = np.array([r["ic"] for r in p.collect()])
    assert np.allclose(np.cov(z.T), np.eye(4), atol=1e-6)


def test_forest_importances_sum_to_one(spark, sf):
    t = PJ.rf_feature_select(FX.emb(spark, sf), "vec", "y", num_trees=10)
    assert abs(t.agg(F.sum("importance")).first()[0] - 1) < 1e-9
