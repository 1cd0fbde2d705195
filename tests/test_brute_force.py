"""Rows-only operators against straightforward numpy / itertools versions on small fixtures."""

import itertools
import math

import numpy as np
import pandas as pd

from vantage.operators import clustering as CU
from vantage.operators import search as SE
from vantage.operators import sequences as SQ
from vantage.plans import fixtures as FX
from vantage.session import table


def _emb(spark, sf):
    rows = FX.emb(spark, sf).orderBy("vec_id").collect()
    return np.array([r["vec"] for r in rows]), np.array([r["y"] for r in rows], dtype=float)


def test_em_statistics_match_numpy(spark, sf):
    x, _ = _emb(spark, sf)
    rng = np.random.default_rng(0)
    k = 3
    w = np.array([0.2, 0.3, 0.5])
    mu = x[rng.choice(len(x), k, replace=False)]
    var = np.full((k, x.shape[1]), x.var(axis=0).mean())
    nk, sk, qk, ll, n = CU.gmm_stats(FX.emb(spark, sf), "vec", w, mu, var)
    logp = np.stack([np.log(w[c]) - 0.5 * np.sum(np.log(2 * math.pi * var[c]))
                     - 0.5 * np.sum((x - mu[c]) ** 2 / var[c], axis=1) for c in range(k)], axis=1)
    lse = np.logaddexp.reduce(logp, axis=1)
    r = np.exp(logp - lse[:, None])
    assert n == len(x)
    assert np.isclose(ll, lse.sum(), rtol=1e-10)
    assert np.allclose(nk, r.sum(0), rtol=1e-9)
    assert np.allclose(sk, r.T @ x, rtol=1e-9, atol=1e-9)
    assert np.allclose(qk, r.T @ (x * x), rtol=1e-9, atol=1e-9)


def test_population_score_matches_numpy(spark, sf):
    x, y = _emb(spark, sf)
    cands = SE.hashed_candidates(6, x.shape[1], seed=3)
    got = {r["candidate"]: (r["sse"], r["accuracy"])
           for r in SE.population_score(FX.emb(spark, sf), "vec", "y", cands).collect()}
    for c, w in enumerate(cands):
        e = x @ np.array(w) - y
        assert math.isclose(got[c][0], float((e * e).sum()), rel_tol=1e-9)
        assert math.isclose(got[c][1], float((np.abs(e) < 0.5).mean()), rel_tol=1e-12)


def test_chow_liu_tree_is_the_maximum_spanning_tree(spark, sf):
    cols = ["l_returnflag", "l_linestatus", "l_linenumber", "l_tax"]
    li = table(spark, sf, "lineitem").select(*cols)
    pdf = li.toPandas().astype(str)

    def mi(a, b):
        j = pd.crosstab(pdf[a], pdf[b]).to_numpy().astype(float)
        p = j / j.sum()
        pa, pb = p.sum(1, keepdims=True), p.sum(0, keepdims=True)
        nz = p > 0
        return float((p[nz] * np.log(p[nz] / (pa @ pb)[nz])).sum())

    weights = {(a, b): mi(a, b) for a, b in itertools.combinations(cols, 2)}
    best, best_w = None, -1.0
    for edges in itertools.combinations(weights, len(cols) - 1):
        parent = {c: c for c in cols}

        def find(u):
            while parent[u] != u:
                u = parent[u]
            return u

        ok = True
        for a, b in edges:
            ra, rb = find(a), find(b)
            if ra == rb:
                ok = False
                break
            parent[ra] = rb
        if ok and sum(weights[e] for e in edges) > best_w + 1e-12:
            best, best_w = set(edges), sum(weights[e] for e in edges)
    got = {(r["col_a"], r["col_b"]) for r in SQ.chow_liu_tree(SQ.pairwise_mutual_information(li, cols)).collect()}
    assert got == best
