"""Dimensionality reduction: PCA, FastICA, sparse / Gaussian random projection, forest selection.

Data-sized work is one or two passes per fit (moment matrices by per-task
partial sums); eigen-decompositions and ICA updates act on ``d x d`` matrices
on the driver.  Projections are JVM column expressions over literal matrices.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import py_hash_unit
from ..functions.vectors import dot, lit_matrix, lit_vector
from .linalg import covariance, gathered, gram, pack_rows, reduce_packed, reduce_partials, stack_vectors


def project(df: DataFrame, vec: str, mat, centre=None, out: str = "proj") -> DataFrame:
    """``out = mat @ (vec - centre)`` as an array column (``mat`` rows = output components)."""
    v = F.col(vec)
    if centre is not None:
        v = F.zip_with(v, lit_vector(list(map(float, centre))), lambda a, b: a - b)
    M = lit_matrix(np.asarray(mat, float).tolist())
    return df.withColumn(out, F.transform(M, lambda row: dot(row, v)))


def pca_fit(df: DataFrame, vec: str) -> dict:
    """All components of the centred data: ratios, variances, singular values (= sqrt(lambda (n-1)))."""
    n, mu, cov = covariance(df, vec)
    lam, vecs = np.linalg.eigh(cov)
    order = np.argsort(lam)[::-1]
    lam, vecs = np.maximum(lam[order], 0.0), vecs[:, order]
    # deterministic sign: largest-magnitude loading positive
    signs = np.sign(vecs[np.argmax(np.abs(vecs), axis=0), range(vecs.shape[1])])
    vecs = vecs * np.where(signs == 0, 1, signs)
    return {"n": n, "mean": mu, "components": vecs.T, "explained_variance": lam,
            "explained_ratio": lam / lam.sum() if lam.sum() > 0 else lam,
            "singular_values": np.sqrt(lam * max(n - 1, 0))}


def pca_table(spark, fit: dict) -> DataFrame:
    rows = [(i, float(r), float(c), float(v), float(s)) for i, (r, c, v, s) in enumerate(zip(
        fit["explained_ratio"], np.cumsum(fit["explained_ratio"]), fit["explained_variance"], fit["singular_values"]))]
    return spark.createDataFrame(rows, "component int, ratio double, cum_ratio double, variance double, singular_value double")


def pca_project(df: DataFrame, vec: str, fit: dict, k: int, out: str = "proj") -> DataFrame:
    return project(df, vec, fit["components"][:k], fit["mean"], out)


def _sym_decorrelate(w: np.ndarray) -> np.ndarray:
    s, u = np.linalg.eigh(w @ w.T)
    return (u * (1.0 / np.sqrt(np.maximum(s, 1e-12)))) @ u.T @ w


def ica_sweep(df: DataFrame, vec: str, dims: Sequence[int], seed: int = 0, max_iter: int = 200,
              tol: float = 1e-4) -> dict[int, dict]:
    """FastICA (symmetric, logcosh contrast) for every number of leading whitened components in ``dims``.

    The whitening of m components is the first m rows of the full one, so one scan per iteration computes
    ``E[z g(Wz)^T]`` and ``E[g'(Wz)]`` for all sizes that have not settled.
    """
    n, mu, cov = covariance(df, vec)
    lam, e = np.linalg.eigh(cov)
    order = np.argsort(lam)[::-1][:max(dims)]
    white = (e[:, order] / np.sqrt(np.maximum(lam[order], 1e-12))).T       # m x d whitening
    kept = pack_rows(project(df.select(vec), vec, white, mu, "_z").select("_z"), ["_z"]).persist()
    try:
        data = gathered(kept)
        fits = {m: {"w": _sym_decorrelate(np.random.default_rng(seed).normal(size=(m, m))), "iterations": 0} for m in dims}
        live = list(dims)
        for it in range(1, max_iter + 1):
            ws = [fits[m]["w"] for m in live]

            def fn(mats, nums, ws=ws):
                z = mats[0]
                out = []
                for w in ws:
                    zm = z[:, :len(w)]
                    g = np.tanh(zm @ w.T)
                    out += [(g.T @ zm).ravel(), (1 - g * g).sum(0)]
                return np.concatenate([*out, [z.shape[0]]])

            tot, at, moving = reduce_packed(data, fn, sum(m * m + m for m in live) + 1), 0, []
            cnt = max(tot[-1], 1.0)
            for m in live:
                gz = tot[at:at + m * m].reshape(m, m) / cnt
                gp = tot[at + m * m:at + m * m + m] / cnt
                at += m * m + m
                w = fits[m]["w"]
                new = _sym_decorrelate(gz - gp[:, None] * w)
                fits[m].update(w=new, iterations=it)
                if float(np.max(np.abs(np.abs(np.einsum("ij,ij->i", new, w)) - 1))) >= tol:
                    moving.append(m)
            live = moving
            if not live:
                break
        return {m: {"n": n, "mean": mu, "unmixing": f["w"] @ white[:m], "iterations": f["iterations"]} for m, f in fits.items()}
    finally:
        kept.unpersist()


def kurtosis_curve(df: DataFrame, vec: str, fits: dict[int, dict]) -> DataFrame:
    """``(dim, kurtosis_abs_mean, iterations)``: mean |sample excess kurtosis| of each fit's components, one scan for all."""
    sizes = list(fits)
    length = sum(4 * m for m in sizes) + 1

    def fn(pdf):
        x = stack_vectors(pdf["_v"])
        out = []
        for m in sizes:
            y = (x - fits[m]["mean"]) @ fits[m]["unmixing"].T
            out += [(y ** p).sum(0) for p in (1, 2, 3, 4)]
        return np.concatenate([*out, [len(x)]])

    tot = reduce_partials(df.select(F.col(vec).alias("_v")), fn, length)
    n, at, rows = tot[-1], 0, []
    for m in sizes:
        e1, e2, e3, e4 = tot[at:at + 4 * m].reshape(4, m) / max(n, 1)
        at += 4 * m
        m2 = e2 - e1 ** 2
        m4 = e4 - 4 * e1 * e3 + 6 * e1 ** 2 * e2 - 3 * e1 ** 4
        k = None
        if n > 3 and (m2 > 0).all():
            k = float(np.abs((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (m4 / m2 ** 2 - 3) + 6)).mean())
        rows.append((int(m), k, int(fits[m]["iterations"])))
    return df.sparkSession.createDataFrame(rows, "dim int, kurtosis_abs_mean double, iterations int")


def ica_fit(df: DataFrame, vec: str, m: int, seed: int = 0, max_iter: int = 200, tol: float = 1e-4) -> dict:
    """FastICA on the ``m`` leading whitened components."""
    return ica_sweep(df, vec, [m], seed, max_iter, tol)[m]


def rca_sweep(df: DataFrame, vec: str, dims: Sequence[int], seeds: Sequence[int]) -> DataFrame:
    """Distance correlation (squared distances, all pairs) of every sparse random projection: ``(dim, seed, r)``.

    With ``y = Rx`` all sums over pairs follow from one moment matrix of ``[1, x, |x|^2, |y|^2 of each projection]``
    on centred rows: two scans for the whole sweep.
    """
    g = gram(df, vec)
    n = g[0, 0]
    mu = g[0, 1:] / max(n, 1)
    d = len(mu)
    plans = [(k, s, sparse_projection_matrix(d, k, seed=s)) for k in dims for s in seeds]
    size = 2 + d + len(plans)

    def fn(pdf):
        x = stack_vectors(pdf["_v"]) - mu
        z = np.hstack([np.ones((len(x), 1)), x, (x * x).sum(1)[:, None],
                       *[((x @ r.T) ** 2).sum(1)[:, None] for _, _, r in plans]])
        return (z.T @ z).ravel()

    m = reduce_partials(df.select(F.col(vec).alias("_v")), fn, size * size).reshape(size, size)
    sx, xx = m[0, 1:1 + d], m[1:1 + d, 1:1 + d]
    ia = 1 + d
    a, aa, ax = m[0, ia], m[ia, ia], m[ia, 1:1 + d]
    rows = []
    for i, (k, s, r) in enumerate(plans):
        ib = ia + 1 + i
        b, bb, ab, bx = m[0, ib], m[ib, ib], m[ia, ib], m[ib, 1:1 + d]
        sy, yy, xy, ay, by = r @ sx, r @ xx @ r.T, xx @ r.T, r @ ax, r @ bx
        s1, s2 = 2 * n * a - 2 * sx @ sx, 2 * n * b - 2 * sy @ sy
        s11 = 2 * n * aa + 2 * a * a - 8 * ax @ sx + 4 * (xx * xx).sum()
        s22 = 2 * n * bb + 2 * b * b - 8 * by @ sy + 4 * (yy * yy).sum()
        s12 = 2 * n * ab + 2 * a * b - 4 * ay @ sy - 4 * bx @ sx + 4 * (xy * xy).sum()
        nn = n * n
        den = math.sqrt(max(nn * s11 - s1 * s1, 0.0) * max(nn * s22 - s2 * s2, 0.0))
        rows.append((int(k), int(s), float((nn * s12 - s1 * s2) / den) if den > 0 else None))
    return df.sparkSession.createDataFrame(rows, "dim int, seed int, r double")


def sparse_projection_matrix(d: int, k: int, seed: int = 0, density: float | None = None) -> np.ndarray:
    """Hashed sparse sign matrix (k x d): +-sqrt(s/k) with probability 1/(2s) each, else 0; s = 1/density.

    Entry (j, i) uses ``u = hash_unit('rca', seed, i, j)``, so SQL can rebuild it.
    """
    s = 1.0 / density if density else math.sqrt(d)
    val = math.sqrt(s / k)
    out = np.zeros((k, d))
    for i in range(d):
        for j in range(k):
            u = py_hash_unit("rca", seed, i, j)
            out[j, i] = val if u < 1 / (2 * s) else (-val if u < 1 / s else 0.0)
    return out


def gaussian_projection_matrix(d: int, k: int, seed: int = 0) -> np.ndarray:
    """N(0, 1/k) entries from hashed Box-Muller draws (reproducible in SQL):
    ``sqrt(-2 ln(1 - u1)) cos(2 pi u2) / sqrt(k)`` with ``u1, u2 = hash_unit('grp', seed, i, j, 1|2)``."""
    out = np.zeros((k, d))
    for i in range(d):
        for j in range(k):
            u1 = py_hash_unit("grp", seed, i, j, 1)
            u2 = py_hash_unit("grp", seed, i, j, 2)
            out[j, i] = math.sqrt(-2.0 * math.log(1.0 - u1)) * math.cos(2.0 * math.pi * u2) / math.sqrt(k)
    return out


def rf_feature_select(df: DataFrame, vec: str, label: str, names: list[str] | None = None, num_trees: int = 500,
                      min_leaf_frac: float = 0.01, seed: int = 0, keep: float = 0.95,
                      max_depth: int = 30) -> DataFrame:
    """Random-forest importances, sorted, with the running sum; rows with cumulative <= ``keep`` are selected."""
    n = df.count()
    data = df.select(array_to_vector(F.col(vec)).alias("features"), F.col(label).cast("double").alias("label"))
    rf = RandomForestClassifier(numTrees=num_trees, minInstancesPerNode=max(1, int(n * min_leaf_frac)), seed=seed,
                                maxDepth=max_depth, featureSubsetStrategy="sqrt")
    imp = rf.fit(data).featureImportances.toArray()
    names = names or [f"f{i}" for i in range(len(imp))]
    t = df.sparkSession.createDataFrame([(i, names[i], float(v)) for i, v in enumerate(imp)],
                                        "feature int, name string, importance double")
    w = Window.orderBy(F.desc("importance"), "feature").rowsBetween(Window.unboundedPreceding, 0)
    return t.withColumn("cum", F.sum("importance").over(w)).withColumn("selected", F.col("cum") <= keep)
