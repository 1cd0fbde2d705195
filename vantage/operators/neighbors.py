"""Nearest neighbours, distances to reference sets, and pair statistics without all pairs.

``knn_join`` is exact, for a stated query set: the base table is cut into
chunks and the query set into blocks, each (chunk, block) is one task group that
returns its local top k, and the chunks' lists are merged per query.  In many
dimensions no exact bound prunes, so the work is queries x base; what is bounded
is a task's memory, and a value held by many rows is spread by the hash of the row.
For approximate search over a large query set use a graph index instead.

Pair statistics over *all* pairs (silhouette, distance correlation) use the
squared-Euclidean identity ``|x-y|^2 = |x|^2 + |y|^2 - 2 x.y``, which turns
sums over pairs into sums of per-row moments: exact, one or two scans.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import dist, dot, lit_matrix, lit_vector, norm_sq
from .prep import bounded
from .linalg import gram


PAIRS_AT_ONCE = 1 << 21   # distances a task holds at a time
FEW = 4                   # candidates per neighbour above which single precision does not pay
LISTED = 1 << 21          # neighbours a task returns for one chunk


def _kth_bound(d2: np.ndarray, k: int) -> np.ndarray:
    """At least the k-th smallest of every row: the k-th smallest minimum of groups of columns, where there are many."""
    wide = min(64, d2.shape[1] // (4 * k))
    if wide >= 8:
        g = d2.shape[1] // wide
        low = d2[:, :g].copy()
        for i in range(1, wide):
            np.minimum(low, d2[:, i * g:(i + 1) * g], out=low)
        d2 = low
    return np.partition(d2, k - 1, axis=1)[:, k - 1]


def _candidates(d2: np.ndarray, bb: np.ndarray, k: int, err: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of all pairs that could be among the k nearest (``d2`` without either norm, right up to ``err``)."""
    d2 += bb
    limit = (_kth_bound(d2, k) + 2 * err).astype(d2.dtype)
    return np.divmod(np.flatnonzero(d2 <= np.nextafter(limit, np.inf, dtype=d2.dtype)[:, None]), d2.shape[1])


def block_topk(q: np.ndarray, qid: np.ndarray, b: np.ndarray, bid: np.ndarray, k: int):
    """Exact local top k of every query row: (query index, base id, distance).

    One matrix product gives squared distances up to rounding; all rows that could be among the k
    nearest within that error are measured exactly.  The product is in single precision where its error leaves few such rows.
    """
    bb = (b * b).sum(1)
    top = max(bb.max(initial=0.0), (q * q).sum(1).max(initial=0.0))
    single = bool(top < 1e30)
    small = (b.T.astype(np.float32), bb.astype(np.float32)) if single else None
    out: list[list[np.ndarray]] = [[], [], []]
    step = max(1, PAIRS_AT_ONCE // len(b))
    kk = min(k, len(b))
    for lo in range(0, len(q), step):
        x = q[lo:lo + step]
        xx = (x * x).sum(1)
        if single:
            rows, cols = _candidates((-2.0 * x).astype(np.float32) @ small[0], small[1], kk, 2.0 ** -22 * (x.shape[1] + 8) * (xx + bb.max()) + 1e-30)
            single = len(rows) <= FEW * kk * len(x)
        if not single:
            rows, cols = _candidates((-2.0 * x) @ b.T, bb, kk, 1e-12 * x.shape[1] * (xx + bb.max(initial=0.0)) + 1e-300)
        dist_ = np.empty(len(rows))
        piece = max(1, PAIRS_AT_ONCE // max(1, x.shape[1]))
        for i in range(0, len(rows), piece):
            diff = x[rows[i:i + piece]] - b[cols[i:i + piece]]
            dist_[i:i + piece] = np.sqrt((diff * diff).sum(1))
        order = np.lexsort((bid[cols], dist_, rows))
        rows, cols, dist_ = rows[order], cols[order], dist_[order]
        keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < kk
        out[0].append(qid[lo + rows[keep]])
        out[1].append(bid[cols[keep]])
        out[2].append(dist_[keep])
    return [np.concatenate(v) for v in out]


def knn_join(
    queries: DataFrame, base: DataFrame, k: int, q_id: str = "qid", b_id: str = "bid",
    vec: str = "vec", q_block: int = 16_384, b_chunk: int = 131_072, least_chunk: int = 128,
) -> DataFrame:
    """Exact k nearest base rows (Euclidean) for every row of a stated query set.

    Output ``(q_id, b_id, distance, rank)`` with ``rank`` 1..k ordered by
    ``(distance, b_id)``.  Inputs carry an ``array<double>`` column ``vec``.
    A task holds at most about ``q_block`` queries (fewer where their lists would pass ``LISTED`` neighbours) and
    ``b_chunk`` base rows; where that gives too few tasks, the base is cut into chunks of ``least_chunk`` rows or more
    until every core has one.  Rows travel once per block or chunk of the other side, lists once per chunk.
    """
    spark = queries.sparkSession
    n_base, n_query = base.count(), queries.count()
    if n_base == 0 or n_query == 0:
        return spark.createDataFrame([], f"{q_id} long, {b_id} long, distance double, rank int")
    blocks = math.ceil(n_query / max(1, min(q_block, LISTED // k)))
    chunks = max(math.ceil(n_base / b_chunk), min(math.ceil(spark.sparkContext.defaultParallelism / blocks), math.ceil(n_base / least_chunk)))
    b = base.select(F.col(b_id).cast("long").alias("_bid"), F.col(vec).alias("_bv")).select(
        "*", F.pmod(F.xxhash64("_bid"), F.lit(chunks)).alias("_c"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_b"))
    q = queries.select(F.col(q_id).cast("long").alias("_qid"), F.col(vec).alias("_qv")).select(
        "*", F.pmod(F.xxhash64("_qid"), F.lit(blocks)).cast("int").alias("_b"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("_c"))

    def local(qp: pd.DataFrame, bp: pd.DataFrame) -> pd.DataFrame:
        if len(qp) == 0 or len(bp) == 0:
            return pd.DataFrame({"_qid": [], "_bid": [], "distance": []})
        got = block_topk(np.stack(qp["_qv"].to_numpy()).astype(float), qp["_qid"].to_numpy(),
                         np.stack(bp["_bv"].to_numpy()).astype(float), bp["_bid"].to_numpy(), k)
        return pd.DataFrame(dict(zip(("_qid", "_bid", "distance"), got, strict=True)))

    cand = q.groupBy("_c", "_b").cogroup(b.groupBy("_c", "_b")).applyInPandas(local, "_qid long, _bid long, distance double")
    w = Window.partitionBy("_qid").orderBy("distance", "_bid")
    return (cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(F.col("_qid").alias(q_id), F.col("_bid").alias(b_id), "distance", "rank"))


def knn_vote(neigh: DataFrame, base_labels: DataFrame, q_id: str, b_id: str, label: str) -> DataFrame:
    """Majority label among each query's neighbours; ties go to the lowest label."""
    votes = neigh.join(base_labels.select(b_id, label), b_id).groupBy(q_id, label).agg(
        F.count(F.lit(1)).alias("_n"))
    return votes.groupBy(q_id).agg(
        F.max_by(F.col(label), F.struct(F.col("_n"), (-F.col(label)).alias("_l"))).alias("prediction"))


def distances_to_reference(df: DataFrame, ref: list[list[float]], id_col: str, vec: str) -> DataFrame:
    """Euclidean distance from every row to every row of a bounded reference set.

    The reference (centres, pivots, landmarks) is shipped as a literal; the
    output has ``rows x len(ref)`` rows.
    """
    R = lit_matrix(ref)
    return df.select(id_col, F.posexplode(F.transform(R, lambda r: dist(r, F.col(vec))))).select(
        id_col, F.col("pos").alias("ref_id"), F.col("col").alias("distance"))


def cluster_stats(df: DataFrame, cluster: str, vec: str) -> dict:
    """Per cluster: count, vector sum, sum of squared norms (an error where clusters are not model-sized)."""
    d = len(df.select(vec).first()[0])
    rows = bounded(df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), F.sum(norm_sq(vec)).alias("q"),
        F.array(*[F.sum(F.col(vec)[i]) for i in range(d)]).alias("s")), cluster)
    return {r[cluster]: (int(r["n"]), np.array(r["s"], dtype=float), float(r["q"])) for r in rows}


def silhouette_sq(df: DataFrame, cluster: str, vec: str) -> DataFrame:
    """Mean silhouette with *squared* Euclidean dissimilarity, exact, linear in rows.

    For a row x and cluster C: mean_j |x - x_j|^2 = |x|^2 - 2 x.S_C/n_C + Q_C/n_C.
    Own-cluster mean excludes the row itself (divide by n_C - 1); singleton
    clusters score 0.  Same definition as ``ClusteringEvaluator``.
    """
    st = cluster_stats(df, cluster, vec)
    ids = sorted(st)
    S = lit_matrix([st[c][1].tolist() for c in ids])
    N = lit_vector([float(st[c][0]) for c in ids])
    Q = lit_vector([st[c][2] for c in ids])
    K = F.array(*[F.lit(c) for c in ids])
    x2 = norm_sq(vec)
    per = F.transform(S, lambda s, i: F.struct(
        F.element_at(K, i + 1).alias("c"), F.element_at(N, i + 1).alias("n"),
        (x2 * F.element_at(N, i + 1) - 2 * dot(vec, s) + F.element_at(Q, i + 1)).alias("tot")))
    rows = df.select(F.col(cluster).alias("_k"), per.alias("_p"))
    own = F.filter("_p", lambda e: e["c"] == F.col("_k"))[0]
    others = F.filter("_p", lambda e: e["c"] != F.col("_k"))
    a = F.try_divide(own["tot"], own["n"] - 1)
    b = F.array_min(F.transform(others, lambda e: e["tot"] / e["n"]))
    # clusters of identical points: 0/0 scores 0
    s = F.when(own["n"] <= 1, F.lit(0.0)).otherwise(F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)))
    return rows.agg(F.avg(s).alias("silhouette"))


def distance_correlation_sq(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson r between the squared-distance matrices of two representations of the same rows.

    Over all ordered pairs (diagonal included).  Sums over pairs are rebuilt from
    one Gram matrix of ``[1, x, y, |x|^2, |y|^2]`` on mean-centred data
    (distances are shift invariant; centring keeps the cancellation small).
    """
    g0 = gram(df.select(F.concat(F.col(x), F.col(y)).alias("_z")), "_z", with_intercept=True)
    n = g0[0, 0]
    dx = len(df.select(x).first()[0])
    mu = g0[0, 1:] / n
    mux, muy = mu[:dx], mu[dx:]
    cx = F.zip_with(F.col(x), lit_vector(mux.tolist()), lambda a, b: a - b)
    cy = F.zip_with(F.col(y), lit_vector(muy.tolist()), lambda a, b: a - b)
    c = df.select(cx.alias("_x"), cy.alias("_y"))
    z = c.select(F.concat("_x", "_y", F.array(norm_sq("_x"), norm_sq("_y"))).alias("_z"))
    G = gram(z, "_z", with_intercept=True)
    dy = len(muy)
    ix = slice(1, 1 + dx)
    iy = slice(1 + dx, 1 + dx + dy)
    ia, ib = 1 + dx + dy, 2 + dx + dy
    Sx, Sy = G[0, ix], G[0, iy]
    A, B = G[0, ia], G[0, ib]
    Aa, Bb, Ab = G[ia, ia], G[ib, ib], G[ia, ib]
    aX, aY, bX, bY = G[ia, ix], G[ia, iy], G[ib, ix], G[ib, iy]
    XX, YY, XY = G[ix, ix], G[iy, iy], G[ix, iy]
    s1 = 2 * n * A - 2 * Sx @ Sx
    s2 = 2 * n * B - 2 * Sy @ Sy
    s11 = 2 * n * Aa + 2 * A * A - 8 * aX @ Sx + 4 * np.sum(XX * XX)
    s22 = 2 * n * Bb + 2 * B * B - 8 * bY @ Sy + 4 * np.sum(YY * YY)
    s12 = 2 * n * Ab + 2 * A * B - 4 * aY @ Sy - 4 * bX @ Sx + 4 * np.sum(XY * XY)
    N = n * n
    num = N * s12 - s1 * s2
    den = math.sqrt(max(N * s11 - s1 * s1, 0.0) * max(N * s22 - s2 * s2, 0.0))
    r = float(num / den) if den > 0 else None
    return df.sparkSession.createDataFrame([(r,)], "distance_correlation double")
