"""Correlation of Euclidean distance matrices by random one-dimensional slices, in n log n work.

For a unit direction drawn at random, ``|x - y|`` is in proportion to the mean of ``|direction . (x - y)|``, so sums of
distances over all pairs are means, over slices, of sums over pairs of numbers, and those need no pairs:

* ``sum |a_i - a_j|`` follows from sorted prefix sums;
* ``sum |a_i - a_j| |b_i - b_j|`` follows from dominance sums (over the points below and left of each point of
  count, a, b and ab), since the signed sum over all pairs is a moment.

A slice is dealt into parts by ``a`` and buckets by ``b``: pairs in one part, pairs in one bucket but not in one part, and pairs of
cells that dominate each other (a table of prefix sums) together are all pairs.  Squared distances are exact moments.

Each slice is set against what it would be for a normal distribution of the same covariance, whose mean over all
directions is known (control variate), so the error is that of the deviation from it; it is reported as ``bound``, four
standard errors by the jackknife over slices.  Equal rows are one weighted row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linalg import gram

SLICES, PART_ROWS, MOST_PARTS, DRAWS = 64, 50_000, 256, 100_000


def dominance_sum(a: np.ndarray, b: np.ndarray, w: np.ndarray, group: np.ndarray | None = None) -> float:
    """``sum w_i w_j (a_j - a_i)(b_j - b_i)`` over the pairs of a group with ``a_i <= a_j`` and ``b_i < b_j``
    (pairs with equal a or b add nothing), level by level over the bits of the rank by b."""
    if len(a) < 2:
        return 0.0
    order = np.lexsort((b, a) if group is None else (b, a, group))
    a, b, w = a[order], b[order], w[order]
    g = np.zeros(len(a), np.int64) if group is None else group[order].astype(np.int64)
    rank = np.empty(len(a), np.int64)
    rank[np.argsort(b, kind="stable")] = np.arange(len(a))
    bits = int(len(a) - 1).bit_length()
    total = 0.0
    for k in range(bits):
        key = (g << bits) | (rank >> (k + 1))
        by = np.argsort(key, kind="stable")
        low = ((rank[by] >> k) & 1) == 0
        x, y, v, key = a[by], b[by], w[by], key[by]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        of = np.repeat(start, np.diff(np.append(start, len(key))))
        sums = []
        for f in (v, v * x, v * y, v * x * y):
            run = np.concatenate([[0.0], np.cumsum(np.where(low, f, 0.0))])
            sums.append(run[:-1] - run[of])
        n, sx, sy, sxy = sums
        high = ~low
        total += float((v * (x * y * n - x * sy - y * sx + sxy))[high].sum())
    return total


def spread_sum(a: np.ndarray, w: np.ndarray) -> float:
    """``sum w_i w_j |a_i - a_j|`` over all pairs."""
    order = np.argsort(a, kind="stable")
    a, w = a[order], w[order]
    return float((w * (a * (np.cumsum(w) - w) - (np.cumsum(w * a) - w * a))).sum())


def mean_share(d: int) -> float:
    """Mean of ``|u . e|`` over unit vectors ``u`` of ``d`` dimensions."""
    return math.exp(math.lgamma(d / 2) - math.lgamma((d + 1) / 2)) / math.sqrt(math.pi)


def directions(n: int, d: int, seed: int) -> np.ndarray:
    v = np.random.default_rng(seed).normal(size=(n, d))
    return v / np.linalg.norm(v, axis=1)[:, None]


def _folded(rho: np.ndarray) -> np.ndarray:
    """``E|X||Y|`` of standard normals with correlation rho."""
    rho = np.clip(rho, -1.0, 1.0)
    return 2 / math.pi * (np.sqrt(1 - rho * rho) + rho * np.arcsin(rho))


def _normal_values(theta, phi, cov, dx):
    """What the slices' means would be for normal differences: mean |da|, |db| and |da||db|."""
    xx, yy, xy = 2 * cov[:dx, :dx], 2 * cov[dx:, dx:], 2 * cov[:dx, dx:]
    sa = np.sqrt(np.maximum(np.einsum("ki,ij,kj->k", theta, xx, theta, optimize=True), 1e-300))
    sb = np.sqrt(np.maximum(np.einsum("ki,ij,kj->k", phi, yy, phi, optimize=True), 1e-300))
    rho = np.einsum("ki,ij,kj->k", theta, xy, phi, optimize=True) / (sa * sb)
    half = math.sqrt(2 / math.pi)
    return sa * half, sb * half, sa * sb * _folded(rho)


def slice_sums(df: DataFrame, x: str, y: str, theta: np.ndarray, phi: np.ndarray, parts: int) -> np.ndarray:
    """Per slice the sums over pairs of ``|da|``, ``|db|`` and ``|da||db|`` of weighted rows (columns x, y, w)."""
    slices = len(theta)
    borders = [np.zeros((slices, 0))] * 2
    if parts > 1:
        # borders from a scan of quantile sketches; any borders give the same sums
        probs = F.array(*[F.lit(i / parts) for i in range(1, parts)])
        sides = []
        for col, m in ((x, theta), (y, phi)):
            def project(batches, m=m):
                for b in batches:
                    v = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, m.shape[1]) @ m.T
                    yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(slices), b.num_rows), pa.int32()), pa.array(v.ravel())], names=["k", "v"])
            got = df.select(col).mapInArrow(project, "k int, v double").groupBy("k").agg(F.percentile_approx("v", probs, F.lit(1000)).alias("q")).collect()
            sides.append(np.array([r["q"] for r in sorted(got, key=lambda r: r["k"])], float))
        borders = sides

    def deal(batches):
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            a = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1) @ theta.T
            c = b.column("y").flatten().to_numpy(zero_copy_only=False).reshape(n, -1) @ phi.T
            w = b.column("w").to_numpy().astype(float)
            for k in range(slices):
                p, q = (np.searchsorted(borders[s][k], v[:, k]).astype(np.int32) for s, v in ((0, a), (1, c)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, k, np.int32)), pa.array(p), pa.array(q), pa.array(a[:, k]), pa.array(c[:, k]), pa.array(w)],
                                                 names=["k", "p", "q", "a", "b", "w"])

    def columns(tab):
        return [tab.column(c).to_numpy() for c in ("p", "q", "a", "b", "w")]

    def by_part(tab: pa.Table) -> pa.Table:
        _, _, a, b, w = columns(tab)
        return pa.table({"k": tab.column("k").slice(0, 1), "sa": [spread_sum(a, w)], "sb": [0.0], "d": [dominance_sum(a, b, w)]})

    def by_bucket(tab: pa.Table) -> pa.Table:
        p, _, a, b, w = columns(tab)
        other = dominance_sum(a, b, w) - dominance_sum(a, b, w, p) if parts > 1 else 0.0
        return pa.table({"k": tab.column("k").slice(0, 1), "sa": [0.0], "sb": [spread_sum(b, w)], "d": [other]})

    def by_table(tab: pa.Table) -> pa.Table:
        """Pairs of different parts and buckets from the cells' sums, and the signed sum over all pairs."""
        p, q = tab.column("p").to_numpy(), tab.column("q").to_numpy()
        grid = np.zeros((4, parts, parts))
        for i, c in enumerate(("w", "wa", "wb", "wab")):
            grid[i, p, q] = tab.column(c).to_numpy()
        below = np.zeros_like(grid)
        below[:, 1:, 1:] = np.cumsum(np.cumsum(grid, axis=1), axis=2)[:, :-1, :-1]
        d = (grid[3] * below[0] - grid[1] * below[2] - grid[2] * below[1] + grid[0] * below[3]).sum()
        cross = []
        for axis, moment in ((2, 1), (1, 2)):  # sums of |da| over parts, of |db| over buckets
            n, s = grid[0].sum(axis=axis - 1), grid[moment].sum(axis=axis - 1)
            cross.append(float((s * (np.cumsum(n) - n) - n * (np.cumsum(s) - s)).sum()))
        n, sa, sb, sab = grid.sum(axis=(1, 2))
        # |da||db| sums to twice the concordant pairs less the signed sum
        return pa.table({"k": tab.column("k").slice(0, 1), "sa": [cross[0]], "sb": [cross[1]], "d": [float(d - (n * sab - sa * sb) / 2)]})

    shape = "k int, sa double, sb double, d double"
    points = df.select(F.col(x).alias("x"), F.col(y).alias("y"), "w").mapInArrow(deal, "k int, p int, q int, a double, b double, w double")
    cells = points.groupBy("k", "p", "q").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("a")).alias("wa"),
                                              F.sum(F.col("w") * F.col("b")).alias("wb"), F.sum(F.col("w") * F.col("a") * F.col("b")).alias("wab"))
    every = points.groupBy("k", "p").applyInArrow(by_part, shape).unionByName(points.groupBy("k", "q").applyInArrow(by_bucket, shape)) \
        .unionByName(cells.groupBy("k").applyInArrow(by_table, shape))
    out = np.zeros((slices, 3))
    for r in every.groupBy("k").agg(F.sum("sa").alias("sa"), F.sum("sb").alias("sb"), (2 * F.sum("d")).alias("sab")).collect():
        out[r["k"]] = r["sa"], r["sb"], r["sab"]
    return out


def distance_correlation(df: DataFrame, x: str, y: str, slices: int = SLICES, part_rows: int = PART_ROWS, seed: int = 0,
                         parts: int | None = None) -> DataFrame:
    """``distance_correlation, bound``: Pearson r of the Euclidean distance matrices of two representations over
    all ordered pairs, and how far it may be off."""
    spark = df.sparkSession
    schema = "distance_correlation double, bound double"
    rows = df.select(F.col(x).cast("array<double>").alias("x"), F.col(y).cast("array<double>").alias("y")).where("x is not null and y is not null")
    rows = rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w")).persist()
    try:
        first = rows.first()
        if first is None:
            return spark.createDataFrame([(None, None)], schema)
        dx, dy = len(first["x"]), len(first["y"])
        root = F.sqrt(F.col("w").cast("double"))  # weighted moments: rows scaled by the root of their weight
        z = F.transform(F.concat(F.array(F.lit(1.0)), "x", "y"), lambda v: v * root)
        g = gram(rows.select(z.alias("z")), "z", with_intercept=False)
        n = g[0, 0]
        mean = g[0, 1:] / n
        cov = g[1:, 1:] / n - np.outer(mean, mean)
        theta, phi = directions(slices, dx, seed), directions(slices, dy, seed + 1)
        cut = parts or int(min(MOST_PARTS, max(1, math.ceil(n / part_rows))))
        sums = 2 * slice_sums(rows, "x", "y", theta, phi, cut) / (n * n)     # means over ordered pairs
    finally:
        rows.unpersist()
    cx, cy = mean_share(dx), mean_share(dy)
    scale = np.array([1 / cx, 1 / cy, 1 / (cx * cy)])
    normal = np.stack(_normal_values(theta, phi, cov, dx), axis=1)
    known = np.zeros(3)   # the control's mean over all directions
    for block in range(10):
        t, f = directions(DRAWS // 10, dx, 1000 + block), directions(DRAWS // 10, dy, 2000 + block)
        known += np.array([v.mean() for v in _normal_values(t, f, cov, dx)]) / 10
    q1, q2 = 2 * np.trace(cov[:dx, :dx]), 2 * np.trace(cov[dx:, dx:])        # mean squared distances, exact

    def r_of(use) -> float:
        got = sums[use].mean(axis=0)
        beta = got / np.maximum(normal[use].mean(axis=0), 1e-300)
        m1, m2, m12 = (got - beta * (normal[use].mean(axis=0) - known)) * scale
        v = max(q1 - m1 * m1, 0.0) * max(q2 - m2 * m2, 0.0)
        return (m12 - m1 * m2) / math.sqrt(v) if v > 0 else float("nan")

    every = np.arange(slices)
    r = r_of(every)
    out = np.array([r_of(every != k) for k in range(slices)])
    error = math.sqrt((slices - 1) / slices * float(((out - out.mean()) ** 2).sum()))
    return spark.createDataFrame([(None, None) if r != r else (float(min(max(r, -1.0), 1.0)), float(4 * error))], schema)
