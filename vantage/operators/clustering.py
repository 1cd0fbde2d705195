"""Clustering: k-means (restarts, one Lloyd step), diagonal Gaussian mixtures by EM, sweeps.

k-means uses ``pyspark.ml.clustering.KMeans`` (k-means|| init) with several
seeds, keeping the lowest training cost.  Spark's ``GaussianMixture`` only
fits full covariances, so the diagonal mixture is a DataFrame EM: each
iteration is one pass whose tasks fold their rows into the k x (1 + 2d)
sufficient statistics; parameters stay on the driver (model-sized).
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import lit_matrix
from .linalg import dealt, gathered, pack_rows, reduce_packed, reduce_partials, stack_vectors, unpack
from .prep import levels as label_levels


def kmeans_fit(df: DataFrame, vec: str, k: int, n_init: int = 10, seed: int = 100, max_iter: int = 300,
               parallelism: int = 8):
    """Best of ``n_init`` k-means fits (lowest within-cluster sum of squares; first seed on ties).

    Restarts are independent Spark jobs submitted concurrently (like
    ``CrossValidator(parallelism=...)``) over one persisted feature frame.
    """
    from concurrent.futures import ThreadPoolExecutor

    data = df.withColumn("_features", array_to_vector(F.col(vec))).persist()

    def fit(i):
        m = KMeans(k=k, seed=seed + i, maxIter=max_iter, featuresCol="_features", predictionCol="cluster").fit(data)
        return i, m, m.summary.trainingCost

    try:
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, n_init))) as ex:
            fits = list(ex.map(fit, range(n_init)))
    finally:
        data.unpersist()
    return min(fits, key=lambda t: (t[2], t[0]))[1]


SEED_ROUNDS, OVERSAMPLE = 5, 2


def _spread_centres(x: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ choice of ``k`` of the weighted rows (rows repeat where there are fewer distinct ones)."""
    chosen = [int(rng.choice(len(x), p=weight / weight.sum()))]
    d2 = ((x - x[chosen[0]]) ** 2).sum(1)
    while len(chosen) < k:
        mass = d2 * weight
        total = mass.sum()
        i = int(rng.choice(len(x), p=mass / total)) if total > 0 else int(rng.integers(len(x)))
        chosen.append(i)
        d2 = np.minimum(d2, ((x - x[i]) ** 2).sum(1))
    return x[chosen].copy()


def _draw(h: np.ndarray, *key: int) -> np.ndarray:
    """Uniform draws in [0, 1) fixed by row hashes and a key."""
    z = h.astype(np.uint64)
    for k in key:
        z = (z ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(29)
    return (z >> np.uint64(11)).astype(float) / float(1 << 53)


HASHES = [("_h", np.int64)]


def _seed_sets(src: DataFrame, plans: Sequence[tuple[int, int, int]], seed: int, rounds: int = SEED_ROUNDS) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """Per plan ``(vector, runs, k)`` and run, oversampled candidate centres and how many rows each is nearest to
    (k-means||, over the whole table).

    In every round a row becomes a candidate with a probability in proportion to its squared distance to the
    candidates so far, about ``2 k`` rows a round; all plans, all runs, and all k up to the largest, share the rounds' scans.
    """
    runs = [(p, view, r, k) for p, (view, n, k) in enumerate(plans) for r in range(n)]
    views = sorted({view for view, _, _ in plans})

    def lowest(batches):
        for mats, (h,) in unpack(batches, HASHES):
            for i, (_, view, r, _) in enumerate(runs):
                u = _draw(h, seed, r)
                at = int(u.argmin())
                yield pa.RecordBatch.from_pydict({"run": pa.array([i], pa.int32()), "u": [u[at]], "v": [mats[view][at].tolist()]})

    first = src.mapInArrow(lowest, "run int, u double, v array<double>").groupBy("run").agg(F.min_by("v", F.struct("u", "v")).alias("v")).collect()
    sets = {r["run"]: np.array([r["v"]], float) for r in first}
    if not sets:
        return []
    for t in range(rounds):
        def cost(mats, nums, sets=dict(sets)):
            xx = {v: (mats[v] * mats[v]).sum(1) for v in views}
            return np.array([_nearest(mats[view], xx[view], sets[i])[1].sum() for i, (_, view, _, _) in enumerate(runs)])

        phi = reduce_packed(src, cost, len(runs))

        def sample(batches, sets=dict(sets), t=t):
            for mats, (h,) in unpack(batches, HASHES):
                xx = {v: (mats[v] * mats[v]).sum(1) for v in views}
                for i, (_, view, r, k) in enumerate(runs):
                    if phi[i] > 0:
                        at = np.flatnonzero(_draw(h, seed, r, t + 1) < OVERSAMPLE * k * _nearest(mats[view], xx[view], sets[i])[1] / phi[i])
                        if len(at):
                            yield pa.RecordBatch.from_pydict({"run": pa.array([i] * len(at), pa.int32()), "h": h[at], "v": mats[view][at].tolist()})

        for r in sorted(src.mapInArrow(sample, "run int, h long, v array<double>").collect(), key=lambda r: (r["run"], r["h"], r["v"])):
            sets[r["run"]] = np.vstack([sets[r["run"]], r["v"]])

    def held(mats, nums):
        xx = {v: (mats[v] * mats[v]).sum(1) for v in views}
        return np.concatenate([np.bincount(_nearest(mats[view], xx[view], sets[i])[0], minlength=len(sets[i]))
                               for i, (_, view, _, _) in enumerate(runs)])

    tot = reduce_packed(src, held, sum(len(sets[i]) for i in range(len(runs))))
    out: list[list] = [[] for _ in plans]
    at = 0
    for i, (p, _, _, _) in enumerate(runs):
        out[p].append((sets[i], np.maximum(tot[at:at + len(sets[i])], 1e-9)))
        at += len(sets[i])
    return out


def _nearest(x: np.ndarray, xx: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d2 = xx[:, None] - 2.0 * (x @ c.T) + (c * c).sum(1)[None, :]
    lab = d2.argmin(1)
    return lab, np.maximum(d2[np.arange(len(x)), lab], 0.0)


def _by_cluster(lab: np.ndarray, v: np.ndarray, k: int) -> np.ndarray:
    """Sums of the rows of ``v`` per cluster (one product with the membership matrix)."""
    hot = np.zeros((len(lab), k))
    hot[np.arange(len(lab)), lab] = 1.0
    return hot.T @ v


STATE_ROWS, LABELLING, CHANGED, MOST_LOOKED, LEAST_GAP, MOST_GAP = 4096, 1.5, 1.5, 0.7, 1e-4, 6e4


class _Rows:
    """A block's vectors about their mean: in doubles, in floats (either way round), and their lengths."""

    def __init__(self, x: np.ndarray, mean: np.ndarray):
        with np.errstate(all="ignore"):
            self.wide = x - mean
            self.low = self.wide.astype(np.float32)
            self.low_t = np.ascontiguousarray(self.low.T)
            self.norm2 = (self.wide * self.wide).sum(1)
            self.norm = np.sqrt(self.norm2).astype(np.float32)


def _split(near: np.ndarray, lab: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of the labelled centres (rows of ``near``), their values, and the least of the others."""
    flat, cell = near.ravel(), lab * near.shape[1] + np.arange(near.shape[1])
    own = flat.take(cell)
    flat[cell] = np.inf
    return cell, own, np.minimum.reduce(near, axis=0)


def _least(near: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(near.T).argmin(1)


def _labels(rows: _Rows, c: np.ndarray, at: np.ndarray | None = None, old: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Nearest of the centres ``c`` (about the mean) for the rows ``at`` (all), and how much farther the second is at least.

    Products of floats settle the rows whose nearest centre is clear beyond their rounding, products of doubles most others, and
    the rest is measured term by term: a row's label does not depend on the rows beside it.  With ``old`` labels the clear ones
    are only confirmed (and no gaps given).
    """
    def some(v, i=None):
        v = v if at is None else v.take(at, axis=0)
        return v if i is None else v.take(i, axis=0)

    with np.errstate(all="ignore"):
        c2 = (c * c).sum(1)
        far = float(c2.max())
        unsure, length = (c.shape[1] + 8) * 2.0 ** -23, 2.0 * math.sqrt(far)
        near = (-2.0 * c).astype(np.float32) @ (rows.low_t if at is None else rows.low.take(at, axis=0).T)
        near += c2.astype(np.float32)[:, None]
        lab = _least(near) if old is None else old.astype(np.intp)
        cell, own, second = _split(near, lab)
        slack = some(rows.norm) * np.float32(unsure * length)
        slack += np.float32(unsure * far + 1e-36)   # below that floats are too coarse
        open_ = np.flatnonzero(~(second - own > slack))
        gap = _gap(own, second, slack, some(rows.norm2)) if old is None else None
        if old is not None and len(open_):   # most of these have changed, clearly
            near.ravel()[cell] = own
            near = near.take(open_, axis=1)
            lab[open_] = got = _least(near)
            _, own, second = _split(near, got)
            open_ = open_[~(second - own > slack[open_])]
        if len(open_):
            where = open_ if at is None else at[open_]
            near = (-2.0 * c) @ rows.wide.take(where, axis=0).T + c2[:, None]
            got = _least(near)
            _, own, second = _split(near, got)
            slack = (unsure * 2.0 ** -28) * (far + length * rows.norm[where].astype(float))
            if gap is not None:
                gap[open_] = _gap(own, second, slack, rows.norm2[where])
            tied = np.flatnonzero(~(second - own > slack))
            for i in range(0, len(tied), 256):
                few = tied[i:i + 256]
                got[few] = ((rows.wide[where[few], None] - c[None]) ** 2).sum(2).argmin(1)
                if gap is not None:
                    gap[open_[few]] = 0.0
            lab[open_] = got
    return lab, gap


def _gap(own: np.ndarray, second: np.ndarray, slack: np.ndarray, norm2: np.ndarray) -> np.ndarray:
    """Lower bound of the difference of the two distances whose squares are ``norm2 + own`` and ``norm2 + second``."""
    own, second, slack = own.astype(float), second.astype(float), slack.astype(float)
    both = np.sqrt(np.maximum(norm2 + own + slack, 0.0)) + np.sqrt(np.maximum(norm2 + second + slack, 0.0))
    return np.where(np.isfinite(second), (second - own - slack) * 0.999 / both, np.where(np.isnan(second), 0.0, np.inf))


def _lloyd(src: DataFrame, runs: list[dict], dims: Sequence[int], means: Sequence[np.ndarray], unit: Sequence[float],
           still: Sequence[float], n: float, max_iter: int) -> None:
    """Lloyd steps of all runs together until each moves its centres by ``still`` at most; sets their centres ``c``, ``iterations``
    and ``cost``.  ``unit`` is the scale of a vector column's components.

    Every row keeps, per run, its nearest centre at some earlier step and a lower bound of how much farther the second nearest
    was.  While the centres have moved by less than that, the row's label stands unmeasured; only the rows that change
    cluster move the sums.  The labels are taken anew once a step costs more than the mean step since they were taken.
    """
    kind = np.uint8 if max(m["k"] for m in runs) <= 256 else np.uint32
    numbers = [("lab", kind), ("gap", np.float16)]

    def first(mats, nums, cs=[(m["view"], m["c"]) for m in runs]):
        rows = [_Rows(x, mean) for x, mean in zip(mats, means, strict=True)]
        ones = [np.hstack([np.ones((len(x), 1)), x]) for x in mats]
        return np.concatenate([_by_cluster(_labels(rows[v], c - means[v])[0], ones[v], len(c)).ravel() for v, c in cs])

    def labelled(live):
        cs = [(m["view"], m["c"]) for m in live]

        def label(batches):
            for mats in _merged(batches, STATE_ROWS):
                rows = [_Rows(x, mean) for x, mean in zip(mats, means, strict=True)]
                lab, gap = np.empty((len(cs), len(mats[0])), kind), np.empty((len(cs), len(mats[0])), np.float16)
                for i, (v, c) in enumerate(cs):
                    lab[i], g = _labels(rows[v], c - means[v])
                    g = g / unit[v]
                    gap[i] = np.where(g >= LEAST_GAP, np.minimum(g, MOST_GAP), 0.0)   # not a number: 0
                yield pa.RecordBatch.from_pydict({
                    "n": pa.array([len(mats[0])], pa.int32()), "dims": pa.array([[x.shape[1] for x in mats]], pa.list_(pa.int32())),
                    "x": [np.hstack(mats).tobytes()], "lab": [lab.tobytes()], "gap": [gap.tobytes()]})

        out = src.mapInArrow(label, "n int, dims array<int>, x binary, lab binary, gap binary").persist()
        out._tasks = src._tasks
        for i, m in enumerate(live):
            m["slot"], m["from"], m["held"] = i, m["c"], m["sums"]
        return out

    live, state = list(runs), None
    try:
        for step in range(max_iter + 1):
            if step == 0:
                tot, at = reduce_packed(src, first, sum(m["k"] * (dims[m["view"]] + 1) for m in runs)), 0
                for m in runs:
                    k, d = m["k"], dims[m["view"]]
                    m["sums"] = tot[at:at + k * (d + 1)].reshape(k, d + 1)
                    at += k * (d + 1)
                spent = None
            else:
                asked = []
                for m in live:
                    moved = np.sqrt(((m["c"] - m["from"]) ** 2).sum(1))
                    top = np.sort(moved)[-2:]
                    other = np.where(moved == top[-1], top[0], top[-1]) if len(moved) > 1 else 0.0
                    asked.append((m["view"], m["slot"], m["c"], ((moved + other) * 1.00001 / unit[m["view"]]).astype(np.float32)))
                length = sum(len(c) * (dims[v] + 1) for v, _, c, _ in asked)

                def change(mats, nums, asked=asked, length=length):
                    rows = [_Rows(x, mean) for x, mean in zip(mats, means, strict=True)]
                    size = len(mats[0])
                    lab, gap = nums[0].reshape(-1, size), nums[1].reshape(-1, size)
                    out, at = np.zeros(length + 2), 0
                    for v, slot, c, far in asked:
                        was = lab[slot]
                        look = np.flatnonzero(~(gap[slot].astype(np.float32) > far[was]))
                        k, d = c.shape
                        if len(look):
                            out[-2] += len(look)
                            if len(look) > MOST_LOOKED * size:   # measuring all costs less than picking
                                look = np.arange(size)
                                now, _ = _labels(rows[v], c - means[v], None, was)
                            else:
                                now, _ = _labels(rows[v], c - means[v], look, was[look])
                            new = np.flatnonzero(now != was[look])
                            if len(new):
                                out[-1] += len(new)
                                hot, col = np.zeros((k, len(new))), np.arange(len(new))
                                hot[now[new], col] = 1.0
                                hot[was[look[new]], col] = -1.0
                                part = out[at:at + k * (d + 1)].reshape(k, d + 1)
                                part[:, 0] = hot.sum(1)
                                part[:, 1:] = hot @ mats[v][look[new]]
                        at += k * (d + 1)
                    return out

                tot, at = reduce_packed(state, change, length + 2, numbers), 0
                for m in live:
                    k, d = m["k"], dims[m["view"]]
                    m["sums"] = m["held"] + tot[at:at + k * (d + 1)].reshape(k, d + 1)
                    at += k * (d + 1)
                last = float(tot[-2] + CHANGED * tot[-1]) / max(n * len(live), 1.0)
                spent, since = spent + last, since + 1
            moving = []
            for m in live:
                part = m["sums"]
                new = np.where(part[:, :1] > 0, part[:, 1:] / np.maximum(part[:, :1], 1.0), m["c"])
                if ((new - m["c"]) ** 2).sum() > still[m["view"]] and step < max_iter:
                    m["next"], m["iterations"] = new, step + 1
                    moving.append(m)
            live = moving
            if not live:
                break
            if spent is None or last > spent / since:
                if state is not None:
                    state.unpersist()
                state, spent, since = labelled(live), LABELLING, 0
            for m in live:
                m["c"] = m["next"]
    finally:
        if state is not None:
            state.unpersist()

    def cost(mats, nums, cs=[(m["view"], m["c"]) for m in runs]):
        rows = [_Rows(x, mean) for x, mean in zip(mats, means, strict=True)]
        out = []
        for v, c in cs:
            c = c - means[v]
            near = rows[v].wide @ (-2.0 * c.T) + (c * c).sum(1)
            out.append(np.maximum(rows[v].norm2 + near.min(1), 0.0).sum())
        return np.array(out)

    for m, total in zip(runs, reduce_packed(src, cost, len(runs)), strict=True):
        m["cost"] = float(total)


def _merged(batches, rows: int):
    """The packed blocks' matrices, joined to blocks of about ``rows`` rows."""
    held, n = [], 0
    for mats, _ in unpack(batches):
        held.append(mats)
        n += len(mats[0])
        if n >= rows:
            yield [np.vstack(part) for part in zip(*held, strict=True)]
            held, n = [], 0
    if held:
        yield [np.vstack(part) for part in zip(*held, strict=True)]


def kmeans_batch(df: DataFrame, vec: str, id_col: str, ks: Sequence[int], n_init: int = 10, seed: int = 100,
                 max_iter: int = 300, tol: float = 1e-4) -> dict[int, dict]:
    """Best of ``n_init`` k-means runs for every k: ``{k: centres, cost, iterations}``."""
    return kmeans_batches(df, id_col, [(vec, ks, n_init)], seed, max_iter, tol)[0]


def kmeans_batches(df: DataFrame, id_col: str, jobs: Sequence[tuple[str, Sequence[int], int]], seed: int = 100,
                   max_iter: int = 300, tol: float = 1e-4) -> list[dict[int, dict]]:
    """:func:`kmeans_batch` for every job ``(vector column, ks, n_init)`` on the same rows.

    All runs of all k and of all jobs advance together (:func:`_lloyd`): one scan per Lloyd step gives the counts and sums of
    all runs that still move, so the number of scans is that of the slowest run.
    """
    vecs = list(dict.fromkeys(v for v, _, _ in jobs))
    view = [vecs.index(v) for v, _, _ in jobs]
    packed = pack_rows(df.select(*vecs, F.xxhash64(F.col(id_col).cast("string")).alias("_h")), vecs, ["_h"])
    src = dealt(packed)
    src.persist()
    try:
        sets = _seed_sets(src, [(view[j], n, max(ks, default=1)) for j, (_, ks, n) in enumerate(jobs)], seed)
        if not sets:
            return [{} for _ in jobs]
        dims = [0] * len(vecs)
        for j, s in enumerate(sets):
            dims[view[j]] = s[0][0].shape[1]

        def sums(mats, nums):
            return np.concatenate([np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)]) for x in mats])

        spread, at, still, means = reduce_packed(src, sums, sum(1 + 2 * d for d in dims)), 0, [], []
        unit = []
        for d in dims:
            n, mean, square = spread[at], spread[at + 1:at + 1 + d] / spread[at], spread[at + 1 + d:at + 1 + 2 * d] / spread[at]
            var = float(np.maximum(square - mean * mean, 0.0).mean())
            still.append(tol * var)
            means.append(mean)
            unit.append(math.sqrt(var) if 0 < var < math.inf else 1.0)
            at += 1 + 2 * d
        runs = [{"job": j, "view": view[j], "k": k, "run": r, "c": _spread_centres(*sets[j][r], k, np.random.default_rng([seed, k, r])), "iterations": 0}
                for j, (_, ks, n_init) in enumerate(jobs) for k in ks for r in range(n_init)]
        _lloyd(src, runs, dims, means, unit, still, n, max_iter)
        return [{k: min((m for m in runs if m["job"] == j and m["k"] == k), key=lambda m: (m["cost"], m["run"])) for k in ks}
                for j, (_, ks, _) in enumerate(jobs)]
    finally:
        src.unpersist()


def gmm_batch(df: DataFrame, vec: str, starts: dict[int, np.ndarray], max_iter: int = 100, tol: float = 1e-3,
              reg: float = 1e-6) -> dict[int, dict]:
    """Diagonal mixtures for every k of ``starts`` (initial centres): EM with one scan per step for all of them."""
    return gmm_batches(df, [(vec, starts)], max_iter, tol, reg)[0]


def gmm_batches(df: DataFrame, jobs: Sequence[tuple[str, dict[int, np.ndarray]]], max_iter: int = 100, tol: float = 1e-3,
                reg: float = 1e-6) -> list[dict[int, dict]]:
    """:func:`gmm_batch` for every job ``(vector column, starts)`` on the same rows, all in the same scans."""
    vecs = list(dict.fromkeys(v for v, _ in jobs))
    kept = pack_rows(df.select(*vecs), vecs).persist()
    try:
        src = gathered(kept)
        asked = [(j, vecs.index(v), k, np.asarray(c, float)) for j, (v, starts) in enumerate(jobs) for k, c in starts.items()]

        def hard(mats, nums):
            wide = [np.hstack([np.ones((len(x), 1)), x, x * x]) for x in mats]
            xx = [(x * x).sum(1) for x in mats]
            return np.concatenate([_by_cluster(_nearest(mats[v], xx[v], c)[0], wide[v], len(c)).ravel() for _, v, _, c in asked] + [[len(mats[0])]])

        tot = reduce_packed(src, hard, sum(len(c) * (1 + 2 * c.shape[1]) for _, _, _, c in asked) + 1)
        n, at, fits = int(round(tot[-1])), 0, []
        for j, v, k, c in asked:
            d = c.shape[1]
            part = tot[at:at + k * (1 + 2 * d)].reshape(k, 1 + 2 * d)
            at += k * (1 + 2 * d)
            w, mu, var = gmm_m_step(np.maximum(part[:, 0], 1e-10), part[:, 1:1 + d], part[:, 1 + d:], n, reg)
            fits.append({"weights": w, "means": mu, "vars": var, "loglik": -np.inf, "iterations": 0, "n": n, "live": True})
        for step in range(1, max_iter + 2):
            live = [i for i, f in enumerate(fits) if f["live"]]
            params = [(asked[i][1], fits[i]["weights"], fits[i]["means"], fits[i]["vars"]) for i in live]

            def soft(mats, nums, params=params):
                both = [np.hstack([x, x * x]) for x in mats]
                out = []
                for v, w, mu, var in params:
                    ld = _log_dens(mats[v], w, mu, var, both[v])
                    m = ld.max(axis=1, keepdims=True)
                    r = np.exp(ld - m)
                    tot = r.sum(axis=1, keepdims=True)
                    r /= tot
                    sk = r.T @ both[v]
                    d = mu.shape[1]
                    out += [r.sum(0), sk[:, :d].ravel(), sk[:, d:].ravel(), [(m + np.log(tot)).sum()]]
                return np.concatenate(out)

            tot, at = reduce_packed(src, soft, sum(len(w) * (1 + 2 * mu.shape[1]) + 1 for _, w, mu, _ in params)), 0
            for i in live:
                f = fits[i]
                k, d = f["means"].shape
                nk = tot[at:at + k]
                sk = tot[at + k:at + k + k * d].reshape(k, d)
                qk = tot[at + k + k * d:at + k + 2 * k * d].reshape(k, d)
                ll = float(tot[at + k + 2 * k * d])
                at += k * (1 + 2 * d) + 1
                settled = abs(ll - f["loglik"]) / max(n, 1) < tol or step > max_iter
                f["loglik"] = ll
                if settled:  # the likelihood just read is that of the parameters kept
                    f["live"] = False
                else:
                    f["weights"], f["means"], f["vars"] = gmm_m_step(nk, sk, qk, n, reg)
                    f["iterations"] = step
            if not any(f["live"] for f in fits):
                break
        out: list[dict] = [{} for _ in jobs]
        for (j, _, k, _), f in zip(asked, fits, strict=True):
            out[j][k] = f
        return out
    finally:
        kept.unpersist()


def clustering_scores(df: DataFrame, vec: str, label: str, y: str, models: dict, assign) -> dict:
    """``{name: homogeneity, f1, silhouette}`` of many clusterings in two scans.

    ``assign(model, x)`` labels the rows of a numpy batch; ``models[name]["k"]`` is its number of clusters.
    The first scan folds the table of (cluster, label, y) counts and the moments of every cluster, the
    second the silhouettes (squared distances).  Majority votes tie to the smaller ``y``.
    """
    levels = label_levels(df, label)
    src = df.select(F.col(vec).alias("_v"), F.col(label).alias("_l"), F.col(y).cast("int").alias("_y")).persist()
    try:
        d = len(src.first()["_v"])
        names = list(models)
        m_levels = len(levels)

        def counts(pdf):
            x = stack_vectors(pdf["_v"])
            lab = np.searchsorted(levels, pdf["_l"].to_numpy())
            yy = pdf["_y"].to_numpy()
            v = np.hstack([np.ones((len(x), 1)), x, (x * x).sum(1)[:, None]])
            out = []
            for name in names:
                k = models[name]["k"]
                c = assign(models[name], x)
                out += [np.bincount((c * m_levels + lab) * 2 + yy, minlength=k * m_levels * 2), _by_cluster(c, v, k).ravel()]
            return np.concatenate(out).astype(float)

        tot, at, res = reduce_partials(src, counts, sum(models[m]["k"] * (2 * m_levels + d + 2) for m in names)), 0, {}
        moments = {}
        for name in names:
            k = models[name]["k"]
            table = tot[at:at + k * m_levels * 2].reshape(k, m_levels, 2)
            at += k * m_levels * 2
            moments[name] = tot[at:at + k * (d + 2)].reshape(k, d + 2)
            at += k * (d + 2)
            n = table.sum()
            ck, nk, nc = table.sum(2), table.sum((1, 2)), table.sum((0, 2))
            some = ck > 0
            h_ck = -(ck[some] * np.log((ck / np.maximum(nk[:, None], 1))[some])).sum() / n
            h_c = -(nc[nc > 0] * np.log(nc[nc > 0] / n)).sum() / n
            by_y = table.sum(1)
            one = by_y[:, 1] > by_y[:, 0]   # clusters that vote 1
            tp, fp, fn = by_y[one, 1].sum(), by_y[one, 0].sum(), by_y[~one, 1].sum()
            res[name] = {"homogeneity": 1.0 if h_c <= 1e-15 else float(1 - h_ck / h_c),
                         "f1": float(2 * tp / (2 * tp + fp + fn)) if tp + fp + fn else 0.0}

        def silhouettes(pdf):
            x = stack_vectors(pdf["_v"])
            xx = (x * x).sum(1)
            rows = np.arange(len(x))
            out = []
            for name in names:
                mo = moments[name]
                nk = mo[:, 0]
                c = assign(models[name], x)
                tot_ = xx[:, None] * nk[None, :] - 2.0 * (x @ mo[:, 1:-1].T) + mo[None, :, -1]
                a = tot_[rows, c] / np.maximum(nk[c] - 1, 1)
                mean = np.where(nk[None, :] > 0, tot_ / np.maximum(nk, 1)[None, :], np.inf)
                mean[rows, c] = np.inf
                b = mean.min(1)
                top = np.maximum(a, b)
                ok = (nk[c] > 1) & np.isfinite(b) & (top > 0)
                out.append(np.where(ok, (b - a) / np.where(ok, top, 1.0), 0.0).sum())
            return np.array([*out, len(x)])

        tot = reduce_partials(src, silhouettes, len(names) + 1)
        for i, name in enumerate(names):
            res[name]["silhouette"] = float(tot[i] / max(tot[-1], 1))
        return res
    finally:
        src.unpersist()


def assign_centres(model: dict, x: np.ndarray) -> np.ndarray:
    return _nearest(x, (x * x).sum(1), model["c"])[0]


def assign_mixture(model: dict, x: np.ndarray) -> np.ndarray:
    return _log_dens(x, model["weights"], model["means"], model["vars"]).argmax(1)


def kmeans_assign(model, df: DataFrame, vec: str) -> DataFrame:
    return model.transform(df.withColumn("_features", array_to_vector(F.col(vec)))).drop("_features")


def kmeans_step(df: DataFrame, vec: str, centres: Sequence[Sequence[float]]) -> DataFrame:
    """One Lloyd step: assign to the nearest centre (ties -> lowest index), average per cluster.

    One scan of per-task partial sums.  Output ``(cluster, n, cost, dim, value)`` in long form,
    empty clusters left out.
    """
    c = np.asarray(centres, float)
    k, d = c.shape

    def fold(pdf):
        x = stack_vectors(pdf["_v"])
        d2 = np.stack([((x - row) ** 2).sum(1) for row in c], axis=1)
        lab = d2.argmin(1)
        v = np.hstack([np.ones((len(x), 1)), d2[np.arange(len(x)), lab][:, None], x])
        return _by_cluster(lab, v, k).ravel()

    part = reduce_partials(df.select(F.col(vec).alias("_v")), fold, k * (d + 2)).reshape(k, d + 2)
    rows = [(i, int(round(p[0])), float(p[1]), j, float(p[2 + j] / p[0])) for i, p in enumerate(part) if p[0] > 0 for j in range(d)]
    return df.sparkSession.createDataFrame(rows, "cluster int, n long, cost double, dim int, value double")


# ---- diagonal Gaussian mixture ---------------------------------------------------

LOG2PI = math.log(2 * math.pi)


DENSITY_ERROR = 1e-9


def _log_dens(x: np.ndarray, w, mu, var, both: np.ndarray | None = None) -> np.ndarray:
    """log(w_k N(x | mu_k, diag var_k)) for every row and component -> (n, k).

    One product with ``[x, x^2]`` (``both``) gives all squares; components whose terms are so large that they would cancel
    (tiny variances far from the origin) are measured term by term.
    """
    both = np.hstack([x, x * x]) if both is None else both
    inv = 1.0 / var
    const = np.log(w) - 0.5 * np.sum(np.log(var) + LOG2PI, axis=1)
    out = both @ np.hstack([mu * inv, -0.5 * inv]).T
    out += const - 0.5 * (mu * mu * inv).sum(axis=1)
    top = (x * x).max(axis=0) if len(x) else np.zeros(x.shape[1])
    rough = 2.0 ** -52 * x.shape[1] * (np.maximum(top, mu * mu) * inv).sum(axis=1) > DENSITY_ERROR
    for c in np.flatnonzero(rough):
        out[:, c] = const[c] - 0.5 * np.sum((x - mu[c]) ** 2 / var[c], axis=1)
    return out


def gmm_stats(df: DataFrame, vec: str, w, mu, var) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, int]:
    """E-step + sufficient statistics in one pass: (Nk, Sk, Qk, loglik, n)."""
    w, mu, var = np.asarray(w, float), np.asarray(mu, float), np.asarray(var, float)
    k, d = mu.shape

    def fn(pdf):
        x = stack_vectors(pdf["_v"])
        ld = _log_dens(x, w, mu, var)
        m = ld.max(axis=1, keepdims=True)
        lse = m[:, 0] + np.log(np.exp(ld - m).sum(axis=1))
        r = np.exp(ld - lse[:, None])
        return np.concatenate([r.sum(0), (r.T @ x).ravel(), (r.T @ (x * x)).ravel(), [lse.sum(), x.shape[0]]])

    tot = reduce_partials(df.select(F.col(vec).alias("_v")), fn, k + 2 * k * d + 2)
    nk = tot[:k]
    sk = tot[k:k + k * d].reshape(k, d)
    qk = tot[k + k * d:k + 2 * k * d].reshape(k, d)
    return nk, sk, qk, float(tot[-2]), int(round(tot[-1]))


def gmm_m_step(nk, sk, qk, n, reg: float = 1e-6):
    nk_safe = np.maximum(nk, 1e-300)
    mu = sk / nk_safe[:, None]
    var = qk / nk_safe[:, None] - mu * mu + reg
    return nk / n, mu, np.maximum(var, reg)


def gmm_diag_fit(df: DataFrame, vec: str, k: int, seed: int = 100, max_iter: int = 100, tol: float = 1e-3,
                 reg: float = 1e-6):
    """EM for a diagonal-covariance mixture; init from k-means (one restart) like the usual default.

    Returns ``dict(weights, means, vars, loglik, iterations, n)``; convergence
    when the mean log-likelihood gain per row drops below ``tol``.
    """
    km = kmeans_fit(df.select(vec), vec, k, n_init=1, seed=seed)
    return gmm_batch(df, vec, {k: np.array(km.clusterCenters())}, max_iter, tol, reg)[k]


def gmm_predict(df: DataFrame, vec: str, params: dict, out: str = "cluster") -> DataFrame:
    """Most likely component per row (JVM expression over the literal parameters)."""
    w, mu, var = params["weights"], params["means"], params["vars"]
    const = [(math.log(w[c]) if w[c] > 0 else -math.inf) - 0.5 * float(np.sum(np.log(var[c]) + LOG2PI)) for c in range(len(w))]
    M, IV = lit_matrix(mu.tolist()), lit_matrix((1.0 / var).tolist())
    terms = F.transform(M, lambda m, i: F.struct(
        (-(F.lit(0.0) + F.element_at(F.array(*[F.lit(v) for v in const]), i + 1)
           - 0.5 * F.aggregate(F.zip_with(F.zip_with(F.col(vec), m, lambda x, y: (x - y) * (x - y)),
                                          F.element_at(IV, i + 1), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)))
        .alias("neg"), i.alias("i")))
    return df.withColumn(out, F.array_min(terms)["i"])


def n_params_diag(k: int, d: int) -> int:
    return 2 * k * d + k - 1


def aic_bic(loglik: float, k: int, d: int, n: int) -> tuple[float, float]:
    p = n_params_diag(k, d)
    return -2 * loglik + 2 * p, -2 * loglik + p * math.log(n)
