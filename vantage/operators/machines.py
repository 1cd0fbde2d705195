"""Many support vector machines at once: kernel feature maps and one batched Newton solver.

Kernels become explicit maps, so a machine is a linear one in the map's space:

* polynomial ``(gamma x.y + c)^p``: tensor sketches.  A count sketch adds every coordinate, with a hashed sign, to one
  hashed cell; the sketch of a p-fold product is the circular convolution of p independent ones, a product in
  the Fourier domain.  The cost does not depend on ``d^p``, and all degrees up to p come from the same p sketches;
* radial ``exp(-gamma |x - y|^2)``: random Fourier features with one hashed normal matrix, scaled by gamma;
* sigmoid: ``tanh(gamma x.l + c)`` against a bounded set of landmark rows.

The solver minimises ``|w|^2 / 2 + C sum loss(1 - y (w.z + b))`` for all penalties, kernels and folds together: a scan
returns loss, gradient and curvature of every machine that still moves, and each machine takes its own damped Newton
step.  The number of scans is that of the slowest machine, whatever the grid.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from ..functions.hashing import py_hash32, py_hash_unit
from .linalg import reduce_long, stack_vectors

CELLS = 256

# ------------------------------------------------------------------ feature maps: float[rows, d] -> float[rows, m]


def sketch_tables(d: int, degree: int, cells: int = CELLS, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Cell and sign of every coordinate in each of ``degree`` count sketches."""
    cell = np.array([[py_hash32("cell", seed, k, i) % cells for i in range(d)] for k in range(degree)], np.int64).reshape(degree, d)
    sign = np.array([[1.0 - 2.0 * (py_hash32("sign", seed, k, i) % 2) for i in range(d)] for k in range(degree)]).reshape(degree, d)
    return cell, sign


def tensor_sketch(x: np.ndarray, degree: int, cells: int = CELLS, gamma: float = 1.0, coef0: float = 0.0, seed: int = 0) -> np.ndarray:
    """Features whose products estimate ``(gamma x.y + coef0)^degree`` without bias."""
    z = math.sqrt(gamma) * x
    if coef0:
        z = np.hstack([z, np.full((len(z), 1), math.sqrt(coef0))])
    cell, sign = sketch_tables(z.shape[1], degree, cells, seed)
    out = 1.0
    for k in range(degree):
        hot = np.zeros((z.shape[1], cells))
        hot[np.arange(z.shape[1]), cell[k]] = sign[k]
        out = out * np.fft.rfft(z @ hot, axis=1)
    return np.fft.irfft(out, cells, axis=1)


def fourier_normals(d: int, n_features: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashed standard normals ``[n_features, d]`` (Box-Muller, which SQL can repeat) and phases."""
    def normal(i, j):
        u1, u2 = 1.0 - py_hash_unit("rff", seed, i, j, 1), py_hash_unit("rff", seed, i, j, 2)
        return math.sqrt(-2.0 * math.log(u1)) * math.cos(2 * math.pi * u2)
    w = np.array([[normal(i, j) for j in range(d)] for i in range(n_features)]).reshape(n_features, d)
    return w, np.array([2 * math.pi * py_hash_unit("rff", seed, i, "b") for i in range(n_features)])


def linear_map() -> Callable[[np.ndarray], np.ndarray]:
    return lambda x: x


def poly_map(degree: int, cells: int = CELLS, gamma: float = 1.0, coef0: float = 0.0, seed: int = 0):
    return lambda x: tensor_sketch(x, degree, cells, gamma, coef0, seed)


def rbf_map(d: int, gamma: float, n_features: int = 128, seed: int = 0):
    w, b = fourier_normals(d, n_features, seed)
    w, scale = math.sqrt(2 * gamma) * w, math.sqrt(2.0 / n_features)
    return lambda x: scale * np.cos(x @ w.T + b)


def sigmoid_map(landmarks: np.ndarray, gamma: float, coef0: float = 0.0):
    return lambda x: np.tanh(gamma * (x @ landmarks.T) + coef0)


def tensor_sketch_map(df: DataFrame, vec: str, degree: int, cells: int = CELLS, gamma: float = 1.0, coef0: float = 0.0,
                      seed: int = 0, out: str = "sketch") -> DataFrame:
    """``df`` with the sketch features as a column (null vector: null)."""
    @pandas_udf("array<double>")
    def sketch(v: pd.Series) -> pd.Series:
        have = v.notna().to_numpy()
        done = iter(tensor_sketch(stack_vectors(v[have]), degree, cells, gamma, coef0, seed) if have.any() else ())
        return pd.Series([next(done) if h else None for h in have], index=v.index, dtype=object)
    return df.withColumn(out, sketch(F.col(vec).cast("array<double>")))


# ------------------------------------------------------------------ the solver

@dataclass
class Machine:
    """One machine: its map's name, penalty and held-out fold (-1: none); ``w`` holds the intercept last."""

    kernel: str
    c: float
    fold: int = -1
    w: np.ndarray = field(default=None, repr=False)
    objective: float = math.inf
    steps: int = 0
    # the last accepted point and the damping of the next step
    _at: tuple = field(default=None, repr=False)
    _damp: float = 0.0


def _loss(r: np.ndarray, smooth: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss of the shortfall ``r = 1 - margin``, its slope and curvature (squared hinge, or a hinge rounded over ``smooth``)."""
    p = np.maximum(r, 0.0)
    if smooth is None:
        return p * p, 2.0 * p, 2.0 * (p > 0)
    inner = p < smooth
    return (np.where(inner, p * p / (2 * smooth), p - smooth / 2), np.where(inner, p / smooth, 1.0),
            np.where((r > 0) & inner, 1.0 / smooth, 0.0))


def _moved(m: Machine, loss: float, grad: np.ndarray, curve: np.ndarray, tol: float) -> bool:
    """Take the scan's result at ``m.w``; set the next trial point.  False: the machine has settled."""
    reg = np.ones(len(m.w))
    reg[-1] = 0.0
    value = 0.5 * float((reg * m.w * m.w).sum()) + m.c * loss
    if m._at is None or value <= m.objective:
        m.objective, m._damp = value, m._damp / 10 if m._damp > 1e-9 else 0.0
        m._at = (m.w, reg * m.w + m.c * grad, np.diag(reg) + m.c * curve)
    else:  # the step went too far: back to the accepted point, with more damping
        m._damp = max(10 * m._damp, 1e-3)
    w, g, h = m._at
    ridge = (1e-10 + m._damp) * max(1.0, float(np.trace(h)) / len(h))
    step = np.linalg.solve(h + ridge * np.eye(len(h)), g)
    if 0.5 * float(g @ step) <= tol * (1.0 + m.objective) or m._damp > 1e9:
        m.w = w
        return False
    m.w = w - step
    return True


def fit_machines(df: DataFrame, vec: str, label: str, maps: dict[str, Callable], machines: Sequence[Machine],
                 fold_col: str | None = None, smooth: float | None = None, max_iter: int = 60, tol: float = 1e-7) -> list[Machine]:
    """Train all machines (labels 0/1) on the rows outside their fold; rows with a null vector or label take no part."""
    src = df.select(F.col(vec).cast("array<double>").alias("_v"), (2 * F.col(label).cast("double") - 1).alias("_y"),
                    (F.col(fold_col) if fold_col else F.lit(-2)).cast("int").alias("_f")).where("_v is not null and _y is not null").persist()
    try:
        first = src.select("_v").first()
        if first is None:
            return list(machines)
        probe = np.array([first["_v"]], float)
        for m in machines:
            m.w = np.zeros(maps[m.kernel](probe).shape[1] + 1)
        live = list(machines)
        for step in range(max_iter):
            sizes = [1 + len(m.w) + len(m.w) ** 2 for m in live]
            asked = [(m.kernel, m.fold, m.w) for m in live]

            def scan(pdf, asked=asked):
                x, y, fold = stack_vectors(pdf["_v"]), pdf["_y"].to_numpy(), pdf["_f"].to_numpy()
                mapped: dict[str, np.ndarray] = {}
                out = []
                for kernel, held, w in asked:
                    if kernel not in mapped:
                        mapped = {kernel: np.hstack([maps[kernel](x), np.ones((len(x), 1))])}
                    z = mapped[kernel]
                    inside = fold != held
                    loss, slope, curve = _loss(np.where(inside, 1.0 - y * (z @ w), -1.0), smooth)
                    act = curve > 0
                    za = z[act]
                    out += [[loss.sum()], -(z.T @ (slope * y)), (za.T @ (curve[act][:, None] * za)).ravel()]
                return np.concatenate(out)

            tot = reduce_long(src, scan, sum(sizes))
            at, moving = 0, []
            for m, size in zip(live, sizes, strict=True):
                d = len(m.w)
                part = tot[at:at + size]
                at += size
                m.steps = step + 1
                if _moved(m, float(part[0]), part[1:1 + d], part[1 + d:].reshape(d, d), tol):
                    moving.append(m)
            live = moving
            if not live:
                break
        for m in live:  # out of steps: the last accepted point
            m.w = m._at[0]
        return list(machines)
    finally:
        src.unpersist()


def machine_counts(df: DataFrame, vec: str, label: str, maps: dict[str, Callable], machines: Sequence[Machine], group: str,
                   groups: int) -> np.ndarray:
    """Confusion counts ``[machine, group, tp fp fn tn]`` by an integer column ``0..groups - 1``, all machines in one scan."""
    src = df.select(F.col(vec).cast("array<double>").alias("_v"), F.col(label).cast("int").alias("_y"), F.col(group).cast("int").alias("_g")) \
        .where("_v is not null and _y is not null")
    asked = [(m.kernel, m.w) for m in machines]

    def scan(pdf):
        x, y, g = stack_vectors(pdf["_v"]), pdf["_y"].to_numpy(), pdf["_g"].to_numpy()
        mapped: dict[str, np.ndarray] = {}
        out = []
        for kernel, w in asked:
            if kernel not in mapped:
                mapped = {kernel: np.hstack([maps[kernel](x), np.ones((len(x), 1))])}
            positive = mapped[kernel] @ w > 0
            cell = np.where(positive, np.where(y == 1, 0, 1), np.where(y == 1, 2, 3))
            out.append(np.bincount(g * 4 + cell, minlength=4 * groups))
        return np.concatenate(out)

    if not asked or asked[0][1] is None:
        return np.zeros((len(asked), groups, 4))
    return reduce_long(src, scan, len(asked) * 4 * groups).reshape(len(asked), groups, 4)


def predictions(df: DataFrame, vec: str, maps: dict[str, Callable], machines: dict[str, Machine], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns and one 0/1 column per named machine."""
    def signs(m: Machine):
        kernel, w = maps[m.kernel], m.w

        @pandas_udf("int")
        def sign(v: pd.Series) -> pd.Series:
            return pd.Series((np.hstack([kernel(stack_vectors(v)), np.ones((len(v), 1))]) @ w > 0).astype(int))
        return sign(F.col(vec))

    if any(m.w is None for m in machines.values()):  # nothing was trained: no rows
        return df.select(*keep, *[F.lit(0).alias(name) for name in machines])
    return df.select(*keep, *[signs(m).alias(name) for name, m in machines.items()])


def scale_gamma(df: DataFrame, vec: str) -> float:
    """``1 / (width x variance of all entries)``, the usual kernel width for unscaled tables (0 rows or no spread: 1)."""
    def total(f):
        return F.sum(F.aggregate(F.col(vec).cast("array<double>"), F.lit(0.0), f))
    row = df.where(F.col(vec).isNotNull()).agg(F.max(F.size(vec)).alias("d"), F.sum(F.size(vec)).alias("n"), total(lambda s, x: s + x).alias("s"),
                                               total(lambda s, x: s + x * x).alias("q")).first()
    if not row["n"]:
        return 1.0
    spread = row["q"] / row["n"] - (row["s"] / row["n"]) ** 2
    return 1.0 / (row["d"] * spread) if spread > 0 else 1.0


# ------------------------------------------------------------------ studies

def _accuracy(c: np.ndarray) -> float:
    return float((c[0] + c[3]) / max(c.sum(), 1.0))


def _f1(c: np.ndarray) -> float:
    return float(2 * c[0] / (2 * c[0] + c[1] + c[2])) if 2 * c[0] + c[1] + c[2] else 0.0


def rbf_grid_search(df: DataFrame, vec: str, label: str, fold_col: str, folds: int, cs: Sequence[float], gammas: Sequence[float],
                    n_features: int = 128, smooth: float | None = None) -> DataFrame:
    """Mean held-out accuracy of every (C, gamma) over the folds, and the best point (the first on ties)."""
    first = df.select(F.size(vec).alias("d")).where("d > 0").first()
    d = first["d"] if first else 0
    maps = {f"rbf{i}": rbf_map(d, g, n_features) for i, g in enumerate(gammas)}
    grid = [(c, i) for c in cs for i in range(len(gammas))]
    machines = [Machine(f"rbf{i}", c, f) for i in range(len(gammas)) for c in cs for f in range(folds)]
    fit_machines(df, vec, label, maps, machines, fold_col, smooth)
    counts = machine_counts(df, vec, label, maps, machines, fold_col, folds)
    score = {(m.c, m.kernel, m.fold): _accuracy(counts[k, m.fold]) for k, m in enumerate(machines)}
    mean = [float(np.mean([score[c, f"rbf{i}", f] for f in range(folds)])) for c, i in grid]
    steps = {(c, i): max(m.steps for m in machines if m.c == c and m.kernel == f"rbf{i}") for c, i in grid}
    best = int(np.argmax(mean))
    rows = [(k, float(c), float(gammas[i]), mean[k], steps[c, i], k == best) for k, (c, i) in enumerate(grid)]
    return df.sparkSession.createDataFrame(rows, "grid_idx int, c double, gamma double, mean_accuracy double, steps int, best boolean")


def kernel_curve(df: DataFrame, vec: str, label: str, split_col: str, maps: dict[str, Callable], c: float = 1.0,
                 smooth: float | None = None) -> tuple[list[Machine], DataFrame]:
    """F1 and accuracy on the train and test split for every kernel; all kernels are trained together."""
    side = df.withColumn("_side", (F.col(split_col) == "test").cast("int"))
    machines = [Machine(name, c, 1) for name in maps]
    fit_machines(side, vec, label, maps, machines, "_side", smooth)
    counts = machine_counts(side, vec, label, maps, machines, "_side", 2)
    rows = [(m.kernel, name, _f1(counts[k, i]), _accuracy(counts[k, i])) for k, m in enumerate(machines) for i, name in enumerate(("train", "test"))]
    return machines, df.sparkSession.createDataFrame(rows, "kernel string, split string, f1 double, accuracy double")
