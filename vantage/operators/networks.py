"""Many small networks trained in lock step: one gradient scan a step for all shapes, learning rates and folds.

A network is a flat weight vector (logistic hidden layers, logistic output, cross-entropy with a small ridge) that lives
on the driver, model-sized.  A step is one scan: every task sums loss and gradient of every network over its rows,
partials travel as binary blocks, and each network takes its own Adam step on the full gradient.  Held-out rows of
a network's fold are left out of its sums, so cross-validation grids share the scans too.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linalg import gathered, pack_rows, reduce_long, reduce_packed, stack_vectors
from .trees import accuracy_of, f1_of

STEPS, RIDGE = 100, 1e-4


@dataclass
class Network:
    """Hidden layer sizes, learning rate and held-out fold (-1: none)."""

    hidden: tuple[int, ...]
    rate: float = 0.05
    fold: int = -1
    w: np.ndarray = field(default=None, repr=False)
    losses: list[float] = field(default_factory=list, repr=False)
    _m: np.ndarray = field(default=None, repr=False)
    _v: np.ndarray = field(default=None, repr=False)

    def start(self, d: int, seed: int) -> None:
        rng = np.random.default_rng([seed, *self.hidden])
        sizes = layer_sizes(d, self.hidden)
        self.w = np.concatenate([rng.uniform(-1, 1, (a + 1) * b) * np.sqrt(2.0 / (a + b)) for a, b in sizes])
        self._m, self._v = np.zeros_like(self.w), np.zeros_like(self.w)

    def step(self, gradient: np.ndarray, t: int) -> None:
        """One Adam step."""
        self._m = 0.9 * self._m + 0.1 * gradient
        self._v = 0.999 * self._v + 0.001 * gradient * gradient
        self.w = self.w - self.rate * (self._m / (1 - 0.9 ** t)) / (np.sqrt(self._v / (1 - 0.999 ** t)) + 1e-8)


def layer_sizes(d: int, hidden: Sequence[int]) -> list[tuple[int, int]]:
    widths = [d, *hidden, 1]
    return list(zip(widths[:-1], widths[1:], strict=True))


def _layers(w: np.ndarray, d: int, hidden: Sequence[int]) -> list[np.ndarray]:
    """Weight matrices with the bias as their last row."""
    out, at = [], 0
    for a, b in layer_sizes(d, hidden):
        out.append(w[at:at + (a + 1) * b].reshape(a + 1, b))
        at += (a + 1) * b
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def forward(x: np.ndarray, w: np.ndarray, hidden: Sequence[int]) -> list[np.ndarray]:
    """Activations of all layers, the input first and the probabilities last."""
    acts = [x]
    for m in _layers(w, x.shape[1], hidden):
        acts.append(_sigmoid(acts[-1] @ m[:-1] + m[-1]))
    return acts


def loss_and_gradient(x: np.ndarray, y: np.ndarray, w: np.ndarray, hidden: Sequence[int]) -> tuple[float, np.ndarray]:
    """Summed cross-entropy of a batch and its gradient."""
    acts = forward(x, w, hidden)
    p = np.clip(acts[-1][:, 0], 1e-12, 1 - 1e-12)
    loss = -float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())
    delta = acts[-1] - y[:, None]
    grads = []
    layers = _layers(w, x.shape[1], hidden)
    for k in range(len(layers) - 1, -1, -1):
        grads.append(np.vstack([acts[k].T @ delta, delta.sum(axis=0)]).ravel())
        if k:
            delta = (delta @ layers[k][:-1].T) * acts[k] * (1 - acts[k])
    return loss, np.concatenate(grads[::-1])


def train_networks(df: DataFrame, vec: str, label: str, nets: Sequence[Network], fold_col: str | None = None, steps: int = STEPS,
                   seed: int = 100) -> list[Network]:
    """All networks on the rows outside their fold (labels 0/1); rows with a null vector or label take no part."""
    rows = df.select(vec, F.col(label).cast("double").alias("_y"), (F.col(fold_col) if fold_col else F.lit(-2)).cast("int").alias("_f")).where("_y is not null")
    kept = pack_rows(rows, [vec], ["_y", "_f"]).persist()
    try:
        first = kept.select("dims").first()
        if first is None:
            return list(nets)
        src = gathered(kept)
        for n in nets:
            n.start(first["dims"][0], seed)
        for t in range(1, steps + 1):
            asked = [(n.w, n.hidden, n.fold) for n in nets]

            def scan(mats, nums, asked=asked):
                x, (y, fold) = mats[0], nums
                sides = {held: (x[use], y[use]) for held in {f for _, _, f in asked} for use in [fold != held]}
                out = []
                for w, hidden, held in asked:
                    loss, grad = loss_and_gradient(*sides[held], w, hidden)
                    out += [[len(sides[held][1]), loss], grad]
                return np.concatenate(out)

            tot = reduce_packed(src, scan, sum(2 + len(n.w) for n in nets), [("_y", np.float64), ("_f", np.int64)])
            at = 0
            for n in nets:
                rows, loss = max(tot[at], 1.0), tot[at + 1]
                grad = tot[at + 2:at + 2 + len(n.w)]
                at += 2 + len(n.w)
                n.losses.append(float(loss / rows + 0.5 * RIDGE * (n.w @ n.w) / rows))
                n.step((grad + RIDGE * n.w) / rows, t)
        return list(nets)
    finally:
        kept.unpersist()


def network_counts(df: DataFrame, vec: str, label: str, nets: Sequence[Network], group: str, groups: int) -> np.ndarray:
    """Confusion counts ``[network, group, tp fp fn tn]`` by an integer column, all networks in one scan."""
    if not nets or nets[0].w is None:
        return np.zeros((len(nets), groups, 4))
    src = df.select(F.col(vec).cast("array<double>").alias("_v"), F.col(label).cast("int").alias("_y"), F.col(group).cast("int").alias("_g")) \
        .where("_v is not null and _y is not null")
    asked = [(n.w, n.hidden) for n in nets]

    def scan(pdf):
        x, y, g = stack_vectors(pdf["_v"]), pdf["_y"].to_numpy(), pdf["_g"].to_numpy()
        out = []
        for w, hidden in asked:
            positive = forward(x, w, hidden)[-1][:, 0] > 0.5
            cell = np.where(positive, np.where(y == 1, 0, 1), np.where(y == 1, 2, 3))
            out.append(np.bincount(g * 4 + cell, minlength=4 * groups))
        return np.concatenate(out)

    return reduce_long(src, scan, len(nets) * 4 * groups).reshape(len(nets), groups, 4)


def network_curve(df: DataFrame, vec: str, label: str, split_col: str, shapes: Sequence[tuple[int, ...]], rate: float = 0.05,
                  steps: int = STEPS) -> DataFrame:
    """``hidden, split, f1, accuracy, losses`` of every shape, trained together on the train split."""
    side = df.withColumn("_side", (F.col(split_col) == "test").cast("int"))
    nets = train_networks(side, vec, label, [Network(tuple(int(h) for h in s), rate, 1) for s in shapes], "_side", steps)
    counts = network_counts(side, vec, label, nets, "_side", 2)
    rows = [(list(n.hidden), name, float(f1_of(counts[k, i])), float(accuracy_of(counts[k, i])), n.losses)
            for k, n in enumerate(nets) for i, name in enumerate(("train", "test"))]
    return df.sparkSession.createDataFrame(rows, "hidden array<int>, split string, f1 double, accuracy double, losses array<double>")


def network_grid_search(df: DataFrame, vec: str, label: str, fold_col: str, folds: int, units: Sequence[int], rates: Sequence[float],
                        steps: int = STEPS) -> DataFrame:
    """Mean held-out accuracy of every (units, rate) over the folds, and the best point (the first on ties)."""
    nets = [Network((int(h),), float(r), f) for h in units for r in rates for f in range(folds)]
    train_networks(df, vec, label, nets, fold_col, steps)
    counts = network_counts(df, vec, label, nets, fold_col, folds)
    own = np.array([float(accuracy_of(counts[k, n.fold])) for k, n in enumerate(nets)]).reshape(-1, folds).mean(axis=1)
    grid = [(h, r) for h in units for r in rates]
    best = int(np.argmax(own))
    rows = [(k, int(h), float(r), float(own[k]), k == best) for k, (h, r) in enumerate(grid)]
    return df.sparkSession.createDataFrame(rows, "grid_idx int, units int, rate double, mean_accuracy double, best boolean")
