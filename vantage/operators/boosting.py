"""Gradient boosting of small trees, all learning rates in lock step, with the score of every round.

A scan of a level sums gradients and curvatures of the logistic loss by node, feature and bin for every learning
rate at once; a round of depth ``m`` trees is ``m`` scans.  Every row's margin is that of the trees so far,
walked again in each scan (the model is a few numbers a tree; trees of one split as one table), so nothing row-sized is kept between scans, and the
confusion counts of the model so far ride along: one fit gives the whole curve over rounds.

Splits lower the squared error of the gradients, leaf values are Newton steps; of equal gains the lowest feature and border win.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linalg import reduce_long
from .trees import BINS, GAIN_DIGITS, accuracy_of, binned, f1_of, quantile_borders


@dataclass
class Booster:
    """One learning rate's model: start margin and trees as heap arrays (feature, bin; feature -1: leaf) with leaf values."""

    rate: float
    start: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        if all(len(tree[0]) == 3 for tree in self.trees):
            return self._stump_margins(x)
        out = np.full(len(x), self.start)
        for tree in self.trees:
            out += self.rate * tree[2][_leaf(tree, x)]
        return out


    def _stump_margins(self, x: np.ndarray) -> np.ndarray:
        """Trees of one split add up to a table by feature and bin, so a scan's work does not follow the rounds."""
        base, table = self.start, {}
        for feature, cut, value in self.trees:
            f = int(feature[0])
            if f < 0:
                base += self.rate * value[0]
                continue
            row = table.setdefault(f, np.zeros(256))
            row[:cut[0] + 1] += self.rate * value[1]
            row[cut[0] + 1:] += self.rate * value[2]
        out = np.full(len(x), base)
        for f, row in table.items():
            out += row[x[:, f]]
        return out


def _leaf(tree, x: np.ndarray) -> np.ndarray:
    """Heap place of the node that each row ends in."""
    feature, cut, _ = tree
    at = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    for _ in range(int(len(feature) + 1).bit_length() - 2):
        f = feature[at]
        at = np.where(f < 0, at, 2 * at + np.where(x[rows, np.maximum(f, 0)] <= cut[at], 1, 2))
    return at


def _unpack(pdf, features: int):
    x = np.frombuffer(b"".join(pdf["bins"]), np.uint8).reshape(len(pdf), features)
    return x, pdf["y"].to_numpy(float), pdf["fold"].to_numpy() == 0


def fit_boosters(rows: DataFrame, features: int, rates: Sequence[float], rounds: int, max_depth: int = 1, min_leaf: int = 1,
                 bins: int = BINS, each_round=None) -> list[Booster]:
    """Boosters on binned rows (``trees.binned``): fold 0 is trained on.  ``each_round(round, counts)`` receives the confusion
    counts ``[rate, train/test, tp fp fn tn]`` of the models with that many rounds."""
    def totals(pdf):
        y, train = pdf["y"].to_numpy(float), pdf["fold"].to_numpy() == 0
        return np.array([train.sum(), y[train].sum()])

    n, positive = reduce_long(rows.select("y", "fold"), totals, 2)
    odds = min(max(positive / n, 1e-9), 1 - 1e-9) if n else 0.5
    models = [Booster(float(r), float(np.log(odds / (1 - odds)))) for r in rates]
    width = features * bins * 3
    for done in range(rounds + 1):
        nodes = 2 ** (max_depth + 1) - 1
        growing = [(np.full(nodes, -1, np.int64), np.zeros(nodes, np.int64), np.zeros(nodes)) for _ in models]
        last_round = done == rounds
        for depth in range(1 if last_round else max_depth):
            first, wide = 2 ** depth - 1, 2 ** depth
            state = [(m, g) for m, g in zip(models, growing, strict=True)]

            def scan(pdf, state=state, first=first, wide=wide, count_only=last_round):
                x, y, train = _unpack(pdf, features)
                out = []
                for model, tree in state:
                    margin = model.margins(x)
                    p = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
                    cell = np.where(margin > 0, np.where(y == 1, 0, 1), np.where(y == 1, 2, 3))
                    out.append(np.bincount(np.where(train, 0, 4) + cell, minlength=8).astype(float))
                    if count_only:
                        continue
                    at = _leaf(tree, x) - first
                    use = np.flatnonzero(train & (at >= 0) & (at < wide))
                    place = ((at[use][:, None] * features + np.arange(features)) * bins + x[use]).ravel()
                    size = wide * features * bins
                    for v in (y - p, p * (1 - p), np.ones(len(y))):
                        out.append(np.bincount(place, np.repeat(v[use], features), size))
                return np.concatenate(out)

            per = 8 + (0 if last_round else wide * width)
            tot = reduce_long(rows, scan, per * len(models)).reshape(len(models), per)
            if depth == 0 and each_round is not None:
                each_round(done, tot[:, :8].reshape(len(models), 2, 4))
            if last_round:
                break
            for k, tree in enumerate(growing):
                g, h, c = tot[k, 8:].reshape(3, wide, features, bins)
                for node in range(wide):
                    if depth and tree[0][(first + node - 1) // 2] < 0:
                        continue  # the parent is a leaf
                    _split(tree, first + node, g[node], h[node], c[node], min_leaf)
        if not last_round:
            for m, tree in zip(models, growing, strict=True):
                m.trees.append(tree)
    return models


def _split(tree, node: int, g: np.ndarray, h: np.ndarray, c: np.ndarray, min_leaf: int) -> None:
    """Best split of one node from its sums by feature and bin; both children start as leaves."""
    feature, cut, value = tree
    gl, cl, hl = (np.cumsum(v, axis=1)[:, :-1] for v in (g, c, h))
    gt, ct, ht = g[0].sum(), c[0].sum(), h[0].sum()
    if node == 0:
        value[0] = gt / ht if ht > 0 else 0.0
    cr = ct - cl
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gl * gl / cl + (gt - gl) ** 2 / cr - gt * gt / ct
    gain = np.where((cl >= min_leaf) & (cr >= min_leaf), np.round(gain, GAIN_DIGITS), 0.0)
    if not gain.size or gain.max() <= 0:
        return
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    feature[node], cut[node] = f, b
    for child, gs, hs in ((2 * node + 1, gl[f, b], hl[f, b]), (2 * node + 2, gt - gl[f, b], ht - hl[f, b])):
        value[child] = gs / hs if hs > 0 else 0.0


def boosting_curve(df: DataFrame, vec: str, label: str, split_col: str, rounds: Sequence[int], rates: Sequence[float],
                   max_depth: int = 1, min_leaf: int = 1, bins: int = BINS) -> DataFrame:
    """F1 and accuracy on both splits after each of ``rounds`` for every learning rate, from one fit."""
    borders = quantile_borders(df, vec, bins)
    side = (F.col(split_col) == "test").cast("int")
    data = binned(df, vec, label, borders, side, F.array(F.lit(1))).select("y", "fold", "bins").persist()
    out = []

    def note(done, counts):
        if done in wanted:
            for k, rate in enumerate(rates):
                for i, name in enumerate(("train", "test")):
                    out.append((float(rate), int(done), name, float(f1_of(counts[k, i])), float(accuracy_of(counts[k, i]))))

    wanted = set(rounds)
    try:
        if borders:
            fit_boosters(data, len(borders), rates, max(rounds), max_depth, min_leaf, bins, note)
    finally:
        data.unpersist()
    return df.sparkSession.createDataFrame(out, "learning_rate double, rounds int, split string, f1 double, accuracy double")
