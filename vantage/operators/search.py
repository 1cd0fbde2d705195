"""Random search over weight vectors, scored on the whole table by Spark.

The candidate population is model-sized (candidates x features) and lives on
the driver; every generation is one Spark job that scores *all* candidates
against *all* rows in a single pass (one dot product per candidate per row,
partial sums per task), and only per-candidate totals come back.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import py_hash_unit
from ..functions.vectors import dot, lit_matrix
from .linalg import reduce_partials, stack_vectors


def hashed_candidates(n: int, d: int, seed: int = 0, scale: float = 0.2) -> list[list[float]]:
    """Deterministic candidates ``w[c][j] = (u - 0.5) * scale`` with ``u = hash_unit(cand:seed:c:j)``."""
    return [[(py_hash_unit("cand", seed, c, j) - 0.5) * scale for j in range(d)] for c in range(n)]


def squared_error(pred, y):
    return (pred - y) * (pred - y)


def population_score(df: DataFrame, vec: str, y: str, cands: Sequence[Sequence[float]],
                     threshold: float = 0.5, objective=squared_error, link=None) -> DataFrame:
    """Per candidate: summed ``objective(pred, y)`` (``sse``) and share of rows with ``|pred - y| < threshold``.

    ``pred = link(w.x)`` (identity by default).  ``objective`` and ``link`` are
    ``Column -> Column`` callables, so injected evaluation functions stay on the JVM.
    """
    W = lit_matrix(cands)
    preds = df.select(F.transform(W, lambda w: dot(w, vec) if link is None else link(dot(w, vec))).alias("_p"),
                      F.col(y).cast("double").alias("_y"))
    aggs = []
    for c in range(len(cands)):
        p, t = F.col("_p")[c], F.col("_y")
        aggs += [F.sum(objective(p, t)).alias(f"sse{c}"),
                 F.avg((F.abs(p - t) < threshold).cast("double")).alias(f"acc{c}")]
    row = preds.agg(*aggs, F.count(F.lit(1)).alias("n"))
    return row.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("candidate"), F.col(f"sse{c}").alias("sse"), F.col(f"acc{c}").alias("accuracy"))
        for c in range(len(cands))])))


def _scores(df, vec, y, pop):
    rows = population_score(df, vec, y, pop.tolist()).collect()
    out = np.zeros(len(pop))
    acc = np.zeros(len(pop))
    for r in rows:
        out[r["candidate"]] = r["sse"]
        acc[r["candidate"]] = r["accuracy"]
    return out, acc


def search_hill_climb(df: DataFrame, vec: str, y: str, d: int, generations: int = 10, neighbours: int = 16,
                      step: float = 0.05, seed: int = 0) -> DataFrame:
    """Randomised hill climbing: each generation scores a batch of neighbours, keeps the best."""
    rng = np.random.default_rng(seed)
    best = np.zeros(d)
    best_sse, best_acc = _scores(df, vec, y, best[None, :])
    best_sse, best_acc = best_sse[0], best_acc[0]
    hist = []
    for g in range(1, generations + 1):
        pop = best + rng.normal(0, step, size=(neighbours, d))
        sse, acc = _scores(df, vec, y, pop)
        i = int(np.argmin(sse))
        if sse[i] < best_sse:
            best, best_sse, best_acc = pop[i], sse[i], acc[i]
        hist.append((g, float(best_sse), float(best_acc)))
    return df.sparkSession.createDataFrame(hist, "generation int, sse double, accuracy double")


def search_anneal(df: DataFrame, vec: str, y: str, d: int, generations: int = 10, chains: int = 16,
                  temp: float = 1e3, cooling: float = 0.4, step: float = 0.05, seed: int = 0) -> DataFrame:
    """Parallel simulated-annealing chains; acceptance ``exp((f - f') / T)``, ``T *= cooling``."""
    rng = np.random.default_rng(seed)
    cur = np.zeros((chains, d))
    cur_sse, _ = _scores(df, vec, y, cur)
    hist = []
    t = temp
    for g in range(1, generations + 1):
        prop = cur + rng.normal(0, step, size=cur.shape)
        sse, acc = _scores(df, vec, y, prop)
        accept = (sse < cur_sse) | (rng.random(chains) < np.exp(np.minimum(0.0, (cur_sse - sse) / max(t, 1e-300))))
        cur[accept] = prop[accept]
        cur_sse[accept] = sse[accept]
        t *= cooling
        i = int(np.argmin(cur_sse))
        hist.append((g, float(cur_sse[i]), float(t)))
    return df.sparkSession.createDataFrame(hist, "generation int, sse double, temperature double")


def search_genetic(df: DataFrame, vec: str, y: str, d: int, generations: int = 10, population: int = 24,
                   mate: int = 8, mutate: int = 2, step: float = 0.05, seed: int = 0) -> DataFrame:
    """Genetic search: keep the best, uniform crossover of ``mate`` pairs, ``mutate`` mutations per generation."""
    rng = np.random.default_rng(seed)
    pop = rng.normal(0, step, size=(population, d))
    sse, acc = _scores(df, vec, y, pop)
    hist = []
    for g in range(1, generations + 1):
        order = np.argsort(sse, kind="stable")
        pop, sse = pop[order], sse[order]
        kids = []
        for _ in range(mate):
            a, b = rng.integers(0, max(1, population // 2), size=2)
            mask = rng.random(d) < 0.5
            kids.append(np.where(mask, pop[a], pop[b]))
        kids = np.array(kids) if kids else np.zeros((0, d))
        for _ in range(mutate):
            if len(kids):
                k = rng.integers(0, len(kids))
                kids[k, rng.integers(0, d)] += rng.normal(0, step)
        if len(kids):
            ks, _ = _scores(df, vec, y, kids)
            pop[-len(kids):], sse[-len(kids):] = kids, ks
        i = int(np.argmin(sse))
        hist.append((g, float(sse[i])))
    return df.sparkSession.createDataFrame(hist, "generation int, sse double")



# ---- one-hidden-layer networks: all optimisers in one scan per generation ----------------

def network_size(d: int, hidden: int) -> int:
    """Weights of a d-hidden-1 network with biases."""
    return hidden * (d + 1) + hidden + 1


def network_forward(x: np.ndarray, w: np.ndarray, hidden: int) -> np.ndarray:
    """Outputs of a batch for one flat weight vector: sigmoid hidden layer and output."""
    d = x.shape[1]
    first = w[:hidden * (d + 1)].reshape(hidden, d + 1)
    last = w[hidden * (d + 1):]
    h = 1 / (1 + np.exp(-np.clip(x @ first[:, :d].T + first[:, d], -40, 40)))
    return 1 / (1 + np.exp(-np.clip(h @ last[:-1] + last[-1], -40, 40)))


def network_scores(df: DataFrame, vec: str, y: str, pop: np.ndarray, hidden: int, threshold: float = 0.5):
    """Squared error and accuracy of every network of ``pop`` on the whole table: one scan of partial sums."""
    n = len(pop)

    def fold(pdf):
        x, t = stack_vectors(pdf["_v"]), pdf["_y"].to_numpy(dtype=float)
        out = np.empty((n, 2))
        for i in range(n):
            e = np.abs(network_forward(x, pop[i], hidden) - t)
            out[i] = (e * e).sum(), (e < threshold).sum()
        return np.concatenate([out.ravel(), [len(x)]])

    tot = reduce_partials(df.select(F.col(vec).alias("_v"), F.col(y).cast("double").alias("_y")), fold, 2 * n + 1)
    part = tot[:-1].reshape(n, 2)
    return part[:, 0], part[:, 1] / max(tot[-1], 1.0)


def _climb(rng, size, neighbours, step):
    """Coroutine: yields populations, receives their errors; sends back the best vector so far."""
    best, best_sse = rng.normal(0, 0.5, size), np.inf
    pop = np.vstack([best, best + rng.normal(0, step, (neighbours - 1, size))])
    while True:
        sse = yield pop, best
        i = int(np.argmin(sse))
        if sse[i] < best_sse:
            best, best_sse = pop[i], sse[i]
        pop = best + rng.normal(0, step, (neighbours, size))


def _anneal(rng, size, chains, step, temp, cooling):
    cur, cur_sse = None, None
    best, best_sse = np.zeros(size), np.inf
    pop = rng.normal(0, 0.5, (chains, size))
    while True:
        sse = yield pop, best
        if cur is None:
            cur, cur_sse = pop.copy(), sse.copy()
        else:
            take = (sse < cur_sse) | (rng.random(chains) < np.exp(np.minimum(0.0, (cur_sse - sse) / max(temp, 1e-300))))
            cur[take], cur_sse[take] = pop[take], sse[take]
            temp *= cooling
        i = int(np.argmin(cur_sse))
        if cur_sse[i] < best_sse:
            best, best_sse = cur[i].copy(), cur_sse[i]
        pop = cur + rng.normal(0, step, cur.shape)


def _evolve(rng, size, population, mate, mutate, step):
    pop = rng.normal(0, 0.5, (population, size))
    all_, all_sse = None, None
    best = pop[0]
    while True:
        sse = yield pop, best
        if all_ is None:
            all_, all_sse = pop.copy(), sse.copy()
        else:  # the new ones take the places of the worst
            order = np.argsort(all_sse, kind="stable")
            all_, all_sse = all_[order], all_sse[order]
            all_[-len(pop):], all_sse[-len(pop):] = pop, sse
        best = all_[int(np.argmin(all_sse))].copy()
        good = all_[np.argsort(all_sse, kind="stable")[:max(2, population // 2)]]
        a, b = good[rng.integers(0, len(good), mate)], good[rng.integers(0, len(good), mate)]
        pop = np.where(rng.random((mate, size)) < 0.5, a, b)
        for _ in range(mutate):
            pop[rng.integers(0, mate)] += rng.normal(0, step, size)


def search_report(train: DataFrame, test: DataFrame, vec: str, y: str, d: int, hidden: int, budgets: Sequence[int],
                  anneal: Sequence[tuple], genetic: Sequence[tuple], neighbours: int = 8, step: float = 0.1,
                  seed: int = 0) -> DataFrame:
    """``(algo, config, budget, split, sse, accuracy, seconds)`` of hill climbing, annealing and genetic search.

    All optimisers and settings propose their candidates for a generation together and one scan of the
    training rows scores them; at each budget one more scan scores the best networks on either split.  A
    budget is a number of generations; every optimiser runs on from the last budget.
    """
    import time

    size = network_size(d, hidden)
    runs = [("hill_climb", "", _climb(np.random.default_rng([seed, 0]), size, neighbours, step))]
    runs += [("anneal", f"T={t:g};cooling={c:g}", _anneal(np.random.default_rng([seed, 1, i]), size, neighbours, step, t, c))
             for i, (t, c) in enumerate(anneal)]
    runs += [("genetic", f"population={p};mate={m};mutate={u}", _evolve(np.random.default_rng([seed, 2, i]), size, p, m, u, step))
             for i, (p, m, u) in enumerate(genetic)]
    asked = [next(g) for _, _, g in runs]
    rows, t0 = [], time.time()
    for generation in range(1, max(budgets) + 1):
        pops = [a[0] for a in asked]
        sse, _ = network_scores(train, vec, y, np.vstack(pops), hidden)
        at = 0
        for i, (_, _, g) in enumerate(runs):
            asked[i] = g.send(sse[at:at + len(pops[i])])
            at += len(pops[i])
        if generation in budgets:
            best = np.vstack([a[1] for a in asked])
            spent = time.time() - t0
            for split, frame in (("train", train), ("test", test)):
                e, acc = network_scores(frame, vec, y, best, hidden)
                rows += [(algo, config, generation, split, float(e[i]), float(acc[i]), spent) for i, (algo, config, _) in enumerate(runs)]
    return train.sparkSession.createDataFrame(
        rows, "algo string, config string, budget int, split string, sse double, accuracy double, seconds double")
