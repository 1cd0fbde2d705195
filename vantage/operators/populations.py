"""Random search as population tables: hill climbing, annealing and genetic search of linear scores.

A population is a DataFrame of weight vectors.  The summed squared error of any vector follows from the
table's Gram matrix, ``yy - 2 b.w + w.G w``, so one scan of the data serves every generation, and generations
are expressions and aggregations over the population: many of them are one plan.  All randomness is hashed
(algorithm, seed, generation, member, gene), so a run repeats anywhere, in SQL too.

* hill climbing: the best of the state and its hashed neighbours stays;
* annealing: chains side by side, each accepting by ``u < exp((f - f') / T)``, ``T`` cooled every generation;
* genetic: members in rank order; parents by hashed rank in the better half, uniform crossover, hashed mutations,
  children in the places of the worst.

Plans are cut every ``CUT`` generations (nested array expressions are slow to optimise, a checkpoint of a population is not).
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_unit
from ..functions.vectors import dot, lit_vector
from ..session import cut_lineage
from .linalg import gram
from .search import population_score

CUT, DIGITS = 1, 9


def moments(df: DataFrame, vec: str, y: str) -> tuple[np.ndarray, np.ndarray, float]:
    """Gram matrix of the vectors, their products with ``y``, and the sum of squares of ``y`` (one scan)."""
    g = gram(df.select(F.concat(F.col(vec).cast("array<double>"), F.array(F.col(y).cast("double"))).alias("_z")), "_z", with_intercept=False)
    return g[:-1, :-1], g[:-1, -1], float(g[-1, -1]) if g.size else 0.0


def squared_errors(m: tuple[np.ndarray, np.ndarray, float], w: Column) -> Column:
    """Summed squared error of a weight column, rounded so that summation order cannot flip a choice."""
    g, b, yy = m
    # one text literal, folded once by the optimizer: thousands of number literals would slow every analysis
    table = F.from_json(F.lit(json.dumps([*g.tolist(), b.tolist()])), "array<array<double>>")
    products = F.transform(table, lambda row: dot(row, w))
    quad = dot(F.slice(products, F.lit(1), F.lit(len(b))), w)
    return F.round(F.lit(yy) - 2 * F.element_at(products, -1) + quad, DIGITS)


def _genes(d: int, make) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(d - 1)), make)


def _jitter(step: float, *key) -> Column:
    return (hash_unit(*key) - F.lit(0.5)) * F.lit(step)


def _steps(d: int, step: float, algo: str, seed: int, generation: int, member: str) -> Column:
    return _genes(d, lambda j: _jitter(step, F.lit(algo), F.lit(seed), F.lit(generation), F.col(member), j))


def _bred(d: int, half: int, seed: int, generation: int):
    """Child ``k``: each gene from its mother or its father, both drawn by rank from the better half of ``pop``."""
    def draw(what, *key):
        return hash_unit(F.lit(what), F.lit(seed), F.lit(generation), *key)

    def parent(which, k):
        return F.element_at(F.col("pop"), F.floor(draw(which, k) * half).cast("int") + 1)["w"]

    def child(k):
        pairs = F.zip_with(parent("mother", k), parent("father", k), lambda x, z: F.struct(x.alias("x"), z.alias("z")))
        return F.zip_with(pairs, F.sequence(F.lit(0), F.lit(d - 1)), lambda p, j: F.when(draw("gene", k, j) < 0.5, p["x"]).otherwise(p["z"]))
    return child


def _mutated(d: int, mate: int, step: float, seed: int, generation: int, nth: int) -> Column:
    """``kids`` with one hashed gene of one hashed child moved."""
    def draw(what):
        return hash_unit(F.lit(what), F.lit(seed), F.lit(generation), F.lit(nth))

    child, gene = F.floor(draw("child") * mate).cast("int"), F.floor(draw("place") * d).cast("int")
    by = (draw("mutate") - F.lit(0.5)) * F.lit(step)
    return F.transform("kids", lambda w, k: F.when(k == child, F.transform(w, lambda v, j: F.when(j == gene, v + by).otherwise(v))).otherwise(w))


def _history(df: DataFrame, vec: str, y: str, best: DataFrame) -> DataFrame:
    """``best`` (generation, w, ...) with the accuracy of every generation's vector, in one more scan."""
    rows = best.orderBy("generation").collect()  # one row a generation
    if not rows:
        return best.drop("w").withColumn("accuracy", F.lit(0.0))
    acc = population_score(df, vec, y, [r["w"] for r in rows]).select((F.col("candidate") + F.lit(rows[0]["generation"])).alias("generation"), "accuracy")
    return best.drop("w").join(acc, "generation")


def hill_climb(df: DataFrame, vec: str, y: str, d: int, generations: int = 10, neighbours: int = 16, step: float = 0.1,
               seed: int = 0) -> DataFrame:
    """``generation, sse, accuracy`` of the best vector so far."""
    if not d:  # an empty table has no width
        return df.sparkSession.createDataFrame([], "generation int, sse double, accuracy double")
    m = moments(df, vec, y)
    zero = F.array_repeat(F.lit(0.0), d)
    state = df.sparkSession.range(1).select(zero.alias("w"), squared_errors(m, zero).alias("sse"), F.array().cast("array<struct<sse:double,w:array<double>>>").alias("past"))
    for g in range(1, generations + 1):
        near = state.select("w", F.posexplode(F.sequence(F.lit(0), F.lit(neighbours - 1))).alias("k", "n"), "sse", "past")
        moved = near.select("k", F.zip_with("w", _steps(d, step, "climb", seed, g, "n"), lambda a, b: a + b).alias("w"), "past")
        tried = moved.select(F.col("k"), "w", squared_errors(m, F.col("w")).alias("sse"), "past")
        both = tried.unionByName(state.select(F.lit(-1).alias("k"), "w", "sse", "past"))  # on ties the state stays
        state = both.agg(F.min_by(F.struct("w", "sse", "past"), F.struct("sse", "k")).alias("s")).select("s.w", "s.sse", "s.past")
        state = state.withColumn("past", F.concat("past", F.array(F.struct("sse", "w"))))
        if g % CUT == 0 or g == generations:
            state = cut_lineage(state)
    best = state.select(F.posexplode("past").alias("g", "p")).select((F.col("g") + 1).alias("generation"), "p.sse", "p.w")
    return _history(df, vec, y, best)


def anneal(df: DataFrame, vec: str, y: str, d: int, generations: int = 10, chains: int = 16, temp: float = 1e3, cooling: float = 0.4,
           step: float = 0.1, seed: int = 0) -> DataFrame:
    """``generation, sse, temperature, accuracy`` of the best chain; a generation is one projection, without a shuffle."""
    if not d:  # an empty table has no width
        return df.sparkSession.createDataFrame([], "generation int, sse double, temperature double, accuracy double")
    m = moments(df, vec, y)
    zero = F.array_repeat(F.lit(0.0), d)
    state = df.sparkSession.range(chains).select(F.col("id").alias("c"), zero.alias("w"), squared_errors(m, zero).alias("sse"),
                                                 F.array().cast("array<struct<sse:double,w:array<double>>>").alias("past"))
    t = float(temp)
    heat = []
    for g in range(1, generations + 1):
        tried = state.withColumn("w2", F.zip_with("w", _steps(d, step, "anneal", seed, g, "c"), lambda a, b: a + b))
        tried = tried.withColumn("sse2", squared_errors(m, F.col("w2")))
        chance = F.exp(F.least(F.lit(0.0), (F.col("sse") - F.col("sse2")) / F.lit(max(t, 1e-300))))
        take = (F.col("sse2") < F.col("sse")) | (hash_unit(F.lit("accept"), F.lit(seed), F.lit(g), F.col("c")) < chance)
        state = tried.withColumn("take", take).select("c", F.when(F.col("take"), F.col("w2")).otherwise(F.col("w")).alias("w"),
                                                      F.when(F.col("take"), F.col("sse2")).otherwise(F.col("sse")).alias("sse"), "past")
        state = state.withColumn("past", F.concat("past", F.array(F.struct("sse", "w"))))
        t *= cooling
        heat.append(t)
        if g % CUT == 0 or g == generations:
            state = cut_lineage(state)
    every = state.select("c", F.posexplode("past").alias("g", "p"))
    best = every.groupBy("g").agg(F.min_by("p", F.struct("p.sse", "c")).alias("p")).select(
        (F.col("g") + 1).alias("generation"), "p.sse", F.element_at(lit_vector(heat), F.col("g") + 1).alias("temperature"), "p.w")
    return _history(df, vec, y, best)


def evolve(df: DataFrame, vec: str, y: str, d: int, generations: int = 10, population: int = 24, mate: int = 8, mutate: int = 2,
           step: float = 0.1, seed: int = 0) -> DataFrame:
    """``generation, sse, accuracy`` of the best member."""
    if not d:  # an empty table has no width
        return df.sparkSession.createDataFrame([], "generation int, sse double, accuracy double")
    m = moments(df, vec, y)
    first = df.sparkSession.range(population).select(
        F.col("id").cast("int").alias("c"), _genes(d, lambda j: _jitter(step, F.lit("first"), F.lit(seed), F.col("id"), j)).alias("w"))
    # rank order: by error, then by number; a population is one bounded row
    ranked = F.array_sort(F.collect_list(F.struct("sse", "c", "w")))
    state = first.select(squared_errors(m, F.col("w")).alias("sse"), "c", "w").agg(ranked.alias("pop")) \
        .withColumn("past", F.array().cast("array<struct<sse:double,w:array<double>>>"))
    half = max(2, population // 2)
    mate = min(mate, population)
    for g in range(1, generations + 1):
        state = state.withColumn("kids", F.transform(F.sequence(F.lit(0), F.lit(mate - 1)), _bred(d, half, seed, g)))
        for u in range(mutate):
            state = state.withColumn("kids", _mutated(d, mate, step, seed, g, u))
        scored = F.transform("kids", lambda w, k: F.struct(squared_errors(m, w).alias("sse"), (k + population - mate).cast("int").alias("c"), w.alias("w")))
        kept = F.transform(F.slice("pop", F.lit(1), F.lit(population - mate)), lambda p, k: F.struct(p["sse"].alias("sse"), k.cast("int").alias("c"), p["w"].alias("w")))
        state = state.select(F.array_sort(F.concat(kept, scored)).alias("pop"), "past")
        state = state.withColumn("past", F.concat("past", F.array(F.struct(F.col("pop")[0]["sse"].alias("sse"), F.col("pop")[0]["w"].alias("w")))))
        state = cut_lineage(state) if g % CUT == 0 or g == generations else state
    best = state.select(F.posexplode("past").alias("g", "p")).select((F.col("g") + 1).alias("generation"), "p.sse", "p.w")
    return _history(df, vec, y, best)
