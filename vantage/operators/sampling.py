"""Splits, bootstrap draws, stratified folds and parameter tables.

Randomness is a deterministic md5 draw on the row id (``functions.hashing``),
so every split is reproducible, independent of partitioning, and checkable
in SQL.  Positional operators use the skew-safe ``ordinal``.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash32, hash60, hash_bucket
from .ordering import ordinal


def split_random(df: DataFrame, id_col: str, test_pct: int = 20, seed: int = 0, out: str = "split") -> DataFrame:
    """Hash split: bucket ``hash32(seed:id) % 100 < test_pct`` -> ``test`` else ``train``."""
    b = hash_bucket(100, F.lit(str(seed)), F.col(id_col))
    return df.withColumn(out, F.when(b < test_pct, F.lit("test")).otherwise(F.lit("train")))


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 0) -> list[DataFrame]:
    """Spark's sampling split, for callers who do not need a SQL-checkable split."""
    return df.randomSplit(list(weights), seed)


def split_ordered(
    df: DataFrame, order_col: str, fractions: Sequence[float] = (0.6, 0.2, 0.2),
    names: Sequence[str] = ("train", "validation", "test"), out: str = "split",
) -> DataFrame:
    """Prefix / middle / suffix by position: boundaries ``floor(n * cumulative fraction)``."""
    n = df.count()
    bounds, acc = [], 0.0
    for f in fractions[:-1]:
        acc += f
        bounds.append(int(n * acc + 1e-9))
    pos = ordinal(df, [order_col], out="_pos")
    expr = None
    lo = 0
    for name, hi in zip(names, bounds):
        cond = (F.col("_pos") >= lo) & (F.col("_pos") < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
        lo = hi
    expr = expr.otherwise(F.lit(names[len(bounds)])) if expr is not None else F.lit(names[0])
    return pos.withColumn(out, expr).drop("_pos")


def bootstrap_sample(df: DataFrame, id_col: str, size: int | None = None, seed: int = 0) -> DataFrame:
    """Exactly ``size`` draws with replacement (default: as many as rows).

    Draw ``j`` picks position ``hash60(seed:j) % n``; rows are numbered with the
    skew-safe ``ordinal`` on ``id_col`` and joined to the draw table on that
    position.  Output keeps every source column plus ``draw``.
    """
    spark = df.sparkSession
    n = df.count()
    size = n if size is None else int(size)
    if n == 0 or size == 0:
        return df.withColumn("draw", F.lit(None).cast("bigint")).limit(0)
    draws = spark.range(size).select(
        F.col("id").alias("draw"), F.pmod(hash60(F.lit(str(seed)), F.col("id")), F.lit(n)).alias("_pos"))
    pos = ordinal(df, [id_col], out="_pos")
    return draws.join(pos, "_pos").drop("_pos")


def kfold_assign(
    df: DataFrame, id_col: str, k: int = 10, label_col: str | None = None, seed: int = 0, out: str = "fold"
) -> DataFrame:
    """Fold ids 0..k-1.  Stratified when ``label_col`` is given: rows of each class are
    ordered by ``hash32(seed:id)`` and dealt round-robin, so every fold holds
    ``floor`` or ``ceil`` of ``n_class / k`` rows of each class.
    """
    h = df.withColumn("_h", hash32(F.lit(str(seed)), F.col(id_col)))
    groups = [label_col] if label_col else []
    pos = ordinal(h, ["_h", id_col], groups, out="_pos")
    return pos.withColumn(out, F.pmod(F.col("_pos"), F.lit(k)).cast("int")).drop("_pos", "_h")


def param_grid(grid: Mapping[str, Sequence]) -> list[dict]:
    """Cartesian grid as a list of dicts (model-sized, in ``grid_idx`` order)."""
    items = [{}]
    for name, values in grid.items():
        items = [dict(it, **{name: v}) for it in items for v in values]
    return items


def param_zip(grid: Mapping[str, Sequence]) -> list[dict]:
    """Zipped (not crossed) parameter lists."""
    names = list(grid)
    return [dict(zip(names, vals)) for vals in zip(*[grid[n] for n in names])]


def grid_column(params: Sequence[Mapping]) -> F.Column:
    """Parameter list as an ``array<struct>`` literal; ``inline`` it to fan rows out."""
    return F.array(*[
        F.struct(F.lit(i).alias("grid_idx"), *[F.lit(v).alias(k) for k, v in p.items()])
        for i, p in enumerate(params)
    ])


def fan_out(df: DataFrame, params: Sequence[Mapping]) -> DataFrame:
    """Each row once per parameter setting (generator, not a join)."""
    return df.select("*", F.inline(grid_column(params)))


def restart_grid(df: DataFrame, n_seeds: int) -> DataFrame:
    """Each row once per seed ``0..n_seeds-1``."""
    return df.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_seeds - 1))).alias("seed"))


def restart_scores(df: DataFrame, by: Sequence[str], n_seeds: int, score) -> DataFrame:
    """``by, seed, score`` without copying rows: ``score(seed)`` is an aggregate, all seeds share one aggregation."""
    wide = df.groupBy(*by).agg(*[score(F.lit(i)).alias(f"_s{i}") for i in range(n_seeds)])
    return wide.select(*by, F.inline(F.array(*[F.struct(F.lit(i).alias("seed"), F.col(f"_s{i}").alias("score")) for i in range(n_seeds)])))
