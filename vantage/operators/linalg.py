"""Distributed moment matrices (Gram / covariance) with per-partition numpy partial sums.

Each task folds its Arrow batches into one ``d x d`` partial sum (vectorised
numpy), Spark sums the partials by entry, and only the ``d x d`` result
(model-sized) reaches the driver.  Nothing row-sized leaves the executors.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


BLOCK, SALTS = 2048, 64


def gram(df: DataFrame, vec: Column | str, with_intercept: bool = True) -> np.ndarray:
    """``Z^T Z`` for ``z = [1, v]`` (or ``v``); entry (0,0) is the row count."""
    v = F.col(vec) if isinstance(vec, str) else vec
    src = df.select(v.cast("array<double>").alias("_v")).where(F.col("_v").isNotNull())
    icpt = bool(with_intercept)

    def partial(batches):
        acc = None
        for pdf in batches:
            if len(pdf) == 0:
                continue
            z = np.stack(pdf["_v"].to_numpy())
            if icpt:
                z = np.hstack([np.ones((z.shape[0], 1)), z])
            g = z.T @ z
            acc = g if acc is None else acc + g
        if acc is not None:
            yield pd.DataFrame({"pos": np.arange(acc.size, dtype=np.int64), "val": acc.ravel()})

    parts = src.mapInPandas(partial, "pos long, val double")
    sums = parts.groupBy("pos").agg(F.sum("val").alias("val")).collect()
    if not sums:
        return np.zeros((0, 0))
    size = int(round((max(r["pos"] for r in sums) + 1) ** 0.5))
    out = np.zeros(size * size)
    for r in sums:
        out[r["pos"]] = r["val"]
    return out.reshape(size, size)


def mean_vector(df: DataFrame, vec: Column | str) -> tuple[int, np.ndarray]:
    g = gram(df, vec, with_intercept=True)
    n = int(round(g[0, 0])) if g.size else 0
    return n, (g[0, 1:] / n if n else np.zeros(0))


def covariance(df: DataFrame, vec: Column | str) -> tuple[int, np.ndarray, np.ndarray]:
    """Sample covariance (``n-1``) with a mean-shifted second pass for accuracy."""
    g0 = gram(df, vec, with_intercept=True)
    n = int(round(g0[0, 0]))
    mu = g0[0, 1:] / max(n, 1)
    v = F.col(vec) if isinstance(vec, str) else vec
    lit = "array(" + ",".join(f"{float(m)!r}D" for m in mu) + ")"
    shifted = df.select(F.zip_with(v.cast("array<double>"), F.expr(lit), lambda a, b: a - b).alias("_c"))
    g = gram(shifted, "_c", with_intercept=False)
    cov = g / (n - 1) if n > 1 else np.full_like(g, np.nan)
    return n, mu, cov


def covariance_matrix(df: DataFrame, vec: Column | str) -> DataFrame:
    """Long table ``(i, j, cov)`` of the sample covariance matrix."""
    _, _, cov = covariance(df, vec)
    d = cov.shape[0]
    rows = [(i, j, float(cov[i, j])) for i in range(d) for j in range(d)]
    return df.sparkSession.createDataFrame(rows, "i int, j int, cov double")


def reduce_partials(df: DataFrame, fn, length: int) -> np.ndarray:
    """Sum of ``fn(batch) -> float array[length]`` over every Arrow batch of ``df``.

    ``fn`` runs vectorised inside the tasks; each task emits one partial vector,
    Spark sums them per entry, and only the ``length``-sized total reaches the
    driver.  This is the map-side-combine pattern for model statistics (EM
    sufficient statistics, ICA fixed-point moments).
    """

    def folded(batches):
        acc = None
        for pdf in batches:
            if len(pdf):
                part = np.asarray(fn(pdf), dtype=float)
                acc = part if acc is None else acc + part
        return acc

    out = np.zeros(length)
    if length <= BLOCK:
        def partial(batches):
            acc = folded(batches)
            if acc is not None:
                yield pd.DataFrame({"pos": np.arange(length, dtype=np.int64), "val": acc})

        for r in df.mapInPandas(partial, "pos long, val double").groupBy("pos").agg(F.sum("val").alias("val")).collect():
            out[r["pos"]] = r["val"]
        return out

    # long vectors travel as blocks and are summed in two levels, so no task gathers all tasks' partials
    def blocks(batches):
        acc = folded(batches)
        if acc is not None:
            starts = range(0, length, BLOCK)
            yield pd.DataFrame({"block": np.arange(len(starts), dtype=np.int32), "val": [acc[i:i + BLOCK] for i in starts]})

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "val": [np.sum(np.stack(pdf["val"].to_numpy()), axis=0)]})

    shape = "block int, val array<double>"
    parts = df.mapInPandas(blocks, shape).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    parts = parts.groupBy("block", "salt").applyInPandas(total, shape).groupBy("block").applyInPandas(total, shape)
    for r in parts.collect():
        out[r["block"] * BLOCK:r["block"] * BLOCK + len(r["val"])] = r["val"]
    return out


LONG_BLOCK = 32_768


def reduce_long(df: DataFrame, fn, length: int) -> np.ndarray:
    """As :func:`reduce_partials` for vectors of millions of entries (many models' gradients and curvatures).

    Partials travel as binary blocks and are summed in two levels with the square root of the task count as
    salt, so a task gathers at most that many blocks of 256 KB.
    """
    salts = max(1, math.isqrt(df.rdd.getNumPartitions()))
    shape = "block int, val binary"

    def partial(batches):
        acc = None
        for pdf in batches:
            if len(pdf):
                part = np.asarray(fn(pdf), dtype=float)
                acc = part if acc is None else acc + part
        if acc is not None:
            starts = range(0, length, LONG_BLOCK)
            yield pd.DataFrame({"block": np.arange(len(starts), dtype=np.int32), "val": [acc[i:i + LONG_BLOCK].tobytes() for i in starts]})

    def total(tab: pa.Table) -> pa.Table:
        acc = sum(np.frombuffer(v) for v in tab.column("val").to_pylist())
        return pa.table({"block": tab.column("block").slice(0, 1), "val": pa.array([acc.tobytes()], pa.binary())})

    parts = df.mapInPandas(partial, shape)
    if salts > 1:
        parts = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts))).groupBy("block", "salt").applyInArrow(total, shape)
    out = np.zeros(length)
    for r in parts.groupBy("block").applyInArrow(total, shape).collect():
        got = np.frombuffer(r["val"])
        out[r["block"] * LONG_BLOCK:r["block"] * LONG_BLOCK + len(got)] = got
    return out


# ---- packed rows: what iterative fits scan again and again ------------------------

PACK_ROWS, DIRECT, SPLITS_PER_TASK = 1024, 32 << 20, 64


def pack_rows(df: DataFrame, vecs: Sequence[str], numbers: Sequence[str] = ()) -> DataFrame:
    """Blocks of up to ``PACK_ROWS`` rows as binary columns: the vectors side by side (``x``, doubles) and one column a number.

    Null vectors are left out, null components become NaN.  A scan of blocks skips the conversion of lists, and is cut into
    about as many tasks as there are cores (up to ``SPLITS_PER_TASK`` partitions each), so the number of partial
    vectors a step moves does not follow the number of input splits.
    """
    kinds = {c: ("long", np.int64) if t in ("bigint", "int") else ("double", np.float64) for c, t in df.select(*numbers).dtypes}
    src = df.select(*[F.col(v).cast("array<double>").alias(f"_v{i}") for i, v in enumerate(vecs)],
                    *[F.col(c).cast(kinds[c][0]) for c in numbers])
    src = src.where(" and ".join(f"_v{i} is not null" for i in range(len(vecs))))
    views = len(vecs)

    def matrix(col) -> np.ndarray:
        sizes = np.unique(pc.list_value_length(col).to_numpy(zero_copy_only=False))
        if len(sizes) != 1:
            raise ValueError("vectors of different lengths")
        return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), int(sizes[0]))

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, PACK_ROWS):
                part = b.slice(lo, PACK_ROWS)
                mats = [matrix(part.column(i)) for i in range(views)]
                out = {"n": [part.num_rows], "dims": [[m.shape[1] for m in mats]],
                       "x": [np.ascontiguousarray(np.hstack(mats), dtype=float).tobytes()]}
                for i, c in enumerate(numbers):
                    out[c] = [part.column(views + i).to_numpy(zero_copy_only=False).astype(kinds[c][1]).tobytes()]
                yield pa.RecordBatch.from_pydict(out, schema=shape)

    shape = pa.schema([("n", pa.int32()), ("dims", pa.list_(pa.int32())), ("x", pa.binary())] + [(c, pa.binary()) for c in numbers])
    return src.mapInArrow(run, ", ".join(["n int, dims array<int>, x binary", *[f"`{c}` binary" for c in numbers]]))


def unpack(batches, numbers: Sequence[tuple[str, type]] = ()):
    """Per block of :func:`pack_rows`: the vector matrices and the named number columns."""
    for b in batches:
        for row in b.to_pylist():
            cuts = np.cumsum([0, *row["dims"]])
            x = np.frombuffer(row["x"]).reshape(row["n"], cuts[-1])
            yield [x[:, a:z] for a, z in zip(cuts[:-1], cuts[1:], strict=True)], [np.frombuffer(row[c], t) for c, t in numbers]


def _task_counts(packed: DataFrame) -> tuple[int, int]:
    parts = packed.rdd.getNumPartitions()
    return parts, max(packed.sparkSession.sparkContext.defaultParallelism, -(-parts // SPLITS_PER_TASK))


def gathered(packed: DataFrame) -> DataFrame:
    """``packed`` in about as many tasks as there are cores."""
    parts, tasks = _task_counts(packed)
    out = packed.coalesce(tasks)
    out._tasks = min(parts, tasks)   # asked for once, not in every step
    return out


def dealt(packed: DataFrame) -> DataFrame:
    """As :func:`gathered`, with the blocks dealt anew: the splits of a table may hold very different numbers of rows."""
    _, tasks = _task_counts(packed)
    out = packed.repartition(tasks)
    out._tasks = tasks
    return out


def reduce_packed(src: DataFrame, fn, length: int, numbers: Sequence[tuple[str, type]] = ()) -> np.ndarray:
    """Sum of ``fn(matrices, numbers) -> float array[length]`` over the blocks of a :func:`gathered` frame.

    One partial vector a task; where all of them together are small (``DIRECT`` bytes) the driver adds them up, else Spark
    does, by blocks and in two levels.
    """
    tasks = src._tasks

    def folded(batches):
        acc = None
        for mats, nums in unpack(batches, numbers):
            part = np.asarray(fn(mats, nums), dtype=float)
            acc = part if acc is None else acc + part
        return acc

    shape = "block int, val binary"
    wide = length if tasks * length * 8 <= DIRECT else LONG_BLOCK

    def partial(batches):
        acc = folded(batches)
        if acc is not None:
            for k, i in enumerate(range(0, length, wide)):
                yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "val": pa.array([acc[i:i + wide].tobytes()], pa.binary())})

    parts = src.mapInArrow(partial, shape)
    if wide < length:
        salts = math.isqrt(tasks) if tasks > SALTS else 1
        if salts > 1:
            parts = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts))).groupBy("block", "salt").applyInArrow(_add_blocks, shape)
        parts = parts.groupBy("block").applyInArrow(_add_blocks, shape)
    out = np.zeros(length)
    for r in parts.collect():
        got = np.frombuffer(r["val"])
        out[r["block"] * wide:r["block"] * wide + len(got)] += got
    return out


def _add_blocks(tab: pa.Table) -> pa.Table:
    acc = sum(np.frombuffer(v) for v in tab.column("val").to_pylist())
    return pa.table({"block": tab.column("block").slice(0, 1), "val": pa.array([acc.tobytes()], pa.binary())})


def stack_vectors(series) -> np.ndarray:
    return np.stack(series.to_numpy()).astype(float)
