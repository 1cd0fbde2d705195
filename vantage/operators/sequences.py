"""Ordered-sequence statistics: runs, edge runs, closed routes, mutual information.

Ordered statistics are folds over range partitions with carried borders (``carry``): a long sequence is spread over
many tasks, rows are neither numbered nor joined with themselves.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import carry


def longest_run(df: DataFrame, seq: str, order_cols: Sequence[str], value: str) -> DataFrame:
    """Longest run of equal consecutive values, per ``(seq, value)``."""
    return carry.run_records(df, seq, order_cols, value).groupBy(seq, value).agg(F.max("longest").alias("longest"))


def edge_runs(df: DataFrame, seq: str, order_cols: Sequence[str], bit: str, t: int) -> DataFrame:
    """Leading ones, trailing zeros, and the both-above-``t`` bonus (four-peaks fitness)."""
    bonus = F.when((F.col("head") > t) & (F.col("tail") > t), F.col("n")).otherwise(F.lit(0))
    return carry.edge_counts(df, seq, order_cols, bit).withColumn("fitness", F.greatest("head", "tail") + bonus)


def route_length(df: DataFrame, route: str, order_cols: Sequence[str], x: str, y: str) -> DataFrame:
    """Total Euclidean length of each closed route (last stop back to the first)."""
    return carry.path_lengths(df, route, order_cols, x, y)


BITMAP_PAIRS = 64   # level pairs of two columns up to which bitmaps are cheaper than one pass over the rows


def joint_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``col_a, col_b, va, vb, n`` of every column pair ``a < b``, without copying rows.

    A batch packs one bitmap per level of a column; a pair's joint counts are the bits that two bitmaps share
    (columns of many levels are counted by their combined codes).  Partial counts are summed by Spark.
    """
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    names = list(cols)
    src = df.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            codes, levels, maps = [], [], []
            for i in range(len(names)):
                d = b.column(i).dictionary_encode(null_encoding="encode")
                code = d.indices.to_numpy(zero_copy_only=False)
                codes.append(code)
                levels.append(d.dictionary)
                maps.append(np.stack([np.packbits(code == v) for v in range(len(d.dictionary))]) if len(d.dictionary) <= BITMAP_PAIRS else None)
            for i, j in pairs:
                m, n = len(levels[i]), len(levels[j])
                if m * n <= BITMAP_PAIRS:
                    both = np.bitwise_count(maps[i][:, None, :] & maps[j][None, :, :]).sum(axis=2, dtype=np.int64).ravel()
                    at = np.flatnonzero(both)
                    count = both[at]
                else:
                    at, count = np.unique(codes[i].astype(np.int64) * n + codes[j], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i]] * len(at)), pa.array([names[j]] * len(at)), levels[i].take(pa.array(at // n)),
                     levels[j].take(pa.array(at % n)), pa.array(count.astype(np.int64))], names=["col_a", "col_b", "va", "vb", "n"])

    parts = src.mapInArrow(run, "col_a string, col_b string, va string, vb string, n long")
    return parts.groupBy("col_a", "col_b", "va", "vb").agg(F.sum("n").cast("double").alias("n"))


def pairwise_mutual_information(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mutual information (nats) of every column pair ``a < b`` of discrete columns; marginals come from the joint counts."""
    j = joint_counts(df, cols)
    pair = ["col_a", "col_b"]
    # window totals: a null level is a level like any other
    t = j.withColumn("na", F.sum("n").over(Window.partitionBy(*pair, "va"))) \
        .withColumn("nb", F.sum("n").over(Window.partitionBy(*pair, "vb"))) \
        .withColumn("nn", F.sum("n").over(Window.partitionBy(*pair)))
    return t.groupBy("col_a", "col_b").agg(
        F.sum(F.col("n") / F.col("nn") * F.log(F.col("n") * F.col("nn") / (F.col("na") * F.col("nb")))).alias("mi"))


def chow_liu_tree(mi: DataFrame) -> DataFrame:
    """Maximum spanning tree over the mutual-information table (Kruskal).

    The input has one row per column pair (model-sized), so the edge pick runs
    on the driver; ties are broken by column names.
    """
    edges = sorted(((r["mi"], r["col_a"], r["col_b"]) for r in mi.collect()), key=lambda e: (-e[0], e[1], e[2]))
    parent: dict = {}

    def find(u):
        parent.setdefault(u, u)
        while parent[u] != u:
            parent[u] = parent[parent[u]]
            u = parent[u]
        return u

    keep = []
    for w, a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[ra] = rb
            keep.append((a, b, float(w)))
    return mi.sparkSession.createDataFrame(keep, "col_a string, col_b string, mi double")
