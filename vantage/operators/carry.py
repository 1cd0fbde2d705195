"""Boundary carry: ordered statistics from one pass over range partitions.

Rows are range-partitioned on (group, order), so a long group is many tasks, and each task folds its sorted rows into
a summary: one record per group it holds, and what its first and last rows leave open.  Summaries number
tasks + groups, so they are checkpointed (which also pins the sampled range bounds) and merged in task order; rows are
neither checkpointed, nor numbered, nor joined with themselves.
"""

from __future__ import annotations

from typing import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def summaries(df: DataFrame, group: str | None, order_cols: Sequence[str], cols: dict[str, Column | str], fold: Callable[[Iterator], Iterator],
              schema: str) -> DataFrame:
    """``fold`` over every task's sorted rows: pandas frames with ``_task``, ``_g`` (the group as text) and ``cols``."""
    g = F.col(group) if group else F.lit(0)
    picked = [F.col(c) if isinstance(c, str) else c for c in cols.values()]
    keys = [f"_o{i}" for i in range(len(order_cols))]
    rows = df.select(g.alias("_g"), *[F.col(c).alias(k) for c, k in zip(order_cols, keys, strict=True)],
                     *[c.alias(n) for n, c in zip(cols, picked, strict=True)])
    rows = rows.repartitionByRange("_g", *keys).sortWithinPartitions("_g", *keys)
    return cut_lineage(rows.select(F.spark_partition_id().alias("_task"), F.col("_g").cast("string").alias("_g"), *cols).mapInPandas(fold, schema))


def _same(a, b) -> bool:
    return a == b or (pd.isna(a) and pd.isna(b))


def _heads(pdf: pd.DataFrame, names: Sequence[str]) -> np.ndarray:
    """First rows of the stretches of equal ``names``."""
    change = np.zeros(len(pdf), bool)
    change[:1] = True
    for n in names:
        code = pd.factorize(pdf[n], use_na_sentinel=False)[0]
        change[1:] |= code[1:] != code[:-1]
    return np.flatnonzero(change)


# ------------------------------------------------------------------ runs

def run_records(df: DataFrame, group: str, order_cols: Sequence[str], value: str) -> DataFrame:
    """``group, value, longest``: the longest run of each task and group, and the runs that cross task borders whole."""
    kind, vkind = df.schema[group].dataType, df.schema[value].dataType

    def fold(batches):
        best: dict = {}
        first = current = None   # [group, value, length]
        task = 0

        def close(run):
            key = (run[0], run[1])
            best[key] = max(best.get(key, 0), run[2])

        for pdf in batches:
            if not len(pdf):
                continue
            task = int(pdf["_task"].iloc[0])
            head = _heads(pdf, ["_g", "v"])
            size = np.diff(np.append(head, len(pdf)))
            at = pdf.iloc[head]
            g, v = at["_g"].tolist(), at["v"].tolist()
            begin = 0
            if current is not None and _same(current[0], g[0]) and _same(current[1], v[0]):
                current[2] += int(size[0])
                begin = 1
            if begin < len(head):
                if current is not None:
                    if first is None:
                        first = current
                    else:
                        close(current)
                inner = range(begin, len(head) - 1)
                if first is None and len(inner):  # the task's first run is still open to the left
                    first = [g[begin], v[begin], int(size[begin])]
                    inner = inner[1:]
                if len(inner):
                    i = np.fromiter(inner, int)
                    for (a, b), n in pd.Series(size[i]).groupby([at["_g"].to_numpy()[i], at["v"].to_numpy()[i]], dropna=False).max().items():
                        close([None if pd.isna(a) else a, None if pd.isna(b) else b, int(n)])
                current = [g[-1], v[-1], int(size[-1])]
        rows = [(None, None, *k, n) for k, n in best.items()]
        for place, run in ((0, first), (1, current)):
            if run is not None:
                rows.append((task, place if first is not None else 2, *run))
        if rows:
            yield pd.DataFrame(rows, columns=["task", "place", "g", "v", "n"]).astype({"task": "Int64", "place": "Int32"})

    got = summaries(df, group, order_cols, {"v": F.col(value).cast("string")}, fold, "task long, place int, g string, v string, n long")
    done = got.where("task is null").select("g", "v", "n")
    # open runs, at most two a task: neighbours of one group and value are one run, unless they are the two ends of a task
    line = Window.orderBy("task", "place")
    edge = got.where("task is not null")
    joins = F.lag("g").over(line).eqNullSafe(F.col("g")) & F.lag("v").over(line).eqNullSafe(F.col("v")) & (F.lag("task").over(line) != F.col("task"))
    islands = edge.withColumn("fresh", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)) \
        .withColumn("run", F.sum("fresh").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    whole = islands.groupBy("run").agg(F.first("g").alias("g"), F.first("v").alias("v"), F.sum("n").alias("n")).drop("run")
    return done.unionByName(whole).select(F.col("g").cast(kind).alias(group), F.col("v").cast(vkind).alias(value), F.col("n").alias("longest"))


# ------------------------------------------------------------------ fragments: one record per task and group

def fragments(df: DataFrame, group: str, order_cols: Sequence[str], cols: dict[str, Column | str], summary: Callable,
              merge: Callable[[tuple, tuple], tuple], fields: str) -> DataFrame:
    """Per group the array ``parts`` of its tasks' summaries in order (at most one a task).

    ``summary(pdf, first, size)`` gives the ``fields`` of all stretches of one group in a batch as arrays, ``merge``
    joins two neighbouring ones of a group.
    """
    names = [f.split()[0] for f in fields.split(", ")]

    def fold(batches):
        task, held = 0, None
        for pdf in batches:
            if not len(pdf):
                continue
            task = int(pdf["_task"].iloc[0])
            first = _heads(pdf, ["_g"])
            parts = pd.DataFrame(dict(zip(names, summary(pdf, first, np.diff(np.append(first, len(pdf)))), strict=True)))
            parts.insert(0, "task", task)
            parts.insert(0, "g", pdf["_g"].iloc[first].to_numpy())
            if held is not None and _same(held["g"].iloc[0], parts["g"].iloc[0]):
                parts.loc[0, names] = merge(tuple(held[names].iloc[0]), tuple(parts[names].iloc[0]))
            elif held is not None:
                yield held
            held = parts.iloc[-1:]
            if len(parts) > 1:
                yield parts.iloc[:-1]
        if held is not None:
            yield held

    got = summaries(df, group, order_cols, cols, fold, f"g string, task long, {fields}")
    return got.groupBy(F.col("g").cast(df.schema[group].dataType).alias(group)).agg(
        F.array_sort(F.collect_list(F.struct("task", *names))).alias("parts"))


def edge_counts(df: DataFrame, group: str, order_cols: Sequence[str], bit: str) -> DataFrame:
    """``group, n, head, tail``: rows, leading ones and trailing zeros of every group."""
    def summary(pdf, first, size):
        b, at = pdf["b"].to_numpy(), np.arange(len(pdf))
        zero = np.minimum.reduceat(np.where(b == 0, at, len(pdf)), first)
        one = np.maximum.reduceat(np.where(b == 1, at, -1), first)
        return size, np.minimum(zero - first, size), np.where(one >= first, first + size - 1 - one, size)

    def merge(a, b):
        return a[0] + b[0], a[1] if a[1] < a[0] else a[0] + b[1], b[2] if b[2] < b[0] else b[0] + a[2]

    got = fragments(df, group, order_cols, {"b": F.col(bit).cast("double")}, summary, merge, "n long, head long, tail long")
    zero = F.struct(*[F.lit(0).cast("bigint").alias(c) for c in ("n", "head", "tail")])
    both = F.aggregate("parts", zero, lambda a, b: F.struct(
        (a["n"] + b["n"]).alias("n"), F.when(a["head"] < a["n"], a["head"]).otherwise(a["n"] + b["head"]).alias("head"),
        F.when(b["tail"] < b["n"], b["tail"]).otherwise(b["n"] + a["tail"]).alias("tail")))
    return got.select(group, both.alias("m")).select(group, "m.n", "m.head", "m.tail")


def path_lengths(df: DataFrame, group: str, order_cols: Sequence[str], x: str, y: str) -> DataFrame:
    """``group, n, length``: rows and Euclidean length of the closed path through every group's points
    (a leg with a missing coordinate adds nothing)."""
    def summary(pdf, first, size):
        px, py = pdf["x"].to_numpy(float), pdf["y"].to_numpy(float)
        leg = np.zeros(len(pdf))
        leg[1:] = np.nan_to_num(np.hypot(np.diff(px), np.diff(py)), nan=0.0)
        leg[first] = 0.0
        last = first + size - 1
        return size, px[first], py[first], px[last], py[last], np.add.reduceat(leg, first)

    def merge(a, b):
        seam = float(np.nan_to_num(np.hypot(b[1] - a[3], b[2] - a[4]), nan=0.0))
        return a[0] + b[0], a[1], a[2], b[3], b[4], a[5] + seam + b[5]

    got = fragments(df, group, order_cols, {"x": F.col(x).cast("double"), "y": F.col(y).cast("double")}, summary, merge,
                    "n long, x0 double, y0 double, x1 double, y1 double, inner double")

    def leg(a, b):
        return F.coalesce(F.hypot(b["x0"] - a["x1"], b["y0"] - a["y1"]), F.lit(0.0))

    k = F.size("parts")
    seams = F.zip_with(F.slice("parts", F.lit(1), k - 1), F.slice("parts", F.lit(2), k - 1), leg)
    total = F.aggregate(F.transform("parts", lambda p: p["inner"]), F.lit(0.0), lambda s, v: s + v) \
        + F.aggregate(seams, F.lit(0.0), lambda s, v: s + v) + leg(F.element_at("parts", -1), F.element_at("parts", 1))
    return got.select(group, F.aggregate("parts", F.lit(0).cast("bigint"), lambda s, p: s + p["n"]).alias("n"), total.alias("length"))


# ------------------------------------------------------------------ steps: what follows what

def step_counts(df: DataFrame, group: str | None, order_cols: Sequence[str], s: str, a: str, r: str) -> DataFrame:
    """``s, a, s2, n, rs``: how often state ``s`` with action ``a`` is followed by ``s2`` in its group (null: by nothing),
    and the sum of the rewards ``r`` of those steps."""
    sk, ak = (df.schema[c].dataType for c in (s, a))

    def fold(batches):
        totals: dict = {}
        first = last = before = None
        task = 0
        for pdf in batches:
            if not len(pdf):
                continue
            task = int(pdf["_task"].iloc[0])
            pdf = pdf[["_g", "s", "a", "r"]]
            if first is None:
                first = pdf.iloc[0]
            if last is not None:
                pdf = pd.concat([before, pdf], ignore_index=True)
            before, last = pdf.iloc[-1:], pdf.iloc[-1]
            code = pd.factorize(pdf["_g"], use_na_sentinel=False)[0]
            now = pdf.iloc[:-1].reset_index(drop=True)
            after = pdf["s"].iloc[1:].reset_index(drop=True).where(code[1:] == code[:-1], None)
            ends = code[1:] != code[:-1]
            sums = now["r"].groupby([now["s"], now["a"], after, ends], dropna=False).agg(["size", "sum"])
            for key, (n, rs) in zip(sums.index, sums.to_numpy(), strict=True):
                key = tuple(None if pd.isna(x) else x for x in key)
                old = totals.get(key, (0, 0.0))
                totals[key] = (old[0] + int(n), old[1] + float(rs))
        rows = [(None, None, None, k[0], k[1], k[2], n, rs) for k, (n, rs) in totals.items()]
        if first is not None:
            rows += [(task, 0, first["_g"], first["s"], None, None, 0, 0.0), (task, 1, last["_g"], last["s"], last["a"], None, 1, float(last["r"]))]
        if rows:
            yield pd.DataFrame(rows, columns=["task", "place", "g", "s", "a", "s2", "n", "rs"]).astype({"task": "Int64", "place": "Int32"})

    got = summaries(df, group, order_cols, {"s": F.col(s).cast("string"), "a": F.col(a).cast("string"), "r": F.col(r).cast("double")}, fold,
                    "task long, place int, g string, s string, a string, s2 string, n long, rs double")
    line = Window.orderBy("task", "place")  # two rows a task
    follows = F.lead("g").over(line).eqNullSafe(F.col("g")) & F.lead("task").over(line).isNotNull()
    seams = got.where("task is not null").withColumn("next", F.when(follows, F.lead("s").over(line))).where("place = 1") \
        .select("s", "a", F.col("next").alias("s2"), "n", "rs")
    every = got.where("task is null").select("s", "a", "s2", "n", "rs").unionByName(seams)
    return every.groupBy(F.col("s").cast(sk).alias("s"), F.col("a").cast(ak).alias("a"), F.col("s2").cast(sk).alias("s2")).agg(
        F.sum("n").cast("double").alias("n"), F.sum("rs").alias("rs"))
