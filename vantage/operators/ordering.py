"""Positional operators without single-partition windows.

``row_number() over (order by k)`` with no PARTITION BY funnels every row
through one task, and ``partition by g`` funnels a hot group through one
task.  ``ordinal`` instead range-partitions on the full key (so a hot group is
split over many tasks), numbers rows inside each task, and adds per-task
offsets computed from a table whose size is bounded by the number of tasks
(plus the number of groups).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_LOW33 = (1 << 33) - 1


def _num_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ordinal(
    df: DataFrame,
    order_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    out: str = "ordinal",
    partitions: int | None = None,
) -> DataFrame:
    """Add a 0-based position in ``order_cols`` order, restarting for each ``group_cols`` value.

    ``order_cols`` should make the order total (end with a unique id); equal keys
    get distinct but arbitrary positions otherwise.
    """
    group_cols = list(group_cols)
    keys = group_cols + list(order_cols)
    n = partitions or _num_partitions(df)
    cols = df.columns
    # Range bounds come from a sample seeded by the RDD id, so two evaluations of
    # the same plan may cut differently.  One reliable checkpoint fixes the cut
    # (and the positions) for both consumers below, and survives executor loss.
    tagged = cut_lineage(
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_loc", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
    stats = tagged.groupBy("_pid", *group_cols).agg(
        F.min("_loc").alias("_first"), F.count(F.lit(1)).alias("_cnt")
    )
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).drop("_cnt")
    # a null group is a group like any other: null-safe join (column names apart from the rows')
    stats = stats.select(F.col("_pid").alias("_spid"), "_first", "_off",
                         *[F.col(g).alias(f"_sg{i}") for i, g in enumerate(group_cols)])
    on = F.col("_pid") == F.col("_spid")
    for i, g in enumerate(group_cols):
        on = on & F.col(g).eqNullSafe(F.col(f"_sg{i}"))
    # without groups: one row per task, so its size is bounded by the partition count; with groups
    # the planner broadcasts it only where its measured size is under the threshold
    res = tagged.join(stats if group_cols else F.broadcast(stats), on)
    return res.select(*cols, (F.col("_off") + F.col("_loc") - F.col("_first")).alias(out))


GATHER, ACCURACY = 10_000, 1000


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """Exact linear-interpolation quantiles (pandas / ``quantile_cont``) of one column: rows ``(p, value)``."""
    got = exact_quantiles_multi(df, [col], probs)
    want = df.sparkSession.createDataFrame([(float(p),) for p in probs], "p double")
    return want.join(got.select("p", "value"), "p", "left")


def exact_quantiles_multi(df: DataFrame, cols: Sequence[str], probs: Sequence[float], gather: int = GATHER) -> DataFrame:
    """Exact quantiles of several columns without a sort: rows ``(column, p, value)``.

    Approximate quantiles (deterministic rank error) bracket each wanted position; a scan counts the
    rows below, at and between the two ends of every bracket, which proves the bracket or widens it.  A
    bracket with more than ``gather`` rows strictly inside is narrowed by the approximate quantiles of
    those rows, the others' few rows are gathered.  Ends are counted apart, so a value held by many
    rows is never gathered.  Each round shrinks a bracket some hundredfold, whatever the table size.
    """
    spark = df.sparkSession
    base = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    eps = 2.0 / ACCURACY

    def near(v, ranks):
        return F.percentile_approx(v, F.array(*[F.lit(min(max(r, 0.0), 1.0)) for r in ranks]), F.lit(ACCURACY))

    ranks = [r for p in probs for r in (p - eps, p + eps)]
    one = base.agg(*[x for i in range(len(cols)) for x in (
        F.count(f"c{i}").alias(f"n{i}"), F.min(f"c{i}").alias(f"mn{i}"), F.max(f"c{i}").alias(f"mx{i}"),
        near(F.col(f"c{i}"), ranks).alias(f"q{i}"))]).first()
    todo, done = [], {}
    for i in range(len(cols)):
        n = one[f"n{i}"]
        for j, p in enumerate(probs if n else ()):
            pos = (n - 1) * float(p)
            lo = int(pos // 1)
            todo.append({"c": i, "p": float(p), "want": (lo, min(lo + 1, n - 1)), "frac": pos - lo, "ends": (one[f"mn{i}"], one[f"mx{i}"]),
                         "lo": one[f"q{i}"][2 * j], "hi": one[f"q{i}"][2 * j + 1]})

    def scan(make):
        """One scan with the aggregates of every open target; their values per target."""
        aggs = [(k, m) for k, t in enumerate(todo) for m in make(t)]
        row = base.agg(*[x.alias(f"a{j}") for j, (_, x) in enumerate(aggs)]).first()
        out = [[] for _ in todo]
        for j, (k, _) in enumerate(aggs):
            out[k].append(row[j])
        return out

    def hits(cond):
        return F.coalesce(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long"), F.lit(0))

    while todo:
        counted = scan(lambda t: [hits(F.col(f"c{t['c']}") < t["lo"]), hits(F.col(f"c{t['c']}") == t["lo"]),
                                  hits((F.col(f"c{t['c']}") > t["lo"]) & (F.col(f"c{t['c']}") < t["hi"])),
                                  hits(F.col(f"c{t['c']}") == t["hi"]) if t["hi"] != t["lo"] else F.lit(0).cast("long")])
        for t, (below, at_lo, inside, at_hi) in zip(todo, counted, strict=True):
            t["inside"] = (below + at_lo, inside)
            a, b = t["want"]
            t["ok"] = below <= a and b < below + at_lo + inside + at_hi
            if not t["ok"]:
                t["lo"], t["hi"] = (t["ends"][0] if below > a else t["lo"]), (t["ends"][1] if b >= below + at_lo + inside + at_hi else t["hi"])
        wide = [t for t in todo if t["ok"] and t["inside"][1] > gather]
        few = [t for t in todo if t["ok"] and t["inside"][1] <= gather]
        missed, todo = [t for t in todo if not t["ok"]], few
        if few:
            inner = scan(lambda t: [F.sort_array(F.collect_list(F.when((F.col(f"c{t['c']}") > t["lo"]) & (F.col(f"c{t['c']}") < t["hi"]), F.col(f"c{t['c']}"))))])
            for t, (vals,) in zip(few, inner, strict=True):
                start = t["inside"][0]
                x, y = (t["lo"] if w < start else vals[w - start] if w < start + len(vals) else t["hi"] for w in t["want"])
                done[t["c"], t["p"]] = x + (y - x) * t["frac"]
        todo = wide
        if wide:
            def ranks_in(t):
                start, m = t["inside"]
                a, b = ((w - start + 0.5) / m for w in t["want"])
                return [a - eps, b + eps]
            got = scan(lambda t: [near(F.when((F.col(f"c{t['c']}") > t["lo"]) & (F.col(f"c{t['c']}") < t["hi"]), F.col(f"c{t['c']}")), ranks_in(t))])
            for t, (q,) in zip(wide, got, strict=True):
                a, b = t["want"]
                start, m = t["inside"]
                # a position on or before the low end keeps that end, likewise the high end
                t["lo"], t["hi"] = (q[0] if a >= start else t["lo"]), (q[1] if b < start + m else t["hi"])
        todo = wide + missed
    rows = [(cols[c], p, float(v)) for (c, p), v in done.items()]
    return spark.createDataFrame(rows, "column string, p double, value double")
