"""Classifier, clustering and run-log metrics as single-pass aggregations.

Every metric is an expression over conditional sums, so it is one scan with
map-side partial aggregation, whatever the table size.  Undefined ratios
(0/0) are 0, as in the usual library convention for precision/recall/F1.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _div0(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def binary_counts(df: DataFrame, y, yhat, positive=1) -> DataFrame:
    """One row ``tp, fp, tn, fn, n`` (positive class = ``positive``).

    A row without a truth is not scored; a row without a prediction is a miss
    (``fn`` or ``fp``), so the four cells always add up to ``n``.
    """
    yt = _c(y) == positive
    yp = F.coalesce(_c(yhat) == positive, ~yt)
    return df.where(_c(y).isNotNull()).agg(
        F.sum((yt & yp).cast("bigint")).alias("tp"), F.sum((~yt & yp).cast("bigint")).alias("fp"),
        F.sum((~yt & ~yp).cast("bigint")).alias("tn"), F.sum((yt & ~yp).cast("bigint")).alias("fn"),
        F.count(F.lit(1)).alias("n"),
    ).select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("tp", "fp", "tn", "fn", "n")])


def _metric_cols():
    tp, fp, tn, fn, n = (F.col(c) for c in ("tp", "fp", "tn", "fn", "n"))
    precision = _div0(tp, tp + fp)
    recall = _div0(tp, tp + fn)
    return {
        "accuracy": _div0(tp + tn, n),
        "precision": precision,
        "recall": recall,
        "f1": _div0(2 * tp, 2 * tp + fp + fn),
        # ROC-AUC of hard 0/1 predictions = (TPR + TNR) / 2
        "auc_hard": (recall + _div0(tn, tn + fp)) / 2,
    }


def metric(df: DataFrame, y, yhat, name: str, positive=1) -> DataFrame:
    return binary_counts(df, y, yhat, positive).select(_metric_cols()[name].alias(name))


def metric_report(df: DataFrame, y, yhat, positive=1, extra: dict | None = None) -> DataFrame:
    """One row: counts + accuracy, precision, recall, F1, hard AUC (+ literal extras such as timings)."""
    m = _metric_cols()
    cols = ["tp", "fp", "tn", "fn", "n"] + [v.alias(k) for k, v in m.items()]
    out = binary_counts(df, y, yhat, positive).select(*cols)
    for k, v in (extra or {}).items():
        out = out.withColumn(k, F.lit(v))
    return out


def confusion_matrix(df: DataFrame, y, yhat, domain: Sequence = (0, 1)) -> DataFrame:
    """Counts for every (truth, prediction) pair of ``domain``; zeros included.

    One aggregation of conditional counts, unpivoted with ``inline`` (no join
    against a domain table).
    """
    pairs = [(a, b) for a in domain for b in domain]
    agg = df.agg(*[F.sum(((_c(y) == a) & (_c(yhat) == b)).cast("bigint")).alias(f"c{i}")
                   for i, (a, b) in enumerate(pairs)])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("y"), F.lit(b).alias("yhat"), F.coalesce(F.col(f"c{i}"), F.lit(0)).alias("n"))
        for i, (a, b) in enumerate(pairs)])))


def confusion_normalized(df: DataFrame, y, yhat, domain: Sequence = (0, 1)) -> DataFrame:
    """Confusion counts plus the row share ``n / sum(n) over the true label``."""
    cm = confusion_matrix(df, y, yhat, domain)
    w = Window.partitionBy("y")  # tiny: |domain|^2 rows
    return cm.withColumn("share", _div0(F.col("n"), F.sum("n").over(w)))


def sum_squared_error(df: DataFrame, pred, actual) -> DataFrame:
    return df.agg(F.sum(F.pow(_c(pred) - _c(actual), 2)).alias("sse"))


def percent_correct(df: DataFrame, correct) -> DataFrame:
    return df.agg((F.avg(_c(correct).cast("double")) * 100).alias("pct_correct"))


# ---- clustering scores ----------------------------------------------------------

def cluster_mode_vote(df: DataFrame, cluster: str, y: str, id_col: str, out: str = "yhat") -> DataFrame:
    """Each cluster predicts its majority label; ties go to the label seen first (lowest ``id_col``).

    Counts per (cluster, label) are a partial aggregation; the winner per cluster
    is picked with ``max_by`` over the (small) count table, then joined back.
    """
    votes = df.groupBy(cluster, y).agg(F.count(F.lit(1)).alias("_n"), F.min(id_col).alias("_first"))
    win = votes.groupBy(cluster).agg(
        F.max_by(F.col(y), F.struct(F.col("_n"), (-F.col("_first")).alias("_f"))).alias(out))
    # one row per cluster: the planner broadcasts it where its measured size allows, else splits a hot cluster
    win = win.withColumnRenamed(cluster, "_k")
    return df.join(win, F.col(cluster).eqNullSafe(F.col("_k")), "left").drop("_k")


def homogeneity(df: DataFrame, cluster: str, y: str) -> DataFrame:
    """``1 - H(C|K) / H(C)`` from the contingency table (1.0 when ``H(C) = 0``).

    A null cluster or label is a level of its own (window totals group nulls together).
    """
    cont = df.groupBy(cluster, y).agg(F.count(F.lit(1)).cast("double").alias("n_ck"))
    cont = cont.withColumn("n_k", F.sum("n_ck").over(Window.partitionBy(cluster))) \
        .withColumn("n_c", F.sum("n_ck").over(Window.partitionBy(y)))
    # sum_k n_ck = n_c, so N*H(C) = sum_ck -n_ck log n_c + N log N: one pass over the table
    t = cont.agg(
        F.sum(-F.col("n_ck") * F.log(F.col("n_ck") / F.col("n_k"))).alias("a"),
        F.sum(-F.col("n_ck") * F.log(F.col("n_c"))).alias("b"),
        F.sum("n_ck").alias("N"))
    hc = (F.col("b") + F.col("N") * F.log(F.col("N"))) / F.col("N")
    return t.select(
        F.when(F.col("N").isNull() | (hc <= 1e-15), F.lit(1.0)).otherwise(1 - (F.col("a") / F.col("N")) / hc)
        .alias("homogeneity"))


def entropy_gain(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Information gain (nats) of splitting ``label`` on each categorical feature.

    Features are unpivoted with ``stack``-like ``inline`` (fan-out bounded by the
    feature count), then one aggregation over (feature, value, label).  Nulls are
    a level of their own.
    """
    long = df.select(F.col(label).cast("string").alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("_v")) for f in features])))
    cnt = long.groupBy("feature", "_v", "_y").agg(F.count(F.lit(1)).cast("double").alias("n"))
    cnt = cnt.withColumn("n_v", F.sum("n").over(Window.partitionBy("feature", "_v"))) \
        .withColumn("n_y", F.sum("n").over(Window.partitionBy("feature", "_y")))
    # sum over values of n = n_y, so sum -n log n_y = sum over labels of -n_y log n_y
    res = cnt.groupBy("feature").agg(
        F.sum(-F.col("n") * F.log(F.col("n") / F.col("n_v"))).alias("hc"), F.sum("n").alias("N"),
        F.sum(-F.col("n") * F.log(F.col("n_y"))).alias("b"))
    h_y = F.log(F.col("N")) + F.col("b") / F.col("N")
    return res.select("feature", (h_y - F.col("hc") / F.col("N")).alias("gain"))


# ---- fold / restart / run-log summaries --------------------------------------------

def fold_mean_std(df: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """Mean and population std of per-fold scores."""
    return df.groupBy(*keys).agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"))


def restart_mean_std(df: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """Mean and sample std across restarts (seeds)."""
    return df.groupBy(*keys).agg(F.avg(score).alias("mean"), F.stddev_samp(score).alias("std"))


def run_average(df: DataFrame, keys: Sequence[str], run: str, fitness: str, seconds: str) -> DataFrame:
    """Best fitness and time per run, then their means per ``keys``."""
    per_run = df.groupBy(*keys, run).agg(F.max(fitness).alias("_best"), F.sum(seconds).alias("_sec"))
    return per_run.groupBy(*keys).agg(
        F.avg("_best").alias("mean_fitness"), F.avg("_sec").alias("mean_seconds"),
        F.count(F.lit(1)).alias("runs"))


def run_average_wide(avg_df: DataFrame, key: str, algo: str, algos: Sequence[str] | None = None,
                     max_algos: int = 1000) -> DataFrame:
    """One wide row per ``key`` holding every algorithm's mean fitness and seconds.

    The algorithms are those of the table unless given; more than ``max_algos`` columns is an error.
    """
    if algos is None:
        found = avg_df.select(algo).where(F.col(algo).isNotNull()).distinct().limit(max_algos + 1).collect()
        if len(found) > max_algos:
            raise ValueError(f"more than {max_algos} algorithms in {algo}")
        algos = sorted(r[0] for r in found)
    return avg_df.groupBy(key).pivot(algo, list(algos)).agg(
        F.first("mean_fitness").alias("fitness"), F.first("mean_seconds").alias("seconds"))


def episode_summary(df: DataFrame, episode: str, reward: str, ts: str) -> DataFrame:
    return df.groupBy(episode).agg(
        F.sum(reward).alias("reward"), F.count(F.lit(1)).alias("steps"),
        F.expr(f"timestampdiff(MICROSECOND, min({ts}), max({ts})) div 1000").alias("ms"))


def episode_reduce(df: DataFrame, episode: str, reward: str, reducers: dict) -> DataFrame:
    """One column per reducer (``Column -> Column`` aggregates, passed in by the caller) of every episode's rewards."""
    return df.groupBy(episode).agg(*[make(F.col(reward)).alias(name) for name, make in reducers.items()])


def episode_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.avg("reward").alias("mean_reward"),
        (F.sum("steps") / F.count(F.lit(1))).cast("bigint").alias("mean_steps_int"),
        F.min("steps").alias("min_steps"), F.avg("ms").alias("mean_ms"),
        F.count(F.lit(1)).alias("episodes"))


def column_min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    row = df.agg(*[F.struct(F.lit(c).alias("column"), F.min(F.col(c).cast("double")).alias("min"),
                            F.max(F.col(c).cast("double")).alias("max")).alias(f"_{i}") for i, c in enumerate(cols)])
    return row.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(cols))])))


def kurtosis_abs_mean(df: DataFrame, cols: Sequence[Column]) -> DataFrame:
    """Bias-corrected excess kurtosis of each column (pandas ``kurt``), then the mean of |k|.

    Spark's ``kurtosis`` is the population form g2; the sample form is
    ``(n-1)/((n-2)(n-3)) * ((n+1) g2 + 6)``.  All columns in one pass.  Fewer than
    four rows have no sample kurtosis: the result is null.
    """
    n = F.count(F.lit(1)).cast("double")
    ks = [F.when(n > 3, F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6)) for c in cols]
    row = df.agg(F.array(*ks).alias("k"))
    return row.select(
        F.aggregate(F.transform("k", lambda v: F.abs(v)), F.lit(0.0), lambda a, v: a + v) / F.size("k")
    ).toDF("kurtosis_abs_mean")


def distinct_levels(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()
