"""Registered queries: one per operator id, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the check tables (or frames Spark derives from them) in
full; fixture choices are listed in the README.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import Callable

import numpy as _np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash32, hash_unit
from ..functions.vectors import argmin_dist, dist
from ..operators import boosting as BO
from ..operators import classify as CL
from ..operators import clustering as CU
from ..operators import machines as MA
from ..operators import metrics as M
from ..operators import neighbors as NB
from ..operators import networks as NW
from ..operators import planning as PL
from ..operators import populations as PO
from ..operators import prep as P
from ..operators import profile as PR
from ..operators import projection as PJ
from ..operators import sampling as S
from ..operators import search as SE
from ..operators import sequences as SQ
from ..operators import slices as SL
from ..operators import trees as TR
from ..session import cut_lineage, shared_path, table
from ..sources import io as IO
from . import fixtures as FX

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def q(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- 2.1 sources / sinks

@q("scan_csv")
def _scan_csv(spark, sf):
    path = shared_path(spark, "orders-csv")
    IO.sink_csv(table(spark, sf, "orders"), path)
    schema = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string")
    df = IO.scan_csv(spark, path, schema)
    # timestamps rendered as ISO text so every client compares the same value
    return df.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@q("scan_csv_positional")
def _scan_csv_positional(spark, sf):
    e = table(spark, sf, "embeddings")
    path = shared_path(spark, "emb-positional")
    d = _width(e, "embedding")
    flat = e.select(*[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(d)], "label")
    IO.sink_csv(flat, path, header=False)
    df = IO.scan_csv_positional(spark, path, d)
    return df.select(*[r6(F.col(f"f{i}")).alias(f"f{i}") for i in range(d)], "label")


@q("sink_csv")
def _sink_csv(spark, sf):
    path = shared_path(spark, "customer-csv")
    IO.sink_csv(table(spark, sf, "customer"), path)
    return IO.scan_csv(spark, path, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")


def _runlog_rows(spark, sf):
    ev = FX.events(spark, sf)
    return ev.groupBy(F.col("event_type").alias("algo"), F.dayofmonth("ts").alias("budget")).agg(
        F.avg("value").alias("accuracy"))


def _runlog(spark, sf, mode):
    path = shared_path(spark, "runlog")
    rows = _runlog_rows(spark, sf).withColumn("run_date", F.lit("2024-01-31"))
    IO.sink_runlog(rows, path, mode="append")
    IO.sink_runlog(rows, path, mode=mode)
    back = IO.read_runlog(spark, path, "2024-01-31")
    return back.groupBy("algo", "budget", "accuracy").agg(F.count(F.lit(1)).alias("copies")).select(
        "algo", "budget", r6(F.col("accuracy")).alias("accuracy"), "copies")


@q("sink_runlog_append")
def _sink_runlog_append(spark, sf):
    return _runlog(spark, sf, "append")


@q("sink_runlog_overwrite")
def _sink_runlog_overwrite(spark, sf):
    return _runlog(spark, sf, "overwrite")


# ---------------------------------------------------------------- 2.2 profiling

LINE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@q("profile_shape")
def _profile_shape(spark, sf):
    return PR.profile_shape(table(spark, sf, "lineitem"))


@q("profile_nulls")
def _profile_nulls(spark, sf):
    return PR.profile_nulls(table(spark, sf, "lineitem"))


@q("profile_describe")
def _profile_describe(spark, sf):
    d = PR.profile_describe(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"] + LINE_NUM)
    # counts that are NULL for some rows are reported as doubles (same rendering in every client)
    return d.select(*[r6(F.col(c)).alias(c) if c in ("mean", "std", "min", "q25", "q50", "q75", "max")
                      else F.col(c).cast("double").alias(c) if c in ("unique", "freq") else c for c in d.columns])


# ---------------------------------------------------------------- 2.3 projections / expressions

@q("select_cols")
def _select_cols(spark, sf):
    return P.select_cols(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"])


@q("drop_cols")
def _drop_cols(spark, sf):
    return P.drop_cols(table(spark, sf, "part"), ["p_name", "p_retailprice"])


@q("move_label_first")
def _move_label_first(spark, sf):
    return P.move_label_first(table(spark, sf, "labels"), "quality")


@q("slice_features")
def _slice_features(spark, sf):
    li = table(spark, sf, "lineitem")
    a = P.assemble(li, LINE_NUM, legacy=True)
    return a.select("l_orderkey", "l_linenumber", *[F.col("features")[i].alias(f"f{i}") for i in range(3)])


@q("cast_category")
def _cast_category(spark, sf):
    return P.cast_category(table(spark, sf, "part").select("p_partkey", "p_size", "p_type"), ["p_size"])


@q("replace_value")
def _replace_value(spark, sf):
    return P.replace_value(table(spark, sf, "part"), 1, 0)


@q("map_label")
def _map_label(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return P.map_label(o, "o_orderstatus", {"F": 0, "O": 1, "P": 2}, out="status_code")


@q("one_hot")
def _one_hot(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return P.one_hot(li, ["l_returnflag", "l_linestatus"])


@q("min_max_scale")
def _min_max_scale(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINE_NUM)
    s = P.min_max_scale(li, LINE_NUM)
    return s.select("l_orderkey", "l_linenumber", *[r6(F.col(c)).alias(c) for c in LINE_NUM])


@q("mask_filter")
def _mask_filter(spark, sf):
    li = table(spark, sf, "lineitem")
    return P.mask_filter(li, (F.col("l_discount") > 0.05) & (F.col("l_returnflag") == "R")).select(
        "l_orderkey", "l_linenumber", "l_discount")


@q("abs_threshold_correct")
def _abs_threshold_correct(spark, sf):
    ev = FX.events(spark, sf)
    return ev.select("event_id", P.abs_threshold_correct(F.col("value") / 100, (F.col("event_type") == "purchase")
                                                          .cast("double")).alias("correct"))


@q("linspace_ladder")
def _linspace_ladder(spark, sf):
    n = FX.events(spark, sf).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return n.select(F.posexplode(F.arrays_zip(
        P.linspace(0.05, 1.0, 20, F.col("n"), "floor").alias("size_floor"),
        P.linspace(0.05, 1.0, 20, F.col("n"), "round").alias("size_round")))).select(
        F.col("pos").alias("i"), F.col("col.size_floor").alias("size_floor"), F.col("col.size_round").alias("size_round"))


@q("int_truncate")
def _int_truncate(spark, sf):
    ev = FX.events(spark, sf)
    g = ev.groupBy("user_id").agg(F.sum(F.floor("value")).alias("total"), F.count(F.lit(1)).alias("n"))
    return g.select("user_id", P.int_div("total", "n").alias("mean_int"), P.int_div("n", F.lit(2)).alias("half_n"))


@q("format_fixed")
def _format_fixed(spark, sf):
    ev = FX.events(spark, sf)
    return ev.select("event_id", P.format_fixed(F.col("value") / 7, 3).alias("value_fmt"))


@q("format_date")
def _format_date(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", P.format_date("o_orderdate").alias("order_day"))


def _csv_lines(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(P.csv_line("l_orderkey", "l_linenumber", "l_returnflag",
                                P.format_fixed("l_extendedprice", 2)).alias("line"))


@q("csv_line")
def _csv_line(spark, sf):
    return _csv_lines(spark, sf)


@q("parse_fields")
def _parse_fields(spark, sf):
    return _csv_lines(spark, sf).select(*P.parse_fields(
        "line", ["bigint", "int", "string", "double"], ["l_orderkey", "l_linenumber", "l_returnflag", "price"]))


@q("lookup_default")
def _lookup_default(spark, sf):
    ev = FX.events(spark, sf)
    return ev.select("event_id", P.lookup_default("event_type", FX.EVENT_ITERATIONS, 100).alias("iterations"))


# ---------------------------------------------------------------- 2.4 sampling / parameter tables

@q("split_random")
def _split_random(spark, sf):
    return S.split_random(FX.events(spark, sf).select("event_id"), "event_id", FX.TEST_PCT)


@q("split_ordered")
def _split_ordered(spark, sf):
    return S.split_ordered(FX.events(spark, sf).select("event_id"), "event_id")


@q("bootstrap_sample")
def _bootstrap_sample(spark, sf):
    return S.bootstrap_sample(FX.events(spark, sf).select("event_id", "value"), "event_id", seed=7)


@q("kfold_assign")
def _kfold_assign(spark, sf):
    ev = FX.events(spark, sf).select("event_id", "event_type")
    return S.kfold_assign(ev, "event_id", 10, label_col="event_type")


PARAM_GRID = {"q_max": [10, 20, 30, 40, 50], "disc_max": [0.02, 0.05, 0.08]}
ZIP_GRID = {"temp": [1.0, 5.0, 10.0, 50.0, 100.0, 500.0, 1000.0], "cooling": [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4]}
CROSS_PARAMS = [1, 2, 4, 8]


@q("param_grid")
def _param_grid(spark, sf):
    grid = S.param_grid(PARAM_GRID)
    li = table(spark, sf, "lineitem").select("l_quantity", "l_discount")
    # one scan: a conditional count per grid point, then unpivot (no join)
    agg = li.agg(*[F.sum(((F.col("l_quantity") <= g["q_max"]) & (F.col("l_discount") <= g["disc_max"]))
                         .cast("bigint")).alias(f"g{i}") for i, g in enumerate(grid)])
    return agg.select(F.inline(F.array(*[F.struct(
        F.lit(i).alias("grid_idx"), F.lit(g["q_max"]).alias("q_max"), F.lit(g["disc_max"]).alias("disc_max"),
        F.coalesce(F.col(f"g{i}"), F.lit(0)).alias("n_rows")) for i, g in enumerate(grid)])))


@q("param_zip")
def _param_zip(spark, sf):
    grid = S.param_zip(ZIP_GRID)
    ev = FX.events(spark, sf).select("value")
    agg = ev.agg(*[F.avg(F.exp(-F.col("value") / F.lit(g["temp"] * g["cooling"]))).alias(f"g{i}")
                   for i, g in enumerate(grid)])
    return agg.select(F.inline(F.array(*[F.struct(
        F.lit(i).alias("grid_idx"), F.lit(g["temp"]).alias("temp"), F.lit(g["cooling"]).alias("cooling"),
        r6(F.col(f"g{i}")).alias("mean_accept")) for i, g in enumerate(grid)])))


def _restart_scores(spark, sf):
    ev = FX.events(spark, sf).select("event_id", "value", F.dayofmonth("ts").alias("budget"))
    return S.restart_scores(ev, ["budget"], 5, lambda seed: F.avg(F.col("value") * hash_unit(seed, F.col("event_id"))))


@q("restart_grid")
def _restart_grid(spark, sf):
    return _restart_scores(spark, sf).select("budget", "seed", r6(F.col("score")).alias("score"))


@q("cross_params")
def _cross_params(spark, sf):
    ev = FX.events(spark, sf).select("event_type", "value")
    fan = S.fan_out(ev, [{"param": p} for p in CROSS_PARAMS])
    return fan.groupBy(F.col("event_type").alias("experiment"), "param").agg(
        F.sum((F.col("value") > F.col("param") * 10).cast("bigint")).alias("n"))


# ---------------------------------------------------------------- 2.5 joins

@q("bind_columns")
def _bind_columns(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf, "labels")
    j = d.join(lab, "doc_id", "full_outer")
    # label columns are NULL for unlabelled documents: reported as doubles
    return j.select("doc_id", "n_chars", F.col("quality").cast("double").alias("quality"),
                    F.col("toxic").cast("double").alias("toxic"))


@q("attach_labels")
def _attach_labels(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return d.join(table(spark, sf, "labels"), "doc_id", "inner")


@q("zip_truth_pred")
def _zip_truth_pred(spark, sf):
    return FX.docs_truth_pred(spark, sf).select("doc_id", "y", "yhat")


def _centroids(spark, sf):
    e = FX.emb(spark, sf)
    rows = e.groupBy("label").agg(F.array(*[F.avg(F.col("vec")[i]) for i in range(_width(e, "vec"))]).alias("c")).collect()
    return [list(r["c"]) for r in sorted(rows, key=lambda r: r["label"])]


@q("pairwise_distance")
def _pairwise_distance(spark, sf):
    e = FX.emb(spark, sf)
    d = NB.distances_to_reference(e, _centroids(spark, sf), "vec_id", "vec")
    return d.select("vec_id", "ref_id", r6(F.col("distance")).alias("distance"))


def _knn(spark, sf, k=FX.KNN_K):
    e = FX.emb_split(spark, sf)
    qy = e.where(F.col("split") == "test").select(F.col("vec_id").alias("qid"), "vec")
    base = e.where(F.col("split") == "train").select(F.col("vec_id").alias("bid"), "vec")
    return NB.knn_join(qy, base, k, "qid", "bid", "vec")


@q("knn_join")
def _knn_join(spark, sf):
    return _knn(spark, sf).select("qid", "bid", r6(F.col("distance")).alias("distance"))


@q("rank_neighbours")
def _rank_neighbours(spark, sf):
    return _knn(spark, sf).select("qid", "bid", "rank")


@q("clf_knn")
def _clf_knn(spark, sf):
    e = FX.emb_split(spark, sf)
    nb = _knn(spark, sf)
    base = e.where(F.col("split") == "train").select(F.col("vec_id").alias("bid"), "label")
    pred = NB.knn_vote(nb, base, "qid", "bid", "label")
    truth = e.where(F.col("split") == "test").select(F.col("vec_id").alias("qid"), "label")
    return truth.join(pred, "qid", "left")


# ---------------------------------------------------------------- 2.6 metrics

def _tp(spark, sf):
    return FX.docs_truth_pred(spark, sf)


@q("confusion_matrix")
def _confusion_matrix(spark, sf):
    return M.confusion_matrix(_tp(spark, sf), "y", "yhat")


@q("confusion_normalized")
def _confusion_normalized(spark, sf):
    c = M.confusion_normalized(_tp(spark, sf), "y", "yhat")
    return c.select("y", "yhat", "n", r6(F.col("share")).alias("share"))


for _m in ("accuracy", "precision", "recall", "f1", "auc_hard"):
    def _mk(name):
        def fn(spark, sf):
            return M.metric(_tp(spark, sf), "y", "yhat", name).select(r6(F.col(name)).alias(name))
        return fn
    REGISTRY[_m] = _mk(_m)


@q("metric_report")
def _metric_report(spark, sf):
    r = M.metric_report(_tp(spark, sf), "y", "yhat")
    return r.select(*[r6(F.col(c)).alias(c) if c in ("accuracy", "precision", "recall", "f1", "auc_hard") else c
                      for c in r.columns])


def _event_pred(spark, sf):
    ev = FX.events(spark, sf)
    return ev.select("event_id", (F.col("value") / 100).alias("pred"),
                     (F.col("event_type") == "purchase").cast("double").alias("actual"))


@q("sum_squared_error")
def _sse(spark, sf):
    return M.sum_squared_error(_event_pred(spark, sf), "pred", "actual").select(r6(F.col("sse")).alias("sse"))


@q("percent_correct")
def _percent_correct(spark, sf):
    e = _event_pred(spark, sf).withColumn("correct", P.abs_threshold_correct("pred", "actual"))
    return M.percent_correct(e, "correct").select(r6(F.col("pct_correct")).alias("pct_correct"))


@q("cluster_mode_vote")
def _cluster_mode_vote(spark, sf):
    return M.cluster_mode_vote(_tp(spark, sf).select("doc_id", "source", "y"), "source", "y", "doc_id")


@q("homogeneity")
def _homogeneity(spark, sf):
    h = M.homogeneity(_tp(spark, sf), "source", "y")
    return h.select(r6(F.col("homogeneity")).alias("homogeneity"))


@q("silhouette_sq")
def _silhouette_sq(spark, sf):
    return NB.silhouette_sq(FX.emb(spark, sf), "label", "vec").select(r6(F.col("silhouette")).alias("silhouette"))


def _folds(spark, sf):
    ev = FX.events(spark, sf).select("event_id", "event_type", "value")
    f = S.kfold_assign(ev, "event_id", 10, label_col="event_type")
    return f.groupBy("event_type", "fold").agg(F.avg("value").alias("score"))


@q("fold_mean_std")
def _fold_mean_std(spark, sf):
    r = M.fold_mean_std(_folds(spark, sf), ["event_type"], "score")
    return r.select("event_type", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std"))


@q("restart_mean_std")
def _restart_mean_std(spark, sf):
    r = M.restart_mean_std(_restart_scores(spark, sf), ["budget"], "score")
    return r.select("budget", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std"))


def _run_avg(spark, sf):
    ev = FX.events(spark, sf)
    runs = ev.select(F.col("event_type").alias("algo"), F.dayofmonth("ts").alias("budget"),
                     F.pmod(F.col("user_id"), F.lit(5)).alias("run"), "value",
                     (F.col("value") / 10).alias("seconds"))
    return M.run_average(runs, ["algo", "budget"], "run", "value", "seconds")


@q("run_average")
def _run_average(spark, sf):
    r = _run_avg(spark, sf)
    return r.select("algo", "budget", r6(F.col("mean_fitness")).alias("mean_fitness"),
                    r6(F.col("mean_seconds")).alias("mean_seconds"), "runs")


@q("run_average_wide")
def _run_average_wide(spark, sf):
    w = M.run_average_wide(_run_avg(spark, sf), "budget", "algo")
    return w.select("budget", *[r6(F.col(c)).alias(c) for c in w.columns if c != "budget"])


def _episodes(spark, sf):
    ev = FX.events(spark, sf)
    return M.episode_summary(ev, "user_id", "value", "ts")


@q("episode_summary")
def _episode_summary(spark, sf):
    s = _episodes(spark, sf)
    return s.select("user_id", r6(F.col("reward")).alias("reward"), "steps", "ms")


@q("episode_totals")
def _episode_totals(spark, sf):
    t = M.episode_totals(_episodes(spark, sf))
    return t.select(r6(F.col("mean_reward")).alias("mean_reward"), "mean_steps_int", "min_steps",
                    F.round(F.col("mean_ms"), 2).alias("mean_ms"), "episodes")


@q("column_min_max")
def _column_min_max(spark, sf):
    return M.column_min_max(table(spark, sf, "lineitem"), LINE_NUM)


@q("kurtosis_abs_mean")
def _kurtosis_abs_mean(spark, sf):
    e = FX.emb(spark, sf)
    k = M.kurtosis_abs_mean(e, [F.col("vec")[i] for i in range(_width(e, "vec"))])
    return k.select(r6(F.col("kurtosis_abs_mean")).alias("kurtosis_abs_mean"))


@q("distinct_levels")
def _distinct_levels(spark, sf):
    return M.distinct_levels(table(spark, sf, "documents"), "lang")


@q("entropy_gain")
def _entropy_gain(spark, sf):
    li = table(spark, sf, "lineitem")
    g = M.entropy_gain(li, "l_returnflag", ["l_linestatus", "l_linenumber"])
    return g.select("feature", r6(F.col("gain")).alias("gain"))


# ---------------------------------------------------------------- 2.7 windows

def _dim_table(spark, sf):
    """Per embedding dimension: variance share and |corr| with y (one pass, 64-row result)."""
    e = FX.emb(spark, sf)
    row = e.agg(F.array(*[F.struct(F.lit(i).alias("dim"), F.var_samp(F.col("vec")[i]).alias("var"),
                                   F.abs(F.corr(F.col("vec")[i], F.col("y").cast("double"))).alias("ac"))
                          for i in range(_width(e, "vec"))]).alias("d"))
    t = row.select(F.inline("d"))
    w = Window.partitionBy()
    return t.select("dim", (F.col("var") / F.sum("var").over(w)).alias("ratio"),
                    (F.col("ac") / F.sum("ac").over(w)).alias("importance"))


@q("cum_explained_variance")
def _cum_explained_variance(spark, sf):
    t = _dim_table(spark, sf)
    w = Window.orderBy(F.desc("ratio"), "dim").rowsBetween(Window.unboundedPreceding, 0)
    return t.select("dim", r6(F.col("ratio")).alias("ratio"), r6(F.sum("ratio").over(w)).alias("cum_ratio"))


@q("cum_importance")
def _cum_importance(spark, sf):
    t = _dim_table(spark, sf)
    w = Window.orderBy(F.desc("importance"), "dim").rowsBetween(Window.unboundedPreceding, 0)
    c = t.select("dim", "importance", F.sum("importance").over(w).alias("cum"))
    return c.where(F.col("cum") <= 0.95).select("dim", r6(F.col("importance")).alias("importance"),
                                                r6(F.col("cum")).alias("cum"))


THRESHOLDS = [500, 1000, 1500, 2000, 4000, 8000]


def _threshold_cv(spark, sf):
    d = _tp(spark, sf).select("doc_id", "n_chars", "y")
    f = S.kfold_assign(d, "doc_id", 5, label_col="y")
    fan = S.fan_out(f, [{"threshold": t} for t in THRESHOLDS])
    per_fold = fan.groupBy("grid_idx", "threshold", "fold").agg(
        F.avg(((F.col("n_chars") > F.col("threshold")).cast("int") == F.col("y")).cast("double")).alias("acc"))
    return per_fold.groupBy("grid_idx", "threshold").agg(F.avg("acc").alias("mean_score"))


@q("best_params")
def _best_params(spark, sf):
    cv = _threshold_cv(spark, sf)
    best = cv.agg(F.max_by(F.struct("grid_idx", "threshold", "mean_score"),
                           F.struct(F.col("mean_score"), (-F.col("grid_idx")).alias("g"))).alias("b"))
    return best.select("b.grid_idx", "b.threshold", r6(F.col("b.mean_score")).alias("mean_score"))


CLUSTER_K = list(range(2, 49, 2))


@q("elbow_curve")
def _elbow_curve(spark, sf):
    """Homogeneity and its first difference per number of k-means clusters (best of 10 runs each)."""
    e = FX.emb(spark, sf)
    fits = CU.kmeans_batch(e, "vec", "vec_id", CLUSTER_K, n_init=10)
    scores = CU.clustering_scores(e, "vec", "label", "y", fits, CU.assign_centres)
    ks = sorted(scores)
    rows = [(k, scores[k]["homogeneity"], scores[k]["homogeneity"] - scores[ks[i - 1]]["homogeneity"] if i else None, float(fits[k]["cost"]))
            for i, k in enumerate(ks)]
    return spark.createDataFrame(rows, "k int, homogeneity double, delta double, cost double")


@q("elbow_kernel")
def _elbow_kernel(spark, sf):
    """The curve's scoring by itself, which SQL can repeat: rows go to the nearest of the first k hash-chosen rows."""
    e = FX.emb(spark, sf)
    seeds = [list(r["vec"]) for r in e.select("vec", hash32(F.lit("elbow"), F.col("vec_id")).alias("h"), "vec_id")
             .orderBy("h", "vec_id").limit(max(CLUSTER_K)).collect()]
    d = F.transform(_lit(_np.array(seeds)), lambda c: F.round(dist(c, F.col("vec")), 9))
    near = F.transform(F.array(*[F.lit(k) for k in CLUSTER_K]), lambda k: F.struct(
        k.alias("k"), F.array_position(F.slice("d", F.lit(1), k), F.array_min(F.slice("d", F.lit(1), k))).alias("c")))
    fan = e.select("label", d.alias("d")).select("label", F.inline(near))
    cont = fan.groupBy("k", "c", "label").agg(F.count(F.lit(1)).cast("double").alias("n_ck"))
    cont = cont.withColumn("n_k", F.sum("n_ck").over(Window.partitionBy("k", "c"))) \
        .withColumn("n_c", F.sum("n_ck").over(Window.partitionBy("k", "label")))
    t = cont.groupBy("k").agg(
        F.sum(-F.col("n_ck") * F.log(F.col("n_ck") / F.col("n_k"))).alias("a"),
        F.sum(-F.col("n_ck") * F.log(F.col("n_c"))).alias("b"), F.sum("n_ck").alias("N"))
    hc = (F.col("b") + F.col("N") * F.log(F.col("N"))) / F.col("N")
    h = t.select("k", (1 - (F.col("a") / F.col("N")) / hc).alias("h"))
    w = Window.orderBy("k")  # one row per k (model-sized)
    return h.select("k", r6(F.col("h")).alias("homogeneity"), r6(F.col("h") - F.lag("h").over(w)).alias("delta"))


# ---------------------------------------------------------------- 2.8 sorts / top-k / unions

@q("sort_desc")
def _sort_desc(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice").orderBy(
        F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")


@q("top_1_per_group")
def _top_1_per_group(spark, sf):
    d = table(spark, sf, "documents")
    c = d.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy("lang").agg(F.min_by(F.struct("source", "n"), F.struct((-F.col("n")).alias("a"), F.col("source")))
                                 .alias("t")).select("lang", "t.source", "t.n")


@q("top_k")
def _top_k(spark, sf):
    return FX.events(spark, sf).select("event_id", "value").orderBy(F.desc("value"), "event_id").limit(10)


@q("union_results")
def _union_results(spark, sf):
    tp = _tp(spark, sf)
    a = M.metric_report(tp, "y", "yhat").withColumn("task", F.lit("quality"))
    b = M.metric_report(tp, "toxic", "yhat").withColumn("task", F.lit("toxic"))
    u = a.unionByName(b)
    return u.select("task", "tp", "fp", "tn", "fn", r6(F.col("accuracy")).alias("accuracy"), r6(F.col("f1")).alias("f1"))


def flagship(spark, sf):
    """Binary kNN (y = label < 5): hash split, exact pruned kNN, vote, metric report."""
    e = FX.emb_split(spark, sf)
    nb = _knn(spark, sf)
    base = e.where(F.col("split") == "train").select(F.col("vec_id").alias("bid"), "y")
    pred = NB.knn_vote(nb, base, "qid", "bid", "y")
    truth = e.where(F.col("split") == "test").select(F.col("vec_id").alias("qid"), "y")
    scored = truth.join(pred, "qid", "left").fillna({"prediction": 0})
    return M.metric_report(scored, "y", "prediction")


# ---------------------------------------------------------------- 2.11 sequences


RUN_T = 2


def _bits(spark, sf):
    ev = FX.events(spark, sf)
    return ev.select("user_id", "ts", "event_id", (F.col("value") > 50).cast("int").alias("bit"))


@q("longest_run")
def _longest_run(spark, sf):
    return SQ.longest_run(_bits(spark, sf), "user_id", ["ts", "event_id"], "bit")


@q("edge_runs")
def _edge_runs(spark, sf):
    return SQ.edge_runs(_bits(spark, sf), "user_id", ["ts", "event_id"], "bit", RUN_T)


def _stops(spark, sf):
    e = FX.emb(spark, sf)
    return e.select("vec_id", "label", F.col("vec")[0].alias("x"), F.col("vec")[1].alias("y"),
                    F.col("vec")[2].alias("key"))


@q("route_length")
def _route_length(spark, sf):
    r = SQ.route_length(_stops(spark, sf), "label", ["vec_id"], "x", "y")
    return r.select("label", "n", r6(F.col("length")).alias("length"))


@q("sort_encoded_route")
def _sort_encoded_route(spark, sf):
    r = SQ.route_length(_stops(spark, sf), "label", ["key", "vec_id"], "x", "y")
    return r.select("label", "n", r6(F.col("length")).alias("length"))


MI_COLS = ["l_returnflag", "l_linestatus", "l_linenumber"]


@q("pairwise_mutual_information")
def _pmi(spark, sf):
    m = SQ.pairwise_mutual_information(table(spark, sf, "lineitem"), MI_COLS)
    return m.select("col_a", "col_b", r6(F.col("mi")).alias("mi"))


@q("chow_liu_tree")
def _chow_liu_tree(spark, sf):
    t = SQ.chow_liu_tree(SQ.pairwise_mutual_information(table(spark, sf, "lineitem"), MI_COLS))
    return t.select("col_a", "col_b", r6(F.col("mi")).alias("mi"))


# ---------------------------------------------------------------- 2.11 planning

@q("grid_to_cells")
def _grid_to_cells(spark, sf):
    return PL.text_to_cells(table(spark, sf, "part").select("p_partkey", "p_name"), ["p_partkey"], "p_name")


def _event_log(spark, sf):
    """Steps of the event stream of each user: state = event type and value band, action = user class."""
    ev = FX.events(spark, sf).select("event_id", "ts", "event_type", "user_id", "value")
    s = F.concat_ws(":", "event_type", F.floor(F.least(F.col("value"), F.lit(199.0)) / 25).cast("string"))
    return ev.withColumn("s", s).withColumn("a", F.pmod(F.col("user_id"), F.lit(4)))


def _trans(spark, sf):
    """Transitions estimated from the log; a purchase ends an episode."""
    t = cut_lineage(PL.estimate_transitions(_event_log(spark, sf), "user_id", ["ts", "event_id"], "s", "a", "value",
                                            terminal=F.col("s").startswith("purchase:")))
    return t, PL.states_of(t)


@q("transition_table")
def _transition_table(spark, sf):
    t, _ = _trans(spark, sf)
    return t.select("s", "a", "s2", r6(F.col("p")).alias("p"), r6(F.col("r")).alias("r"))


def _vi(spark, sf):
    t, st = _trans(spark, sf)
    return t, PL.value_iteration(t, st, PL.GAMMA, PL.THETA, PL.ITERATIONS["value_iteration"])


@q("value_iteration")
def _value_iteration(spark, sf):
    _, v = _vi(spark, sf)
    return v.select("s", r6(F.col("v")).alias("v"), "sweeps")


@q("greedy_policy")
def _greedy_policy(spark, sf):
    t, v = _vi(spark, sf)
    g = PL.greedy_policy(t, v.select("s", "v"))
    return g.select("s", "a", r6(F.col("q")).alias("q"))


@q("policy_iteration")
def _policy_iteration(spark, sf):
    t, st = _trans(spark, sf)
    p = PL.policy_iteration(t, st, PL.GAMMA, rounds=PL.ITERATIONS["policy_iteration"],
                            eval_sweeps=PL.ITERATIONS["value_iteration"])
    return p.select("s", r6(F.col("v")).alias("v"), "a")


@q("udf_planner_factory")
def _planner_factory(spark, sf):
    """The fitted-Q strategy looked up by name, over the estimated transitions."""
    t, st = _trans(spark, sf)
    return PL.run_planner("q_learning", t, st, Q_SWEEPS).select("s", "a", r6(F.col("q")).alias("q"))


@q("reachable_states")
def _reachable_states(spark, sf):
    t, st = _trans(spark, sf)
    return PL.reachable_states(t, st.agg(F.min("s")).first()[0])


Q_SWEEPS = 10


@q("batch_q_learning")
def _batch_q_learning(spark, sf):
    ev = FX.events(spark, sf).select("event_id", "ts", "event_type", "user_id", "value")
    log = ev.select("ts", "event_id", F.col("event_type").alias("s"), F.pmod(F.col("user_id"), F.lit(4)).alias("a"), "value")
    qv = PL.batch_q_learning(log, ["ts", "event_id"], "s", "a", "value", PL.GAMMA, 0.3, 0.1, Q_SWEEPS)
    return qv.select("s", "a", r6(F.col("q")).alias("q"))


# ---------------------------------------------------------------- 2.11 search

N_CANDIDATES = 16
SEARCH_GENERATIONS = 10


def _cands(e):
    return SE.hashed_candidates(N_CANDIDATES, _width(e, "vec"), seed=0, scale=0.2)


@q("population_score")
def _population_score(spark, sf):
    e = FX.emb(spark, sf)
    s = SE.population_score(e, "vec", "y", _cands(e))
    return s.select("candidate", r6(F.col("sse")).alias("sse"), r6(F.col("accuracy")).alias("accuracy"))


@q("udf_objective")
def _objective(spark, sf):
    """Absolute error of logistic scores, both passed in as callables."""
    e = FX.emb(spark, sf)
    s = SE.population_score(e, "vec", "y", _cands(e), objective=lambda p, y: F.abs(p - y), link=lambda z: 1 / (1 + F.exp(-z)))
    return s.select("candidate", r6(F.col("sse")).alias("error"), r6(F.col("accuracy")).alias("accuracy"))


@q("search_tuning_report")
def _search_tuning_report(spark, sf):
    e = FX.emb_split(spark, sf)
    parts = [SE.population_score(e.where(F.col("split") == sp), "vec", "y", _cands(e)).withColumn("split", F.lit(sp))
             for sp in ("train", "test")]
    u = parts[0].unionByName(parts[1])
    return u.select("candidate", "split", r6(F.col("sse")).alias("sse"), r6(F.col("accuracy")).alias("accuracy"))


HIDDEN = 50
SEARCH_BUDGETS = [10, 25, 50]   # generations; the studied budgets go on to 100, 500, 1000, 2500, 5000
# fixed values: (temperature, cooling) pairs and (population, mate, mutate) triples of the tuning runs
ANNEAL_GRID = [(1e1, 0.05), (1e2, 0.2), (1e3, 0.35), (1e4, 0.5), (1e5, 0.65), (1e6, 0.8), (1e7, 0.95)]
GENETIC_GRID = [(10, 5, 2), (25, 10, 5), (50, 30, 10), (75, 40, 15), (100, 50, 20), (125, 60, 25)]


@q("search_report")
def _search_report(spark, sf):
    """Accuracy of a d-50-1 network by optimiser, setting, budget and split."""
    e = FX.emb_split(spark, sf).persist()
    with _released(e):
        return SE.search_report(e.where(F.col("split") == "train"), e.where(F.col("split") == "test"), "vec", "y", _width(e, "vec"),
                                HIDDEN, SEARCH_BUDGETS, ANNEAL_GRID, GENETIC_GRID)


def _searched(search, spark, sf):
    e = FX.emb(spark, sf)
    got = search(e, "vec", "y", _width(e, "vec"), SEARCH_GENERATIONS)
    return got.withColumn("sse", r6(F.col("sse"))).withColumn("accuracy", r6(F.col("accuracy")))


@q("search_hill_climb")
def _search_hill_climb(spark, sf):
    return _searched(PO.hill_climb, spark, sf)


@q("search_anneal")
def _search_anneal(spark, sf):
    return _searched(PO.anneal, spark, sf)


@q("search_genetic")
def _search_genetic(spark, sf):
    return _searched(PO.evolve, spark, sf)


# ---------------------------------------------------------------- 2.9 / 2.10 estimators


MLP_HIDDEN = 16
RCA_K = 8
ICA_M = 8
GMM_REG = 1e-6


def _width(df, col) -> int:
    """Vector width, read from the table (0 rows: 0)."""
    row = df.select(col).first()
    return len(row[0]) if row else 0


def _ml_split(spark, sf):
    e = FX.emb_split(spark, sf)
    tr = CL.ml_frame(e.where(F.col("split") == "train"), "vec", "y", ["vec_id"]).persist()
    te = CL.ml_frame(e.where(F.col("split") == "test"), "vec", "y", ["vec_id"]).persist()
    return tr, te


@contextmanager
def _released(*frames):
    """Persisted frames, given back at the end."""
    try:
        yield
    finally:
        for f in frames:
            f.unpersist()


def _predict(make):
    """``make(d, n)``: estimator for ``d`` features and ``n`` training rows, both read from the table."""
    def fn(spark, sf):
        tr, te = _ml_split(spark, sf)
        with _released(tr, te):
            _, pred, _ = CL.fit_predict(make(_width(tr, "features"), tr.count()), tr, te, ["vec_id"])
            return pred.select("vec_id", F.col("label").cast("int").alias("y"), F.col("prediction").cast("int").alias("prediction"))
    return fn


REGISTRY["clf_mlp"] = _predict(lambda d, n: CL.mlp([d, MLP_HIDDEN, 2], max_iter=100))
REGISTRY["clf_mlp_2layer"] = _predict(lambda d, n: CL.mlp([d, MLP_HIDDEN, 8, 2], max_iter=100))
REGISTRY["clf_svm_linear"] = _predict(lambda d, n: CL.linear_svc(c=1.0, n=n))
REGISTRY["clf_tree"] = _predict(lambda d, n: CL.tree(max_depth=5, min_leaf=2))
REGISTRY["clf_gbt"] = _predict(lambda d, n: CL.gbt(n_estimators=10, max_depth=3))


@q("mlp_loss_curve")
def _mlp_loss_curve(spark, sf):
    tr, te = _ml_split(spark, sf)
    with _released(tr, te):
        model = CL.mlp([_width(tr, "features"), MLP_HIDDEN, 2], max_iter=50).fit(tr)
        hist = model.summary().objectiveHistory
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(hist)], "iteration int, loss double")


def _kernel_svm(mapper):
    def fn(spark, sf):
        e = mapper(FX.emb_split(spark, sf))
        tr = CL.ml_frame(e.where(F.col("split") == "train"), "kf", "y", ["vec_id"])
        te = CL.ml_frame(e.where(F.col("split") == "test"), "kf", "y", ["vec_id"])
        _, pred, _ = CL.fit_predict(CL.linear_svc(c=1.0, n=tr.count()), tr, te, ["vec_id"])
        return pred.select("vec_id", F.col("label").cast("int").alias("y"), F.col("prediction").cast("int").alias("prediction"))
    return fn


REGISTRY["clf_svm_rbf"] = _kernel_svm(lambda e: CL.rff_map(e, "vec", _width(e, "vec"), 128, gamma=1.0, out="kf"))
REGISTRY["clf_svm_sigmoid"] = _kernel_svm(lambda e: CL.sigmoid_map(e, "vec", "vec_id", 32, gamma=0.1, out="kf"))


def _features(mapper):
    def fn(spark, sf):
        e = mapper(FX.emb(spark, sf))
        return e.select("vec_id", F.posexplode("kf").alias("component", "value")).select(
            "vec_id", "component", r6(F.col("value")).alias("value"))
    return fn


POLY_DEGREES = range(2, 9)                                            # the studied degrees
SVM_CS, SVM_GAMMAS = [1e-4, 1e-3, 1e-2, 10.0, 1.0], [1.0, 10.0, 100.0]   # the studied grid


@q("clf_svm_poly")
def _clf_svm_poly(spark, sf):
    """Predictions of polynomial machines of degree 2..8, trained together."""
    e = FX.emb_split(spark, sf)
    gamma = MA.scale_gamma(e, "vec")
    maps = {f"d{p}": MA.poly_map(p, gamma=gamma) for p in POLY_DEGREES}
    tr, te = (e.where(F.col("split") == side) for side in ("train", "test"))
    machines = {k: MA.Machine(k, 1.0) for k in maps}
    MA.fit_machines(tr, "vec", "y", maps, list(machines.values()))
    got = MA.predictions(te, "vec", maps, machines, ["vec_id", "y"])
    return got.select("vec_id", "y", F.inline(F.array(*[F.struct(F.lit(p).alias("degree"), F.col(f"d{p}").alias("prediction")) for p in POLY_DEGREES])))


@q("complexity_curve_svm")
def _complexity_curve_svm(spark, sf):
    """Linear, polynomial 2..8, radial and sigmoid machines (C = 1, gamma by the table's spread): F1 on both splits."""
    e = FX.emb_split(spark, sf)
    d, gamma = _width(e, "vec"), MA.scale_gamma(e, "vec")
    marks = e.where(F.col("split") == "train").select("vec", hash32(F.lit("lm0"), F.col("vec_id")).alias("h"), "vec_id") \
        .orderBy("h", "vec_id").limit(32).collect()
    maps = {"linear": MA.linear_map(), **{f"poly{p}": MA.poly_map(p, gamma=gamma) for p in POLY_DEGREES},
            "rbf": MA.rbf_map(d, gamma), "sigmoid": MA.sigmoid_map(_np.array([r["vec"] for r in marks], float).reshape(-1, d), gamma)}
    return MA.kernel_curve(e, "vec", "y", "split", maps)[1]


@q("svm_grid_search")
def _svm_grid_search(spark, sf):
    """C x gamma of the radial machine, 10 stratified folds: 150 machines in shared scans."""
    e = FX.emb_split(spark, sf).where(F.col("split") == "train")
    data = S.kfold_assign(e, "vec_id", 10, label_col="y")
    return MA.rbf_grid_search(data, "vec", "y", "fold", 10, SVM_CS, SVM_GAMMAS)


@q("poly_features")
def _poly_features(spark, sf):
    """Tensor sketch of degree 3, which SQL can repeat as circular convolutions."""
    e = MA.tensor_sketch_map(FX.emb(spark, sf), "vec", 3, cells=32, out="kf")
    return e.select("vec_id", F.posexplode("kf").alias("component", "value")).select(
        "vec_id", "component", (F.round("value", 9) + F.lit(0.0)).alias("value"))


# the kernel maps by themselves, which SQL can repeat
REGISTRY["rbf_features"] = _features(lambda e: CL.rff_map(e, "vec", _width(e, "vec"), 32, gamma=1.0, out="kf"))
REGISTRY["sigmoid_features"] = _features(lambda e: CL.sigmoid_map(e, "vec", "vec_id", 32, gamma=0.1, out="kf"))


@q("clf_random_forest")
def _clf_random_forest(spark, sf):
    tr, te = _ml_split(spark, sf)
    with _released(tr, te):
        # leaves of at least one per cent of the rows, as in the studied forests
        _, pred, _ = CL.fit_predict(CL.random_forest(n_trees=500, min_leaf=max(1, tr.count() // 100)), tr, te, ["vec_id"])
        return pred.select("vec_id", F.col("label").cast("int").alias("y"), F.col("prediction").cast("int").alias("prediction"))


@q("udf_estimator_arg")
def _estimator_arg(spark, sf):
    """A complexity curve of an estimator that is passed in as a factory."""
    tr, te = _ml_split(spark, sf)
    with _released(tr, te):
        return CL.complexity_curve(lambda d: CL.tree(max_depth=d), [1, 3, 5], tr, te, "max_depth")


@q("udf_reducer")
def _reducer(spark, sf):
    """Episode rewards under reducers that are passed in as callables."""
    ev = FX.events(spark, sf).select("user_id", "ts", "value")
    got = M.episode_reduce(ev, "user_id", "value", {"total": F.sum, "best": F.max, "spread": lambda c: F.max(c) - F.min(c)})
    return got.select("user_id", *[r6(F.col(c)).alias(c) for c in ("total", "best", "spread")])


@q("complexity_curve_gbt")
def _complexity_curve_gbt(spark, sf):
    """Boosted trees: F1 on both splits after 40 numbers of rounds up to 250, for three learning rates grown together."""
    rounds = sorted({int(v) for v in _np.linspace(1, 250, 40)})
    return BO.boosting_curve(FX.emb_split(spark, sf), "vec", "y", "split", rounds, [float(v) for v in _np.linspace(0.001, 0.1, 3)], min_leaf=25)


CURVE_FRACTIONS = [float(v) for v in _np.linspace(0.05, 1.0, 20)]   # the studied training sizes
CURVE_FOLDS, TREE_DEPTH, MLP_STEPS = 10, 30, 60


def _folded(spark, sf, folds):
    """Embeddings with stratified folds."""
    return S.kfold_assign(FX.emb(spark, sf), "vec_id", folds, label_col="y")


@q("complexity_curve")
def _complexity_curve(spark, sf):
    """Tree depth 1..30, F1 and accuracy on both splits."""
    return TR.tree_complexity_curve(FX.emb_split(spark, sf), "vec", "y", "split", TREE_DEPTH)


@q("grid_search_cv")
def _grid_search_cv(spark, sf):
    """Tree depth 1..19 x 20 leaf sizes from 0.5 to 5 per cent of the training rows, 10 stratified folds."""
    e = FX.emb_split(spark, sf).where(F.col("split") == "train")
    n = e.count()
    leaves = [max(1, int(v)) for v in _np.linspace(round(0.005 * n), round(0.05 * n), 20).round()]
    data = S.kfold_assign(e, "vec_id", CURVE_FOLDS, label_col="y")
    return TR.tree_grid_search(data, "vec", "y", "fold", CURVE_FOLDS, range(1, 20), leaves)


@q("learning_curve")
def _learning_curve(spark, sf):
    """20 training sizes x 10 folds, with fit and score seconds."""
    return TR.tree_learning_curve(_folded(spark, sf, CURVE_FOLDS), "vec_id", "vec", "y", "fold", CURVE_FOLDS, CURVE_FRACTIONS, max_depth=5)


@q("tree_levels")
def _tree_levels(spark, sf):
    """Nodes of one tree a fold, three levels deep: the kernel of the tree studies, which SQL can repeat."""
    t = TR.tree_levels(_folded(spark, sf, 5), "vec", "y", "fold", 5, max_depth=3, min_leaf=5)
    return t.withColumn("gain", r6(F.col("gain")))


@q("poisson_draws")
def _poisson_draws(spark, sf):
    """Draw counts of the hashed bootstrap at three sizes."""
    e = table(spark, sf, "events")
    return e.select("event_id", *[TR.poisson_weight(f, F.lit("boot0"), F.lit(i), F.col("event_id")).alias(f"w{i}")
                                  for i, f in enumerate((0.05, 0.5, 1.0))])


@q("mlp_surface")
def _mlp_surface(spark, sf):
    """Two hidden layers, 10 x 10 shapes from 1 to 50 units, trained together: F1, accuracy and loss curve of each."""
    units = [int(v) for v in _np.linspace(1, 50, 10)]
    got = NW.network_curve(FX.emb_split(spark, sf), "vec", "y", "split", [(a, b) for a in units for b in units], 0.05, MLP_STEPS)
    return got.select(F.col("hidden")[0].alias("units1"), F.col("hidden")[1].alias("units2"), "split", "f1", "accuracy", "losses")


@q("complexity_curve_mlp")
def _complexity_curve_mlp(spark, sf):
    """One hidden layer, 30 sizes from 1 to 150 units: F1 and accuracy on both splits."""
    got = NW.network_curve(FX.emb_split(spark, sf), "vec", "y", "split", [(int(v),) for v in _np.linspace(1, 150, 30)], 0.05, MLP_STEPS)
    return got.select(F.col("hidden")[0].alias("units"), "split", "f1", "accuracy")


@q("mlp_grid_search")
def _mlp_grid_search(spark, sf):
    """Hidden units x learning rate, 10 stratified folds: 240 networks in shared scans."""
    e = FX.emb_split(spark, sf).where(F.col("split") == "train")
    data = S.kfold_assign(e, "vec_id", 10, label_col="y")
    return NW.network_grid_search(data, "vec", "y", "fold", 10, [5, 10, 20, 30, 40, 50, 75, 100], [0.01, 0.05, 0.1], MLP_STEPS)


def _label_params(spark, sf):
    """Per-label diagonal Gaussians (weights, means, population variances + reg), model-sized."""
    e = FX.emb(spark, sf)
    n, d = e.count(), _width(e, "vec")
    rows = e.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                  F.array(*[F.avg(F.col("vec")[i]) for i in range(d)]).alias("mu"),
                                  F.array(*[F.var_pop(F.col("vec")[i]) for i in range(d)]).alias("var")).collect()
    rows = sorted(rows, key=lambda r: r["label"])
    return ([r["label"] for r in rows], _np.array([r["n"] / n for r in rows]), _np.array([r["mu"] for r in rows]),
            _np.array([r["var"] for r in rows]) + GMM_REG, n)


@q("kmeans_step")
def _kmeans_step(spark, sf):
    labels, _, mu, _, _ = _label_params(spark, sf)
    s = CU.kmeans_step(FX.emb(spark, sf), "vec", mu.tolist())
    return s.select("cluster", "n", r6(F.col("cost")).alias("cost"), "dim", r6(F.col("value")).alias("value"))


@q("gmm_step")
def _gmm_step(spark, sf):
    labels, w, mu, var, n = _label_params(spark, sf)
    nk, sk, qk, ll, cnt = CU.gmm_stats(FX.emb(spark, sf), "vec", w, mu, var)
    w2, mu2, var2 = CU.gmm_m_step(nk, sk, qk, cnt, GMM_REG)
    rows = [(int(labels[c]), float(w2[c]), j, float(mu2[c, j]), float(var2[c, j]))
            for c in range(len(labels)) for j in range(mu2.shape[1])]
    df = spark.createDataFrame(rows, "component int, weight double, dim int, mean double, var double")
    return df.select("component", r6(F.col("weight")).alias("weight"), "dim", r6(F.col("mean")).alias("mean"),
                     r6(F.col("var")).alias("var"))


@q("aic_bic")
def _aic_bic(spark, sf):
    labels, w, mu, var, n = _label_params(spark, sf)
    _, _, _, ll, cnt = CU.gmm_stats(FX.emb(spark, sf), "vec", w, mu, var)
    aic, bic = CU.aic_bic(ll, len(labels), mu.shape[1], cnt)
    return spark.createDataFrame([(ll, aic, bic)], "loglik double, aic double, bic double").select(
        *[r6(F.col(c)).alias(c) for c in ("loglik", "aic", "bic")])


@q("kmeans_fit")
def _kmeans_fit(spark, sf):
    e = FX.emb(spark, sf)
    m = CU.kmeans_batch(e, "vec", "vec_id", [10], n_init=10)
    centres = _lit(m[10]["c"]) if m else F.array().cast("array<array<double>>")
    return e.select("vec_id", "label", argmin_dist(centres, "vec").alias("cluster"))


@q("sink_model_table")
def _sink_model_table(spark, sf):
    """Component means of the per-label mixture written as a table and read back."""
    labels, _, mu, _, _ = _label_params(spark, sf)
    t = IO.sink_model_table(spark, mu.tolist(), shared_path(spark, "component-means"), "component")
    return t.select("component", "dim", r6(F.col("value")).alias("value"))


@q("kmeans_sweep")
def _kmeans_sweep(spark, sf):
    e = FX.emb(spark, sf)
    fits = CU.kmeans_batch(e, "vec", "vec_id", CLUSTER_K, n_init=10)
    scores = CU.clustering_scores(e, "vec", "label", "y", fits, CU.assign_centres)
    rows = [(k, float(m["cost"]), int(m["iterations"]), scores[k]["homogeneity"], scores[k]["f1"], scores[k]["silhouette"])
            for k, m in fits.items()]
    return spark.createDataFrame(rows, "k int, cost double, iterations int, homogeneity double, f1 double, silhouette double")


@q("gmm_diag_fit")
def _gmm_diag_fit(spark, sf):
    p = CU.gmm_diag_fit(FX.emb(spark, sf), "vec", 4)
    rows = [(c, float(p["weights"][c]), j, float(p["means"][c, j]), float(p["vars"][c, j]))
            for c in range(4) for j in range(p["means"].shape[1])]
    return spark.createDataFrame(rows, "component int, weight double, dim int, mean double, var double")


MIXTURE_K = list(range(2, 98, 5))


def _mixtures_from(e, jobs):
    """Mixtures of every job ``(vector column, k-means fits by k)``, all in the same scans."""
    fits = CU.gmm_batches(e, [(vec, {k: m["c"] for k, m in km.items()}) for vec, km in jobs])
    return [{k: p | {"k": k} for k, p in f.items()} for f in fits]


def _mixtures(e, ks):
    return _mixtures_from(e, [("vec", CU.kmeans_batch(e, "vec", "vec_id", ks, n_init=1))])[0]


@q("gmm_sweep")
def _gmm_sweep(spark, sf):
    e = FX.emb(spark, sf)
    fits = _mixtures(e, MIXTURE_K)
    scores = CU.clustering_scores(e, "vec", "label", "y", fits, CU.assign_mixture)
    rows = []
    for k, p in fits.items():
        aic, bic = CU.aic_bic(p["loglik"], k, p["means"].shape[1], p["n"])
        rows.append((k, p["loglik"], aic, bic, p["iterations"], scores[k]["homogeneity"], scores[k]["f1"], scores[k]["silhouette"]))
    return spark.createDataFrame(rows, "k int, loglik double, aic double, bic double, iterations int, "
                                       "homogeneity double, f1 double, silhouette double")


@q("cluster_eval")
def _cluster_eval(spark, sf):
    """Mode-vote metrics of a k-means and of a mixture clustering, with iterations, cost and likelihood bound."""
    e = FX.emb(spark, sf)
    km, start = CU.kmeans_batches(e, "vec_id", [("vec", [10], 10), ("vec", [10], 1)])
    km, em = km[10], _mixtures_from(e, [("vec", start)])[0][10]
    parts = []
    for name, df, extra in (
            ("kmeans", e.withColumn("cluster", argmin_dist(_lit(km["c"]), "vec")),
             {"iterations": int(km["iterations"]), "cost": float(km["cost"]), "loglik": None}),
            ("em", CU.gmm_predict(e, "vec", em), {"iterations": int(em["iterations"]), "cost": None, "loglik": float(em["loglik"])})):
        r = M.metric_report(M.cluster_mode_vote(df, "cluster", "y", "vec_id"), "y", "yhat").select(F.lit(name).alias("clusterer"), "*")
        parts.append(r.withColumn("iterations", F.lit(extra["iterations"])).withColumn("cost", F.lit(extra["cost"]).cast("double"))
                     .withColumn("loglik", F.lit(extra["loglik"]).cast("double")))
    return parts[0].unionByName(parts[1])


@q("covariance_matrix")
def _covariance_matrix(spark, sf):
    from ..operators.linalg import covariance_matrix
    c = covariance_matrix(FX.emb(spark, sf), "vec")
    return c.select("i", "j", r6(F.col("cov")).alias("cov"))


@q("pca_fit")
def _pca_fit(spark, sf):
    return PJ.pca_table(spark, PJ.pca_fit(FX.emb(spark, sf), "vec"))


@q("pca_trace")
def _pca_trace(spark, sf):
    """Totals of the fitted components: their number, the sum of ratios and of variances (the covariance's trace)."""
    t = PJ.pca_table(spark, PJ.pca_fit(FX.emb(spark, sf), "vec"))
    return t.agg(F.count(F.lit(1)).alias("components"), r6(F.sum("ratio")).alias("ratio"), r6(F.sum("variance")).alias("variance"))


def _rca(spark, sf):
    e = FX.emb(spark, sf)
    R = PJ.sparse_projection_matrix(_width(e, "vec"), RCA_K, seed=0)
    return PJ.project(e, "vec", R, out="proj")


@q("rca_project")
def _rca_project(spark, sf):
    p = _rca(spark, sf)
    return p.select("vec_id", F.posexplode("proj").alias("component", "value")).select(
        "vec_id", "component", r6(F.col("value")).alias("value"))


@q("rca_gaussian")
def _rca_gaussian(spark, sf):
    e = FX.emb(spark, sf)
    p = PJ.project(e, "vec", PJ.gaussian_projection_matrix(_width(e, "vec"), RCA_K, seed=0), out="proj")
    return p.select("vec_id", F.posexplode("proj").alias("component", "value")).select(
        "vec_id", "component", r6(F.col("value")).alias("value"))


@q("distance_correlation")
def _distance_correlation(spark, sf):
    d = NB.distance_correlation_sq(_rca(spark, sf), "vec", "proj")
    return d.select(r6(F.col("distance_correlation")).alias("distance_correlation"))


@q("distance_correlation_euclid")
def _distance_correlation_euclid(spark, sf):
    """The same on plain Euclidean distances, by random slices, with the bound of its error."""
    return SL.distance_correlation(_rca(spark, sf), "vec", "proj")


def _dims(d):
    """Sizes of a projection sweep: 2, 5, 8, ... below d - 1, and d."""
    return [*range(2, d - 1, 3), d]


@q("ica_fit")
def _ica_fit(spark, sf):
    """Kurtosis curve of the independent components over their number."""
    e = FX.emb(spark, sf)
    return PJ.kurtosis_curve(e, "vec", PJ.ica_sweep(e, "vec", _dims(_width(e, "vec")), max_iter=100))


@q("rca_sweep")
def _rca_sweep(spark, sf):
    """Distance correlation of sparse random projections: dims x 5 seeds, mean and sample deviation."""
    e = FX.emb(spark, sf)
    r = M.restart_mean_std(PJ.rca_sweep(e, "vec", _dims(_width(e, "vec")), range(5)), ["dim"], "r")
    return r.select("dim", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std"))


@q("rf_feature_select")
def _rf_feature_select(spark, sf):
    e = FX.emb(spark, sf)
    return PJ.rf_feature_select(e, "vec", "y", num_trees=500)


def _projections(spark, sf, e):
    d = _width(e, "vec")
    pca = PJ.pca_fit(e, "vec")
    ica = PJ.ica_fit(e, "vec", ICA_M, max_iter=200)
    sel = [r["feature"] for r in PJ.rf_feature_select(e, "vec", "y", num_trees=500).where("selected").collect()]
    return {
        "pca": lambda f, out: PJ.pca_project(f, "vec", pca, 8, out),
        "ica": lambda f, out: PJ.project(f, "vec", ica["unmixing"], ica["mean"], out),
        "rca": lambda f, out: PJ.project(f, "vec", PJ.sparse_projection_matrix(d, RCA_K, seed=0), out=out),
        "rfc": lambda f, out: f.withColumn(out, F.array(*[F.col("vec")[i] for i in sel])),
    }


PROJECTED_KMEANS, PROJECTED_EM = [9, 25], [24, 41]   # the cluster numbers the studied runs settled on


@q("project_then_cluster")
def _project_then_cluster(spark, sf):
    """k-means and mixtures on every projection, all projections in the same scans."""
    e = FX.emb(spark, sf).persist()
    with _released(e):
        parts = _projections(spark, sf, e)
        names = list(parts)
        wide = e
        for name in names:
            wide = parts[name](wide, name)
        wide = wide.select("vec_id", "label", "y", *names).persist()
        with _released(wide):
            got = CU.kmeans_batches(wide, "vec_id", [(n, PROJECTED_KMEANS, 10) for n in names] + [(n, PROJECTED_EM, 1) for n in names])
            km, start = got[:len(names)], got[len(names):]
            em = _mixtures_from(wide, list(zip(names, start, strict=True)))
            rows = []
            for i, name in enumerate(names):
                for kind, fits, assign in (("kmeans", km[i], CU.assign_centres), ("em", em[i], CU.assign_mixture)):
                    for k, s in CU.clustering_scores(wide, name, "label", "y", fits, assign).items():
                        rows.append((name, kind, k, s["homogeneity"], s["f1"], s["silhouette"]))
    return spark.createDataFrame(rows, "projection string, clusterer string, k int, homogeneity double, f1 double, silhouette double")


def _mlp_f1(p, vec, d):
    tr = CL.ml_frame(p.where(F.col("split") == "train"), vec, "y", ["vec_id"])
    te = CL.ml_frame(p.where(F.col("split") == "test"), vec, "y", ["vec_id"])
    _, pred, secs = CL.fit_predict(CL.mlp([d, MLP_HIDDEN, 2], max_iter=100), tr, te, ["vec_id"])
    return float(M.metric_report(pred, "label", "prediction", 1.0).first()["f1"]), secs


@q("project_then_classify")
def _project_then_classify(spark, sf):
    e = S.split_random(FX.emb(spark, sf), "vec_id", FX.TEST_PCT).persist()
    with _released(e):
        rows = [("full", *_mlp_f1(e, "vec", _width(e, "vec")))]
        for name, add in _projections(spark, sf, e).items():
            p = add(e, "p")
            rows.append((name, *_mlp_f1(p, "p", _width(p, "p"))))
    return spark.createDataFrame(rows, "projection string, f1 double, fit_seconds double")


def _cluster_features(spark, sf):
    labels, w, mu, var, n = _label_params(spark, sf)
    e = FX.emb(spark, sf)
    e = e.withColumn("km", argmin_dist(_lit(mu), "vec"))
    e = CU.gmm_predict(e, "vec", {"weights": w, "means": mu, "vars": var}, out="em")
    lv = list(range(len(labels)))
    return P.one_hot(e, ["km", "em"], level_map={"km": lv, "em": lv})


def _lit(mu):
    from ..functions.vectors import lit_matrix
    return lit_matrix(mu.tolist())


@q("add_cluster_features")
def _add_cluster_features(spark, sf):
    f = _cluster_features(spark, sf)
    return f.select("vec_id", "label", *[c for c in f.columns if c.startswith("km_") or c.startswith("em_")])


CLASSIFIED_KMEANS, CLASSIFIED_EM = 9, 24   # the cluster numbers of the studied classifier


def _fitted_cluster_features(spark, sf):
    """One-hot clusters of a k-means (best of 10 runs) and of a diagonal mixture, both fitted to the whole table."""
    e = FX.emb(spark, sf)
    km, start = CU.kmeans_batches(e, "vec_id", [("vec", [CLASSIFIED_KMEANS], 10), ("vec", [CLASSIFIED_EM], 1)])
    em = _mixtures_from(e, [("vec", start)])[0][CLASSIFIED_EM]
    e = e.withColumn("km", argmin_dist(_lit(km[CLASSIFIED_KMEANS]["c"]), "vec"))
    e = CU.gmm_predict(e, "vec", em, out="em")
    return P.one_hot(e, ["km", "em"], level_map={"km": range(CLASSIFIED_KMEANS), "em": range(CLASSIFIED_EM)})


@q("cluster_then_classify")
def _cluster_then_classify(spark, sf):
    """MLP on fitted clusters joined to the full table and to each projection."""
    f = S.split_random(_fitted_cluster_features(spark, sf), "vec_id", FX.TEST_PCT).persist()
    oh = [c for c in f.columns if c.startswith("km_") or c.startswith("em_")]
    hot = F.array(*[F.col(c).cast("double") for c in oh])
    rows = []
    with _released(f):
        frames = {"full": f.withColumn("p", F.col("vec")), **{name: add(f, "p") for name, add in _projections(spark, sf, f).items()}}
        for name, p in frames.items():
            p = p.select("vec_id", "split", "y", F.concat("p", hot).alias("vx"))
            rows.append((f"clusters+{name}", *_mlp_f1(p, "vx", _width(p, "vx"))))
    return spark.createDataFrame(rows, "features string, f1 double, fit_seconds double")


KNN_GRID = [1, 3, 5, 7, 9]


@q("grid_search_cv_knn")
def _grid_search_cv_knn(spark, sf):
    """Exact kNN variant of the grid search: stratified 5-fold CV over k."""
    e = S.kfold_assign(FX.emb(spark, sf), "vec_id", 5, label_col="y")
    r = CL.knn_grid_search_cv(e, "vec_id", "vec", "y", "fold", KNN_GRID)
    return r.select("k", r6(F.col("mean_accuracy")).alias("mean_accuracy"), "best")


KNN_CURVE = sorted({int(v) for v in _np.linspace(1, 250, 25)})   # floor(linspace(1, 250, 25))


@q("complexity_curve_knn")
def _complexity_curve_knn(spark, sf):
    """Exact kNN variant of the complexity curve: train / test F1 for each k."""
    e = FX.emb_split(spark, sf)
    r = CL.knn_complexity_curve(e.where(F.col("split") == "train"), e.where(F.col("split") == "test"),
                                "vec_id", "vec", "y", KNN_CURVE)
    return r.select("k", "split", r6(F.col("f1")).alias("f1"))


LC_FRACTIONS = [0.25, 0.5, 1.0]


@q("learning_curve_knn")
def _learning_curve_knn(spark, sf):
    """Exact kNN variant of the learning curve (k = 5, 3 stratified folds on the source rows)."""
    r = CL.knn_learning_curve(FX.emb(spark, sf), "vec_id", "vec", "y", LC_FRACTIONS, k=FX.KNN_K, folds=3)
    return r.select("train_size", *[r6(F.col(c)).alias(c) for c in
                                    ("train_f1_mean", "train_f1_std", "cv_f1_mean", "cv_f1_std")])
