"""Hand-made edge frames: ties, one class, constant column, k > n, empty input, hot keys."""

import math
import random

from pyspark.sql import functions as F, Window

from vantage.operators import metrics as M
from vantage.operators import neighbors as NB
from vantage.operators import prep as P
from vantage.operators import sequences as SQ
from vantage.operators import planning as PL
from vantage.operators.ordering import exact_quantiles, ordinal


def test_mode_vote_tie_goes_to_first_seen_label(spark):
    df = spark.createDataFrame([(1, 0, 1), (2, 0, 0), (3, 1, 0), (4, 1, 1)], "id long, k int, y int")
    out = {r["id"]: r["yhat"] for r in M.cluster_mode_vote(df, "k", "y", "id").collect()}
    assert out == {1: 1, 2: 1, 3: 0, 4: 0}


def test_single_class_metrics_are_zero_not_errors(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (0, 1)], "y int, yhat int")
    r = M.metric_report(df, "y", "yhat").first()
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["f1"] == 0.0
    assert math.isclose(r["accuracy"], 2 / 3)


def test_empty_frame_metrics(spark):
    df = spark.createDataFrame([], "y int, yhat int")
    r = M.metric_report(df, "y", "yhat").first()
    assert r["n"] == 0 and r["accuracy"] == 0.0
    cm = M.confusion_matrix(df, "y", "yhat").collect()
    assert len(cm) == 4 and all(x["n"] == 0 for x in cm)


def test_constant_column_scales_to_null(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id int, x double")
    assert [r["x"] for r in P.min_max_scale(df, ["x"]).collect()] == [None, None]


def test_one_hot_unseen_level_is_all_zero(spark):
    df = spark.createDataFrame([("a",), ("c",)], "c string")
    out = P.one_hot(df, ["c"], level_map={"c": ["a", "b"]}).collect()
    assert [tuple(r) for r in out] == [(1, 0), (0, 0)]


def test_knn_k_larger_than_base(spark):
    q = spark.createDataFrame([(1, [0.0, 0.0])], "qid long, vec array<double>")
    b = spark.createDataFrame([(10, [1.0, 0.0]), (11, [0.0, 2.0])], "bid long, vec array<double>")
    out = NB.knn_join(q, b, 5).orderBy("rank").collect()
    assert [r["bid"] for r in out] == [10, 11]


def test_knn_exact_vs_brute_force_with_duplicates(spark):
    rnd = random.Random(1)
    pts = [[rnd.choice([0.0, 1.0, 2.0]) + rnd.random() * 0.01 for _ in range(3)] for _ in range(150)]
    pts += [[5.0, 5.0, 5.0]] * 60  # a third of the rows on one point
    b = spark.createDataFrame([(i, p) for i, p in enumerate(pts)], "bid long, vec array<double>")
    q = b.select(F.col("bid").alias("qid"), "vec")
    got = {(r["qid"], r["bid"]) for r in NB.knn_join(q, b, 4, least_chunk=8, q_block=3).collect()}
    want = set()
    for i, p in enumerate(pts):
        d = sorted((math.dist(p, x), j) for j, x in enumerate(pts))[:4]
        want |= {(i, j) for _, j in d}
    assert got == want


def test_ordinal_hot_group_matches_row_number(spark):
    rows = [(i, 0 if i % 3 else i % 7, i * 7 % 101) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g long, t long")
    a = ordinal(df, ["t", "id"], ["g"], out="o")
    b = df.withColumn("o2", F.row_number().over(Window.partitionBy("g").orderBy("t", "id")) - 1)
    assert a.join(b, "id").where(F.col("o") != F.col("o2")).count() == 0


def test_exact_quantiles_hot_value(spark):
    vals = [1.0] * 700 + [float(i) for i in range(300)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    q = {r["p"]: r["value"] for r in exact_quantiles(df, "x", [0.1, 0.5, 0.9]).collect()}
    s = sorted(vals)

    def ref(p):
        pos = (len(s) - 1) * p
        lo = int(pos)
        hi = min(lo + 1, len(s) - 1)
        return s[lo] + (s[hi] - s[lo]) * (pos - lo)

    assert all(math.isclose(q[p], ref(p)) for p in (0.1, 0.5, 0.9))


def test_all_ones_and_all_zeros_sequences(spark):
    rows = [(1, i, 1) for i in range(5)] + [(2, i, 0) for i in range(4)]
    df = spark.createDataFrame(rows, "seq long, pos long, bit int")
    out = {r["seq"]: (r["head"], r["tail"], r["fitness"]) for r in SQ.edge_runs(df, "seq", ["pos"], "bit", 1).collect()}
    assert out[1] == (5, 0, 5) and out[2] == (0, 4, 4)
    lr = {(r["seq"], r["bit"]): r["longest"] for r in SQ.longest_run(df, "seq", ["pos"], "bit").collect()}
    assert lr == {(1, 1): 5, (2, 0): 4}


def test_one_stop_route_has_zero_length(spark):
    df = spark.createDataFrame([(1, 0, 3.0, 4.0)], "r long, o long, x double, y double")
    assert SQ.route_length(df, "r", ["o"], "x", "y").first()["length"] == 0.0


def _random_log(spark, n=400, states=7, seed=3):
    rnd = random.Random(seed)
    rows = [(i, rnd.randrange(5), f"s{rnd.randrange(states)}", rnd.randrange(3), float(rnd.randrange(10))) for i in range(n)]
    return spark.createDataFrame(rows, "t long, u long, s string, a int, r double")


def test_text_to_cells(spark):
    df = spark.createDataFrame([(2, "ab"), (1, "c"), (3, None), (4, "")], "k long, line string")
    got = {(r["x"], r["y"], r["kind"]) for r in PL.text_to_cells(df, ["k"], "line").collect()}
    assert got == {(0, 3, "c"), (0, 2, "a"), (1, 2, "b")}


def test_next_in_group_keeps_null_groups(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, 1, "c"), (4, 1, "d")], "t long, u long, v string")
    got = {(r["t"], r["n"]) for r in PL.next_in_group(df, "u", ["t"], "v", "n").collect()}
    assert got == {(1, "b"), (2, None), (3, "d"), (4, None)}


def test_estimated_transitions_are_distributions(spark):
    t = PL.estimate_transitions(_random_log(spark), "u", ["t"], "s", "a", "r", terminal=F.col("s") == "s0")
    sums = t.groupBy("s", "a").agg(F.sum("p").alias("p")).collect()
    assert sums and all(abs(r["p"] - 1) < 1e-12 and r["s"] != "s0" for r in sums)


def test_reachability_is_directed(spark):
    t = spark.createDataFrame([("a", 0, "b", 1.0, 0.0), ("b", 0, "c", 1.0, 0.0), ("d", 0, "a", 1.0, 0.0), ("c", 0, "e", 0.0, 0.0)],
                              "s string, a int, s2 string, p double, r double")
    assert {r["s"] for r in PL.reachable_states(t, "a").collect()} == {"a", "b", "c"}


def test_value_iteration_contracts(spark):
    t = PL.estimate_transitions(_random_log(spark), "u", ["t"], "s", "a", "r")
    st = PL.states_of(t)
    a, b, c = ({r["s"]: r["v"] for r in PL.value_iteration(t, st, max_iter=k, theta=0.0).collect()} for k in (1, 2, 3))
    d12 = max(abs(a[s] - b[s]) for s in a)
    d23 = max(abs(b[s] - c[s]) for s in a)
    assert d23 <= PL.GAMMA * d12 + 1e-9


def test_connected_components_match_union_find(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["label"] for r in PL.connected_components(df).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comp = {}
    for x in {n for e in edges for n in e}:
        comp.setdefault(find(x), []).append(x)
    want = {x: min(members) for members in comp.values() for x in members}
    assert got == want


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(i, None if i % 3 else i % 2, float(i)) for i in range(20)], "id long, g int, v double")
    from vantage.operators.sampling import kfold_assign
    assert kfold_assign(df, "id", 4, label_col="g").count() == 20
    assert sorted(r["p"] for r in ordinal(df, ["id"], ["g"], out="p").where("g is null").collect()) == list(range(13))
    runs = SQ.longest_run(df.withColumn("b", (F.col("v") > 4).cast("int")), "g", ["id"], "b").collect()
    assert {r["g"] for r in runs} == {None, 0, 1}
    route = {r["g"]: r["n"] for r in SQ.route_length(df, "g", ["id"], "v", "v").collect()}
    assert sum(route.values()) == 20 and None in route


def test_information_scores_with_nulls(spark):
    df = spark.createDataFrame([(None, 0), (None, 0), ("a", 1), ("a", None), ("b", None), ("b", 1)], "k string, y int")
    h = M.homogeneity(df, "k", "y").first()[0]
    assert 0 <= h <= 1
    assert all(r["gain"] >= -1e-12 for r in M.entropy_gain(df, "y", ["k"]).collect())
    assert all(r["mi"] >= -1e-12 for r in SQ.pairwise_mutual_information(df, ["k", "y"]).collect())
    same = spark.createDataFrame([(None, None), ("a", 1)], "k string, y int")
    assert abs(M.homogeneity(same, "k", "y").first()[0] - 1) < 1e-12


def test_zero_divisions_have_a_result(spark):
    same = spark.createDataFrame([(0, [1.0, 1.0]), (0, [1.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0])], "k int, vec array<double>")
    assert NB.silhouette_sq(same, "k", "vec").first()[0] == 0.0
    three = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    assert M.kurtosis_abs_mean(three, [F.col("x")]).first()[0] is None


def test_one_hot_of_null_is_zero_and_levels_are_bounded(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert sorted(tuple(r) for r in P.one_hot(df, ["c"]).collect()) == [(0,), (1,)]
    import pytest
    with pytest.raises(ValueError):
        P.levels(spark.range(50), "id", max_levels=10)


def test_missing_predictions_are_misses(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (0, None), (None, 1)], "y int, p int")
    r = M.binary_counts(df, "y", "p").first()
    assert (r["tp"], r["fp"], r["tn"], r["fn"], r["n"]) == (1, 1, 0, 1, 3)


def test_describe_keeps_an_all_null_column(spark):
    from vantage.operators.profile import profile_describe
    df = spark.createDataFrame([(None, "x", 1), (None, "x", 2)], "a string, b string, c int")
    got = {r["column"]: r for r in profile_describe(df).collect()}
    assert got["a"]["count"] == 0 and got["a"]["unique"] == 0 and got["a"]["top"] is None and got["b"]["freq"] == 2


def test_wide_averages_take_all_algorithms(spark):
    df = spark.createDataFrame([("p", 1, 2.0, 3.0), ("q", 1, 4.0, 5.0)], "algo string, budget int, mean_fitness double, mean_seconds double")
    assert M.run_average_wide(df, "budget", "algo").columns == ["budget", "p_fitness", "p_seconds", "q_fitness", "q_seconds"]


def test_bracketed_quantiles_are_exact_with_ties_and_narrow_brackets(spark):
    import numpy as np
    from vantage.operators.ordering import exact_quantiles_multi
    rng = np.random.default_rng(0)
    n = 4000
    data = {"a": rng.normal(size=n), "b": np.where(rng.random(n) < 0.4, 5.0, rng.integers(0, 50, n).astype(float)), "c": np.full(n, 2.5)}
    df = spark.createDataFrame(list(zip(*[v.tolist() for v in data.values()], strict=True)), "a double, b double, c double").repartition(4)
    for gather in (10_000, 3):
        got = {(r["column"], r["p"]): r["value"] for r in exact_quantiles_multi(df, ["a", "b", "c"], [0.0, 0.3, 0.5, 1.0], gather=gather).collect()}
        assert len(got) == 12
        assert all(abs(v - np.quantile(data[c], p)) < 1e-9 for (c, p), v in got.items())
