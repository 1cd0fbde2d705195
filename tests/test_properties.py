"""Property-based checks of the distributed building blocks against plain Python."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vantage.operators import neighbors as NB
from vantage.operators.ordering import exact_quantiles_multi, ordinal

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5)), min_size=1, max_size=300))
def test_ordinal_is_row_number_per_group(spark, rows):
    data = [(i, g, t) for i, (g, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, g long, t long")
    got = {r["id"]: r["o"] for r in ordinal(df, ["t", "id"], ["g"], out="o").collect()}
    want = {}
    for g in {g for _, g, _ in data}:
        members = sorted((t, i) for i, gg, t in data if gg == g)
        want.update({i: pos for pos, (_, i) in enumerate(members)})
    assert got == want


@SETTINGS
@given(st.lists(st.integers(-3, 3), min_size=1, max_size=200), st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_exact_quantiles_match_linear_interpolation(spark, xs, probs):
    df = spark.createDataFrame([(float(x), float(-x)) for x in xs], "a double, b double")
    got = {(r["column"], r["p"]): r["value"] for r in exact_quantiles_multi(df, ["a", "b"], probs).collect()}
    for col, vals in (("a", sorted(map(float, xs))), ("b", sorted(-float(x) for x in xs))):
        for p in probs:
            pos = (len(vals) - 1) * p
            lo = int(pos)
            hi = min(lo + 1, len(vals) - 1)
            assert math.isclose(got[(col, float(p))], vals[lo] + (vals[hi] - vals[lo]) * (pos - lo), abs_tol=1e-9)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), min_size=2, max_size=80), st.integers(1, 6))
def test_knn_matches_brute_force_on_duplicate_heavy_points(spark, pts, k):
    data = [(i, [float(a), float(b)]) for i, (a, b) in enumerate(pts)]
    base = spark.createDataFrame(data, "bid long, vec array<double>")
    q = base.selectExpr("bid as qid", "vec")
    got = {(r["qid"], r["rank"]): r["bid"] for r in NB.knn_join(q, base, k, least_chunk=4, q_block=2).collect()}
    for i, v in data:
        order = sorted((math.dist(v, w), j) for j, w in data)[:k]
        for rank, (_, j) in enumerate(order, start=1):
            assert got[(i, rank)] == j


@SETTINGS
@given(st.lists(st.integers(0, 10 ** 6), min_size=1, max_size=250, unique=True), st.integers(1, 400))
def test_split_ordered_and_bootstrap_sizes(spark, ids, size):
    from vantage.operators.sampling import bootstrap_sample, split_ordered
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    parts = {r["id"]: r["split"] for r in split_ordered(df, "id").collect()}
    order = sorted(ids)
    n = len(order)
    b1, b2 = int(n * 0.6 + 1e-9), int(n * (0.6 + 0.2) + 1e-9)
    want = {i: ("train" if p < b1 else "validation" if p < b2 else "test") for p, i in enumerate(order)}
    assert parts == want
    draws = bootstrap_sample(df, "id", size=size, seed=3).collect()
    assert len(draws) == size and sorted(r["draw"] for r in draws) == list(range(size))
    assert {r["id"] for r in draws} <= set(ids)
