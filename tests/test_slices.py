import numpy as np
import pytest

from vantage.operators import slices as S

SCHEMA = "x array<double>, y array<double>"


def exact(x, y):
    d = [np.linalg.norm(v[:, None, :] - v[None, :, :], axis=2).ravel() for v in (x, y)]
    return np.corrcoef(*d)[0, 1]


def data(kind, n=150, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6)) * [3, 1, 1, 0.5, 0.5, 0.2]
    if kind == "clusters":
        x += 6 * rng.integers(0, 3, (n, 1))
    if kind == "copies":
        x[: n // 3] = x[0]
    return x, x @ rng.normal(size=(6, 2)) + 0.1 * rng.normal(size=(n, 2)) * (kind != "copies")


@pytest.mark.parametrize("kind", ["normal", "clusters", "copies"])
def test_within_the_bound_of_brute_force(spark, kind):
    x, y = data(kind)
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist(), strict=True)), SCHEMA).coalesce(2)
    r = S.distance_correlation(df, "x", "y").first()
    assert r["bound"] < 0.2
    assert abs(r["distance_correlation"] - exact(x, y)) <= max(r["bound"], 0.01)


def test_parts_and_buckets_add_up_to_all_pairs(spark):
    x, y = data("clusters", 120)
    w = np.random.default_rng(2).integers(1, 4, 120)
    theta, phi = S.directions(3, 6, 0), S.directions(3, 2, 1)
    df = spark.createDataFrame([(*r, int(v)) for r, v in zip(zip(x.tolist(), y.tolist(), strict=True), w, strict=True)], SCHEMA + ", w long").coalesce(2)
    ww = np.outer(w, w)
    for parts in (1, 5):
        got = S.slice_sums(df, "x", "y", theta, phi, parts)
        for k in range(3):
            a, b = (v @ t[k] for v, t in ((x, theta), (y, phi)))
            da, db = np.abs(a[:, None] - a), np.abs(b[:, None] - b)
            assert got[k] == pytest.approx([(ww * da).sum() / 2, (ww * db).sum() / 2, (ww * da * db).sum() / 2])


def test_edges(spark):
    assert S.distance_correlation(spark.createDataFrame([], SCHEMA), "x", "y").first()["distance_correlation"] is None
    same = spark.createDataFrame([([1.0, 2.0], [3.0])] * 4 + [(None, [1.0])], SCHEMA)
    assert S.distance_correlation(same, "x", "y", slices=4).first()["distance_correlation"] is None
