"""k-means steps that measure only the rows whose cluster may have changed, against plain Lloyd steps."""

import numpy as np
import pytest

from vantage.operators import clustering as CU
from vantage.operators.linalg import dealt, pack_rows, reduce_packed


def _nearest(x, c):
    return ((x[:, None].astype(np.longdouble) - c[None]) ** 2).sum(2).argmin(1)


def _plain(x, c, still, max_iter=300):
    for step in range(max_iter + 1):
        lab = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[lab == j].mean(0) if (lab == j).any() else c[j] for j in range(len(c))])
        if not (((new - c) ** 2).sum() > still and step < max_iter):
            return c, ((x - c[lab]) ** 2).sum(), step
        c = new
    raise AssertionError


@pytest.mark.parametrize("kind", ["plain", "far off", "tiny", "huge", "grid", "one centre", "same rows"])
def test_labels_and_gaps(kind):
    rng = np.random.default_rng(2)
    x, c = rng.normal(size=(400, 5)), rng.normal(size=(7, 5)) * 0.5
    if kind == "far off":
        x, c = x + 1e5, c + 1e5
    elif kind == "tiny":
        x, c = x * 1e-25, c * 1e-25
    elif kind == "huge":
        x, c = x * 1e30, c * 1e30
    elif kind == "grid":
        x, c = np.round(x), np.round(c * 2)
    elif kind == "one centre":
        c = c[:1]
    elif kind == "same rows":
        c = np.repeat(x[:2], 3, axis=0)
    mean = x.mean(0)
    rows, near = CU._Rows(x, mean), _nearest(x - mean, c - mean)
    lab, gap = CU._labels(rows, c - mean)
    some = np.sort(rng.choice(400, 90, replace=False))
    part, _ = CU._labels(rows, c - mean, some, rng.integers(len(c), size=90).astype(np.uint8))
    assert np.array_equal(lab[some], part)
    d = np.sqrt(((x[:, None].astype(np.longdouble) - c[None]) ** 2).sum(2))
    assert np.allclose((d[np.arange(400), lab]).astype(float), d.min(1).astype(float), rtol=1e-9)
    if kind not in ("grid", "same rows"):
        assert np.array_equal(lab, near)
    if len(c) > 1:
        two = np.sort(d, axis=1)[:, :2]
        assert (gap <= (two[:, 1] - two[:, 0]) + 1e-300).all()
        if kind == "plain":
            assert np.median(gap / (two[:, 1] - two[:, 0]).astype(float)) > 0.95
    else:
        assert np.isinf(gap).all()


def test_labels_do_not_depend_on_the_rows_beside():
    x = np.random.default_rng(5).integers(0, 3, size=(600, 4)).astype(float)
    c = np.array([[0, 0, 0, 0], [2, 2, 2, 2], [0, 2, 0, 2], [1, 1, 1, 1], [1, 1, 1, 1]], float) / 3
    mean = x.mean(0)
    lab, _ = CU._labels(CU._Rows(x, mean), c - mean)
    for size in (1, 7, 100):
        got = np.concatenate([CU._labels(CU._Rows(x[i:i + size], mean), c - mean)[0] for i in range(0, 600, size)])
        assert np.array_equal(lab, got)
    assert 4 not in lab   # equal centres: the first


def test_steps_match_plain_lloyd_and_measure_few_rows(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 6)) + 3.0
    df = spark.createDataFrame([(i, [float(e) for e in v]) for i, v in enumerate(x)], "vec_id long, vec array<double>")
    starts = {(k, r): x[rng.choice(3000, k, replace=False)] for k in (1, 3, 8) for r in range(2)}
    looked = []

    def traced(src, fn, length, *more):
        out = reduce_packed(src, fn, length, *more)
        if fn.__name__ == "change":
            looked.append(out[-2])
        return out

    monkeypatch.setattr(CU, "reduce_packed", traced)
    src = dealt(pack_rows(df, ["vec"]))
    src.persist()
    runs = [{"view": 0, "k": k, "c": c, "iterations": 0} for (k, _), c in starts.items()]
    CU._lloyd(src, runs, [6], [x.mean(0)], [1.0], [1e-9], 3000.0, 300)
    src.unpersist()
    for m, c in zip(runs, starts.values(), strict=True):
        want, cost, steps = _plain(x, c.copy(), 1e-9)
        assert m["iterations"] == steps
        assert np.allclose(m["c"], want, atol=1e-9) and abs(m["cost"] - cost) < 1e-6
    assert len(looked) > 10 and sum(looked) < 0.6 * len(looked) * 3000 * len(runs)


def test_blocks_of_one_split_are_dealt_to_all_tasks(spark):
    df = spark.range(40_000).selectExpr("array(cast(id as double), 1.0D) as vec").coalesce(1)
    src = dealt(pack_rows(df, ["vec"]))
    sizes = src.rdd.mapPartitions(lambda it: [sum(r["n"] for r in it)]).collect()
    assert sum(sizes) == 40_000 and len(sizes) == src._tasks and max(sizes) < 20_000
