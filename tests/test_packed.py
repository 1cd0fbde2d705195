"""Packed blocks: partial sums that do not follow the number of input splits, fits in lock step, boosted tables, kNN bounds."""

import numpy as np

from vantage.operators import boosting as BO
from vantage.operators import clustering as CU
from vantage.operators import linalg as LA
from vantage.operators import neighbors as NB
from vantage.operators import networks as NW


def _points(spark, n=600, parts=40):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 4)) + 4 * rng.integers(0, 3, (n, 1))
    rows = [(i, [float(v) for v in x[i]], [float(v) for v in x[i, :2]], int(x[i, 0] > 4), i % 5) for i in range(n)]
    return x, spark.createDataFrame(rows, "id long, vec array<double>, half array<double>, y int, fold int").repartition(parts)


def test_partials_follow_cores_not_splits(spark):
    x, df = _points(spark)
    src = LA.gathered(LA.pack_rows(df, ["vec"], ["id"]))
    assert src.rdd.getNumPartitions() <= max(spark.sparkContext.defaultParallelism, 1)
    for length in (5, 3 * LA.LONG_BLOCK):
        got = LA.reduce_packed(src, lambda m, nums, length=length: np.concatenate([m[0].sum(0), [nums[0].sum()], np.ones(length - 5)]), length, [("id", np.int64)])
        assert np.allclose(got[:5], [*x.sum(0), sum(range(len(x)))])


def test_kmeans_and_mixtures_of_several_columns_share_scans(spark):
    _, df = _points(spark)
    jobs = [("vec", [2, 3], 2), ("half", [3], 1)]
    both = CU.kmeans_batches(df, "id", jobs)
    for job, got in zip(jobs, both, strict=True):
        alone = CU.kmeans_batch(df, job[0], "id", job[1], n_init=job[2])
        assert all(np.isclose(alone[k]["cost"], got[k]["cost"]) for k in job[1])   # restarts may tie but for rounding
    em = CU.gmm_batches(df, [("vec", {3: both[0][3]["c"]}), ("half", {3: both[1][3]["c"]})])
    assert np.isclose(em[1][3]["loglik"], CU.gmm_batch(df, "half", {3: both[1][3]["c"]})[3]["loglik"])


def test_densities_by_products_match_terms():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 6)) * 100
    for var in (np.full((3, 6), 2.0), np.full((3, 6), 1e-6)):
        mu = x[:3] + 1e-3
        w = np.full(3, 1 / 3)
        want = np.stack([np.log(w[c]) - 0.5 * np.sum(np.log(var[c]) + CU.LOG2PI) - 0.5 * np.sum((x - mu[c]) ** 2 / var[c], axis=1) for c in range(3)], 1)
        assert np.allclose(CU._log_dens(x, w, mu, var), want, rtol=1e-9, atol=1e-6)


def test_networks_do_not_shuffle_by_splits(spark, monkeypatch):
    _, df = _points(spark)
    seen = []
    real = NW.reduce_packed
    monkeypatch.setattr(NW, "reduce_packed", lambda src, *a: (seen.append(src.rdd.getNumPartitions()), real(src, *a))[1])
    NW.train_networks(df, "vec", "y", [NW.Network((3,), 0.05, 1)], "fold", steps=2)
    assert len(seen) == 2 and max(seen) <= max(spark.sparkContext.defaultParallelism, 1)


def test_stumps_add_up_to_a_table():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 32, (200, 5)).astype(np.uint8)
    m = BO.Booster(0.1, 0.3)
    for _ in range(30):
        m.trees.append((np.array([rng.integers(-1, 5), -1, -1]), np.array([rng.integers(0, 31), 0, 0]), rng.normal(size=3)))
    want = 0.3 + sum(0.1 * t[2][BO._leaf(t, x)] for t in m.trees)
    assert np.allclose(m.margins(x), want) and np.allclose(m._stump_margins(x), want)


def test_group_minima_bound_the_nearest():
    rng = np.random.default_rng(2)
    q, b = rng.normal(size=(30, 8)), rng.normal(size=(4000, 8))
    b[100:140] = b[0]
    for k in (1, 5, 250):
        at, ids, dist = NB.block_topk(q, np.arange(30), b, np.arange(4000), k)
        d = np.sqrt(((q[:, None] - b[None]) ** 2).sum(2))
        want = [np.lexsort((np.arange(4000), row))[:k] for row in d]
        assert (ids.reshape(30, k) == np.array(want)).all()
        assert (NB._kth_bound(d, k) >= np.sort(d, axis=1)[:, k - 1]).all()
    assert NB._kth_bound(d, 5).shape == (30,)
