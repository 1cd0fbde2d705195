import random

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from vantage.operators import machines as MA

SCHEMA = "id long, vec array<double>, y int, fold int"


def frame(spark, n=240, d=4, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rng.gauss(0, 1) for _ in range(d)]
        rows.append((i, x, int(x[0] - 0.5 * x[1] + 0.3 + rng.gauss(0, 0.6) > 0), i % 4))
    return spark.createDataFrame(rows, SCHEMA).repartition(3), rows


@pytest.mark.parametrize("degree", [2, 3, 5])
def test_sketch_estimates_the_polynomial_kernel(degree):
    rng = np.random.default_rng(degree)
    x = rng.normal(size=(40, 10))
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = (0.8 * x @ x.T + 0.2) ** degree
    got = np.mean([(z := MA.tensor_sketch(x, degree, 512, 0.8, 0.2, seed)) @ z.T for seed in range(30)], axis=0)
    one = MA.tensor_sketch(x, degree, 2048, 0.8, 0.2, 99)
    assert np.abs(got - want).mean() < 0.02           # no bias
    assert np.abs(one @ one.T - want).mean() < 0.06   # one sketch


def test_sketch_is_a_product_of_count_sketches():
    x = np.random.default_rng(0).normal(size=(3, 6))
    cell, sign = MA.sketch_tables(6, 3, 16)
    want = np.zeros((3, 16))
    for i in range(6):
        for j in range(6):
            for k in range(6):
                c = (cell[0, i] + cell[1, j] + cell[2, k]) % 16
                want[:, c] += sign[0, i] * sign[1, j] * sign[2, k] * x[:, i] * x[:, j] * x[:, k]
    assert np.allclose(MA.tensor_sketch(x, 3, 16), want)


def test_squared_hinge_reaches_the_optimum(spark):
    df, rows = frame(spark)
    machines = [MA.Machine("linear", c, f) for c in (0.01, 1.0, 100.0) for f in (-1, 2)]
    MA.fit_machines(df, "vec", "y", {"linear": MA.linear_map()}, machines, "fold")
    for m in machines:
        use = [r for r in rows if r[3] != m.fold]
        z = np.hstack([np.array([r[1] for r in use]), np.ones((len(use), 1))])
        y = np.array([2 * r[2] - 1 for r in use])
        short = np.maximum(1 - y * (z @ m.w), 0)
        grad = np.append(m.w[:-1], 0) - 2 * m.c * z.T @ (short * y)
        assert np.abs(grad).max() < 1e-2 * max(1.0, m.c)
        assert m.objective == pytest.approx(0.5 * (m.w[:-1] ** 2).sum() + m.c * (short ** 2).sum(), rel=1e-6)


def test_rounded_hinge_agrees_with_the_engine(spark):
    df, _ = frame(spark, 150)
    df = df.coalesce(1).persist()
    c, n = 0.5, 150
    m = MA.Machine("linear", c)
    MA.fit_machines(df, "vec", "y", {"linear": MA.linear_map()}, [m], smooth=0.01)
    svc = LinearSVC(regParam=1.0 / (c * n), maxIter=100, tol=1e-7, standardization=False).fit(
        df.select(array_to_vector("vec").alias("features"), F.col("y").cast("double").alias("label")))
    assert np.allclose(m.w[:-1], svc.coefficients.toArray(), atol=0.03) and abs(m.w[-1] - svc.intercept) < 0.03


def test_grid_equals_machines_trained_alone(spark):
    df, rows = frame(spark, 160)
    df = df.coalesce(1)
    got = MA.rbf_grid_search(df, "vec", "y", "fold", 4, [0.01, 1.0], [0.1, 1.0], n_features=24).collect()
    assert [(r["c"], r["gamma"]) for r in got] == [(0.01, 0.1), (0.01, 1.0), (1.0, 0.1), (1.0, 1.0)]
    assert sum(r["best"] for r in got) == 1
    for r in got[1:3]:
        acc = []
        for f in range(4):
            m = MA.Machine("rbf", r["c"])
            kernel = MA.rbf_map(4, r["gamma"], 24)
            MA.fit_machines(df.where(F.col("fold") != f), "vec", "y", {"rbf": kernel}, [m])
            te = [x for x in rows if x[3] == f]
            z = np.hstack([kernel(np.array([x[1] for x in te])), np.ones((len(te), 1))])
            acc.append(np.mean((z @ m.w > 0) == np.array([x[2] == 1 for x in te])))
        assert r["mean_accuracy"] == pytest.approx(np.mean(acc), abs=0.011)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert MA.rbf_grid_search(empty, "vec", "y", "fold", 2, [1.0], [1.0]).first()["mean_accuracy"] == 0.0
    one = spark.createDataFrame([(1, [1.0, 2.0], 1, 0), (2, [3.0, 1.0], 1, 0), (3, None, 0, 0), (4, [0.0, 0.0], None, 0)], SCHEMA)
    m = MA.Machine("linear", 1.0)
    MA.fit_machines(one, "vec", "y", {"linear": MA.linear_map()}, [m])
    assert m.w[-1] > 0.9 and MA.scale_gamma(empty, "vec") == 1.0
    assert MA.tensor_sketch_map(one, "vec", 2, 8).where("sketch is null").count() == 1
