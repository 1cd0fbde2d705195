import random

import numpy as np
import pytest

from vantage.operators import networks as N

SCHEMA = "id long, vec array<double>, y int, split string, fold int"


def frame(spark, n=160):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        x = [rng.gauss(0, 1) for _ in range(3)]
        rows.append((i, x, int(x[0] * x[1] > 0), "test" if i % 4 == 0 else "train", i % 4))
    return spark.createDataFrame(rows, SCHEMA).coalesce(2), rows


@pytest.mark.parametrize("hidden", [(4,), (3, 5)])
def test_gradient_matches_differences(hidden):
    rng = np.random.default_rng(0)
    net = N.Network(hidden)
    net.start(3, 1)
    x, y = rng.normal(size=(20, 3)), rng.integers(0, 2, 20).astype(float)
    _, g = N.loss_and_gradient(x, y, net.w, hidden)
    for i in rng.integers(0, len(g), 12):
        e = np.zeros_like(net.w)
        e[i] = 1e-5
        diff = (N.loss_and_gradient(x, y, net.w + e, hidden)[0] - N.loss_and_gradient(x, y, net.w - e, hidden)[0]) / 2e-5
        assert g[i] == pytest.approx(diff, rel=1e-4, abs=1e-6)


def test_lock_step_equals_a_loop_of_its_own(spark):
    df, rows = frame(spark)
    nets = N.train_networks(df, "vec", "y", [N.Network((4,), 0.1, 2), N.Network((3, 2), 0.05, -1)], "fold", steps=8)
    for net in nets:
        use = [r for r in rows if r[4] != net.fold]
        x, y = np.array([r[1] for r in use]), np.array([r[2] for r in use], float)
        alone = N.Network(net.hidden, net.rate)
        alone.start(3, 100)
        for t in range(1, 9):
            loss, g = N.loss_and_gradient(x, y, alone.w, net.hidden)
            alone.step((g + N.RIDGE * alone.w) / len(y), t)
        assert np.allclose(alone.w, net.w) and len(net.losses) == 8


def test_curve_and_grid(spark):
    df, _ = frame(spark, 240)
    got = N.network_curve(df, "vec", "y", "split", [(1,), (12,)], 0.2, steps=40).collect()
    acc = {(tuple(r["hidden"]), r["split"]): r["accuracy"] for r in got}
    assert acc[(12,), "train"] > acc[(1,), "train"] and acc[(12,), "test"] > 0.8
    assert all(r["losses"][-1] < r["losses"][0] for r in got)
    grid = N.network_grid_search(df, "vec", "y", "fold", 4, [1, 6], [0.05, 0.2], steps=10).collect()
    assert len(grid) == 4 and sum(r["best"] for r in grid) == 1
    assert N.network_curve(df.limit(0), "vec", "y", "split", [(2,)], steps=2).where("accuracy > 0").count() == 0
