import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from vantage.operators import boosting as B
from vantage.operators import clustering as CU
from vantage.operators import sequences as SQ
from vantage.operators import trees as T

SCHEMA = "id long, vec array<double>, y int, split string"


def frame(spark, n=240):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        x = [rng.gauss(0, 1) for _ in range(3)]
        rows.append((i, x, int(x[0] * x[0] + x[1] > 0.8), "test" if i % 5 == 0 else "train"))
    return spark.createDataFrame(rows, SCHEMA).coalesce(2), rows


@pytest.mark.parametrize("depth", [1, 2])
def test_boosters_match_a_plain_loop(spark, depth):
    df, rows = frame(spark)
    borders = T.quantile_borders(df, "vec")
    x = np.array([r[1] for r in rows])
    y, train = np.array([r[2] for r in rows], float), np.array([r[3] == "train" for r in rows])
    got = {(r["rounds"], r["split"]): r["accuracy"] for r in
           B.boosting_curve(df, "vec", "y", "split", [1, 4], [0.3], max_depth=depth, min_leaf=5).collect()}
    p0 = y[train].mean()
    margin = np.full(len(y), np.log(p0 / (1 - p0)))

    def grow(use, g, h, left):
        """Leaf value of every row of ``use``, splitting at most ``left`` levels."""
        out = np.full(len(y), np.nan)
        best = (0.0, None)
        for f, edges in enumerate(borders if left else ()):
            for b, e in enumerate(edges):
                go = x[:, f] <= e
                a, c = use & train & go, use & train & ~go
                if a.sum() >= 5 and c.sum() >= 5:
                    t = use & train
                    gain = round(g[a].sum() ** 2 / a.sum() + g[c].sum() ** 2 / c.sum() - g[t].sum() ** 2 / t.sum(), 9)
                    if gain > best[0]:
                        best = (gain, go)
        if best[1] is None:
            t = use & train
            out[use] = g[t].sum() / h[t].sum()
            return out
        for side in (use & best[1], use & ~best[1]):
            out = np.where(side, grow(side, g, h, left - 1), out)
        return out

    for done in range(1, 5):
        p = 1 / (1 + np.exp(-margin))
        margin = margin + 0.3 * grow(np.ones(len(y), bool), y - p, p * (1 - p), depth)
        if done in (1, 4):
            for name, at in (("train", train), ("test", ~train)):
                assert got[done, name] == pytest.approx(np.mean((margin[at] > 0) == (y[at] == 1)))


def test_curve_is_as_good_as_the_engine(spark):
    df, _ = frame(spark, 400)
    ours = [r["accuracy"] for r in B.boosting_curve(df, "vec", "y", "split", [25], [0.3], max_depth=2).where("split = 'test'").collect()][0]
    ml = df.select(array_to_vector("vec").alias("features"), F.col("y").cast("double").alias("label"), "split")
    model = GBTClassifier(maxIter=25, maxDepth=2, stepSize=0.3, seed=1).fit(ml.where("split = 'train'"))
    engine = model.transform(ml.where("split = 'test'")).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert ours >= engine - 0.05
    assert B.boosting_curve(df.limit(0), "vec", "y", "split", [2], [0.1]).count() == 0


def test_seeds_cost_no_more_than_the_engine(spark):
    rng = random.Random(2)
    centres = [[rng.uniform(-20, 20) for _ in range(4)] for _ in range(12)]
    rows = [(i, [c + rng.gauss(0, 1) for c in centres[i % 12 if i % 3 else 0]]) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, vec array<double>").coalesce(2).persist()
    ours = CU.kmeans_batch(df, "vec", "id", [12], n_init=3)[12]["cost"]
    ml = df.select(array_to_vector("vec").alias("features"))
    engine = min(KMeans(k=12, seed=s, maxIter=100).fit(ml).summary.trainingCost for s in range(3))
    assert ours <= 1.02 * engine
    few = spark.createDataFrame([(i, [float(i % 2)]) for i in range(9)] + [(10, None)], "id long, vec array<double>")
    assert CU.kmeans_batch(few, "vec", "id", [2, 5], n_init=2)[2]["cost"] == 0.0
    assert CU.kmeans_batch(few.limit(0), "vec", "id", [2], n_init=2) == {}


def test_joint_counts_of_many_levels_and_nulls(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(200), rng.randrange(3)) for _ in range(500)]
    got = {tuple(r) for r in SQ.joint_counts(spark.createDataFrame(rows, "p string, q int, r int").repartition(3), ["p", "q", "r"]).collect()}
    want = {}
    for r in rows:
        for (i, a), (j, b) in (((0, "p"), (1, "q")), ((0, "p"), (2, "r")), ((1, "q"), (2, "r"))):
            key = (a, b, None if r[i] is None else str(r[i]), str(r[j]))
            want[key] = want.get(key, 0) + 1
    assert got == {(*k, float(v)) for k, v in want.items()}
