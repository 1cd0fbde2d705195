import numpy as np
from pyspark.sql import functions as F

from vantage.plans import queries as Q


def _blobs(spark, path, blobs, each=12):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(blobs, 4)) * 10
    rows = [(i, [float(v) for v in centres[i % blobs] + rng.normal(size=4) * 0.05], int(rng.integers(2)) * 7) for i in range(blobs * each)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")


def _features(spark, path, monkeypatch):
    """The feature rows that the classifier of ``cluster_then_classify`` is given (no projections)."""
    seen = []

    def keep(p, vec, d):
        seen.append((d, {r["vec_id"]: r[vec] for r in p.select("vec_id", F.col(vec)).collect()}))
        return 0.0, 0.0

    monkeypatch.setattr(Q, "_mlp_f1", keep)
    monkeypatch.setattr(Q, "_projections", lambda spark, sf, e: {})
    assert [r["features"] for r in Q.REGISTRY["cluster_then_classify"](spark, str(path)).collect()] == ["clusters+full"]
    return seen[0]


def test_classifier_is_given_fitted_clusters(spark, tmp_path, monkeypatch):
    _blobs(spark, tmp_path, 9)
    width, rows = _features(spark, tmp_path, monkeypatch)
    assert width == 4 + 9 + 24
    hot = {i: (tuple(v[4:13]), tuple(v[13:])) for i, v in rows.items()}
    assert all(sum(a) == 1 and sum(b) == 1 for a, b in hot.values())
    # clusters follow the vectors, whatever the labels say: one cluster a blob, none shared
    assert len({(i % 9, km) for i, (km, _) in hot.items()}) == len({km for km, _ in hot.values()}) == 9
    assert len({(em, i % 9) for i, (_, em) in hot.items()}) == len({em for _, em in hot.values()}) <= 24


def test_fewer_different_vectors_than_components(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, [float(i % 3), 1.0], i % 2) for i in range(30)], "vec_id long, embedding array<float>, label int") \
        .write.parquet(f"{tmp_path}/embeddings.parquet")
    width, rows = _features(spark, tmp_path, monkeypatch)
    assert width == 2 + 9 + 24 and len(rows) == 30
    assert all(len({tuple(v) for j, v in rows.items() if j % 3 == i}) == 1 for i in range(3))
    assert len({tuple(v[2:11]) for v in rows.values()}) == 3
