"""Session helpers: scale sizing, shared checkpoint folder."""

from vantage.session import checkpoint_root, drop_shared, shared_path, tune_for_scale


def test_tune_for_scale_sizes_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        s = tune_for_scale(spark, 100 * 2 ** 40, executor_cores=8000)
        assert s["spark.sql.shuffle.partitions"] == str(100 * 2 ** 40 // (256 << 20))
        s = tune_for_scale(spark, 1 << 20, executor_cores=8)
        assert s["spark.sql.shuffle.partitions"] == "16"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_shared_paths_live_under_the_checkpoint_root(spark):
    root = checkpoint_root(spark)
    a, b = shared_path(spark, "x"), shared_path(spark, "x")
    assert a.startswith(root.rstrip("/")) and a != b


def test_dropped_folders_are_gone(spark):
    path = shared_path(spark, "drop")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    assert drop_shared(spark) >= 1 and drop_shared(spark) == 0
    import os
    assert not os.path.exists(path.removeprefix("file:"))


def test_a_cluster_needs_a_shared_folder():
    import pytest

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        checkpoint_root(Session())
