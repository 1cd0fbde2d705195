"""Readers and writers: explicit schemas, FAILFAST, run-log partitions, model tables, streaming."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from vantage.session import shared_path
from vantage.sources import io as IO
from vantage.streaming import score_stream


def test_positional_csv_round_trip_and_failfast(spark):
    d = tempfile.mkdtemp(prefix="vantage-test-")
    good = os.path.join(d, "good.csv")
    with open(good, "w") as f:
        f.write("0.5,1.5,1\n2.0,3.0,0\n")
    df = IO.scan_csv_positional(spark, good, 2, assemble=True)
    assert [(list(r["features"]), r["label"]) for r in df.collect()] == [([0.5, 1.5], 1), ([2.0, 3.0], 0)]
    bad = os.path.join(d, "bad.csv")
    with open(bad, "w") as f:
        f.write("0.5,oops,1\n")
    with pytest.raises(Exception):
        IO.scan_csv_positional(spark, bad, 2).collect()


def test_runlog_append_then_dynamic_overwrite(spark):
    path = shared_path(spark, "test-runlog")
    a = spark.createDataFrame([("rhc", 10, 0.5, "2024-01-01"), ("sa", 10, 0.6, "2024-01-02")],
                              "algo string, budget int, accuracy double, run_date string")
    IO.sink_runlog(a, path, "append")
    IO.sink_runlog(a.where("algo = 'rhc'"), path, "append")
    assert IO.read_runlog(spark, path, "2024-01-01").count() == 2
    IO.sink_runlog(a.where("algo = 'rhc'"), path, "overwrite")
    assert IO.read_runlog(spark, path, "2024-01-01").count() == 1
    assert IO.read_runlog(spark, path, "2024-01-02").count() == 1   # other partition untouched


def test_model_table_round_trip(spark):
    t = IO.sink_model_table(spark, [[1.0, 2.0], [3.0, 4.0]], shared_path(spark, "test-model"), "cluster")
    assert sorted(tuple(r) for r in t.collect()) == [(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)]


def test_score_stream_applies_batch_transform(spark):
    src = shared_path(spark, "test-stream-src")
    spark.range(10).withColumn("x", F.col("id") * 2).write.parquet(src)
    stream = spark.readStream.schema("id long, x long").parquet(src)
    got = []
    q = score_stream(stream, lambda df: df.where("x > 10"), lambda df, epoch: got.extend(df.collect()),
                     shared_path(spark, "test-stream-ckpt"))
    q.awaitTermination(60)
    assert sorted(r["id"] for r in got) == [6, 7, 8, 9]
