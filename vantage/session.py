"""Session helpers: building a local session, shared scratch folders, table loading."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_shared: list[str] = []


def build_session(cpus: int | str = "*", app: str = "vantage", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the provided session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("VANTAGE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster (``spark.checkpoint.dir``).

    Only when nothing is configured and the session is local (tests) a folder
    under the system temp directory is created and registered; on a cluster an
    unset folder is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="vantage-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root; :func:`drop_shared` removes them all."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/vantage/{name}-{uuid.uuid4().hex}"
    _shared.append(path)
    return path


def drop_shared(spark: SparkSession) -> int:
    """Delete the shared folders this process has made (call it when their results are no longer read)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _shared:
        path = jvm.org.apache.hadoop.fs.Path(_shared.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the input files (Hadoop FileSystem, works for any cluster file system)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


def tune_for_scale(spark: SparkSession, total_input_bytes: int, executor_cores: int,
                   target_partition_bytes: int = 256 << 20) -> dict:
    """Size scan splits and shuffle partitions so every task handles ~``target_partition_bytes``.

    * ``spark.sql.files.maxPartitionBytes`` = target (scan tasks of one size);
    * ``spark.sql.shuffle.partitions`` = max(2 x cores, input / target): the upper
      bound for the first shuffle; AQE coalesces smaller post-aggregation stages
      towards ``advisoryPartitionSizeInBytes`` and splits skewed join partitions.
    Returns the settings applied.
    """
    parts = max(2 * executor_cores, -(-int(total_input_bytes) // target_partition_bytes))
    settings = {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    return settings
