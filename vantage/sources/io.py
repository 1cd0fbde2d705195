"""CSV scans with explicit schemas, CSV / parquet sinks, and the dated run log."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, infer: bool = False) -> DataFrame:
    """Header CSV with an explicit schema (inference only for exploration)."""
    r = spark.read.option("header", header).option("mode", "FAILFAST")
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def positional_schema(n_features: int, label_type: str = "int", prefix: str = "f") -> T.StructType:
    fields = [T.StructField(f"{prefix}{i}", T.DoubleType(), False) for i in range(n_features)]
    fields.append(T.StructField("label", T.IntegerType() if label_type == "int" else T.DoubleType(), False))
    return T.StructType(fields)


def scan_csv_positional(spark: SparkSession, path: str, n_features: int, assemble: bool = False) -> DataFrame:
    """Headerless numeric CSV: ``n_features`` doubles then the label; malformed rows fail the job."""
    df = scan_csv(spark, path, positional_schema(n_features), header=False)
    if assemble:
        df = df.select(F.array(*[f"f{i}" for i in range(n_features)]).alias("features"), "label")
    return df


def sink_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", header).csv(path)
    return path


def sink_runlog(df: DataFrame, path: str, mode: str = "append", date_col: str = "run_date") -> str:
    """Append (or replace) result rows under ``run_date=yyyy-MM-dd`` partitions.

    ``overwrite`` replaces only the partitions present in ``df`` (dynamic
    partition overwrite), never the whole log.
    """
    out = df if date_col in df.columns else df.withColumn(date_col, F.date_format(F.current_date(), "yyyy-MM-dd"))
    w = out.write.partitionBy(date_col)
    if mode == "overwrite":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("append")
    w.parquet(path)
    return path


def read_runlog(spark: SparkSession, path: str, run_date: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("run_date") == run_date) if run_date else df


def sink_model_table(spark: SparkSession, rows: Sequence[Sequence[float]], path: str, name: str = "component") -> DataFrame:
    """Model-sized matrix (cluster centres, component means) as a ``(component, dim, value)`` table."""
    data = [(i, j, float(v)) for i, r in enumerate(rows) for j, v in enumerate(r)]
    df = spark.createDataFrame(data, f"{name} int, dim int, value double")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
