"""Profiling: shape, null checks, ``describe``-style summaries."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordering import exact_quantiles_multi

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def profile_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def profile_nulls(df: DataFrame) -> DataFrame:
    """One pass: null count per column (long form) plus a frame-wide ``any_null`` flag."""
    row = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in df.columns])
    stacked = row.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit(0)).alias("n_null"))
                           for c in df.columns]))
    )
    return stacked.withColumn("any_null", F.max(F.col("n_null") > 0).over(Window.partitionBy()))


def profile_describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``describe(include='all')`` as a long table, one row per column.

    Categorical columns: count, unique, top (most frequent, smallest on ties), freq.
    Numeric columns: count, mean, std (sample), min, q25, q50, q75 (exact,
    linear interpolation), max.
    """
    cols = list(cols or df.columns)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    parts = []
    numeric = [c for c in cols if isinstance(types[c], _NUMERIC)]
    qs = {(r["column"], r["p"]): r["value"] for r in exact_quantiles_multi(df, numeric, [0.25, 0.5, 0.75]).collect()} \
        if numeric else {}
    if numeric:
        # every numeric statistic of every column in one scan
        stats = []
        for c in numeric:
            x = F.col(c).cast("double")
            stats.append(F.struct(
                F.lit(c).alias("column"), F.count(c).alias("count"), F.lit(None).cast("bigint").alias("unique"),
                F.lit(None).cast("string").alias("top"), F.lit(None).cast("bigint").alias("freq"),
                F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
                F.lit(qs.get((c, 0.25))).cast("double").alias("q25"), F.lit(qs.get((c, 0.5))).cast("double").alias("q50"),
                F.lit(qs.get((c, 0.75))).cast("double").alias("q75"), F.max(x).alias("max")))
        parts.append(df.agg(F.array(*stats).alias("_s")).select(F.inline("_s")))
    cats = [c for c in cols if c not in numeric]
    if cats:
        # all categorical columns in one pass: unpivot to (column, level), count, then summarise per column
        long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("_v"))
                                             for c in cats])))
        # the null level stays in the count table, so that an all-null column keeps its row
        counts = long.groupBy("column", "_v").agg(F.count(F.lit(1)).alias("n"))
        parts.append(counts.groupBy("column").agg(
            F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("count"),
            F.count("_v").cast("bigint").alias("unique"),
            # most frequent level, smallest level on ties
            F.min_by("_v", F.when(F.col("_v").isNotNull(), F.struct((-F.col("n")).alias("a"), F.col("_v").alias("b")))).alias("top"),
            F.max(F.when(F.col("_v").isNotNull(), F.col("n"))).cast("bigint").alias("freq"),
            *[F.lit(None).cast("double").alias(k) for k in ("mean", "std", "min", "q25", "q50", "q75", "max")],
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
