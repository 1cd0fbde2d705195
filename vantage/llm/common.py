"""Shared small pieces: intermediate tables in the shared folder, seeded draws, word counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

WORD = "[^\\x20\\x09-\\x0D]+"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, and gives the planner
    true file sizes, so that joins broadcast only what Spark's own size check allows.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES`` (Spark's default is 64 MB): a task holds a batch on both sides of the
    pipe, some of it twice, and long texts would fill that default."""
    if int(spark.conf.get(_BATCH, "67108864b").rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def documents_view(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """``doc_id, text`` (null text: empty) plus named columns; all other columns are left behind."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       *[F.col(c) for c in more])


def unit(*cols) -> Column:
    """Uniform draw in [0, 1) fixed by the given columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def n_words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` (null: 0)."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x")
    return F.length(F.translate(marks, " \t\n\x0b\f\r", "")).cast("long")
