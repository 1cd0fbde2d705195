"""Derived inputs shared by the registered queries (all read the given tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import as_doubles
from ..session import table

# fixed settings of the registered queries
DOC_THRESHOLD = 1500          # n_chars above -> predicted quality 1
TEST_PCT = 20                 # hash split: bucket < 20 -> test
KNN_K = 5
# lookup-with-default fixture: event type -> iteration budget of the planning problems (default 100)
EVENT_ITERATIONS = {"view": 20, "click": 2, "purchase": 50}


def emb(spark: SparkSession, sf: str) -> DataFrame:
    """embeddings with ``vec`` (array<double>) and binary ``y`` = label < 5."""
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", as_doubles("embedding").alias("vec"), "label",
                    (F.col("label") < 5).cast("int").alias("y"))


def emb_split(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.sampling import split_random
    return split_random(emb(spark, sf), "vec_id", TEST_PCT)


def docs_truth_pred(spark: SparkSession, sf: str) -> DataFrame:
    """labels joined to documents: truth ``y`` = quality, prediction ``yhat`` = n_chars rule."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    lab = table(spark, sf, "labels")
    j = lab.join(d, "doc_id")
    return j.select("doc_id", "lang", "source", "n_chars", F.col("quality").alias("y"),
                    (F.col("n_chars") > DOC_THRESHOLD).cast("int").alias("yhat"), "toxic")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")
