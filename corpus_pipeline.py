"""Corpus pipeline: quality rules, near-duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents.  ``run`` writes every stage's rows to the shared folder and reads them
again, so a lost executor costs at most one stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.llm.common import stage
from vantage.llm.mixing import mixed_documents
from vantage.llm.neardup import THRESHOLD, one_of_each_group
from vantage.llm.packing import pack
from vantage.llm.pii import redact
from vantage.llm.quality import quality_filter
from vantage.session import table

#: Documents whose sets of five-word shingles are this alike (per cent) are near copies for the pipeline;
#: the query of the near-duplicate operator has its own, higher threshold.
NEAR = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the isolation forest reject go."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str, threshold: int = THRESHOLD) -> DataFrame:
    """One document of each group of near-duplicates stays; rows are judged by id and text."""
    return one_of_each_group(docs, threshold=threshold)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The stage that runs: near_dedup from the pipeline's similarity on."""
    return near_dedup(spark, docs, sf_dir, NEAR)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; the length column follows."""
    out = redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return pack(docs)


STAGES = [("quality", quality), ("near_dedup", near_copies), ("pii", pii), ("mix", mix), ("packing", packing)]

#: SQL can express neither the forest, nor the classifier, nor the cube method: the stages are tested
#: against brute-force versions of their rules in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
