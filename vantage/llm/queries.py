"""Queries of the llm operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def q(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


@q("op9_quality_rules")
def _quality(spark, sf):
    from .quality import quality_rules
    return quality_rules(table(spark, sf, "documents"), table(spark, sf, "labels")).drop("threshold")


@q("op10_minhash_near_dedup")
def _near(spark, sf):
    from .neardup import near_duplicates
    return near_duplicates(table(spark, sf, "documents"))


@q("op8_fm_index_dedup")
def _substring(spark, sf):
    from .substring import remove_repeats
    return remove_repeats(table(spark, sf, "documents"), with_text=False)


@q("op4_best_fit_packing")
def _pack(spark, sf):
    from .packing import pack
    return pack(table(spark, sf, "documents"))


@q("op2_cube_mixing")
def _mix(spark, sf):
    from .mixing import mix_sources
    return mix_sources(table(spark, sf, "documents")).drop("copies", "uid", "k")


@q("op6_language_id")
def _lang(spark, sf):
    from .langid import identify_language
    return identify_language(table(spark, sf, "documents"))


@q("op1_pii")
def _pii(spark, sf):
    from . import pii
    s = F.col("spans")

    def of(*kinds):
        return F.filter(s, lambda x: x["kind"].isin(*kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.BASE]
    base = pii.digest(of(*pii.BASE))
    return pii.find_pii(table(spark, sf, "documents")).select(
        "doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), pii.digest(s).alias("spans"),
        F.size(s).cast("long").alias("n_spans"))


@q("op3_hnsw_search")
def _ann(spark, sf):
    from .hnsw import nearest
    return nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@q("op7_html_text")
def _html(spark, sf):
    from .html import extract_text
    return extract_text(table(spark, sf, "pages"))


@q("op5_edit_aware_counts")
def _counts(spark, sf):
    from .tokencount import edited_counts, revision
    got = edited_counts(table(spark, sf, "documents"), revision())
    return got.withColumn("edited_sha256", F.sha2("edited_text", 256)).drop("edited_text")


@q("op13_periodic_runs")
def _runs(spark, sf):
    from .repetition import periodic_runs, planted
    docs = table(spark, sf, "documents").select("doc_id", "text")
    got = periodic_runs(docs.withColumn("text", planted(F.col("doc_id"), F.col("text"))))
    top = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws("", r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))))
    return got.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), (-top["less"]).alias("length"),
        top["period"].alias("period"), F.floor(-top["less"] * 1000 / top["period"]).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))


@q("op11_decontamination")
def _clean(spark, sf):
    from .decontaminate import decontaminate
    got = decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"), with_text=False)
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@q("op12_conversation_repair")
def _talks(spark, sf):
    from .conversation import damaged, digests, repair_conversations
    talks = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    done = repair_conversations(damaged(talks))
    out = talks.select("conv_id").distinct()
    for more in (done.report, digests(done.rows)):
        more = more.withColumnRenamed("conv_id", "_id")
        out = out.join(more, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
