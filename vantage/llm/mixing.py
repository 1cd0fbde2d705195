"""Mixing sources to target weights by cube-method balanced sampling.

Targets: sources in code point order (null last) weigh 1, 2, 3, repeating; a target above
``cap`` times its source's size is cut to that and the excess reshared by weight.  A source
whose target is r times its size takes every document floor(r) times, and one copy more
with inclusion probability r - floor(r).  The extra copies are drawn by the cube method:
within a block, three open units at a time move along the direction that keeps both the
number of documents and of words (the null space of the two constraints) until one of
them reaches 0 or 1.  A block ends with two open units at most; these meet in new blocks, level
by level, until one block a source is left, and only its last two units are rounded (landing).

A block holds about ``block_rows`` units, chosen by hash, so a hot source is many blocks and each
level shrinks the open units to about 2 / block_rows of the last.  Only ids and sizes move.

Defined results: null or empty texts have size 0; a source of size 0 has target 0 and takes
nothing; null is a source of its own, last in order; repeated rows are units each; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import ordinal
from . import textbuf as T
from .common import documents_view, n_words, stage

WEIGHTS, CAP, BLOCK_ROWS, SEED = (1, 2, 3), 3, 2048, 17


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, n_docs -> the same and target.

    Resharing: sources above their cap are fixed there, the rest share what is left by weight,
    until none is above; every round is one aggregate over the table of sources.
    """
    last = F.when(F.col("source").isNull(), 1).otherwise(0)
    ranked = ordinal(sizes.withColumn("is_null", last), ["is_null", "source"], out="rank").drop("is_null")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"))
    table = stage(ranked.withColumn("w", w).withColumn("fixed", F.col("source_size") == 0), "mix-sources")
    total = int(table.agg(F.sum("source_size")).first()[0] or 0)
    while True:
        got = table.agg(F.sum(F.when(F.col("fixed"), cap * F.col("source_size"))).alias("gone"),
                        F.sum(F.when(~F.col("fixed"), F.col("w"))).alias("w")).first()
        left, weight = total - int(got["gone"] or 0), float(got["w"] or 0.0)
        if not weight:
            break
        share = F.lit(float(left)) * F.col("w") / F.lit(weight)
        over = ~F.col("fixed") & (share > cap * F.col("source_size"))
        if table.where(over).isEmpty():
            break
        table = stage(table.withColumn("fixed", F.col("fixed") | over), "mix-sources")
    share = F.lit(float(left)) * F.col("w") / F.lit(weight or 1.0)
    target = F.when(F.col("fixed"), (cap * F.col("source_size")).cast("double")).otherwise(share)
    return table.select("source", "source_size", "n_docs", target.alias("target"))


def flight(p: np.ndarray, x: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Flight phase over one block: probabilities ``p``, word sizes ``x``, uniform draws ``u``.

    Keeps sum(p) and sum(p * x); returns probabilities of which at most two are strictly between 0 and 1.
    """
    p = p.copy()
    eps = 1e-9
    hold: list[int] = []
    for nxt in range(len(p)):
        if p[nxt] <= eps or p[nxt] >= 1 - eps:
            p[nxt] = round(p[nxt])
            continue
        hold.append(nxt)
        if len(hold) < 3:
            continue
        a, b, c = hold
        # v sums to zero, and so does v * x
        v = (x[b] - x[c], x[c] - x[a], x[a] - x[b])
        if v == (0.0, 0.0, 0.0):
            v = (1.0, -1.0, 0.0)
        up = down = np.inf
        for i, d in zip(hold, v, strict=True):
            if d > 0:
                up, down = min(up, (1 - p[i]) / d), min(down, p[i] / d)
            elif d < 0:
                up, down = min(up, p[i] / -d), min(down, (1 - p[i]) / -d)
        step = up if u[nxt] * (up + down) < down else -down
        for i, d in zip(hold, v, strict=True):
            p[i] += step * d
            if p[i] <= eps or p[i] >= 1 - eps:
                p[i] = round(p[i])
        hold = [i for i in hold if 0 < p[i] < 1]
    return p


def landing(p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Round the last open units of a source, keeping the number of documents where it is whole."""
    p = p.copy()
    open_ = np.flatnonzero((p > 0) & (p < 1))
    if len(open_) == 2 and abs(p[open_].sum() - 1) < 1e-6:  # exactly one of the two
        a, b = open_
        take = a if u[a] < p[a] else b
        p[a], p[b] = float(take == a), float(take == b)
    else:
        for i in open_:
            p[i] = float(u[i] < p[i])
    return p


def _block_step(seed: int):
    """Task function: flight over one block, and landing where the block is its source's last."""

    def run(tab):
        uid, size, p = (tab.column(c).to_numpy() for c in ("uid", "size", "p"))
        order = np.lexsort((p, size, uid))
        x = T.mix((uid[order].astype(np.uint64) + np.uint64(seed)) ^ T.mix(np.arange(len(order), dtype=np.uint64)))
        u = (x >> np.uint64(11)).astype(float) / float(1 << 53)
        out = flight(p[order], size[order].astype(float), u)
        if tab.column("ends")[0].as_py():
            out = landing(out, u)
        rows = pa.array(order)
        return pa.table({"source": tab.column("source").take(rows), "uid": tab.column("uid").take(rows),
                         "size": tab.column("size").take(rows), "p": pa.array(out)})

    return run


def draw_extra(units: DataFrame, block_rows: int = BLOCK_ROWS, seed: int = SEED) -> DataFrame:
    """One 0/1 decision (column ``extra``) for every unit (uid, source, size, p), balanced on units and words.

    ``uid`` is the unit's hash; equal units (repeated rows) are interchangeable.
    """
    spark = units.sparkSession
    schema = "source string, uid long, size long, p double"
    done: list[DataFrame] = []
    live = units
    level = 0
    while True:
        per = live.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / block_rows)).cast("long")
        per = stage(per.select(F.col("source").alias("src"), blocks.alias("blocks")), "mix-blocks")
        most = per.agg(F.max("blocks")).first()[0]
        if most is None:
            break
        last = most == 1

        block = F.pmod(F.xxhash64("uid", F.lit(level)), F.col("blocks"))
        dealt = live.join(per, F.col("source").eqNullSafe(F.col("src"))).withColumn("block", block) \
            .withColumn("ends", F.col("blocks") == 1).drop("src", "blocks")
        moved = stage(dealt.groupBy("source", "block").applyInArrow(_block_step(seed + 31 * level), schema), "mix-flight")
        done.append(moved.where("p <= 0 or p >= 1"))
        if last:
            break
        live = moved.where("p > 0 and p < 1")
        level += 1
    if not done:
        return spark.createDataFrame([], "source string, uid long, size long, extra int")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("source", "uid", "size", F.col("p").cast("int").alias("extra"))


def _numbered(rows: DataFrame, seed: int, order: str) -> DataFrame:
    """Add ``uid`` (hash of id, size and source) and ``k``, the number of a row among those with its uid."""
    rows = rows.withColumn("uid", F.xxhash64(F.lit(seed), "doc_id", "size", "source"))
    return rows.withColumn("k", F.row_number().over(Window.partitionBy("uid").orderBy(order)))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block_rows: int = BLOCK_ROWS,
                seed: int = SEED) -> DataFrame:
    """doc_id, size, source, source_size, target, copies and taken (size * copies) for every row
    (and uid, k: which of the rows with one id, size and source it is)."""
    view = documents_view(docs, id_col, text_col, source_col)
    sized = stage(view.select("doc_id", F.col(source_col).cast("string").alias("source"), n_words(F.col("text")).alias("size")), "mix-sizes")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = stage(source_targets(sums, weights, cap), "mix-targets")
    t = targets.select(F.col("source").alias("src"), "source_size", "target",
                       F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("r"))
    whole = F.floor(F.col("r") + 1e-12)
    rows = sized.join(t, F.col("source").eqNullSafe(F.col("src"))).drop("src") \
        .withColumn("base", whole.cast("int")).withColumn("p", F.greatest(F.lit(0.0), F.col("r") - whole))
    rows = _numbered(rows, seed, "doc_id")
    # empty documents add no words, whatever is drawn: they take no part
    drawn = draw_extra(rows.where("p > 0 and size > 0").select("source", "uid", "size", "p"), block_rows, seed)
    # repeated rows have one uid: their draws are dealt out by number
    nth = Window.partitionBy("uid").orderBy(F.desc("extra"))
    drawn = drawn.select("uid", "extra", F.row_number().over(nth).alias("k"))
    copies = F.col("base") + F.coalesce("extra", F.lit(0))
    return rows.join(drawn, ["uid", "k"], "left") \
        .select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"),
                (F.col("size") * copies).alias("taken"), "uid", "k")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    seed: int = SEED, **settings) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, all columns as they are."""
    mix = mix_sources(docs, id_col, text_col, source_col, seed=seed, **settings) \
        .where("copies > 0").select("uid", "k", "copies")
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"))
    return _numbered(rows, seed, "doc_id").join(mix, ["uid", "k"]) \
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
