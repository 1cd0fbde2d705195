"""Quality rules: an isolation forest over per-document rule statistics.

Plan: one scan of the texts computes the statistics (Arrow batches, numpy; a few
numbers per document are written), every tree of the forest draws its rows from
all of them (the method's subsample of 256 a tree), the threshold is calibrated on all labelled rows (their
distinct scores, sorted by range partitions with carried counts), and a second pass over
the small statistics table scores every document.  No row is ever shuffled on a
text or on a source, so hot sources cannot skew anything.

Defined results: null or empty text counts as no words (fails the base rule);
repeated rows are judged row by row; an empty table gives an empty result; extra
columns are ignored; null ids are kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import textbuf as T
from .common import documents_view, stage

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_chars", "n_upper", "n_digits", "n_lines", "n_marks"]
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
DIGIT = np.zeros(256, bool)
DIGIT[0x30:0x3A] = True
MARKS = np.zeros(256, bool)
MARKS[list(b"!?")] = True

# trees of the forest and rows of each, as the method defines them
TREES, SUBSAMPLE = 100, 256
GOOD_KEPT = 0.995


def _per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    run = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=run[1:])
    return run[offsets[1:]] - run[offsets[:-1]]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every key: whether it occurs twice or more, and whether it occurred before."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = np.zeros(len(k), bool)
    same[1:] = k[1:] == k[:-1]
    later = np.zeros(len(k), bool)
    later[order] = same
    multi = same.copy()
    multi[:-1] |= same[1:]
    out = np.zeros(len(k), bool)
    out[order] = multi
    return out, later


def chunk_stats(c: T.Chunk) -> dict[str, np.ndarray]:
    """Rule statistics of every document of a chunk."""
    w = T.words(c)
    ws = T.WS[c.buf]
    lead = (c.buf & 0xC0) != 0x80  # first byte of a code point
    doc = w.doc()
    # lines: after every newline and at every document start
    cuts = np.unique(np.concatenate([c.offsets[:-1], np.flatnonzero(c.buf == 10) + 1]))
    cuts = cuts[cuts < len(c.buf)] if len(c.buf) else cuts[:0]
    ends = np.append(cuts[1:], len(c.buf)) if len(cuts) else cuts
    stops = np.where((ends > 0) & (c.buf[np.maximum(ends - 1, 0)] == 10), ends - 1, ends) if len(cuts) else ends
    n = c.n
    dup = np.zeros(n, np.int64)
    lines = np.zeros(n, np.int64)
    if len(cuts):
        has_word = np.searchsorted(w.start, stops) > np.searchsorted(w.start, cuts)
        of = np.searchsorted(c.offsets, cuts, side="right") - 1
        h = T.span_hash(T.prefix(c.buf), cuts, np.maximum(stops, cuts))
        at = np.flatnonzero(has_word)
        lines = np.bincount(of[at], minlength=n)
        _, later = _repeated(h[at] ^ T.mix(of[at].astype(np.uint64) + np.uint64(1)))
        dup = np.bincount(of[at[later]], minlength=n)
    rep = np.zeros(n, np.int64)
    g, at = T.grams(w, 3)
    if len(at):
        multi, _ = _repeated(g ^ T.mix(doc[at].astype(np.uint64) + np.uint64(1)))
        cover = np.zeros(len(w.hash) + 3, bool)
        for k in range(3):
            cover[at[multi] + k] = True
        rep = np.bincount(doc[cover[:len(doc)]], minlength=n)
    return {"n_words": w.counts, "word_chars": _per_doc(~ws & lead, c.offsets),
            "n_symbols": _per_doc(SYMBOL[c.buf], c.offsets), "n_dup_lines": dup, "n_repeat_words": rep,
            "n_chars": _per_doc(lead, c.offsets), "n_upper": _per_doc(UPPER[c.buf], c.offsets),
            "n_digits": _per_doc(DIGIT[c.buf], c.offsets), "n_lines": lines,
            "n_marks": _per_doc(MARKS[c.buf], c.offsets)}


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *carry: str) -> DataFrame:
    """One row per document: id, carried columns and the rule statistics (longs)."""
    view = documents_view(docs, id_col, text_col, *carry)
    keep = [f for f in view.schema.fields if f.name != "text"]
    names = [f.name for f in keep]

    def run(batches):
        for b in batches:
            for c in T.chunks(b.column("text")):
                s = chunk_stats(c)
                cols = [b.column(name).slice(c.first_row, c.n) for name in names]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(s[k].astype(np.int64)) for k in STATS + EXTRA],
                                                 names=names + STATS + EXTRA)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + [f"{k} long" for k in STATS + EXTRA])
    return view.mapInArrow(run, schema)


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """Scale-free rule statistics: shares of symbols, repeats, capitals, digits; lengths in logs."""
    w = np.maximum(s["n_words"], 1).astype(float)
    ch = np.maximum(s["n_chars"], 1).astype(float)
    return np.stack([
        s["word_chars"] / w, s["n_symbols"] / ch, s["n_symbols"] / w, s["n_dup_lines"] / np.maximum(s["n_lines"], 1),
        s["n_repeat_words"] / w, s["n_upper"] / ch, s["n_digits"] / ch,
        s["n_marks"] / w, np.log1p(s["n_words"]) / 4.0,
    ], axis=1)


def fit_forest(x: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 7) -> dict[str, np.ndarray]:
    """Isolation forest as flat arrays: split feature, cut, children, and path length at leaves."""
    rng = np.random.default_rng(seed)
    m = min(subsample, len(x))
    return grow_forest([x[rng.choice(len(x), m, replace=False)] for _ in range(trees)], m, seed)


def grow_forest(draws: list[np.ndarray], m: int, seed: int = 7) -> dict[str, np.ndarray]:
    """One isolation tree on each draw of ``m`` rows."""
    rng = np.random.default_rng(seed)
    depth = max(1, int(np.ceil(np.log2(max(m, 2)))))

    def c(n):  # mean path length of an unsuccessful search among n rows
        return 0.0 if n <= 1 else 2.0 * (np.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n if n > 2 else 1.0

    feat, cut, left, length, roots = [], [], [], [], []

    def grow(rows, d):
        at = len(feat)
        feat.append(-1), cut.append(0.0), left.append(0), length.append(d + c(len(rows)))
        lo, hi = rows.min(axis=0), rows.max(axis=0)
        live = np.flatnonzero(hi > lo)
        if d < depth and len(rows) > 1 and len(live):
            f = int(rng.choice(live))
            v = float(rng.uniform(lo[f], hi[f]))
            side = rows[:, f] < v
            feat[at], cut[at] = f, v
            a = grow(rows[side], d + 1) if side.any() else None
            b = grow(rows[~side], d + 1) if (~side).any() else None
            if a is None or b is None:  # a cut at the very edge: keep the node as a leaf
                feat[at] = -1
            else:
                left[at] = (a, b)
        return at

    for x in draws:
        roots.append(grow(x, 0))
    kids = np.array([v if isinstance(v, tuple) else (0, 0) for v in left], dtype=np.int32)
    return {"feat": np.array(feat, np.int32), "cut": np.array(cut), "kids": kids, "length": np.array(length),
            "roots": np.array(roots, np.int32), "norm": np.array(max(c(m), 1e-9)), "depth": np.array(depth)}


def forest_score(forest: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Anomaly score in (0, 1]: 2 ** (-mean path length / expected)."""
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for root in forest["roots"]:
        node = np.full(len(x), root, np.int32)
        for _ in range(int(forest["depth"])):
            f = forest["feat"][node]
            live = f >= 0
            right = x[rows, np.maximum(f, 0)] >= forest["cut"][node]
            node = np.where(live, forest["kids"][node, right.astype(np.int8)], node)
        total += forest["length"][node]
    return 2.0 ** (-total / len(forest["roots"]) / float(forest["norm"]))


def calibrate(score: np.ndarray, good: np.ndarray, good_kept: float = GOOD_KEPT) -> float:
    """Score above which a document is rejected: the cut that catches most rows labelled bad
    while at least ``good_kept`` of the good ones stay.  Without both kinds of label: 0.75."""
    if not good.any() or good.all():
        return 0.75
    floor = float(np.quantile(score[good], good_kept))
    cuts = np.unique(np.concatenate([[floor], score[score >= floor]]))
    s_good, s_bad = np.sort(score[good]), np.sort(score[~good])
    caught = 1 - np.searchsorted(s_bad, cuts, side="right") / len(s_bad)
    lost = 1 - np.searchsorted(s_good, cuts, side="right") / len(s_good)
    return float(cuts[np.argmax(caught - lost)])


@dataclass
class Rules:
    """Fitted forest and threshold; without a forest (no rows to fit) only the base rules judge."""

    forest: dict[str, np.ndarray] | None
    threshold: float = 0.75

    def score(self, s: dict[str, np.ndarray]) -> np.ndarray:
        return forest_score(self.forest, features(s)) if self.forest is not None else np.zeros(len(s["n_words"]))


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    """Too short, or too many words in repeated three-word windows."""
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def tree_draws(stats: DataFrame, trees: int = TREES, subsample: int = SUBSAMPLE) -> list[np.ndarray]:
    """Features of every tree's rows: the ``subsample`` rows of the whole table with the smallest hashes of its own."""
    cols = STATS + EXTRA
    n = stats.count()
    if not n:
        return []
    m = min(subsample, n)
    for share in (min(1.0, 4 * m / n), 1.0):  # rows far from every tree's smallest hashes stay out of the sort
        each = stats.select(*cols, F.xxhash64("doc_id", *cols).alias("_h")).select(
            "*", F.inline(F.array(*[F.struct(F.lit(t).alias("tree"), F.xxhash64(F.lit(t), F.col("_h")).alias("u")) for t in range(trees)])))
        near = each.where(F.col("u") < F.lit(int(share * 2.0 ** 64) - 2 ** 63)) if share < 1.0 else each
        w = Window.partitionBy("tree").orderBy("u", *cols)
        got = near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= m).toArrow()
        if got.num_rows == m * trees:
            break
    order = np.lexsort((got.column("rank").to_numpy(), got.column("tree").to_numpy()))
    x = features({k: got.column(k).to_numpy()[order] for k in cols})
    return [x[i:i + m] for i in range(0, len(x), m)]


def calibrate_rows(scored: DataFrame, good_kept: float = GOOD_KEPT) -> float:
    """:func:`calibrate` over all rows ``(score, good)``, distributed: distinct scores in range partitions, counts carried."""
    per = scored.groupBy("score").agg(F.sum(F.col("good").cast("long")).alias("g"), F.sum((~F.col("good")).cast("long")).alias("b"))
    table = cut_lineage(per.repartitionByRange("score").sortWithinPartitions("score")).withColumn("part", F.spark_partition_id())
    sums = sorted(tuple(r) for r in table.groupBy("part").agg(F.sum("g"), F.sum("b")).collect())
    n_good, n_bad = sum(r[1] for r in sums), sum(r[2] for r in sums)
    if not n_good or not n_bad:
        return 0.75
    before, at = {}, (0, 0)
    for part, g, b in sums:
        before[part] = at
        at = (at[0] + g, at[1] + b)
    place = (n_good - 1) * good_kept
    ranks = (int(np.floor(place)), int(np.ceil(place)))

    def columns(batches):
        carried = None
        for t in batches:
            if t.num_rows:
                score, g, b, part = (t.column(k).to_numpy() for k in ("score", "g", "b", "part"))
                carried = carried or before[int(part[0])]
                g, b = carried[0] + np.cumsum(g), carried[1] + np.cumsum(b)
                carried = (int(g[-1]), int(b[-1]))
                yield score, g, b, t.column("g").to_numpy()

    def order_statistics(batches):
        for score, g, _, own in columns(batches):
            for r in ranks:
                hit = np.flatnonzero((g > r) & (g - own <= r))
                if len(hit):
                    yield pa.RecordBatch.from_pydict({"rank": [r], "score": [float(score[hit[0]])]})

    at_rank = dict(tuple(r) for r in table.mapInArrow(order_statistics, "rank long, score double").collect())
    floor = float(np.quantile([at_rank[r] for r in ranks], place - ranks[0])) if ranks[0] < ranks[1] else at_rank[ranks[0]]

    def best(batches):
        for score, g, b, own in columns(batches):
            # the floor itself is judged by the counts of the last score up to it
            use = np.flatnonzero(score >= floor)
            below = np.flatnonzero(score <= floor)[-1:]
            gain = (1 - b / n_bad) - (1 - g / n_good)
            if len(use):
                i = use[int(np.argmax(gain[use]))]
                yield pa.RecordBatch.from_pydict({"cut": [float(score[i])], "gain": [float(gain[i])], "under": [False]})
            if len(below):
                yield pa.RecordBatch.from_pydict({"cut": [float(score[below[0]])], "gain": [float(gain[below[0]])], "under": [True]})

    found = table.mapInArrow(best, "cut double, gain double, under boolean")
    row = found.where("under").agg(F.max_by("gain", "cut")).first()[0]
    cuts = found.where("not under").agg(F.max(F.struct("gain", (-F.col("cut")).alias("c")))).first()[0]
    options = [(row, -floor)] + ([(cuts["gain"], cuts["c"])] if cuts else [])
    return -max(options)[1]


def fit_rules(stats: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", trees: int = TREES, subsample: int = SUBSAMPLE) -> Rules:
    """Forest from draws over all rows of statistics, threshold from all labelled rows (id, quality 0/1)."""
    cols = STATS + EXTRA
    draws = tree_draws(stats, trees, subsample)
    if not draws:
        return Rules(None)
    rules = Rules(grow_forest(draws, len(draws[0])))
    if labels is not None:
        lab = labels.select(F.col(id_col).alias("lid"), F.col("quality").alias("q")).where("q is not null and lid is not null") \
            .groupBy("lid").agg(F.min("q").alias("q"))
        known = stats.join(lab, F.col("doc_id") == F.col("lid")).select(*cols, F.col("q") > 0)

        def scored(batches):
            for b in batches:
                s = {k: b.column(k).to_numpy(zero_copy_only=False) for k in cols}
                passed = pa.array(~base_failed(s))  # the threshold only has to judge what the base rules leave
                yield pa.RecordBatch.from_arrays([pa.array(rules.score(s)), b.column(len(cols))], names=["score", "good"]).filter(passed)

        rules.threshold = calibrate_rows(known.mapInArrow(scored, "score double, good boolean"))
    return rules


def quality_rules(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                  **bounds: int) -> DataFrame:
    """Statistics, ``base_failed``, ``score``, ``threshold`` and ``kept`` for every document.

    ``bounds`` are those of :func:`fit_rules`; statistics and scores cover every document.
    """
    stats = stage(rule_statistics(docs, id_col, text_col), "quality-stats")
    rules = fit_rules(stats, labels, id_col, **bounds)
    cols = STATS + EXTRA

    def judge(batches):
        for b in batches:
            s = {k: b.column(k).to_numpy(zero_copy_only=False) for k in cols}
            score, failed = rules.score(s), base_failed(s)
            yield pa.RecordBatch.from_arrays(
                b.columns + [pa.array(failed), pa.array(score), pa.array(~failed & (score <= rules.threshold))],
                names=b.schema.names + ["base_failed", "score", "kept"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema.fields) + ", base_failed boolean, score double, kept boolean"
    return stats.mapInArrow(judge, schema).drop(*EXTRA).withColumn("threshold", F.lit(rules.threshold))


def quality_filter(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                   **bounds: int) -> DataFrame:
    """``docs`` without the rejected rows, all columns as they are.

    The statistics are computed once to fit and once more to judge: two scans, no shuffle of texts.
    """
    stats = stage(rule_statistics(docs, id_col, text_col), "quality-stats")
    rules = fit_rules(stats, labels, id_col, **bounds)

    def keep(batches):
        for b in batches:
            for c in T.chunks(b.column(text_col)):
                s = {k: np.asarray(v, np.int64) for k, v in chunk_stats(c).items()}
                good = ~base_failed(s) & (rules.score(s) <= rules.threshold)
                yield b.slice(c.first_row, c.n).filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
