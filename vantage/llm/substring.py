"""Repeated passages: matching statistics over a compressed FM-index per shard.

Two equal windows of ``window`` words hold the same smallest word-gram (minimizer),
so shards are formed by that content: every run of consecutive windows with one
minimizer is a segment, and all segments of a minimizer go to one shard.  A
document is therefore streamed only against the shards that can match it, and
the work follows the input instead of documents times shards.

1. one scan lists the runs (minimizer, segment hash, place); runs whose minimizer
   stands once in the corpus are done: their windows are unique;
2. equal segments are one segment with a weight (copies never meet in a task),
   cut from the text of one holder as 48-bit word codes;
3. per shard: truncated suffix order, BWT, wavelet matrix with rank directory.  The
   segments are streamed through it by backward search, all in lock step; a match
   of weight 2 or more and at least ``window`` words long is reported as an interval;
4. intervals go back to all holders of the segment, and one pass rewrites the texts.

A minimizer with more than ``hot`` different segments (a very common line) is split
further: its windows are sent one by one, to shards by the hash of the window.

Defined results: null or empty texts have no words; windows never span two
documents; repeated rows count as occurrences of each other; documents shorter than
the window stay whole; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbuf as T
from .common import documents_view, stage

WINDOW, GRAM, PIECE = 35, 8, 256
SHARD_WORDS, HOT = 1 << 19, 4096
ORDER = 64  # suffixes are sorted by their first ORDER words, so matches up to ORDER - 1 words are exact
CODE = 6    # bytes a word takes in a shard


# ------------------------------------------------------------------ runs of windows

def window_runs(w: T.Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of consecutive windows of one document with one minimizer, at most PIECE windows each.

    Returns (minimizer, first word, number of words, document, places) of each run; places is 2 where the
    minimizer stands twice or more in the run, so that the run may repeat a window by itself.
    """
    none = np.zeros(0, np.int64)
    g, at = T.grams(w, gram)
    last = np.repeat(w.first[1:], w.counts)
    win = np.flatnonzero(np.arange(len(w.hash)) + window <= last)
    if not len(win):
        return none.astype(np.uint64), none, none, none, none
    m = np.full(len(w.hash), np.iinfo(np.uint64).max, np.uint64)
    m[at] = g
    grams = m.copy()
    n, span = window - gram + 1, 1
    while 2 * span <= n:
        m[:-span] = np.minimum(m[:-span], m[span:])
        span *= 2
    if n > span:
        m[:len(m) - (n - span)] = np.minimum(m[:len(m) - (n - span)], m[n - span:])
    m = m[win]
    new = np.ones(len(win), bool)
    new[1:] = (m[1:] != m[:-1]) | (win[1:] != win[:-1] + 1)
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(win)))
    parts = -(-size // PIECE)
    if (parts > 1).any():
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(start, parts) + nth * PIECE
        size = np.minimum(np.repeat(size, parts) - nth * PIECE, PIECE)
    first, value = win[start], m[start]
    reach = np.arange(window - gram + 1)
    left = (grams[first[:, None] + reach] == value[:, None]).argmax(axis=1)
    right = (grams[(first + size - 1)[:, None] + reach[::-1]] == value[:, None]).argmax(axis=1)
    places = np.where(first + left < first + size - 1 + len(reach) - 1 - right, 2, 1)
    return value, first, size + window - 1, np.searchsorted(w.first, first, side="right") - 1, places


def runs_of(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """doc_id, th (text hash), m, sh (segment hash), s (first word in the document), l (words), c (places of m)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for c in T.chunks(b.column("text")):
                w = T.words(c)
                m, first, size, doc, places = window_runs(w, window, gram)
                sh = T.span_hash(T.prefix(w.hash), first, first + size)
                rows = pa.array(doc + c.first_row)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(rows), b.column("th").take(rows), pa.array(m.view(np.int64)),
                     pa.array(sh.view(np.int64)), pa.array((first - w.first[doc]).astype(np.int32)),
                     pa.array(size.astype(np.int32)), pa.array(places.astype(np.int8))],
                    names=["doc_id", "th", "m", "sh", "s", "l", "c"])

    return docs.mapInArrow(run, f"doc_id {id_type}, th long, m long, sh long, s int, l int, c byte")


def _codes(h: np.ndarray) -> np.ndarray:
    """48-bit word codes (never 0) as rows of CODE bytes."""
    v = (h >> np.uint64(16)) | np.uint64(1) << np.uint64(47)
    return v.view(np.uint8).reshape(-1, 8)[:, :CODE]


def cut_segments(listed: DataFrame, window: int) -> DataFrame:
    """Segments (sub, m, sh, seg, w, words) cut from the texts of their holders.

    ``listed`` has text and the runs to cut: arrays m, sh, s, l, w, hot.  A hot run is cut
    into its windows, each with ``sub`` (window hash) as second shard key and ``seg`` = its place.
    """

    def run(batches):
        for b in batches:
            for c in T.chunks(b.column("text")):
                w = T.words(c)
                codes = _codes(w.hash)
                pre = T.prefix(w.hash)
                cols = {k: [] for k in ("sub", "m", "sh", "seg", "w")}
                texts: list[bytes] = []
                for d in range(c.n):
                    runs = b.column("runs")[c.first_row + d].as_py()
                    for r in runs:
                        a = int(w.first[d]) + r["s"]
                        if r["hot"]:
                            at = np.arange(a, a + r["l"] - window + 1)
                            subs = T.span_hash(pre, at, at + window).view(np.int64).tolist()
                        else:
                            at, subs = [a], [0]
                        size = window if r["hot"] else r["l"]
                        for i, (x, sub) in enumerate(zip(at, subs, strict=True)):
                            texts.append(codes[x:x + size].tobytes())
                            for k, v in (("sub", sub), ("m", r["m"]), ("sh", r["sh"]), ("seg", i), ("w", r["w"])):
                                cols[k].append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols["sub"], pa.int64()), pa.array(cols["m"], pa.int64()), pa.array(cols["sh"], pa.int64()),
                     pa.array(cols["seg"], pa.int32()), pa.array(cols["w"], pa.int64()), pa.array(texts, pa.binary())],
                    names=["sub", "m", "sh", "seg", "w", "words"])

    return listed.select("text", "runs").mapInArrow(run, "sub long, m long, sh long, seg int, w long, words binary")


# ------------------------------------------------------------------ the index of a shard

class FMIndex:
    """FM-index of integer sequences: BWT in a wavelet matrix, weights summed in suffix order."""

    def __init__(self, text: np.ndarray, weight: np.ndarray, order: int = ORDER):
        """``text``: symbols 1.., each sequence followed by 0; ``weight``: of each position's sequence."""
        n = len(text)
        self.sigma = int(text.max(initial=0)) + 1
        rank = text.astype(np.int64)
        h = 1
        while h < order:
            key = rank * (rank.max(initial=0) + 1)
            key[:n - h] += rank[h:]
            _, rank = np.unique(key, return_inverse=True)
            h *= 2
        sa = np.argsort(rank, kind="stable")
        self.weights = np.zeros(n + 1, np.int64)
        np.cumsum(weight[sa], out=self.weights[1:])
        self.first = np.zeros(self.sigma + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=self.sigma), out=self.first[1:])
        bwt = text[sa - 1]
        self.levels = max(1, int(self.sigma - 1).bit_length())
        self.bits, self.ranks, self.zeros = [], [], []
        for lev in range(self.levels - 1, -1, -1):
            bit = ((bwt >> lev) & 1).astype(bool)
            packed = np.zeros(-(-(n + 1) // 64) * 8, np.uint8)
            raw = np.packbits(bit, bitorder="little")
            packed[:len(raw)] = raw
            blocks = packed.view(np.uint64)
            directory = np.zeros(len(blocks), np.int32)
            np.cumsum(np.bitwise_count(blocks[:-1]), out=directory[1:])
            self.bits.append(blocks)
            self.ranks.append(directory)
            self.zeros.append(int(n - bit.sum()))
            bwt = np.concatenate([bwt[~bit], bwt[bit]])

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward-search step: suffix intervals of ``symbol`` followed by each pattern."""
        n = len(symbol)
        at = np.concatenate([lo, hi, np.zeros(n, np.int64)])  # the third part follows the symbol's first place
        for i in range(self.levels):
            block = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.ranks[i][block] + np.bitwise_count(self.bits[i][block] & mask)
            bit = np.tile(((symbol >> (self.levels - 1 - i)) & 1).astype(bool), 3)
            at = np.where(bit, self.zeros[i] + ones, at - ones)
        base = self.first[symbol] - at[2 * n:]
        return base + at[:n], base + at[n:2 * n]


def repeated_intervals(index: FMIndex, text: np.ndarray, start: np.ndarray, end: np.ndarray, window: int,
                       order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matching statistics of the sequences [start, end) of the indexed text: intervals (sequence, from, to)
    of at least ``window`` words that occur with weight 2 or more.

    Each sequence is read from its right end.  When [p, e) is no longer repeated, the windows ending at
    e are settled and the search goes on at the next end whose window could reach p.
    """
    seq = np.flatnonzero(end - start >= window)
    e = end[seq].copy()
    p = e.copy()
    lo = np.zeros(len(seq), np.int64)
    hi = np.full(len(seq), len(text), np.int64)
    found: list[np.ndarray] = []
    while len(seq):
        s0 = start[seq]
        nlo, nhi = index.extend(text[p - 1], lo, hi)
        alive = index.weights[nhi] - index.weights[nlo] >= 2
        p = np.where(alive, p - 1, p)
        lo, hi = np.where(alive, nlo, lo), np.where(alive, nhi, hi)
        full = alive & (e - p >= order - 1)
        stop = ~alive | full | (p == s0)
        if stop.any():
            hit = stop & (e - p >= window)
            if hit.any():
                found.append(np.stack([seq[hit], p[hit], e[hit]]))
            # where the search was broken by word p - 1, windows holding it end at p - 1 + window at most
            nxt = np.where(alive, np.where(p == s0, s0, p - 1 + window), np.minimum(e - 1, p - 1 + window))
            e = np.where(stop, nxt, e)
            p = np.where(stop, e, p)
            lo, hi = np.where(stop, 0, lo), np.where(stop, len(text), hi)
            go = e - s0 >= window
            if not go.all():
                seq, e, p, lo, hi = seq[go], e[go], p[go], lo[go], hi[go]
    if not found:
        z = np.zeros(0, np.int64)
        return z, z, z
    out = np.concatenate(found, axis=1)
    return out[0], out[1], out[2]


def shard_intervals(words: list[bytes], weight: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeated intervals (segment, from, to in its words) of the segments of one shard."""
    size = np.array([len(x) // CODE for x in words], np.int64)
    raw = np.zeros((int(size.sum()), 8), np.uint8)
    raw[:, :CODE] = np.frombuffer(b"".join(words), np.uint8).reshape(-1, CODE)
    _, symbol = np.unique(raw.view(np.uint64).ravel(), return_inverse=True)
    end = np.cumsum(size + 1) - 1
    start = end - size
    text = np.zeros(int(size.sum()) + len(size), np.int64)
    inside = np.ones(len(text), bool)
    inside[end] = False
    text[inside] = symbol + 1
    index = FMIndex(text, np.repeat(weight, size + 1))
    seq, a, b = repeated_intervals(index, text, start, end, window)
    return seq, a - start[seq], b - start[seq]


def match_segments(segments: DataFrame, window: int) -> DataFrame:
    """``m, sh, a, b``: repeated word intervals of each distinct segment (a hot one's windows merged by place)."""

    def shard(tab: pa.Table) -> pa.Table:
        seq, a, b = shard_intervals(tab.column("words").to_pylist(), tab.column("w").to_numpy(), window)
        at = tab.column("seg").to_numpy()[seq]
        rows = pa.array(seq)
        return pa.table({"m": tab.column("m").take(rows), "sh": tab.column("sh").take(rows),
                         "a": pa.array((a + at).astype(np.int32)), "b": pa.array((b + at).astype(np.int32))})

    return segments.groupBy("shard").applyInArrow(shard, "m long, sh long, a int, b int")


# ------------------------------------------------------------------ rewriting the texts

def rewrite(listed: DataFrame, with_text: bool) -> DataFrame:
    """Word counts, hash of the kept words (and the kept text) from texts and their intervals ``cuts``."""
    id_type = listed.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for c in T.chunks(b.column("text")):
                w = T.words(c)
                removed, digests, texts = np.zeros(c.n, np.int64), [], []
                raw = c.buf.tobytes()
                for d in range(c.n):
                    n = int(w.counts[d])
                    keep = np.ones(n, bool)
                    for cut in b.column("cuts")[c.first_row + d].as_py() or ():
                        keep[cut["a"]:cut["b"]] = False
                    removed[d] = n - keep.sum()
                    at = w.first[d] + np.flatnonzero(keep)
                    kept = b" ".join([raw[x:y] for x, y in zip(w.start[at].tolist(), w.end[at].tolist(), strict=True)])
                    digests.append(hashlib.sha256(kept).hexdigest())
                    texts.append(kept.decode("utf-8", "replace") if with_text else None)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(c.first_row, c.n), pa.array(w.counts.astype(np.int64)), pa.array(removed),
                     pa.array(digests)] + ([pa.array(texts, pa.string())] if with_text else []),
                    names=["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text)

    return listed.select("doc_id", "text", "cuts").mapInArrow(
        run, f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   gram: int = GRAM, shard_words: int = SHARD_WORDS, hot: int = HOT, with_text: bool = True) -> DataFrame:
    """Every document without the words of windows that also start elsewhere.

    Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space) and, if
    ``with_text``, kept_text.
    """
    view = documents_view(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    runs = stage(runs_of(view, window, gram), "fm-runs")
    common = runs.groupBy("m").agg(F.sum("c").alias("n")).where("n > 1").select("m")
    runs = stage(runs.drop("c").join(common, "m"), "fm-repeated")
    segs = stage(runs.groupBy("m", "sh").agg(F.count(F.lit(1)).alias("w"),
                                             F.min(F.struct("doc_id", "th", "s", "l")).alias("r")), "fm-segments")
    crowded = segs.groupBy("m").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("m", F.lit(True).alias("hot"))
    segs = segs.join(crowded, "m", "left").select(
        "r.doc_id", "r.th", F.struct("m", "sh", F.col("r.s").alias("s"), F.col("r.l").alias("l"), "w",
                                     F.coalesce("hot", F.lit(False)).alias("hot")).alias("run"))
    total = segs.agg(F.sum(F.when(F.col("run.hot"), (F.col("run.l") - window + 1) * window)
                           .otherwise(F.col("run.l")).cast("long"))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_words))
    listed = segs.groupBy("doc_id", "th").agg(F.collect_list("run").alias("runs"))
    listed = _with_text(view, listed, "inner")
    cut = cut_segments(listed, window).withColumn("shard", F.pmod(F.xxhash64("m", "sub"), F.lit(shards)))
    hits = match_segments(cut, window).groupBy("m", "sh").agg(F.collect_list(F.struct("a", "b")).alias("hits"))
    cuts = runs.join(hits, ["m", "sh"]).select("doc_id", "th", "s", F.explode("hits").alias("h")) \
        .groupBy("doc_id", "th").agg(F.collect_set(F.struct((F.col("s") + F.col("h.a")).alias("a"),
                                                            (F.col("s") + F.col("h.b")).alias("b"))).alias("cuts"))
    return rewrite(_with_text(view, cuts, "left"), with_text)


def _with_text(view: DataFrame, listed: DataFrame, how: str) -> DataFrame:
    """Join per-document lists to the texts; a row is known by id and text hash (a null id is a value too)."""
    right = listed.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), *[c for c in listed.columns if c not in ("doc_id", "th")])
    return view.join(right, (F.col("th") == F.col("_th")) & F.col("doc_id").eqNullSafe(F.col("_id")), how).drop("_id", "_th")
