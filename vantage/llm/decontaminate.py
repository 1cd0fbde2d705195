"""Benchmark decontamination: a generalised suffix automaton of normalised items, streamed over documents.

Texts are lower-cased (A-Z) and cut into words of letters, digits and characters beyond ASCII.  The items' word
sequences go into one suffix automaton; a document's words advance it, so at every word the length of the
longest match that ends there with any item is known.  A match of ``window`` words or more (or a whole item of fewer
words) is a hit; its state names the window, and through it all items that hold it.  Overlapping hits join
into spans; spans are cut from the text, and a document whose hit words exceed ``coverage`` of its words is
marked to go as a whole.

The automaton is broadcast, so its size is bounded: items go into blocks of at most ``BLOCK_WORDS`` words
(an item longer than a quarter of that is cut into pieces that overlap by ``window - 1`` words, which loses no window; its
``longest`` may then be shorter).  The blocks pass over the documents one after the other, and the rows carry
the spans and items found so far; a usual benchmark is one block and one scan.  Only stretches of words whose
neighbouring pairs all stand in some item are streamed: no match can cross a pair that stands in none.

Defined results: null and empty texts have no words and no hits; items without words, and those with a null
id or text, name nothing; an id given to several items is one item; repeated rows and null document ids are rows like all
others (every row is judged by itself); extra columns are ignored; an empty table gives an empty result, an
empty benchmark no hits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbuf as T
from .common import documents_view, stage

WINDOW, BLOCK_WORDS = 10, 100_000
SPANS = "array<struct<start:bigint,end:bigint>>"

IN_WORD = np.zeros(256, bool)  # bytes of lower-cased text
IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def normal_words(c: T.Chunk) -> T.Words:
    buf = T.LOWER[c.buf]
    start, end = T.edges(IN_WORD[buf], c.offsets)
    return T.Words(start, end, np.searchsorted(start, c.offsets), T.span_hash(T.prefix(buf), start, end))


# ------------------------------------------------------------------ the automaton

@dataclass
class Automaton:
    """Suffix automaton of one block of items over word codes (places in ``vocab``)."""

    vocab: np.ndarray             # sorted word hashes
    pairs: np.ndarray             # sorted codes of neighbouring words of items, first * len(vocab) + second
    step: dict[int, int]          # state * len(vocab) + code -> state
    link: list[int]               # the state of the longest suffix in another state
    length: list[int]             # longest string of each state
    window_of: list[int]          # the state that holds the window-long suffix (-1: shorter)
    items_of: dict[int, int]      # window state -> place in ``holders``
    shorts: list[tuple]           # (words, place in ``holders``) of whole short items that end here
    holders: list[frozenset]      # sets of items (places in ``ids``)
    ids: list
    shortest: int                 # words of the shortest window


def _insert(words: list[int], n_codes: int, step: dict, out: list, link: list, length: list) -> None:
    """Add one item's words, from the root on."""

    def state(size: int, suffix: int, codes: list) -> int:
        link.append(suffix)
        length.append(size)
        out.append(codes)
        return len(link) - 1

    def split(p: int, q: int, c: int) -> int:
        """The part of state q that ends p's strings plus c gets a state of its own."""
        new = state(length[p] + 1, link[q], list(out[q]))
        for code in out[q]:
            step[new * n_codes + code] = step[q * n_codes + code]
        while p >= 0 and step.get(p * n_codes + c) == q:
            step[p * n_codes + c] = new
            p = link[p]
        link[q] = new
        return new

    last = 0
    for c in words:
        q = step.get(last * n_codes + c)
        if q is not None:
            last = q if length[q] == length[last] + 1 else split(last, q, c)
            continue
        cur, p = state(length[last] + 1, 0, []), last
        while p >= 0 and (p * n_codes + c) not in step:
            step[p * n_codes + c] = cur
            out[p].append(c)
            p = link[p]
        if p >= 0:
            q = step[p * n_codes + c]
            link[cur] = q if length[q] == length[p] + 1 else split(p, q, c)
        last = cur


def build(items: list[tuple], window: int) -> Automaton:
    """Automaton of ``(id, word hashes, whether it is a whole item)``."""
    flat = np.concatenate([np.asarray(h, np.int64).view(np.uint64) for _, h, _ in items]) if items else np.zeros(0, np.uint64)
    vocab = np.unique(flat)
    n = max(len(vocab), 1)
    ids = sorted({i for i, _, _ in items})
    place = {i: k for k, i in enumerate(ids)}
    coded = [(place[i], np.searchsorted(vocab, np.asarray(h, np.int64).view(np.uint64)).tolist(), whole) for i, h, whole in items]
    step, out, link, length = {}, [[]], [-1], [0]
    for _, codes, _ in coded:
        _insert(codes, n, step, out, link, length)
    by_length = sorted(range(1, len(link)), key=length.__getitem__)
    window_of = [-1] * len(link)
    for v in by_length:
        if length[v] >= window:
            window_of[v] = v if length[link[v]] < window else window_of[link[v]]
    found: dict[int, set] = {}
    short_at: dict[int, dict] = {}
    for k, codes, whole in coded:
        v = 0
        for i, c in enumerate(codes):
            v = step[v * n + c]
            if i + 1 >= window:
                found.setdefault(window_of[v], set()).add(k)
        if whole and len(codes) < window:
            short_at.setdefault(v, {}).setdefault(len(codes), set()).add(k)
    known: dict[frozenset, int] = {}
    items_of = {v: known.setdefault(frozenset(s), len(known)) for v, s in found.items()}
    shorts: list[tuple] = [()] * len(link)
    for v in by_length:
        own = tuple((m, known.setdefault(frozenset(s), len(known))) for m, s in short_at.get(v, {}).items())
        shorts[v] = own + shorts[link[v]]
    pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *[np.array(c[:-1], np.int64) * n + np.array(c[1:], np.int64) for _, c, _ in coded]]))
    shortest = min((min(len(c), window) for _, c, _ in coded), default=window)
    return Automaton(vocab, pairs, step, link, length, window_of, items_of, shorts, list(known), ids, shortest)


def _member(sorted_values: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_values, x), max(len(sorted_values) - 1, 0))
    return at, (sorted_values[at] == x) if len(sorted_values) else np.zeros(len(x), bool)


def stream(auto: Automaton, w: T.Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, set], np.ndarray]:
    """Hits of a chunk as document, first word and end, the holder sets met by document, and longest matches."""
    n, n_docs = len(w.hash), len(w.first) - 1
    longest = np.zeros(n_docs, np.int64)
    code, known = _member(auto.vocab, w.hash)
    doc = w.doc()
    linked = np.zeros(n, bool)  # the word continues the stretch of the one before
    if n > 1:
        near = np.flatnonzero(known[1:] & known[:-1] & (doc[1:] == doc[:-1])) + 1
        _, is_pair = _member(auto.pairs, code[near - 1] * len(auto.vocab) + code[near])
        linked[near] = is_pair
    head = np.flatnonzero(known & ~linked)
    border = np.flatnonzero(np.append(~linked, True))
    tail = border[np.searchsorted(border, head, side="right")] if len(head) else head
    np.maximum.at(longest, doc[head], 1)
    go = tail - head >= auto.shortest
    docs_hit, starts, ends, holders = [], [], [], {}
    step, link, length, window_of, shorts = auto.step, auto.link, auto.length, auto.window_of, auto.shorts
    n_codes = len(auto.vocab)
    for a, b in zip(head[go].tolist(), tail[go].tolist(), strict=True):
        d = int(doc[a])
        v = size = top = 0
        for i, c in enumerate(code[a:b].tolist(), a + 1):
            to = step.get(v * n_codes + c)
            while to is None:
                v = link[v]
                size = length[v]
                to = step.get(v * n_codes + c)
            v = to
            size += 1
            if size > top:
                top = size
            if size >= window:
                docs_hit.append(d)
                starts.append(i - window)
                ends.append(i)
                holders.setdefault(d, set()).add(auto.items_of[window_of[v]])
            for m, h in shorts[v]:
                if m <= size:
                    docs_hit.append(d)
                    starts.append(i - m)
                    ends.append(i)
                    holders.setdefault(d, set()).add(h)
        longest[d] = max(longest[d], top)
    return np.array(docs_hit, np.int64), np.array(starts, np.int64), np.array(ends, np.int64), holders, longest


# ------------------------------------------------------------------ Spark side

def item_words(items: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> DataFrame:
    """``item_id, part, words, whole``: word hashes of items, long ones in overlapping pieces."""
    view = documents_view(items, id_col, text_col).where("doc_id is not null")
    id_type = view.schema["doc_id"].dataType.simpleString()
    most = max(block_words // 4, 2 * window)

    def run(batches):
        for b in batches:
            for c in T.chunks(b.column("text")):
                w = normal_words(c)
                row, part, lists = [], [], []
                for d in range(c.n):
                    h = w.hash[w.first[d]:w.first[d + 1]].view(np.int64)
                    for k, a in enumerate(range(0, max(len(h) - window + 1, 1), most - window + 1) if len(h) else ()):
                        row.append(d)
                        part.append(k)
                        lists.append(h[a:a + most])
                size = w.counts[row] if row else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(c.first_row, c.n).take(pa.array(row, pa.int64())), pa.array(part, pa.int32()),
                     pa.array(lists, pa.list_(pa.int64())), pa.array(size <= most)], names=["item_id", "part", "words", "whole"])

    return view.mapInArrow(run, f"item_id {id_type}, part int, words array<bigint>, whole boolean")


def item_blocks(parts: DataFrame, block_words: int) -> tuple[DataFrame, int]:
    """The parts with their block's number, and the number of blocks; no block holds more than ``block_words``."""
    total = parts.agg(F.sum(F.size("words"))).first()[0] or 0
    n = max(1, -(-2 * int(total) // block_words)) if total > block_words else 1
    while True:
        dealt = parts.withColumn("block", F.pmod(F.xxhash64("item_id", "part", "words"), F.lit(n)).cast("int"))
        most = dealt.groupBy("block").agg(F.sum(F.size("words")).alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= block_words or n > total:
            return dealt, n
        n *= 2


def _spans(cover: np.ndarray, w: T.Words) -> pa.Array:
    """Runs of covered words by document, as word numbers."""
    start, end = T.edges(cover, w.first)
    doc = np.searchsorted(w.first, start, side="right") - 1
    fields = pa.StructArray.from_arrays([pa.array(start - w.first[doc]), pa.array(end - w.first[doc])], names=["start", "end"])
    return pa.ListArray.from_arrays(np.searchsorted(start, w.first).astype(np.int32), fields)


def _clean(c: T.Chunk, w: T.Words, cover: np.ndarray) -> pa.Array:
    """Texts without their spans, each from its first word's first character to its last word's last."""
    start, end = T.edges(cover, w.first)
    cut = np.zeros(len(c.buf) + 1, np.int64)
    cut[w.start[start]] += 1
    cut[w.end[end - 1]] -= 1
    keep = np.cumsum(cut[:-1]) == 0
    size = np.zeros(len(c.buf) + 1, np.int64)
    np.cumsum(keep, out=size[1:])
    return pa.StringArray.from_buffers(c.n, pa.py_buffer(size[c.offsets].astype(np.int32)), pa.py_buffer(c.buf[keep]))


def _pass(rows: DataFrame, shared, window: int, last: bool, with_text: bool) -> DataFrame:
    """One block's automaton over all rows; the last pass gives the cleaned text instead of the text."""
    id_type, item_type = (rows.schema[x].dataType.simpleString() for x in ("doc_id", "items"))
    names = ["doc_id", "n_words", "spans", "items", "longest"]
    names += [] if last and not with_text else ["clean_text" if last else "text"]
    types = {"doc_id": id_type, "n_words": "bigint", "spans": SPANS, "items": item_type, "longest": "bigint",
             "clean_text": "string", "text": "string"}

    def run(batches):
        auto = shared.value
        for b in batches:
            for c in T.chunks(b.column("text")):
                w = normal_words(c)
                _, start, end, holders, longest = stream(auto, w, window)
                old = b.column("spans").slice(c.first_row, c.n)
                flat = old.flatten()
                base = np.repeat(w.first[:-1], np.diff(old.offsets.to_numpy()))
                edge = np.zeros(len(w.hash) + 1, np.int64)
                np.add.at(edge, np.concatenate([start, base + flat.field("start").to_numpy()]), 1)
                np.add.at(edge, np.concatenate([end, base + flat.field("end").to_numpy()]), -1)
                cover = np.cumsum(edge[:-1]) > 0
                items = b.column("items").slice(c.first_row, c.n)
                if holders:
                    lists = items.to_pylist()
                    for d, sets in holders.items():
                        got = set().union(*(auto.holders[h] for h in sets))
                        lists[d] = sorted({*lists[d], *(auto.ids[k] for k in got)})
                    items = pa.array(lists, items.type)
                before = b.column("longest").slice(c.first_row, c.n).to_numpy()
                columns = [b.column("doc_id").slice(c.first_row, c.n), pa.array(w.counts.astype(np.int64)), _spans(cover, w),
                           items, pa.array(np.maximum(before, longest))]
                if len(names) > 5:
                    columns.append(_clean(c, w, cover) if last else b.column("text").slice(c.first_row, c.n))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, ", ".join(f"{x} {types[x]}" for x in names))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, coverage: float = 0.5, block_words: int = BLOCK_WORDS,
                  with_text: bool = True) -> DataFrame:
    """``doc_id, n_words, n_hit, spans, items, longest, dropped`` (and ``clean_text``) for every row of ``docs``.

    ``spans`` are word intervals to remove, ``items`` the sorted ids whose windows occur, ``longest`` the
    longest match with any item, ``dropped`` whether more than ``coverage`` of the words are hit.
    """
    spark = docs.sparkSession
    parts = stage(item_words(items, item_id_col, item_text_col, window, block_words), "clean-items")
    item_type = parts.schema["item_id"].dataType.simpleString()
    dealt, blocks = item_blocks(parts, block_words)
    rows = documents_view(docs, id_col, text_col).select(
        "doc_id", "text", F.lit(0).cast("bigint").alias("n_words"), F.array().cast(SPANS).alias("spans"),
        F.array().cast(f"array<{item_type}>").alias("items"), F.lit(0).cast("bigint").alias("longest"))
    for k in range(blocks):
        # at most block_words words reach the driver, whatever the benchmark's size
        block = [(r["item_id"], r["words"], r["whole"]) for r in dealt.where(F.col("block") == k).collect()]
        rows = _pass(rows, spark.sparkContext.broadcast(build(block, window)), window, k == blocks - 1, with_text)
        if k < blocks - 1:
            rows = stage(rows, "clean-pass")
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    text = ["clean_text"] if with_text else []
    return rows.withColumn("n_hit", n_hit).select("doc_id", "n_words", "n_hit", "spans", "items", "longest",
                                                  (F.col("n_hit") > F.lit(coverage) * F.col("n_words")).alias("dropped"), *text)
