"""Periodic runs in texts by dyadic square catching, and texts with their repetitions collapsed.

Every completed block of ``2**j`` words (counted from the document's start) is a catcher for the squares
whose period lies in its octave: when a word is appended, the suffix of ``2**j`` words that it ends is
compared with the catchers at those distances, one comparison a level for exponents from 3 on (the aligned
block that the distance range leaves), two or three below.  Suffixes of a level are compared by a hash made of the two
halves' hashes, level by level, so a comparison is one equality.  Squares of one period that neighbouring
catchers report merge into one stretch; its two ends are found by descending the lower levels.  All
documents of a chunk advance together; work and memory are about ``words x levels``.

A run is a maximal stretch of consecutive words with smallest period ``q``; runs with fewer than
``min_length`` words or less than ``min_exponent`` periods are left out.  A stretch that also has a smaller
period is the run of that period: by the periodicity lemma both have the same ends, so the smallest period
of equal ends stays.

Defined results: null and empty texts have no words, no runs and an empty collapsed text; repeated rows and
null ids are rows like all others (every row is judged by itself); extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textbuf as T
from .common import WORD, documents_view

MIN_LENGTH, MIN_EXPONENT = 6, 4
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _doubled(level: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all stretches of ``2 * size`` words from those of ``size`` words."""
    return T.mix(level[:-size] * _LEFT + level[size:] * _RIGHT) if len(level) > size else level[:0]


def _octave(size: int, min_exponent: float) -> tuple[int, int]:
    """Periods [low, high) that catchers of ``size`` words serve: a run of such a period holds a whole
    aligned block (two, for exponents from 3 on) that has its copy one period on."""
    if min_exponent >= 3:
        return size, 2 * size
    return (2 * size if size > 1 else 1), 4 * size


def _caught(level, size, low, high, at, rel):
    """Catchers (by first word) and periods of all squares that suffixes starting at ``at`` report."""
    catchers, periods = [], []
    newest = (rel - low) // size * size  # the newest catcher that is far enough back
    for k in range(-(-(high - low) // size)):
        block = newest - k * size
        ok = np.flatnonzero((rel >= low) & (block >= 0) & (rel - block < high))
        period = (rel - block)[ok]
        i = at[ok]
        same = level[i] == level[i - period]
        catchers.append((i - period)[same])
        periods.append(period[same])
    return np.concatenate(catchers), np.concatenate(periods)


def find_runs(words: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH,
              min_exponent: float = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of all documents of a chunk as document, first word (in the chunk), end and period, sorted so.

    ``words`` are 64-bit word hashes, document ``d`` holds words ``first[d]`` to ``first[d + 1]``.
    """
    n_of = np.diff(first)
    doc = np.repeat(np.arange(len(n_of)), n_of)
    found = [np.zeros((4, 0), np.int64)]
    levels = [words]
    at = np.arange(len(words))
    size = 1
    while True:
        low, high = _octave(size, min_exponent)
        at = at[n_of[doc[at]] >= min_exponent * low]
        level = levels[-1]
        at = at[at < len(level)]
        if not len(at):
            break
        inside = at[at + size <= first[doc[at] + 1]]
        block, q = _caught(level, size, low, high, inside, inside - first[doc[inside]])
        if len(block):
            order = np.lexsort((block, q))
            block, q = block[order], q[order]
            fresh = np.append(True, (q[1:] != q[:-1]) | (block[1:] != block[:-1] + size) | (doc[block[1:]] != doc[block[:-1]]))
            head = np.flatnonzero(fresh)
            tail = np.append(head[1:], len(block)) - 1
            q, left, right = q[head], block[head], block[tail] + size
            start, end = first[doc[left]], first[doc[left] + 1]
            for k in range(len(levels) - 2, -1, -1):
                step, lv = 1 << k, levels[k]
                a = np.maximum(left - step, 0)
                left = np.where((left - step >= start) & (lv[a] == lv[a + q]), left - step, left)
                b = np.minimum(right + q, len(lv) - 1)
                right = np.where((right + q + step <= end) & (lv[b - q] == lv[b]), right + step, right)
            stop = right + q
            keep = (stop - left >= min_length) & (stop - left >= min_exponent * q)
            found.append(np.stack([doc[left], left, stop, q])[:, keep])
        levels.append(_doubled(level, size))
        size *= 2
    d, a, b, q = np.concatenate(found, axis=1)
    order = np.lexsort((q, b, a, d))
    d, a, b, q = d[order], a[order], b[order], q[order]
    if len(d):
        lead = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        d, a, b, q = d[lead], a[lead], b[lead], q[lead]
        order = np.lexsort((q, a, d))
        d, a, b, q = d[order], a[order], b[order], q[order]
    return d, a, b, q


def _joined(c: T.Chunk, w: T.Words, keep: np.ndarray) -> pa.Array:
    """The kept words of every document, joined by one space."""
    kept = np.flatnonzero(keep)
    bounds = np.searchsorted(kept, w.first)
    gap = np.ones(len(kept), np.int64)
    last = bounds[1:][np.diff(bounds) > 0] - 1
    gap[last] = 0
    size = w.end[kept] - w.start[kept] + gap
    total = np.zeros(len(kept) + 1, np.int64)
    np.cumsum(size, out=total[1:])
    raw = np.append(c.buf, np.uint8(0x20))
    out = raw[np.repeat(w.start[kept] - total[:-1], size) + np.arange(total[-1])]
    out[(total[1:] - 1)[gap == 1]] = 0x20
    offsets = total[bounds].astype(np.int32)
    return pa.StringArray.from_buffers(c.n, pa.py_buffer(offsets), pa.py_buffer(out))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  min_exponent: float = MIN_EXPONENT) -> DataFrame:
    """``doc_id, n_words, runs, collapsed_text`` for every row.

    ``runs`` holds (start, length, period) in words, by start and period; ``collapsed_text`` is the words that
    no run holds after its first period, joined by one space.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")
    view = documents_view(docs, id_col, text_col)
    id_type = view.schema["doc_id"].dataType.simpleString()
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for b in batches:
            for c in T.chunks(b.column("text")):
                w = T.words(c)
                d, start, stop, q = find_runs(w.hash, w.first, min_length, min_exponent)
                drop = np.zeros(len(w.hash) + 1, np.int64)
                np.add.at(drop, start + q, 1)
                np.add.at(drop, stop, -1)
                fields = pa.StructArray.from_arrays([pa.array(start - w.first[d]), pa.array(stop - start), pa.array(q)], fields=list(item))
                lists = pa.ListArray.from_arrays(np.searchsorted(d, np.arange(c.n + 1)).astype(np.int32), fields)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(c.first_row, c.n), pa.array(w.counts.astype(np.int64)), lists,
                     _joined(c, w, np.cumsum(drop[:-1]) == 0)], names=["doc_id", "n_words", "runs", "collapsed_text"])

    return view.mapInArrow(run, f"doc_id {id_type}, n_words long, runs {RUNS}, collapsed_text string")


def planted(doc_id: Column, text: Column) -> Column:
    """Texts with a periodic tail in the documents that their id's checksum names (others as they are).

    With h = crc32(id as text) and g = h div 10, a document with h % 10 = 0 and n words repeats the
    p = 1 + (n - a) div (3 + g % 8) words from word a = g % n on up to its end.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    new = F.concat_ws(" ", F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)))
    return F.when((h % 10 == 0) & text.rlike(WORD), new).otherwise(text)
