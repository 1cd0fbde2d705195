"""Best-fit packing by exact-complement hashing.

Documents become token ids plus an end id; longer ones are cut into full pieces, the
first piece taking the remainder.  A piece is at most ``capacity`` long, so the whole
corpus is a histogram of at most ``capacity`` lengths, and the packing is planned on
that bounded table: fill the gap above the longest piece with a single, pair or triple
of available lengths that sums to it exactly; where there is none, place the best
fitting length and look again.  One plan row is a combination with a multiplicity
(each row exhausts a length), so the plan is bounded too and does not grow with the
corpus.  Pieces are then numbered within their length (numbering is split into hash
buckets, so a hot length is no hot task) and take the places of their numbers.

Defined results: null text is empty and gives one piece holding the end id; repeated
rows are packed each; null ids are kept; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textbuf as T
from .bpe import VOCABULARY, encoder
from .common import documents_view, stage

CAPACITY, END_ID, BUCKET_ROWS = 2048, 0, 4096


def pieces_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
              end_id: int = END_ID, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, and its ids if asked for."""
    view = documents_view(docs, id_col, text_col)
    id_type = view.schema["doc_id"].dataType.simpleString()

    def run(batches):
        enc = encoder(vocabulary)
        for b in batches:
            for c in T.chunks(b.column("text")):
                ids, off = enc.encode(c)
                n = np.diff(off) + 1
                whole = np.insert(ids, off[1:], end_id).astype("<u4")
                base = off[:-1] + np.arange(c.n)
                k = -(-n // capacity)
                doc = np.repeat(np.arange(c.n), k)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(k) - k, k)
                head = n - (k - 1) * capacity
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[doc], capacity)
                raw = memoryview(whole.tobytes())
                at = (base[doc] + start).tolist()
                crc = [zlib.crc32(raw[4 * a:4 * (a + m)]) for a, m in zip(at, length.tolist(), strict=True)]
                rows = pa.array(doc + c.first_row)
                cols = [b.column("doc_id").take(rows), pa.array(piece.astype(np.int32)), pa.array(start),
                        pa.array(length), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:  # pieces lie one after the other
                    cols.append(pa.ListArray.from_arrays(np.append(at, len(whole)).astype(np.int32), whole.astype(np.int32)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return view.mapInArrow(run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of lengths and how often each is used; together they use up ``counts``."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n

    def pair(avail: np.ndarray, gap: int) -> tuple[int, int] | None:
        """Two available lengths with sum ``gap``, the larger one as long as can be."""
        if gap < 2:
            return None
        a = np.arange(gap - 1, (gap - 1) // 2, -1)
        ok = (avail[a] > 0) & (avail[gap - a] > (a == gap - a))
        i = int(ok.argmax()) if len(ok) else 0
        return (int(a[i]), int(gap - a[i])) if len(ok) and ok[i] else None

    def exact(avail: np.ndarray, gap: int) -> tuple[int, ...] | None:
        if avail[gap] > 0:
            return (gap,)
        two = pair(avail, gap)
        if two:
            return two
        for a in np.flatnonzero(avail[:gap])[::-1].tolist():
            if 3 * a < gap:
                break  # the largest of three is at least a third
            avail[a] -= 1
            two = pair(avail, gap - a)
            avail[a] += 1
            if two:
                return (a, *two)
        return None

    out = []
    top = capacity
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return out
        combo, avail = [top], left.copy()
        avail[top] -= 1
        gap = capacity - top
        while gap:
            more = exact(avail, gap)
            if more is None:
                fits = np.flatnonzero(avail[:gap + 1])
                if not len(fits):
                    break
                more = (int(fits[-1]),)
            combo += more
            for x in more:
                avail[x] -= 1
            gap -= sum(more)
        uses = {x: combo.count(x) for x in combo}
        times = int(min(left[x] // n for x, n in uses.items()))
        for x, n in uses.items():
            left[x] -= n * times
        out.append((tuple(combo), times))


def _places(rows: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Plan as sorted ranges: key (length and first number), first sequence of the range, offset in it."""
    used: dict[int, int] = {}
    out, seq = [], 0
    for combo, times in rows:
        offset = 0
        for x in combo:
            n = used.get(x, 0)
            out.append((x << 44 | n, seq, offset))
            used[x] = n + times
            offset += x
        seq += times
    out.sort()
    a = np.array(out, np.int64).reshape(-1, 3)
    return a[:, 0].copy(), a[:, 1].copy(), a[:, 2].copy()


def numbered(pieces: DataFrame, total: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add ``nth``: the number of each piece within its length, from 0.

    A length's pieces are spread over hash buckets of about ``bucket_rows`` pieces; the buckets of a
    length are counted first, so that each bucket numbers its own pieces from its offset.
    """
    order = ["doc_id", "piece", "ids_crc32"]
    buckets = max(1, -(-total // bucket_rows))
    p = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    sizes = p.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "bucket").orderBy(*order)
    return p.withColumn("k", F.row_number().over(own) - 1).join(sizes, ["length", "bucket"]) \
        .withColumn("nth", F.col("base") + F.col("k")).drop("bucket", "base", "k")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """Pieces with their place: sequence_id and offset (gapless from 0 in every sequence)."""
    pieces = stage(pieces_of(docs, id_col, text_col, capacity, end_id, vocabulary, with_ids), "pack-pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    key, seq, offset = _places(plan(counts, capacity))
    names = [f.name for f in pieces.schema.fields]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def place(batches):
        for b in batches:
            want = b.column("length").to_numpy() << 44 | b.column("nth").to_numpy()
            i = np.searchsorted(key, want, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [b.column(x) for x in names] + [pa.array(seq[i] + want - key[i]), pa.array(offset[i])],
                names=names + ["sequence_id", "offset"])

    return numbered(pieces, sum(counts.values())).mapInArrow(place, f"{schema}, sequence_id long, offset long")
