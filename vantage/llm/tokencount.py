"""Edit-aware token counts: a segment tree over the pre-tokens of each document.

Leaves are pre-tokens with their lengths and token counts; inner nodes hold sums, so
the place of an edit is found by descending and a changed leaf updates one path.  An edit
(position, deleted length, inserted text) re-encodes only the pre-tokens it touches plus
boundary context: scanning starts one pre-token before the edit and stops at the first border
that falls on an old border behind it, since from a common border on pre-tokens are the same.
The tree keeps the document's pre-tokens in blocks; a splice rebuilds the blocks it touches
and their path of sums only.

Documents are independent: one scan, no shuffle; the edits of a document travel in its row.

Defined results: null text is empty; positions and lengths beyond the end are cut to it;
edits apply in their order; no edits (null or empty list) leave the count as it is; repeated
rows are counted each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textbuf as T
from .bpe import VOCABULARY, Encoder, code_points, encoder
from .common import documents_view, unit

LEAF = 64  # pre-tokens a block holds about


class SumTree:
    """Sums of pairs (code points, tokens) over blocks of pre-tokens, in a flat binary tree."""

    def __init__(self, length: np.ndarray, tokens: np.ndarray):
        self.blocks = [(length[i:i + LEAF].copy(), tokens[i:i + LEAF].copy()) for i in range(0, len(length), LEAF)] or \
            [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        self._grow()

    def _grow(self) -> None:
        self.size = 1 << max(0, len(self.blocks) - 1).bit_length()
        self.sums = np.zeros((2 * self.size, 2), np.int64)
        for i, (a, b) in enumerate(self.blocks):
            self.sums[self.size + i] = a.sum(), b.sum()
        for i in range(self.size - 1, 0, -1):
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @property
    def total(self) -> int:
        return int(self.sums[1][1])

    def block_at(self, position: int) -> tuple[int, int]:
        """Block that holds a code point (the last one for the end), and the block's first code point."""
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if position >= start + self.sums[i][0]:
                start += int(self.sums[i][0])
                i += 1
        at = i - self.size
        if at >= len(self.blocks):
            at = len(self.blocks) - 1
            start = int(self.sums[1][0]) - int(self.blocks[at][0].sum())
        return at, start

    def replace(self, first: int, last: int, length: np.ndarray, tokens: np.ndarray) -> None:
        """Put new pre-tokens in place of blocks ``first``..``last``."""
        if first == last and 0 < len(length) <= 2 * LEAF:
            self.blocks[first] = (length, tokens)
            i = self.size + first
            self.sums[i] = length.sum(), tokens.sum()
            while i > 1:
                i //= 2
                self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]
            return
        self.blocks[first:last + 1] = [(length[i:i + LEAF], tokens[i:i + LEAF]) for i in range(0, len(length), LEAF)]
        if not self.blocks:
            self.blocks = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        self._grow()


class Counted:
    """A document with its pre-token tree; ``edit`` keeps the count up to date."""

    def __init__(self, enc: Encoder, text: str, length: np.ndarray | None = None, tokens: np.ndarray | None = None):
        self.enc, self.text, self.reencoded = enc, text, 0
        if length is None:
            length, tokens = self._scan(text)
        self.tree = SumTree(length, tokens)

    def _scan(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and token counts of the pre-tokens of a text."""
        cps = _cps(text)
        start = self.enc.borders(text, cps, np.array([0, len(cps)]))
        end = np.append(start[1:], len(cps)) if len(start) else start
        return end - start, self.enc.counts(text, cps, start, end)

    @property
    def tokens(self) -> int:
        return self.tree.total

    def edit(self, position: int, delete: int, insert: str) -> None:
        n = len(self.text)
        position = min(max(position, 0), n)
        stop = min(position + max(delete, 0), n)
        new = self.text[:position] + insert + self.text[stop:]
        tree = self.tree
        # context on the left: a pre-token looks one character ahead, an added token reaches as far as it is long
        near = max(position - self.enc.reach, 0)
        first, at = tree.block_at(near)
        if first > 0:
            first -= 1
            at -= int(tree.blocks[first][0].sum())
        last, last_at = tree.block_at(stop)
        shift = len(insert) - (stop - position)
        while True:
            length, tokens = (np.concatenate([b[k] for b in tree.blocks[first:last + 1]]) for k in (0, 1))
            borders = at + np.cumsum(length) - length  # old borders
            end = at + int(length.sum())
            # scan from the last border before the edit's context to the end of the blocks taken
            i = max(int(np.searchsorted(borders, near, side="right")) - 2, 0) if len(borders) else 0
            begin = int(borders[i]) if len(borders) else at
            got_len, got_tok, upto, j = self._rescan(new, begin, end, shift, borders, stop, last == len(tree.blocks) - 1)
            if upto >= 0:
                break
            last += 1
        self.reencoded += upto - begin
        self.text = new
        tree.replace(first, last, np.concatenate([length[:i], got_len, length[j:]]), np.concatenate([tokens[:i], got_tok, tokens[j:]]))

    def _rescan(self, new: str, begin: int, end: int, shift: int, borders: np.ndarray, stop: int, final: bool):
        """Pre-tokens of the new text from ``begin`` up to the first border that is an old one too.

        Returns lengths, token counts, where the scan stopped (-1: no common border yet) and the index of the
        first old pre-token that stays.
        """
        old = borders[borders > stop]
        reach = 64
        while True:
            limit = min(max(stop + shift, begin) + reach, end + shift)
            part = new[begin:limit + 1 + self.enc.reach] if limit < len(new) else new[begin:]
            cps = _cps(part)
            start = self.enc.borders(part, cps, np.array([0, len(cps)]))
            start = start + begin
            safe = start[start < limit] if limit < len(new) else np.append(start, len(new))
            common = safe[np.isin(safe, old + shift) & (safe > begin)]
            if len(common):
                upto = int(common[0])
            elif limit >= end + shift and final:
                upto = len(new)
            elif limit >= end + shift:
                return None, None, -1, 0
            else:
                reach *= 4
                continue
            keep = start[start < upto]
            stops = np.append(keep[1:], upto) if len(keep) else keep
            text = new[begin:upto]
            tokens = self.enc.counts_few(text, keep - begin, stops - begin)
            j = int(np.searchsorted(borders, upto - shift)) if len(common) else len(borders)
            return stops - keep, tokens, upto, j


def _cps(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def edited_counts(docs: DataFrame, edits: Column, id_col: str = "doc_id", text_col: str = "text",
                  vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_chars, n_tokens, n_tokens_edited, n_reencoded (code points) and edited_text of every row.

    ``edits``: array of structs (position int, delete int, insert string) over the row's columns.
    """
    view = documents_view(docs.withColumn("_edits", edits), id_col, text_col, "_edits")
    id_type = view.schema["doc_id"].dataType.simpleString()

    def run(batches):
        enc = encoder(vocabulary)
        for b in batches:
            lists = b.column("_edits").to_pylist()
            for c in T.chunks(b.column("text")):
                text, cps, offsets = code_points(c)
                start = enc.borders(text, cps, offsets)
                end = np.append(start[1:], len(cps)) if len(start) else start
                count = enc.counts(text, cps, start, end)
                first = np.searchsorted(start, offsets)
                rows = []
                for d in range(c.n):
                    s = slice(first[d], first[d + 1])
                    doc = Counted(enc, text[offsets[d]:offsets[d + 1]], (end - start)[s], count[s])
                    before = doc.tokens
                    for e in lists[c.first_row + d] or ():
                        if e is not None:
                            doc.edit(e["position"] or 0, e["delete"] or 0, e["insert"] or "")
                    rows.append((len(doc.text), before, doc.tokens, doc.reencoded, doc.text))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(c.first_row, c.n)] + [pa.array(v, pa.int64()) for v in cols[:4]] + [pa.array(cols[4], pa.string())],
                    names=["doc_id", "n_chars", "n_tokens", "n_tokens_edited", "n_reencoded", "edited_text"])

    return view.mapInArrow(run, f"doc_id {id_type}, n_chars long, n_tokens long, n_tokens_edited long, n_reencoded long, edited_text string")


def revision(id_col: str = "doc_id", text_col: str = "text", edits: int = 3) -> Column:
    """A revision of each document, fixed by its id and text: replacements, deletions and insertions of words.

    The inserted word is taken from elsewhere in the same text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    n = F.length(text)

    def draw(i: int, what: str) -> Column:
        return unit(F.col(id_col), n, F.lit(f"{what}{i}"))

    one = [F.struct(F.floor(draw(i, "at") * (n + 1)).cast("int").alias("position"),
                    F.floor(draw(i, "cut") * 12).cast("int").alias("delete"),
                    F.substring(text, F.floor(draw(i, "from") * n).cast("int") + 1, F.floor(draw(i, "size") * 16).cast("int")).alias("insert"))
           for i in range(edits)]
    return F.array(*one)
