"""Byte-level BPE over Arrow chunks: pre-tokens by numpy, each distinct pre-token encoded once.

Pre-token borders depend on character classes only (letters, numbers, white
space, the rest, contractions), so they are found for a whole chunk at once, in any script.
Classes are Unicode's; a code point that this Python's Unicode tables do not hold yet is put to the tokenizer once.
An added token of the file (``<|endoftext|>``) that stands in a text is one pre-token, as the tokenizer's
default has it.  A worker remembers the ids of the pre-tokens it has met (up to ``REMEMBER``, then it starts afresh).
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np

from . import textbuf as T

VOCABULARY = "byte_bpe_50k.json"
REMEMBER = 400_000
LETTER, NUMBER, SPACE, OTHER, UNKNOWN = 0, 1, 2, 3, 4
CONTRACTED = ("s", "t", "m", "d", "re", "ve", "ll")

_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Class of every code point (filled on first use)."""
    if not _classes:
        kind = {"L": LETTER, "N": NUMBER}
        out = np.full(0x110000, OTHER, np.uint8)
        for cp in range(0x110000):
            ch = chr(cp)
            cat = unicodedata.category(ch)
            out[cp] = UNKNOWN if cat == "Cn" else SPACE if ch.isspace() and not 0x1C <= cp <= 0x1F else kind.get(cat[0], OTHER)
        _classes.append(out)
    return _classes[0]


def code_points(c: T.Chunk) -> tuple[str, np.ndarray, np.ndarray]:
    """Text and code points of a chunk, and the document offsets among them."""
    text = c.buf.tobytes().decode("utf-8")
    cps = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    lead = np.zeros(len(c.buf) + 1, np.int64)
    np.cumsum((c.buf & 0xC0) != 0x80, out=lead[1:])
    return text, cps, lead[c.offsets]


def pretoken_starts(cps: np.ndarray, offsets: np.ndarray, whole: list[tuple[int, int]] = ()) -> np.ndarray:
    """First code point of every pre-token; the spans of ``whole`` are pre-tokens as they are."""
    n = len(cps)
    if not n:
        return np.zeros(0, np.int64)
    k = classes()[cps]
    edge = np.zeros(n + 1, bool)  # borders of documents and of added tokens
    edge[offsets] = True
    for a, b in whole:
        edge[[a, b]] = True
    cut = edge[:n].copy()
    cut[1:] |= k[1:] != k[:-1]
    space = k == SPACE
    # the last of the white space before another character: a blank joins that character's pre-token,
    # anything else stands alone
    before = np.zeros(n, bool)
    before[:-1] = space[:-1] & ~space[1:] & ~edge[1:n]
    blank = before & (cps == 0x20)
    cut[np.flatnonzero(before)] = True
    nxt = np.flatnonzero(blank) + 1
    cut[nxt] = False
    # a contraction: an apostrophe alone in its run, not after a blank, then one of the endings
    quote = np.flatnonzero((cps[:-1] == 0x27) & cut[:n - 1] & (k[1:] == LETTER) & ~edge[1:n]) if n > 1 else np.zeros(0, np.int64)
    if len(quote):
        pad = np.concatenate([cps, np.zeros(2, cps.dtype)])
        edges = np.flatnonzero(edge)
        limit = edges[np.searchsorted(edges, quote, side="right")]
        size = np.zeros(len(quote), np.int64)
        for end in CONTRACTED:
            ok = (size == 0) & (quote + 1 + len(end) <= limit)
            for i, ch in enumerate(end):
                ok &= pad[quote + 1 + i] == ord(ch)
            size[ok] = len(end)
        quote, size = quote[size > 0], size[size > 0]
        cut[quote + 1] = False
        stop = quote + 1 + size
        inside = stop < n
        cut[stop[inside]] = True
    for a, b in whole:
        cut[a + 1:b] = False
    return np.flatnonzero(cut)


def _single_pieces(path: str, ask):
    """Ids of one pre-token, and the added tokens by text.  Where the file's merges are in id order they are
    ranks, and a plain rank merger (a tenth of the time) gives the same ids; otherwise the tokenizer is asked."""
    import tiktoken
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    vocab, merges = file["model"]["vocab"], file["model"]["merges"]
    added = {t["content"]: t["id"] for t in file.get("added_tokens", ())}
    ids = [vocab[m.replace(" ", "", 1) if isinstance(m, str) else "".join(m)] for m in merges]
    if any(a >= b for a, b in zip(ids, ids[1:], strict=False)):
        return lambda x: ask().encode(x, add_special_tokens=False).ids, added
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes the format writes as themselves
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    made = set(ids) | {vocab[ch] for ch in byte}
    ranks = {bytes(byte[ch] for ch in tok): i for tok, i in vocab.items() if i in made}
    merge = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda x: [added[x]] if x in added else merge(x), added


class Encoder:
    """Pre-token ids of one worker, kept sorted by hash."""

    def __init__(self, vocabulary: str = VOCABULARY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        self.path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
        self._tokenizer = None
        self.single, self.added = _single_pieces(self.path, self.tokenizer)
        self.reach = max([1, *map(len, self.added)])  # code points that can decide about a border
        self.forget()

    def tokenizer(self):
        """The file's tokenizer, loaded when it is asked for the first time."""
        if self._tokenizer is None:
            from tokenizers import Tokenizer
            self._tokenizer = Tokenizer.from_file(self.path)
        return self._tokenizer

    def borders(self, text: str, cps: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """First code point of every pre-token of the documents between ``offsets``."""
        table = classes()
        for cp in np.unique(cps[table[cps] == UNKNOWN]).tolist():
            table[cp] = self._asked(cp)
        whole = []
        for token in self.added:  # leftmost first, none across two documents
            at = text.find(token)
            while at >= 0:
                inside = offsets[np.searchsorted(offsets, at, side="right")] >= at + len(token)
                if inside:
                    whole.append((at, at + len(token)))
                at = text.find(token, at + (len(token) if inside else 1))
        return pretoken_starts(cps, offsets, whole)

    def _asked(self, cp: int) -> int:
        """Class of a code point by which of a letter, a number and a mark it joins."""
        for k, before in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if len(self.tokenizer().pre_tokenizer.pre_tokenize_str(before + chr(cp))) == 1:
                return k
        return SPACE

    def forget(self) -> None:
        self.hash = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.at = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer().encode(text, add_special_tokens=False).ids, np.uint32)

    def slots(self, text: str, cps: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Slot (index into count and at) of every pre-token."""
        h, first, inverse = np.unique(T.span_hash(T.prefix(cps), start, end), return_index=True, return_inverse=True)
        if len(self.hash) > REMEMBER:
            self.forget()
        pos = np.searchsorted(self.hash, h)
        known = np.zeros(len(h), bool)
        inside = pos < len(self.hash)
        known[inside] = self.hash[pos[inside]] == h[inside]
        new = np.flatnonzero(~known)
        if len(new):
            got = [self.single(text[a:b]) for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)]
            size = np.array([len(x) for x in got], np.int64)
            flat = np.fromiter((i for x in got for i in x), np.uint32, int(size.sum()))
            slot = len(self.count) + np.arange(len(new))
            self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(size) - size])
            self.count = np.concatenate([self.count, size])
            self.ids = np.concatenate([self.ids, flat])
            self.slot = np.insert(self.slot, pos[new], slot)
            self.hash = np.insert(self.hash, pos[new], h[new])
            pos = np.searchsorted(self.hash, h)
        return self.slot[pos][inverse]

    def counts(self, text: str, cps: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of tokens of every pre-token."""
        slot = self.slots(text, cps, start, end)  # may replace the count table
        return self.count[slot]

    def counts_few(self, text: str, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of tokens of a handful of pre-tokens, encoded as they come (the table is for whole texts)."""
        return np.array([len(self.single(text[a:b])) for a, b in zip(start.tolist(), end.tolist(), strict=True)], np.int64)

    def encode(self, c: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a chunk in one array, and the document offsets in it."""
        text, cps, offsets = code_points(c)
        start = self.borders(text, cps, offsets)
        first = np.searchsorted(start, offsets)
        slot = self.slots(text, cps, start, np.append(start[1:], len(cps)) if len(start) else start)
        size = self.count[slot]
        total = np.zeros(len(slot) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        ids = self.ids[np.repeat(self.at[slot] - total[:-1], size) + np.arange(total[-1])]
        return ids, total[first]


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]
