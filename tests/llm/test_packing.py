import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tests.llm.helpers import edge_frame, edge_rows, empty_frame
from vantage.llm import bpe, packing as P
from vantage.llm import textbuf as T


def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_encoder_matches_the_tokenizer():
    random.seed(3)
    bits = list("ab'strevlmd  \n\t.,é1²ß '") + ["'s", "'re", " '", "中", "\x1f", "<|endoftext|>", "ñ", " ", "😀"]
    texts = ["".join(random.choice(bits) for _ in range(random.randrange(0, 60))) for _ in range(2500)] + ["", " ", "  ", "\n"]
    want = [e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]
    enc, got = bpe.encoder(), []
    for c in T.chunks(pa.array(texts), limit=3000):
        ids, off = enc.encode(c)
        got += [ids[off[d]:off[d + 1]].tolist() for d in range(c.n)]
    assert got == want


SCRIPTS = ["latin’s “quotes” — dash… it's", "русский текст, 12", "Ελληνικά, 7", "עברית טקסט", "نص عربي ١٢٣", "हिन्दी पाठ १२", "中文字符，很长。第１", "日本語のテキスト。", "한국어 텍스트",
           "ไทยข้อความ", "emoji 😀👩‍👩‍👧 ok 🤷🏽", "math ∑∫ x² ½ Ⅷ", "\u2028\u3000wide\u00a0space\u0085", "new \u1c89\ua7cb\U000105c0\U00016d70 ones", "private \ue000 \ufffe"]


def test_every_script_and_added_tokens():
    rng = random.Random(6)
    texts = SCRIPTS + ["end <|endoftext|> next", "<|endoftext|>", "a<|endoftext|><|endoftext|>'s", "<|endoftext", "|> <|endoftext|>\n", " <|endoftext|> "]
    texts += [" ".join(rng.sample(texts, 4)) for _ in range(60)] + ["".join(chr(rng.choice([rng.randrange(0x20, 0xD800), rng.randrange(0xE000, 0x110000)]))
                                                                            for _ in range(50)) for _ in range(200)]
    want = [e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]
    enc, got = bpe.encoder(), []
    for c in T.chunks(pa.array(texts), limit=2000):
        ids, off = enc.encode(c)
        got += [ids[off[d]:off[d + 1]].tolist() for d in range(c.n)]
    assert got == want


def brute_pieces(rows, capacity=2048):
    t, out = tokenizer(), []
    for r in rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids + [0]
        head = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(head, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            out.append((str(r[0]), k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out)


def check_sequences(rows, capacity=2048):
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


def test_edges(spark):
    got = P.pack(edge_frame(spark)).collect()
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == brute_pieces(edge_rows())
    check_sequences(got)
    assert P.pack(empty_frame(spark)).count() == 0


def test_documents_pack_close_to_the_bound(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = P.pack(docs).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == brute_pieces(rows)
    n, bound = check_sequences(got), -(-sum(r["length"] for r in got) // 2048)
    assert n <= bound + 2
    ids = {(r["doc_id"], r["piece"]): r["ids"] for r in P.pack(docs, with_ids=True).collect()}
    assert all(zlib.crc32(np.array(ids[r["doc_id"], r["piece"]], "<u4").tobytes()) == r["ids_crc32"] for r in got)


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(4)
    for _ in range(20):
        counts = {int(k): int(n) for k, n in zip(rng.integers(1, 201, 40), rng.integers(1, 500, 40), strict=True)}
        used, seqs = {}, 0
        for combo, times in P.plan(counts, 200):
            assert times > 0 and sum(combo) <= 200
            seqs += times
            for x in combo:
                used[x] = used.get(x, 0) + times
        assert used == counts
        assert seqs <= 1.03 * -(-sum(k * n for k, n in counts.items()) // 200) + 2 or max(counts) > 100


def test_numbers_do_not_depend_on_partitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    key = lambda df: sorted((r["doc_id"], r["piece"], r["sequence_id"], r["offset"]) for r in df.collect())
    assert key(P.pack(docs)) == key(P.pack(docs.repartition(5)))
