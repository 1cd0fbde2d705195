import random

from pyspark.sql import functions as F

from tests.llm.helpers import edge_frame, edge_rows, empty_frame
from tests.llm.test_packing import SCRIPTS
from vantage.llm import bpe
from vantage.llm import tokencount as C


def test_edits_match_full_counts():
    enc = bpe.encoder()
    random.seed(5)
    bits = list("ab'strevlmd  \n\t.,é1²ß '") + ["'s", "'re", " '", " the", " ", "中", "я", "😀", "<|endoftext|>", "<|endof", "text|>", "’"]
    for trial in range(300):
        d = C.Counted(enc, "".join(random.choice(bits) for _ in range(random.choice([0, 5, 60, 800, 3000]))))
        for _ in range(5):
            p, cut = random.randrange(0, len(d.text) + 3), random.choice([0, 1, 3, 10, 400])
            new = "".join(random.choice(bits) for _ in range(random.choice([0, 1, 4, 30, 300])))
            old, at = d.text, min(p, len(d.text))
            d.edit(p, cut, new)
            assert d.text == old[:at] + new + old[at + cut:]
            assert d.tokens == len(enc.whole(d.text))


def test_only_the_edited_region_is_encoded_again():
    enc = bpe.encoder()
    d = C.Counted(enc, "some words follow here and there " * 20_000)
    d.edit(300_000, 5, "other")
    assert d.reencoded < 400 and d.tokens == len(enc.whole(d.text))


def test_the_region_is_small_in_every_script():
    enc = bpe.encoder()
    for script in SCRIPTS:
        d = C.Counted(enc, (script + " ") * 3_000)
        d.edit(len(d.text) // 2, 3, "new")
        assert d.reencoded < 400 and d.tokens == len(enc.whole(d.text))


def test_edges(spark):
    docs = edge_frame(spark)
    got = C.edited_counts(docs, C.revision()).collect()
    enc = bpe.encoder()
    texts = sorted((str(r[0]), len(enc.whole(r[1] or ""))) for r in edge_rows())
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == texts
    assert all(r["n_tokens_edited"] == len(enc.whole(r["edited_text"])) and r["n_chars"] == len(r["edited_text"]) for r in got)
    none = C.edited_counts(docs, F.expr("cast(null as array<struct<position:int,delete:int,insert:string>>)")).collect()
    assert all(r["n_tokens"] == r["n_tokens_edited"] and r["n_reencoded"] == 0 for r in none)
    assert C.edited_counts(empty_frame(spark), C.revision()).count() == 0
