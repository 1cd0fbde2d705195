import hashlib
import random
import re

import pytest

from tests.llm.helpers import edge_frame, edge_rows, empty_frame
from vantage.llm import decontaminate as D
from vantage.llm.queries import REGISTRY

NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normal(text):
    return NORMAL.findall((text or "").translate(UPPER))


def brute(docs, items, window=10):
    """(id, n_words, hit word numbers, items) by looking every item window up in every document."""
    wins = {}
    for i, t in items:
        w = normal(t)
        if w and i is not None:
            m = min(window, len(w))
            for a in range(len(w) - m + 1):
                wins.setdefault(tuple(w[a:a + m]), set()).add(i)
    sizes = {len(x) for x in wins}
    out = []
    for i, t in docs:
        w = normal(t)
        hit, got = set(), set()
        for m in sizes:
            for a in range(len(w) - m + 1):
                k = wins.get(tuple(w[a:a + m]))
                if k:
                    hit |= set(range(a, a + m))
                    got |= k
        out.append((i, len(w), sorted(hit), sorted(got)))
    return out


def corpus(seed=2, words=14):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(words)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 9, 10, 11, 14, 30, 60])) )) for i in range(25)]
    items += [(25, items[3][1]), (3, items[7][1]), (26, ""), (27, None), (28, "!! ..."), (None, "w1 w2")]
    docs = []
    for i in range(150):
        parts = []
        for _ in range(rng.randrange(0, 5)):
            parts.append(" ".join(word() for _ in range(rng.randrange(0, 30))))
            t = (rng.choice(items)[1] or "").split()
            a = rng.randrange(0, len(t) // 2 + 1)
            parts.append(rng.choice(["-", ", ", "\n"]).join(t[a:]).upper())
        docs.append((i, " ".join(parts)))
    return docs + [(200, None), (201, ""), (202, "é w1"), (None, docs[0][1]), (3, docs[3][1])], items


def rows(spark, docs, items, **settings):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = D.decontaminate(d, b, **settings).collect()
    flat = [(r["doc_id"], r["n_words"], [k for s in r["spans"] for k in range(s["start"], s["end"])], r["items"]) for r in got]
    assert all(r["n_hit"] == len(f[2]) and r["dropped"] == (len(f[2]) > 0.5 * f[1]) for r, f in zip(got, flat, strict=True))
    return sorted(flat, key=str), got


@pytest.mark.parametrize("words, block", [(14, 100_000), (14, 120), (400, 100_000), (400, 60)])
def test_matches_brute_force_in_one_and_many_blocks(spark, words, block):
    docs, items = corpus(words=words)
    if words == 400:  # no one-word items: most documents are clean
        items = [x for x in items if len(normal(x[1])) != 1]
    got, _ = rows(spark, docs, items, block_words=block)
    assert got == sorted(brute(docs, items), key=str)


def test_longest_match_and_clean_text(spark):
    items = [(1, "a b c d e f g h i j k l"), (2, "m n")]
    docs = [(1, "Zero, A b-C d e f g h i j k; tail"), (2, "x m. N y"), (3, "a b c d"), (4, "m x n")]
    _, got = rows(spark, docs, items)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["longest"] for i in (1, 2, 3, 4)] == [11, 2, 4, 1]
    assert [by[i]["clean_text"] for i in (1, 2, 3, 4)] == ["Zero, ; tail", "x  y", "a b c d", "m x n"]
    assert [by[i]["dropped"] for i in (1, 2, 3, 4)] == [True, False, False, False]


def test_long_item_in_pieces(spark):
    w = [f"t{i}" for i in range(500)]
    docs = [(1, " ".join(w[a:a + 10])) for a in range(0, 491, 7)] + [(2, " ".join(w)), (3, " ".join(w[5:14]))]
    got, _ = rows(spark, docs, [(1, " ".join(w))], block_words=100)
    assert got == sorted(brute(docs, [(1, " ".join(w))]), key=str)


def test_edges(spark):
    items = spark.createDataFrame([(1, edge_rows()[0][1], "clash"), (2, "one two three", None)], "item_id long, text string, doc_id string")
    got = D.decontaminate(edge_frame(spark), items).collect()
    want = brute([r[:2] for r in edge_rows()], [(1, edge_rows()[0][1]), (2, "one two three")])
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in got) == sorted((str(i), n, len(h), k) for i, n, h, k in want)
    assert D.decontaminate(empty_frame(spark), items).count() == 0
    assert {r["n_hit"] for r in D.decontaminate(edge_frame(spark), items.limit(0)).collect()} == {0}


def test_query_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(c, "text").collect()]
                   for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    want = [(i, n, len(h), len(k), hashlib.sha256(",".join(sorted(map(str, k))).encode()).hexdigest(), bool(h)) for i, n, h, k in brute(docs, items)]
    got = REGISTRY["op11_decontamination"](spark, sf).collect()
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(tuple(r[c] for c in cols) for r in got) == sorted(want)
    assert any(r[-1] for r in want)
