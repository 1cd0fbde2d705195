import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm.helpers import edge_frame, edge_rows, empty_frame, words
from vantage.llm import repetition as R
from vantage.llm.queries import REGISTRY


def brute_runs(w, min_length=6, min_exponent=4):
    """All maximal stretches with smallest period q, by comparing every word with the one q before."""
    n, runs = len(w), set()
    for q in range(1, n // min_exponent + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            a = i - q
            while i < n and w[i] == w[i - q]:
                i += 1
            if i - a >= max(min_length, min_exponent * q):
                runs.add((a, i, q))
    least = {}
    for a, b, q in runs:
        least[a, b] = min(q, least.get((a, b), q))
    return sorted((a, q, b) for (a, b), q in least.items())


def brute_row(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = [(a, b - a, q) for a, q, b in brute_runs(w)]
    cut = {i for a, size, q in runs for i in range(a + q, a + size)}
    top = min(((-size, a, q) for a, size, q in runs), default=None)
    lines = "".join(f"{a},{size},{q}\n" for a, size, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in cut)
    best = (None,) * 4 if top is None else (top[1], -top[0], top[2], 1000 * -top[0] // top[2])
    return (doc_id, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


COLS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def texts():
    rng = random.Random(5)
    out = ["a " * k for k in (1, 3, 5, 6, 7, 40, 1000)]
    out += ["a b " * 12 + "c", ("a b " * 5 + "c ") * 5, "x " + "p q r " * 4, "p q r " * 3 + "p q", "a a a a a b " * 9]
    fib = ["a", "a b"]
    while len(fib[-1]) < 1200:
        fib.append(fib[-1] + " " + fib[-2])
    thue = [bin(i).count("1") % 2 for i in range(4096)]
    out += [fib[-1], " ".join("xy"[b] for b in thue[:700])]
    for _ in range(120):
        k = rng.choice([2, 3, 30])
        w = []
        for _ in range(rng.randrange(1, 6)):
            part = [f"w{rng.randrange(k)}" for _ in range(rng.randrange(1, 25))]
            w += part * rng.choice([1, 2, 4, 5, 11]) + part[:rng.randrange(len(part) + 1)]
        out.append(rng.choice([" ", "\n", "\t "]).join(w))
    return out


@pytest.mark.parametrize("exponent", [4, 3, 2, 2.5])
def test_runs_match_brute_force(exponent):
    rng = np.random.default_rng(3)
    lists = [words(t)[:180] for t in texts()]
    codes = {x: np.uint64(v) for x, v in zip(sorted({x for w in lists for x in w}), rng.integers(1, 1 << 62, 10_000), strict=False)}
    flat = np.array([codes[x] for w in lists for x in w], np.uint64)
    first = np.concatenate([[0], np.cumsum([len(w) for w in lists])])
    d, a, b, q = R.find_runs(flat, first, 6, exponent)
    got = [(int(i), int(x - first[i]), int(p), int(y - first[i])) for i, x, y, p in zip(d, a, b, q, strict=True)]

    def brute(w):
        n, runs = len(w), {}
        for q in range(1, n // 2 + 1):
            i = q
            while i < n:
                s = i - q
                while i < n and w[i] == w[i - q]:
                    i += 1
                if i - s >= max(6, exponent * q):
                    runs.setdefault((s, i), q)
                i += 1
        return sorted((s, q, e) for (s, e), q in runs.items())
    assert got == [(i, *r) for i, w in enumerate(lists) for r in brute(w)]


def test_query_matches_brute_force(spark, tmp_path):
    rows = list(enumerate(texts()))
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{path}/documents.parquet")
    got = sorted(tuple(r[c] for c in COLS) for r in REGISTRY["op13_periodic_runs"](spark, path).collect())
    assert got == sorted(brute_row(*r) for r in rows)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if len(words(r["text"])) < 900}
    got = {r["doc_id"]: tuple(r[c] for c in COLS) for r in REGISTRY["op13_periodic_runs"](spark, sf).collect()}
    for i, t in docs.items():
        assert got[i] == brute_row(i, t)


def test_edges(spark):
    got = R.periodic_runs(edge_frame(spark)).collect()
    assert len(got) == len(edge_rows())
    by = {r["doc_id"]: r for r in got}
    assert [tuple(x) for x in by[10]["runs"]] == [(0, 300, 1)] and by[10]["collapsed_text"] == "a"
    assert by[15]["collapsed_text"] == "line"
    for i in (4, 5, 6):
        assert by[i]["runs"] == [] and by[i]["collapsed_text"] == "" and by[i]["n_words"] == 0
    assert by[11]["collapsed_text"] == "é ü 中文 words here"
    assert by[9]["runs"] == [] or by[9]["n_words"] == 30_000
    assert R.periodic_runs(empty_frame(spark)).count() == 0


def test_long_document_of_one_word(spark):
    docs = spark.createDataFrame([(1, "z " * 300_000)], "doc_id long, text string")
    r = R.periodic_runs(docs).first()
    assert [tuple(x) for x in r["runs"]] == [(0, 300_000, 1)] and r["collapsed_text"] == "z"
