import random

import numpy as np

from tests.llm.helpers import edge_frame, edge_rows, empty_frame, words
from vantage.llm import mixing as M


def brute_targets(sizes, cap=3):
    order = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    w = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {s for s in sizes if not sizes[s]}
    while True:
        left, weight = total - sum(cap * sizes[s] for s in fixed), sum(w[s] for s in sizes if s not in fixed)
        t = {s: float(cap * sizes[s]) if s in fixed else left * w[s] / weight for s in sizes}
        over = {s for s in sizes if s not in fixed and t[s] > cap * sizes[s]}
        if not over:
            return t
        fixed |= over


def corpus(n=3000):
    random.seed(2)
    rows = []
    for i in range(n):
        s = random.choice(["hot"] * 6 + ["b", "c", "é", "z", "tiny", None]) if i % 400 else "rare"
        k = random.choice([0, 1, 3, 20, 100, 400]) if s != "tiny" else 1
        rows.append((i, " ".join(["w"] * k), s))
    return rows


def test_targets_and_totals(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = M.mix_sources(docs, block_rows=64).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want = brute_targets(sizes)
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in sizes:  # two documents at most are rounded
        assert abs(taken[s] - want[s]) <= 2 * 400, (s, taken[s], want[s])
    again = M.mix_sources(docs.repartition(7), block_rows=64).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(0)
    for _ in range(50):
        n = int(rng.integers(1, 400))
        p, x = np.full(n, rng.random()), rng.integers(1, 900, n).astype(float)
        out = M.flight(p, x, rng.random(n))
        assert ((out > 0) & (out < 1)).sum() <= 2
        assert abs(out.sum() - p.sum()) < 1e-6 and abs(out @ x - p @ x) < 1e-3


def test_inclusion_is_even():
    rng = np.random.default_rng(1)
    x = rng.integers(1, 50, 60).astype(float)
    hits = sum(M.landing(M.flight(np.full(60, 0.3), x, rng.random(60)), rng.random(60)) for _ in range(1500)) / 1500
    assert abs(hits.mean() - 0.3) < 0.01 and hits.min() > 0.2 and hits.max() < 0.4


def test_edges(spark):
    docs = edge_frame(spark)
    got = M.mix_sources(docs).collect()
    assert len(got) == len(edge_rows())
    total = sum(len(words(r[1])) for r in edge_rows())
    assert abs(sum({r["source"]: r["target"] for r in got}.values()) - total) < 1e-6 * total
    out = M.mixed_documents(docs)
    assert out.schema == docs.schema and out.count() == sum(r["copies"] for r in got)
    assert M.mix_sources(empty_frame(spark)).count() == 0 and M.mixed_documents(empty_frame(spark)).count() == 0
