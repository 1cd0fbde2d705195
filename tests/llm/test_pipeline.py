import itertools
import random

import corpus_pipeline as P
from tests.llm.helpers import edge_frame, empty_frame, words
from tests.llm.test_neardup import brute, shingles
from tests.llm.test_packing import check_sequences
from vantage.llm.common import stage


def test_stages_on_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    q = stage(P.quality(spark, docs, sf), "t")
    assert q.columns == columns and all(len(words(r["text"])) >= 50 for r in q.collect()) and q.count() > 0.7 * docs.count()
    d = stage(P.near_dedup(spark, q, sf), "t")
    want = {c for _, _, c in brute([(r["doc_id"], r["text"]) for r in q.collect()])}
    assert {r["doc_id"] for r in d.collect()} == want and d.columns == columns
    p = stage(P.pii(spark, d, sf), "t")
    assert p.columns == columns and p.count() == d.count() and p.where("text like '%@mail%'").count() == 0
    m = stage(P.mix(spark, p, sf), "t")
    assert m.columns == columns and m.groupBy("doc_id").count().where("count > 3").count() == 0
    k = P.packing(spark, m, sf).collect()
    check_sequences(k)
    assert sum(r["piece"] == 0 for r in k) == m.count()


def test_run_and_edges(spark, sf):
    assert P.run(spark, sf).count() > 0
    for make in (edge_frame, empty_frame):
        docs = make(spark).select("doc_id", "text", "lang", "source", "n_chars")
        for name, step in P.STAGES:
            docs = stage(step(spark, docs, sf), f"t-{name}")
        docs.count()


def test_near_copies_from_eighty_per_cent(spark, sf):
    """Families whose similarities run from 0.75 to 0.9: a pair from 0.80 on is linked in the stage."""
    random.seed(21)
    rows, n = [], 0
    for _ in range(25):
        base = [f"v{random.randrange(5000)}" for _ in range(104)]  # 100 shingles
        rows.append((n, " ".join(base)))
        for cut in range(9, 14):  # one changed end of `cut` words: 100 - cut shingles of 100 + cut are shared
            rows.append((n + 1000 * cut, " ".join(base[:104 - cut] + [f"n{random.randrange(10**6)}" for _ in range(cut)])))
        n += 1
    sets = {i: shingles(t) for i, t in rows}
    want = {}
    for i in sets:
        want[i] = i
    for a, b in sorted(itertools.combinations(sorted(sets), 2)):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and want[a] != want[b]:
            lo, hi = sorted((want[a], want[b]))
            want = {i: lo if c == hi else c for i, c in want.items()}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"] for r in dict(P.STAGES)["near_dedup"](spark, docs, sf).collect()}
    assert got == set(want.values())
    assert got != {c for _, _, c in brute(rows)}  # 0.85 keeps more
