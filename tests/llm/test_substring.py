import hashlib
import random
from collections import Counter

import numpy as np

from tests.llm.helpers import edge_frame, edge_rows, empty_frame, words
from vantage.llm import substring as S
from vantage.llm import textbuf as T


def brute(texts, window):
    seen = Counter()
    lists = [words(t) for t in texts]
    for w in lists:
        seen.update(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    out = []
    for w in lists:
        cut = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                cut |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in cut)
        out.append((len(w), len(cut), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def corpus():
    random.seed(11)
    word = lambda: f"v{random.randrange(4000)}"
    passage = [[word() for _ in range(n)] for n in (34, 35, 36, 50, 90, 400)]
    texts = []
    for _ in range(70):
        w = []
        for _ in range(random.randrange(1, 5)):
            w += [word() for _ in range(random.randrange(0, 60))]
            p = random.choice(passage)
            a = random.randrange(0, len(p) // 2)
            w += random.choice([p, p[a:], p[:len(p) - a], []])
        texts.append(random.choice([" ", "\n", " \t"]).join(w))
    texts += ["same " * 500, "same " * 36, "same " * 35, "ab cd " * 300, texts[0], texts[0], "", " "]
    return texts


def run(spark, texts, **settings):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = sorted(S.remove_repeats(docs, **settings).collect(), key=lambda r: r["doc_id"])
    return [(r["n_words"], r["n_removed"], r["kept_sha256"], r["kept_text"]) for r in rows]


def test_matches_brute_force(spark):
    texts = corpus()
    assert run(spark, texts, shard_words=3000) == brute(texts, 35)


def test_hot_minimizers_are_split_by_window(spark):
    texts = corpus()
    assert run(spark, texts, shard_words=20_000, hot=2) == brute(texts, 35)


def test_index_intervals_match_brute_force():
    rng = np.random.default_rng(0)
    for trial in range(6):
        base = [rng.integers(0, 40, rng.integers(36, 200)) for _ in range(3)]
        segs = [np.concatenate([rng.integers(0, 40, rng.integers(0, 30)), base[rng.integers(3)][rng.integers(0, 20):],
                                np.full(rng.integers(0, 150) * (trial % 2), 7)]) for _ in range(10)]
        weight = rng.integers(1, 3, len(segs))
        seq, a, b = S.shard_intervals([S._codes(T.mix(x.astype(np.uint64) + np.uint64(9))).tobytes() for x in segs], weight, 35)
        got = {(int(s), k) for s, i, j in zip(seq, a, b, strict=True) for k in range(i, j - 34)}
        seen = Counter()
        for x, n in zip(segs, weight, strict=True):
            for k in range(len(x) - 34):
                seen[tuple(x[k:k + 35])] += n
        assert got == {(i, k) for i, x in enumerate(segs) for k in range(len(x) - 34) if seen[tuple(x[k:k + 35])] > 1}


def test_edges(spark):
    rows = edge_rows()
    got = sorted(((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in S.remove_repeats(edge_frame(spark)).collect()))
    want = sorted((str(r[0]), *b[:3]) for r, b in zip(rows, brute([r[1] for r in rows], 35), strict=True))
    assert got == want
    assert S.remove_repeats(empty_frame(spark)).count() == 0
