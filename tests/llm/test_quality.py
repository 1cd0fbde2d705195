import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.helpers import edge_frame, edge_rows, empty_frame, words
from vantage.llm import quality as Q
from vantage.llm import textbuf as T


def brute(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = set()
    for i, t in enumerate(tri):
        if tri.count(t) > 1:
            hit |= {i, i + 1, i + 2}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def test_chunk_statistics_match_brute_force():
    rng = np.random.default_rng(1)
    parts = list("ab cé\n\n\t#$%  ") + ["the cat ", "the cat sat\n", "中 "]
    texts = ["".join(rng.choice(parts, rng.integers(0, 80))) for _ in range(400)] + ["", "\n", " x", "x\r\nx\r\n"]
    got = []
    for c in T.chunks(pa.array(texts), limit=500):
        s = Q.chunk_stats(c)
        got += list(zip(*[s[k].tolist() for k in Q.STATS], strict=True))
    assert got == [brute(t) for t in texts]


def test_forest_scores_outliers_higher():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 4))
    forest = Q.fit_forest(x)
    assert Q.forest_score(forest, np.full((1, 4), 8.0))[0] > np.quantile(Q.forest_score(forest, x), 0.99)


def test_calibration_keeps_good_rows():
    score = np.concatenate([np.linspace(0.3, 0.5, 1000), np.linspace(0.45, 0.9, 100)])
    good = np.arange(1100) < 1000
    cut = Q.calibrate(score, good)
    assert (score[good] <= cut).mean() >= 0.99 and (score[~good] > cut).mean() > 0.8
    assert Q.calibrate(score, np.ones(1100, bool)) == 0.75


def test_edges_and_filter(spark):
    docs = edge_frame(spark)
    rows = Q.quality_rules(docs).collect()
    assert len(rows) == len(edge_rows())
    want = sorted((str(r[0]), *brute(r[1])) for r in edge_rows() if len(r[1] or "") < 2000)
    got = sorted((str(r["doc_id"]), *[r[k] for k in Q.STATS]) for r in rows if r["word_chars"] < 2000 and r["n_words"] < 2000)
    assert got == want
    assert all(not r["kept"] for r in rows if r["base_failed"])
    kept = Q.quality_filter(docs)
    assert kept.schema == docs.schema
    assert kept.count() == sum(r["kept"] for r in rows)
    assert Q.quality_rules(empty_frame(spark)).count() == 0 and Q.quality_filter(empty_frame(spark)).count() == 0


def test_labelled_junk_goes_and_good_stays(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = Q.quality_rules(docs, labels).where("not base_failed").join(labels, "doc_id").groupBy("quality").agg({"kept": "count"}).collect()
    good = Q.quality_rules(docs, labels).where("not base_failed").join(labels.where("quality = 1"), "doc_id")
    assert got and good.where("kept").count() >= 0.97 * good.count()


def test_calibration_on_all_rows_matches_one_array(spark):
    rng = np.random.default_rng(4)
    for n, digits in ((3000, 9), (400, 2), (1, 3)):
        score = np.round(rng.beta(2, 5, n), digits)
        good = rng.random(n) > score
        rows = spark.createDataFrame([(float(s), bool(g)) for s, g in zip(score, good, strict=True)], "score double, good boolean").repartition(7)
        assert Q.calibrate_rows(rows) == Q.calibrate(score, good)


def test_trees_draw_from_all_rows(spark):
    stats = spark.range(40_000).select(*[F.col("id").alias(k) for k in ["doc_id", *Q.STATS, *Q.EXTRA]])
    draws = Q.tree_draws(stats, trees=200, subsample=256)
    assert [len(d) for d in draws] == [256] * 200
    words_ = {round(float(np.expm1(4 * v))) for d in draws for v in d[:, 8]}
    assert len(words_) > 16_384   # more rows than the forest used to see
