"""Language identification: the family first, then one-versus-one linear SVMs within it.

Features are hashed byte trigrams of letters (case folded, everything else a blank),
counted by numpy over Arrow batches.  The models are fitted on a bounded sample of
labelled rows (``per_lang`` documents a language, smallest hash first) and travel in the
task closures; every text is scored as a whole, in one scan, without a shuffle.

Defined results: ``und`` with score 0 for null texts and texts without a letter, and for
all texts when nothing can be learned; repeated rows are scored each; a null id is
neither held out nor learned from; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textbuf as T
from .common import stage, unit

PER_LANG, BUCKETS, ROWS_AT_ONCE = 600, 4096, 256

# fixed values: family of each language code; others are families of their own
FAMILIES = {
    "germanic": ["da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
}

FOLD = np.full(256, 0x20, np.uint8)
FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
FOLD[0x80:] = np.arange(0x80, 0x100)


def family_of(lang: str, families: dict[str, list[str]]) -> str:
    return next((f for f, members in families.items() if lang in members), lang)


def trigram_counts(c: T.Chunk, buckets: int = BUCKETS) -> np.ndarray:
    """Documents x buckets counts of hashed trigrams; a trigram never spans two documents."""
    b = FOLD[c.buf]
    if len(b) > 1:  # capital accented letters of the Latin-1 block (C3 80..9E) folded too
        up = np.flatnonzero((b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97))
        b[up + 1] += 0x20
    v = b.astype(np.uint32)
    n = max(len(v) - 2, 0)
    tri = (v[:n] << 16) | (v[1:n + 1] << 8) | v[2:n + 2]
    blank = (v[:n] == 0x20).astype(np.uint8) + (v[1:n + 1] == 0x20) + (v[2:n + 2] == 0x20)
    doc = np.repeat(np.arange(c.n), np.diff(c.offsets))
    ok = (blank < 2) & (doc[:n] == doc[2:n + 2])
    f = ((tri[ok] * np.uint32(0x9E3779B1)) >> np.uint32(7)) % np.uint32(buckets)
    return np.bincount(doc[:n][ok] * buckets + f, minlength=c.n * buckets).reshape(c.n, buckets)


def parts(c: T.Chunk, rows: int = ROWS_AT_ONCE):
    """A chunk of very many short documents in smaller ones: the count matrix stays bounded."""
    for i in range(0, c.n, rows):
        off = c.offsets[i:i + rows + 1]
        yield T.Chunk(c.first_row + i, c.buf[off[0]:off[-1]], off - off[0])


def _scaled(counts: np.ndarray) -> np.ndarray:
    x = np.sqrt(counts.astype(np.float32))
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.hstack([x / np.maximum(norm, 1e-9), np.ones((len(x), 1), np.float32)])


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 60, seed: int = 3) -> np.ndarray:
    """Linear SVM (squared hinge) by dual coordinate descent; ``y`` is +1 / -1."""
    rng = np.random.default_rng(seed)
    a, w = np.zeros(len(x)), np.zeros(x.shape[1])
    q = (x.astype(float) ** 2).sum(axis=1) + 0.5 / c
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(x)):
            g = y[i] * float(x[i] @ w) - 1 + 0.5 * a[i] / c
            if a[i] > 0 or g < 0:
                new = max(a[i] - g / q[i], 0.0)
                worst = max(worst, abs(new - a[i]))
                w += (new - a[i]) * y[i] * x[i]
                a[i] = new
        if worst < 1e-3:
            break
    return w


def fit(x: np.ndarray, langs: list[str], families: dict[str, list[str]]) -> dict:
    """Family model (log odds of trigrams, smoothed) and pairwise SVMs inside each family."""
    names = sorted(set(langs))
    fam = [family_of(v, families) for v in langs]
    fams = sorted(set(fam))
    lang_arr, fam_arr = np.array(langs), np.array(fam)
    logp = []
    for f in fams:
        # languages of a family count alike, however many rows each has
        share = sum(x[lang_arr == v].sum(axis=0) / max(x[lang_arr == v].sum(), 1) for v in names if family_of(v, families) == f)
        share = share / share.sum() if share.sum() else np.full(x.shape[1], 1.0 / x.shape[1])
        logp.append(np.log(0.999 * share + 0.001 / x.shape[1]))
    xs = _scaled(x)
    pairs = []
    for f in fams:
        mine = [v for v in names if family_of(v, families) == f]
        for a, b in itertools.combinations(mine, 2):
            rows = np.flatnonzero((lang_arr == a) | (lang_arr == b))
            pairs.append((a, b, linear_svm(xs[rows], np.where(lang_arr[rows] == a, 1.0, -1.0)).astype(np.float32)))
    return {"fams": fams, "logp": np.array(logp).T, "langs": names, "family": [family_of(v, families) for v in names], "pairs": pairs}


def predict(model: dict, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language index and score of every row of counts."""
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    ll = counts @ model["logp"] / np.sqrt(total)  # tempered: neighbouring trigrams are not independent
    ll -= ll.max(axis=1, keepdims=True)
    p = np.exp(ll)
    p /= p.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    xs = _scaled(counts)
    at = {v: i for i, v in enumerate(model["langs"])}
    votes = np.zeros((len(counts), len(at)))
    conf = np.zeros((len(counts), len(at)))
    rivals = np.zeros(len(at))
    for a, b, w in model["pairs"]:
        margin = xs @ w
        s = 1 / (1 + np.exp(-4 * np.clip(margin, -20, 20)))
        votes[:, at[a]] += margin >= 0
        votes[:, at[b]] += margin < 0
        conf[:, at[a]] += s
        conf[:, at[b]] += 1 - s
        rivals[at[a]] += 1
        rivals[at[b]] += 1
    conf = np.where(rivals > 0, conf / np.maximum(rivals, 1), 1.0)
    inside = np.array([[f == g for g in model["family"]] for f in model["fams"]])[best]
    pick = np.where(inside, votes + conf * 0.5, -1.0).argmax(axis=1)
    rows = np.arange(len(counts))
    # six digits: what the summation order of a batch decides is cut off, so that reruns agree
    return pick, np.round(np.clip(p[rows, best] * conf[rows, pick], 0.0, 1.0), 6)


def held_out_fold(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def identify_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      per_lang: int = PER_LANG, buckets: int = BUCKETS,
                      families: dict[str, list[str]] = FAMILIES) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; rows held out are never learned from."""
    view = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                       held_out_fold(F.col(id_col)).alias("held_out"))
    learn = view.where(~F.col("held_out") & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()
                       & F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)))
    # texts are drawn, not rows: copies count once, and a shared id cannot take a language away
    per = stage(learn.select("lang", F.xxhash64("text").alias("h")).distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang-counts")
    thin = learn.join(per, "lang").where(unit("lang", "text") < 2.0 * per_lang / F.col("n"))

    def count(batches):
        for b in batches:
            for chunk in T.chunks(b.column("text")):
                for c in parts(chunk):
                    x = np.minimum(trigram_counts(c, buckets), 65535).astype(np.uint16)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("lang").slice(c.first_row, c.n), b.column("h").slice(c.first_row, c.n),
                         pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "h", "x"])

    first = Window.partitionBy("lang").orderBy("h")
    sample = thin.groupBy("lang", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text")) \
        .withColumn("k", F.row_number().over(first)).where(F.col("k") <= per_lang).drop("k") \
        .mapInArrow(count, "lang string, h long, x binary").orderBy("lang", "h").collect()
    model = None
    if sample:
        model = fit(np.stack([np.frombuffer(r["x"], np.uint16) for r in sample]).astype(float), [r["lang"] for r in sample], families)
    id_type = view.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            ok = b.column("known").to_numpy(zero_copy_only=False)
            for chunk in T.chunks(b.column("text")):
                for c in parts(chunk):
                    known = ok[c.first_row:c.first_row + c.n]
                    lang = np.full(c.n, "und", object)
                    score = np.zeros(c.n)
                    if model is not None and known.any():
                        pick, s = predict(model, trigram_counts(c, buckets))
                        lang = np.where(known, np.array(model["langs"], object)[pick], "und")
                        score = np.where(known, s, 0.0)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(x).slice(c.first_row, c.n) for x in ("doc_id", "held_out")] + [pa.array(lang, pa.string()), pa.array(score)],
                        names=["doc_id", "held_out", "lang_pred", "score"])

    known = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    return view.select("doc_id", "held_out", F.coalesce("text", F.lit("")).alias("text"), known.alias("known")) \
        .mapInArrow(run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")
