import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import edge_frame, edge_rows, empty_frame
from vantage.llm import pii
from vantage.llm.common import stage

RX = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
      "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
      "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
      "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def brute(text):
    out = []
    for kind, rx in RX.items():
        for m in rx.finditer(text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                  "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def texts():
    random.seed(7)
    bits = ["a.b@c.de", "x@y", "@", "x@y.z@w.v", "a@b.c%d@e.f", "q@w..e", "é@b.cd", "1.2.3.4", "256.1.1.1", "001.02.3.4", "1.2.3.4.5.6.7.8",
            "1.2.3", "999999999999.1.1.1", "4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1112", "12 34", "+1 (542) 555-3599",
            "+49 30 1234567", "+1((((", "+1 2", "++12345678901", "中文", "😀", " ", "  ", "\n", "word", "5", "-", ".", "call 555-123-4567",
            "password=abcdef0123456789abcd", "Dr. John Smith", "078-05-1120", "version 1.2.3.4"]
    out = ["".join(random.choice(bits) + random.choice(["", " ", ", "]) for _ in range(random.randrange(0, 25))) for _ in range(300)]
    return out + ["", " ", "1.2.3.4 " * 700, "a" * 20_000, "9" * 5000, "a@b" + ".c" * 4000, "1." * 5000]


def test_base_spans_match_brute_force(spark):
    t = texts()
    docs = spark.createDataFrame(list(enumerate(t)), "doc_id long, text string").repartition(4)
    for r in pii.find_pii(docs).collect():
        base = [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] in pii.BASE]
        assert base == brute(t[r["doc_id"]]), t[r["doc_id"]]


def test_no_python_in_the_plan(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = pii.redact(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_digest_and_edges(spark):
    rows = edge_rows()
    got = pii.find_pii(edge_frame(spark)).select("doc_id", pii.digest(F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))).alias("d"))
    want = sorted((str(r[0]), ",".join(f"{k}:{a}:{b}" for k, a, b in brute(r[1]))) for r in rows)
    assert sorted((str(r["doc_id"]), r["d"]) for r in got.collect()) == want
    assert pii.find_pii(empty_frame(spark)).count() == 0
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit(""), 256)).first()[0]


def test_redaction_replaces_spans_only(spark):
    t = ["mail a.b@c.de now", "no data here", None, "", "😀 ip 10.20.30.40 and +1 (542) 555-3599.", "a@b.cd,e@f.gh"]
    docs = spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert got == {0: "mail [EMAIL] now", 1: "no data here", 2: None, 3: "", 4: "😀 ip [IP] and [PHONE].", 5: "[EMAIL],[EMAIL]"}


def test_reliabilities_prefer_the_better_labeler():
    random.seed(3)
    counts = {}
    for _ in range(4000):
        y = random.random() < 0.4
        vote = lambda acc: (1 if y else -1) if random.random() < acc else (-1 if y else 1)  # noqa: E731, B023
        v = (vote(0.95), vote(0.9), vote(0.85), vote(0.55))
        counts[v] = counts.get(v, 0) + 1
    rows = [dict(zip(pii.LABELERS, v, strict=True)) | {"n": n} for v, n in counts.items()]
    _, chance = pii.reliabilities(rows)
    power = [chance[k][1][0] - chance[k][1][1] for k in pii.LABELERS]
    assert power[0] > power[1] > power[2] > power[3]


def test_recall_of_the_further_kinds(spark, sf):
    """Planted spans of each further kind among the given texts: nearly all are found, ordinary words are left alone."""
    rng = random.Random(4)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    upper = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(n))
    make = {
        "secret": [lambda: f"API_KEY={hexa(24)}", lambda: f"Password: Tr0ub4dor{rng.randrange(99)}x", lambda: f'token = "{hexa(40)}"',
                   lambda: f"secret_key: '{hexa(20)}Z'"],
        "key": [lambda: f"AKIA{upper(16)}", lambda: f"ghp_{hexa(36)}", lambda: f"sk-{hexa(32)}"],
        "name": [lambda: f"Dr. {rng.choice(['Mary', 'John', 'Anna'])} Smith{rng.choice('abc')}"],
        "national_id": [lambda: f"{rng.randrange(100, 600)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}"],
        "phone_local": [lambda: f"call 555-{rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}"],
    }
    base = [r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    rows = []
    for i in range(300):
        kind = rng.choice(list(make))
        words = rng.choice(base).split()[:80]
        words.insert(rng.randrange(len(words) + 1), rng.choice(make[kind])())
        rows.append((i, " ".join(words), kind))
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string").repartition(3)
    got = {r["doc_id"]: {x["kind"] for x in r["spans"]} for r in pii.find_pii(docs).collect()}
    for kind in make:
        mine = [i for i, _, k in rows if k == kind]
        assert sum(kind in got[i] for i in mine) >= 0.9 * len(mine), kind
    plain = [(i, t) for i, t in enumerate(["the password is secret", "token ring", "my secret garden", "sk-ip this", "eyJust", "AKIA"] * 20)]
    clean = pii.find_pii(spark.createDataFrame(plain, "doc_id long, text string")).collect()
    assert not any(r["spans"] for r in clean)


def test_the_fit_is_one_job_on_the_vote_table(spark):
    """The classifier's steps make no jobs: each one broadcast its coefficients and tasks, which filled the driver."""
    random.seed(3)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    found = stage(docs.select(pii.candidates(F.coalesce("text", F.lit(""))).alias("spans")), "t")
    sc = spark.sparkContext
    sc.setJobGroup("pii-fit", "fit")
    model = pii.fit(found)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert model is not None and len(sc.statusTracker().getJobIdsForGroup("pii-fit")) <= 4


def test_logistic_finds_the_least_regularised_loss(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    rng = np.random.default_rng(5)
    x = (rng.random((60, 5)) < 0.4).astype(float)
    x[:, 4] = 1.0  # a constant column stays without weight
    p = np.clip(1 / (1 + np.exp(-(x @ [4.0, -3.0, 1.0, 0.0, 0.0]))), 1e-3, 1 - 1e-3)
    n = rng.integers(1, 1000, 60).astype(float)
    both, y, w = np.concatenate([x, x]), np.repeat([1.0, 0.0], 60), np.concatenate([n * p, n * (1 - p)])
    got, bias = pii.logistic(both, y, w)
    frame = spark.createDataFrame([(float(a), float(b), *map(float, r)) for a, b, r in zip(y, w, both, strict=True)],
                                  "label double, weight double, " + ", ".join(f"x{i} double" for i in range(5))).coalesce(1)
    frame = VectorAssembler(inputCols=[f"x{i}" for i in range(5)], outputCol="features").transform(frame)
    want = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=200, tol=1e-10, standardization=False).fit(frame)
    assert np.allclose(got, want.coefficients.toArray(), atol=1e-4) and abs(bias - want.intercept) < 1e-4
