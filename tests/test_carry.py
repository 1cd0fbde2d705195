import math
import random
from collections import Counter, defaultdict
from contextlib import contextmanager

import pytest

from vantage.operators import carry as C

SCHEMA = "u long, t long, v string, b int, x double, y double, a int, r double"


@contextmanager
def many_tasks(spark, n=16):
    """Range partitions stay as they are cut, and batches are small."""
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": str(n),
            "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for t in range(500):  # a hot group, a null group, small ones; long runs
        u = rng.choice([1, 1, 1, 1, None, None, 2, 3, 4, 5])
        v = rng.choice(["p", "q", None]) if rng.random() < 0.3 or t < 250 else "p"
        out.append((u, t, v, int(rng.random() < 0.8), rng.random(), rng.random(), rng.randrange(3), float(rng.randrange(9))))
    out += [(9, 1000 + t, "p", 1, 0.0, 0.0, 0, 1.0) for t in range(60)] + [(8, 2000 + t, "q", 0, 0.0, 0.0, 0, 1.0) for t in range(60)]
    rng.shuffle(out)
    return out


def groups(rows):
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: r[1]):
        by[r[0]].append(r)
    return by


def test_runs(spark, rows):
    want = {}
    for u, rs in groups(rows).items():
        n = 0
        for i, r in enumerate(rs):
            n = n + 1 if i and rs[i - 1][2] == r[2] else 1
            want[u, r[2]] = max(want.get((u, r[2]), 0), n)
    with many_tasks(spark):
        got = C.run_records(spark.createDataFrame(rows, SCHEMA), "u", ["t"], "v").groupBy("u", "v").max("longest").collect()
    assert {(r[0], r[1]): r[2] for r in got} == want


def test_edge_counts(spark, rows):
    want = {}
    for u, rs in groups(rows).items():
        bits = "".join(str(r[3]) for r in rs)
        want[u] = (len(bits), len(bits) - len(bits.lstrip("1")), len(bits) - len(bits.rstrip("0")))
    with many_tasks(spark):
        got = C.edge_counts(spark.createDataFrame(rows, SCHEMA), "u", ["t"], "b").collect()
    assert {r["u"]: (r["n"], r["head"], r["tail"]) for r in got} == want


def test_path_lengths(spark, rows):
    with many_tasks(spark):
        got = {r["u"]: (r["n"], r["length"]) for r in C.path_lengths(spark.createDataFrame(rows, SCHEMA), "u", ["t"], "x", "y").collect()}
    assert len(got) == len(groups(rows))
    for u, rs in groups(rows).items():
        p = [(r[4], r[5]) for r in rs]
        assert got[u] == (len(p), pytest.approx(sum(math.dist(a, b) for a, b in zip(p, p[1:] + p[:1], strict=True))))


@pytest.mark.parametrize("group", ["u", None])
def test_step_counts(spark, rows, group):
    n, total = Counter(), Counter()
    for rs in (groups(rows) if group else {0: sorted(rows, key=lambda r: r[1])}).values():
        for r, nxt in zip(rs, rs[1:] + [None], strict=True):
            key = (r[2], r[6], nxt[2] if nxt else None)
            n[key] += 1
            total[key] += r[7]
    with many_tasks(spark):
        got = C.step_counts(spark.createDataFrame(rows, SCHEMA), group, ["t"], "v", "a", "r").collect()
    assert {(r["s"], r["a"], r["s2"]): (r["n"], r["rs"]) for r in got} == {k: (n[k], total[k]) for k in n}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert C.run_records(df, "u", ["t"], "v").count() == 0 and C.edge_counts(df, "u", ["t"], "b").count() == 0
    assert C.path_lengths(df, "u", ["t"], "x", "y").count() == 0 and C.step_counts(df, None, ["t"], "v", "a", "r").count() == 0
