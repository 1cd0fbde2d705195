import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from vantage.llm import conversation as C
from vantage.llm.queries import REGISTRY

SCHEMA = "conv_id long, turn long, role string, text string"
COLS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
MOVES = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if d == 1:
            text = ""
        if d == 2:
            text = re.sub("[.!?]", "", text)
        if d == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    return out


def brute(rows):
    """Report of one conversation by plain recursion over (row, last role kept, inserted in a row)."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))

    @lru_cache(None)
    def best(i, at, added):
        """(cost, audit, lines) from row i on; equal audits have equal lines."""
        ways = []
        if i == len(rows) and at in ("", "a"):
            ways.append((0, "", ()))
        give = "assistant" if at == "u" else "user"
        if added < 3:
            c, a, t = best(i, give[0], added + 1)
            ways.append((c + 2, "I" + a, (give + ":", *t)))
        if i < len(rows):
            _, _, role, text = rows[i]
            c, a, t = best(i + 1, at, 0)
            ways.append((c + 3, "D" + a, t))
            if faults[i] not in ("blank", "duplicate"):
                extra = faults[i] == "truncated"
                to = MOVES[at].get(role[:1])
                if to:
                    c, a, t = best(i + 1, to, 0)
                    ways.append((c + extra, "K" + a, (f"{role}:{text}", *t)))
                c, a, t = best(i + 1, give[0], 0)
                ways.append((c + 2 + extra, "R" + a, (f"{give}:{text}", *t)))
        return min(ways, default=(10 ** 9, "", ()))

    cost, audit, lines = best(0, "", 0)
    n = {k: faults.count(k) for k in ("blank", "duplicate", "truncated")}
    return (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_all(rows, damaged):
    by = defaultdict(list)
    for r in damaged:
        by[r[0]].append(r)
    return sorted(((c, *brute(by[c])) for c in {r[0] for r in rows}), key=str)


def talks(seed=4, n=120):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        turn = rng.randrange(3)
        for _ in range(rng.choice([1, 2, 3, 5, 8, 13])):
            text = rng.choice(["Hi.", "yes", "Go on!", "", " \n", None, "wait. ", "no?\t", f"t{rng.randrange(5)}.", f"u{rng.randrange(9)}"])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            rows.append((conv, rng.choice([turn, turn, None]), role, text))
            turn += rng.choice([0, 1, 1, 2])
    return rows


def report(spark, rows, **settings):
    done = C.repair_conversations(spark.createDataFrame(rows, SCHEMA).repartition(4), **settings)
    sums = {r["conv_id"]: r["repaired_sha256"] for r in C.digests(done.rows).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return sorted(((*[r[c] for c in COLS[:-1]], sums.get(r["conv_id"], empty)) for r in done.report.collect()), key=str)


def plain(rows):
    return [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]


@pytest.mark.parametrize("bits", [0, 1, 2, 12])
def test_matches_brute_force_in_pieces_of_any_size(spark, bits):
    rows = talks()
    assert report(spark, rows, bits=bits) == brute_all(rows, plain(rows))


def test_long_runs(spark):
    rng = random.Random(9)
    rows = []
    for conv in range(6):
        for k in range(rng.choice([90, 131])):
            role = ["user", "assistant", "tool", "system"][(k // (conv + 1) ** 2) % 4] if conv else "user"
            rows.append((conv, k, role, f"{'' if conv % 2 else 'x'}{k}{'.' if conv < 4 else ''}"))
    want = brute_all(rows, plain(rows))
    assert report(spark, rows) == want and report(spark, rows, bits=3) == want


def test_run_lengths_match_row_by_row():
    """Binary powers, piece transitions and unrolled letters against one row at a time."""
    rng = random.Random(1)
    for _ in range(200):
        runs = [(rng.randrange(9), rng.choice([1, 2, 3, 7, 20])) for _ in range(rng.randrange(1, 6))]
        after = [rng.randrange(6) for _ in range(4)]
        single = [(s, 1) for s, n in runs for _ in range(n)]
        behind, v, total = C.chain(runs, after)
        behind1, v1, total1 = C.chain(single, after)
        assert (v, total) == (v1, total1)
        assert (C.transition(runs) + after).min(axis=1).tolist() == [x + total for x in v]
        for s in range(4):
            assert C.unroll(runs, behind, s) == C.unroll(single, behind1, s)


def test_query_matches_brute_force(spark, tmp_path):
    rows = talks(seed=8, n=200)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = REGISTRY["op12_conversation_repair"](spark, str(tmp_path)).collect()
    assert sorted((tuple(r[c] for c in COLS) for r in got), key=str) == brute_all(rows, damage(rows))


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = REGISTRY["op12_conversation_repair"](spark, sf).collect()
    assert sorted((tuple(r[c] for c in COLS) for r in got), key=str) == brute_all(rows, damage(rows))


def test_edges(spark):
    assert C.repair_conversations(spark.createDataFrame([], SCHEMA)).report.count() == 0
    assert C.repair_conversations(spark.createDataFrame([], SCHEMA)).rows.count() == 0
    clash = spark.createDataFrame([(1, 0, "user", "a." * 200_000, "x", 3, "y")], SCHEMA + ", conv string, pos int, seg string")
    done = C.repair_conversations(clash)
    r = done.report.first()
    assert (r["conv_id"], r["cost"], r["audit"]) == (1, 2, "KI")
    assert [(x["role"], x["edit"]) for x in sorted(done.rows.collect(), key=lambda x: (x["pos"], x["k"]))] == [("user", "K"), ("assistant", "I")]
    same = spark.createDataFrame([(7, 0, "user", "again.")] * 50, SCHEMA)
    assert C.repair_conversations(same, bits=2).report.first()["duplicate"] == 49
