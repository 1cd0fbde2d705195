import itertools
import random

from tests.llm.helpers import edge_frame, edge_rows, empty_frame, words
from vantage.llm import neardup as N


def shingles(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if x and y and 100 * len(x & y) >= 85 * len(x | y):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return sorted({(i, len(s), find(i)) for i, s in sets})


def check(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = N.near_duplicates(docs, **settings).collect()
    assert len(got) == len(rows)
    assert sorted({(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None}) == brute(rows)
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)


def test_families_chains_and_singles(spark):
    random.seed(4)
    rows, n = [], 0
    for family in range(12):
        base = [f"v{random.randrange(3000)}" for _ in range(random.choice([6, 9, 40, 150]))]
        for _ in range(random.randrange(1, 14)):
            w = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2, 5])):
                w[random.randrange(len(w))] = f"n{random.randrange(10**6)}"
            rows.append((n, " ".join(w)))
            n += 1
        # a chain: each member differs a little from the one before it
        w = list(base)
        for _ in range(6):
            w = w[1:] + [f"c{random.randrange(10**6)}"]
            rows.append((n, " ".join(w)))
            n += 1
    random.shuffle(rows)
    check(spark, rows)


def test_crowded_lists_need_the_exact_rest(spark):
    """Many documents share most text without all being linked: star rounds alone cannot settle them."""
    random.seed(9)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(60):
        w = list(base)
        for j in random.sample(range(60), random.choice([1, 1, 2])):
            w[j] = f"q{random.randrange(40)}"
        rows.append((i, " ".join(w)))
    check(spark, rows, star_rounds=1)
    check(spark, rows, star_rounds=1, small_list=10**6)
    check(spark, rows, star_rounds=1, small_list=0)


def test_chains_in_crowded_lists(spark):
    """Links among members that are all too far from the hub, and sizes that differ."""
    random.seed(10)
    base = [f"b{i}" for i in range(50)]
    rows = []
    for i in range(70):
        w = list(base)
        for j in random.sample([3, 11, 19, 27, 35, 43], random.choice([0, 1, 2, 3])):
            w[j] = f"q{j}x{random.randrange(2)}"
        rows.append((i, " ".join(w[random.choice([0, 0, 1, 2]):50 - random.choice([0, 0, 1, 3])])))
    for rounds in (1, 2):
        check(spark, rows, star_rounds=rounds, small_list=0)


def test_edges(spark):
    got = N.near_duplicates(edge_frame(spark)).collect()
    assert len(got) == len(edge_rows())
    want = {i: (n, c) for i, n, c in brute([r[:2] for r in edge_rows() if r[0] is not None and len(r[1] or "") < 60_000])}
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        elif r["doc_id"] in want:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
    assert N.near_duplicates(empty_frame(spark)).count() == 0


def test_components_follow_long_chains(spark):
    n = 500
    edges = [(i, i + 1) for i in range(0, n) if i % 100 != 99] + [(7, 3), (3, 7), (5, 5)]
    got = {r["node"]: r["label"] for r in N.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == i // 100 * 100 for i in got) and len(got) == n


def test_one_of_each_group_judges_id_and_text(spark):
    a, b, c = (" ".join(f"{p}{i}" for i in range(40)) for p in "abc")
    rows = [(1, a, "x"), (1, b, "x"), (1, a, "x"), (2, a + " tail", "y"), (3, c, "z"), (None, c, "n"), (None, c + " more words here to differ a lot " * 9, "n"),
            (4, None, "e"), (4, None, "e"), (4, "", "e"), (5, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, uid string").repartition(3)
    got = sorted(map(str, (tuple(r) for r in N.one_of_each_group(docs).collect())))
    assert got == sorted(map(str, [(1, a, "x"), (1, b, "x"), (3, c, "z"), rows[6], (4, None, "e"), (4, "", "e"), (5, "", "e")]))
    assert N.one_of_each_group(empty_frame(spark)).count() == 0


def test_rounds_without_new_links_leave_the_components(spark, monkeypatch):
    """One pair links in the first round, nothing after: the labels are made once, and no crowded list is looked into."""
    random.seed(31)
    bits = [[f"p{i}x{j}" for j in range(30)] for i in range(4)]
    rows = []
    for i in range(8):  # 30 shared words in a text of 90: far below the threshold
        rows.append((i, " ".join([f"a{i}y{j}" for j in range(60)] + bits[i % 4])))
    rows.append((100, rows[0][1] + " end"))
    made, looked = [], []
    was = N.components
    monkeypatch.setattr(N, "components", lambda edges: made.append(1) or was(edges))
    monkeypatch.setattr(N, "_crowded_lists", lambda *a: looked.append(1))
    check(spark, rows)
    assert len(made) == 1 and not looked
