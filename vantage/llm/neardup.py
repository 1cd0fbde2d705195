"""Near-duplicates by a signature-coordinate inverted join, links confirmed on full shingle sets.

Every distinct shingle set gets a MinHash signature of ``coords`` values and is
posted under each (coordinate, value) pair.  Two sets of similarity ``threshold``
agree on about ``threshold * coords`` coordinates; pairs with fewer than
``need`` agreements (six standard deviations below) are not retained.  A pair with
``need`` agreements must meet in the ``coords - need + 1`` rarest pairs of both
(prefix), so only those are posted; pairs of one component are skipped in merging.

No list of links is ever expanded:

* documents with equal sets are one class before anything is posted;
* a set whose shingles are to more than the tolerated share its own (no other posted set
  has them) can link with nobody and leaves the lists; the same bound is held against pairs;
* star rounds compare each member of a posting list with one hub only, the member with the
  fewest shingles of its own; members already in the hub's component are done;
* what is left are lists that hold several components: members outside a list's largest
  component look for partners, in small lists one by one, in crowded ones through the
  shingles in which they differ from the hub (see ``_crowded_lists``); every cross-component
  pair that shares a prefix pair and can reach the threshold is judged, and none within one.

Defined results: null or empty texts have no set and link with nothing; equal
sets link (also texts shorter than five words, which are one shingle as a
whole); repeated rows link with each other; a null id takes no part in linking
and gets a null component and ``kept`` true; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbuf as T
from .common import documents_view, stage

SHINGLE, THRESHOLD, COORDS, STAR_ROUNDS, SMALL_LIST, SALTS = 5, 85, 64, 2, 8, 8


def agreements_needed(threshold: int, coords: int) -> int:
    """Six standard deviations below the expected agreements at the threshold."""
    j = threshold / 100
    return max(1, math.ceil(coords * j - 6 * math.sqrt(coords * j * (1 - j))))


def shingle_sets(c: T.Chunk, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all documents of a chunk, and the offsets between documents."""
    w = T.words(c, lower=True)
    g, at = T.grams(w, k)
    first = np.searchsorted(at, w.first)
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))
    whole = T.span_hash(T.prefix(w.hash), w.first[short], w.first[short + 1])
    at_short = dict(zip(short.tolist(), whole, strict=True))
    sets = []
    for d in range(c.n):
        s = np.sort(g[first[d]:first[d + 1]])
        if len(s):
            s = s[np.append(True, s[1:] != s[:-1])]
        elif d in at_short:
            s = np.array([at_short[d]], np.uint64)
        sets.append(s)
    off = np.zeros(c.n + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=off[1:])
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), off


def signatures(values: np.ndarray, off: np.ndarray, coords: int) -> np.ndarray:
    """MinHash signatures (non-negative int32) of the non-empty sets."""
    rng = np.random.default_rng(12345)
    a = rng.integers(0, 1 << 32, coords, dtype=np.uint32) | np.uint32(1)
    x = rng.integers(0, 1 << 32, coords, dtype=np.uint32)
    starts = off[:-1][np.diff(off) > 0]
    h = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), coords), np.int32)
    for i in range(coords):
        v = (h ^ x[i]) * a[i]
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x846CA68B)
        out[:, i] = (np.minimum.reduceat(v, starts) >> np.uint32(1)).astype(np.int32) if len(starts) else 0
    return out


def fingerprints(docs: DataFrame, id_col: str, text_col: str, k: int, coords: int) -> DataFrame:
    """doc_id, set size, 128-bit set digest and signature (null for an empty set) of every document."""
    view = documents_view(docs, id_col, text_col)
    id_type = view.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for c in T.chunks(b.column("text")):
                values, off = shingle_sets(c, k)
                size = np.diff(off)
                d = []
                for salt in (np.uint64(0x51ED270B), np.uint64(0xB5297A4D)):
                    run_sum = np.zeros(len(values) + 1, np.uint64)
                    np.cumsum(T.mix(values ^ salt), out=run_sum[1:])
                    d.append((run_sum[off[1:]] - run_sum[off[:-1]]).view(np.int64))
                sig = np.zeros((c.n, coords), np.int32)
                sig[size > 0] = signatures(values, off, coords)
                lists = pa.ListArray.from_arrays(np.arange(0, c.n * coords + 1, coords, dtype=np.int32), sig.ravel())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(c.first_row, c.n), pa.array(size), pa.array(d[0]), pa.array(d[1]), lists],
                    names=["doc_id", "n_shingles", "d1", "d2", "sig"])

    return view.mapInArrow(run, f"doc_id {id_type}, n_shingles long, d1 long, d2 long, sig array<int>")


def full_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """Sorted shingle sets (array of long) of the documents in ``ids`` (column node)."""
    view = documents_view(docs, id_col, text_col).join(ids.select(F.col("node").alias("doc_id")), "doc_id")
    id_type = view.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for c in T.chunks(b.column("text")):
                values, off = shingle_sets(c, k)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(c.first_row, c.n),
                     pa.ListArray.from_arrays(off.astype(np.int32), values.view(np.int64))], names=["node", "members"])

    return view.mapInArrow(run, f"node {id_type}, members array<bigint>")


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` (smallest node of the component) for every node of ``edges`` (u, v).

    Each round hooks every node to its smallest neighbour, follows those pointers
    to their ends by doubling, and contracts the edges; the number of nodes left
    falls at least by half a round.
    """
    live = stage(edges.select("u", "v").where("u <> v").distinct(), "cc-edges")
    maps: list[DataFrame] = []
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("p"))
                       .select(F.col("u").alias("node"), F.col("p")), "cc-parent")
        while True:
            up = parent.select(F.col("node").alias("p"), F.col("p").alias("pp"))
            jumped = stage(parent.join(up, "p").select("node", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")),
                           "cc-jump")
            parent = jumped.select("node", "p")
            if jumped.where("moved").isEmpty():
                break
        maps.append(parent)
        a = parent.select(F.col("node").alias("u"), F.col("p").alias("pu"))
        b = parent.select(F.col("node").alias("v"), F.col("p").alias("pv"))
        live = stage(live.join(a, "u").join(b, "v").where("pu <> pv")
                     .select(F.greatest("pu", "pv").alias("u"), F.least("pu", "pv").alias("v")).distinct(), "cc-edges")
    if not maps:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).limit(0)
    out = maps[0].select("node", F.col("p").alias("label"))
    for m in maps[1:]:
        out = out.join(m.select(F.col("node").alias("label"), F.col("p").alias("up")), "label", "left") \
            .select("node", F.coalesce("up", "label").alias("label"))
    return stage(out, "cc-labels")


def _verified(pairs: DataFrame, sigs: DataFrame, sets: DataFrame, need: int, threshold: int) -> DataFrame:
    """The pairs (u, v) whose signatures agree often enough and whose full sets reach the threshold."""
    a = sigs.select(F.col("node").alias("u"), F.col("sig").alias("su"))
    b = sigs.select(F.col("node").alias("v"), F.col("sig").alias("sv"))
    agree = F.expr("size(filter(zip_with(su, sv, (x, y) -> x = y), e -> e))")
    near = stage(pairs.join(a, "u").join(b, "v").where(agree >= need).select("u", "v"), "near-pairs")
    a = sets.select(F.col("node").alias("u"), F.col("members").alias("mu"))
    b = sets.select(F.col("node").alias("v"), F.col("members").alias("mv"))
    both = F.size(F.array_intersect("mu", "mv"))
    return stage(near.join(a, "u").join(b, "v").withColumn("i", both)
                 .where(100 * F.col("i") >= threshold * (F.size("mu") + F.size("mv") - F.col("i")))
                 .select("u", "v"), "near-links")


def _reach(sets: DataFrame, threshold: int) -> DataFrame:
    """node, size, common (shingles that some other set of the table has too) and own share of the sets that
    can still reach the threshold with anyone.

    All partners a set can have are in the table, so a set with too many shingles of its own links with nobody.
    """
    lone = sets.select("node", F.explode("members").alias("s")).groupBy("s") \
        .agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1") \
        .groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    sized = sets.select("node", F.size("members").cast("long").alias("size"))
    return sized.join(lone, "node", "left").withColumn("own", F.coalesce("own", F.lit(0))) \
        .select("node", "size", (F.col("size") - F.col("own")).alias("common"), (F.col("own") / F.col("size")).alias("own")) \
        .where(100 * F.col("common") >= threshold * F.col("size"))


def _small_list_pairs(outside: DataFrame, at: DataFrame, close, small_list: int) -> DataFrame:
    """Cross-component pairs of the lists of at most ``small_list`` members, as they are."""
    others = at.select("token", F.col("node").alias("node2"), F.col("label").alias("label2"),
                       F.col("size").alias("size2"), F.col("common").alias("common2"))
    return outside.where(F.col("listed") <= small_list).drop("node2", "size2", "common2", "main", "listed").join(others, "token") \
        .where(F.col("label") != F.col("label2")).where(close) \
        .select(F.greatest("node", "node2").alias("u"), F.least("node", "node2").alias("v"))


def _crowded_lists(crowded: DataFrame, sets: DataFrame, threshold: int, salts: int = SALTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Crowded lists by what sets differ in from one set of their lists' largest component: certain links (u, v), who
    seeks partners (main, e, node, label) and who is found (main, e, node2, label2, s2).

    All crowded lists with one largest component are one group, and its *hub* stands for the component, so a
    set is compared once per component and not once per list.  With D = the shingles in which a set differs from
    the hub's, two sets differ in |Da| + |Db| - 2 |Da & Db| shingles, and they link if that is at most
    c (na + nb), c = (1 - t) / (1 + t).  With S = |D| - c n:

    * if Sa + Sb <= 0 they link for certain, and then both link with the member of the smallest S: that one pair
      stands for all of these;
    * otherwise Da and Db must share (Sa + Sb) / 2 shingles at least, so they meet in the rarest
      |D| - (S + least S of a possible partner) / 2 + 1 of them: only those are posted, only members outside
      the main component look for partners, and of its own members only shingles that these post are kept.
    """
    t = threshold
    group = stage(crowded.groupBy("main", "node", "label", "size").agg(F.min("node2").alias("hub")), "near-crowded")
    # one of the lists' hubs (members with the fewest shingles of their own) for the whole component
    one = group.groupBy("main").agg(F.min("hub").alias("hub"))
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    hubs = sets.select(F.col("node").alias("hub"), F.col("members").alias("of_hub")).join(one, "hub").select("main", "of_hub", every)
    salted = group.select("main", "node", "label", "size", F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int").alias("salt"))
    delta = F.concat(F.array_except("members", "of_hub"), F.array_except("of_hub", "members"))
    d = salted.join(sets, "node").join(hubs, ["main", "salt"]).select("main", "node", "label", "size", delta.alias("delta"))
    outer = F.col("label") != F.col("main")
    d = stage(d.withColumn("s", (100 + t) * F.size("delta").cast("long") - (100 - t) * F.col("size")).withColumn("outer", outer), "near-deltas")
    least = stage(d.groupBy("main").agg(F.min("s").alias("s_min"), F.min_by("node", F.struct("s", "node")).alias("m"),
                                        F.min(F.when(F.col("outer"), F.col("s"))).alias("s_out")), "near-least")
    own = d.select("main", "node", "label", "outer", F.size("delta").alias("n"), "s",
                   F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int").alias("salt")).join(least.select("*", every), ["main", "salt"])
    certain = own.where(F.col("outer") & (F.col("s") + F.col("s_min") <= 0)).select("node", F.col("m").alias("other"))
    # the hub itself has S < 0, so the member of the smallest S links with the component
    certain = certain.unionByName(least.select(F.col("m").alias("node"), "main").join(one.select("main", F.col("hub").alias("other")), "main").select("node", "other"))

    def spread(rows: DataFrame) -> DataFrame:
        return rows.select("main", "node", "outer", F.explode("delta").alias("e"))

    seekers = stage(spread(d.where("outer")), "near-outer")
    posts = seekers.groupBy("main", "e").agg(F.count(F.lit(1)).alias("df_out"))
    inner = stage(spread(d.where("not outer")).join(posts.select("main", "e"), ["main", "e"], "left_semi"), "near-inner")
    held = inner.groupBy("main", "e").agg(F.count(F.lit(1)).alias("df_in"))
    shared = posts.join(held, ["main", "e"], "left").withColumn("df", F.col("df_out") + F.coalesce("df_in", F.lit(0))) \
        .where("df > 1").select("main", "e", "df", every)
    listed = seekers.unionByName(inner).withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int")) \
        .join(shared, ["main", "e", "salt"]).groupBy("main", "node").agg(F.array_sort(F.collect_list(F.struct("df", "e"))).alias("t"))
    posted = stage(own.join(listed, ["main", "node"]).select("main", "node", "label", "outer", "n", "s", "s_min", "s_out", "t"), "near-posted")

    def prefix(rows: DataFrame, partner: str) -> DataFrame:
        # shingles that nobody else has come first in the order and meet nobody
        must = F.greatest(F.lit(1), F.ceil((F.col("s") + F.col(partner)) / F.lit(2 * (100 + t)))).cast("int")
        take = F.greatest(F.lit(0), F.size("t") - must + 1)
        return rows.select("main", "node", "label", "s", F.explode(F.slice("t", F.lit(1), take)).alias("x")) \
            .select("main", F.col("x.e").alias("e"), "node", "label", "s")

    seek = prefix(posted.where("outer"), "s_min").drop("s")
    find = prefix(posted, "s_out").select("main", "e", F.col("node").alias("node2"), F.col("label").alias("label2"), F.col("s").alias("s2"))
    return _ordered(certain.withColumnRenamed("other", "node2")), seek, find


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("node <> node2").select(F.greatest("node", "node2").alias("u"), F.least("node", "node2").alias("v"))


def _met(seek: DataFrame, find: DataFrame) -> DataFrame:
    return _ordered(seek.join(find, ["main", "e"]).where(F.col("label") != F.col("label2")).select("node", "node2"))


def _relabelled(rows: DataFrame, labels: DataFrame, node: str, label: str) -> DataFrame:
    now = labels.select(F.col("node").alias(node), F.col("label").alias("_now"))
    return rows.join(now, node, "left").withColumn(label, F.coalesce("_now", label)).drop("_now")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                    threshold: int = THRESHOLD, coords: int = COORDS, star_rounds: int = STAR_ROUNDS,
                    small_list: int = SMALL_LIST) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row."""
    need = agreements_needed(threshold, coords)
    prefix = coords - need + 1
    smallest = math.ceil(100 / (100 - threshold)) - 1  # fewer shingles: only equal sets can link
    prints = stage(fingerprints(docs, id_col, text_col, k, coords), "near-prints")
    # sums of the class as a whole, then its first document stands for it
    classes = stage(prints.where("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "d1", "d2")
                    .agg(F.min("doc_id").alias("node"), F.first("sig").alias("sig")), "near-classes")
    big = classes.where(F.col("n_shingles") >= smallest)
    tokens = big.select("node", F.posexplode("sig").alias("at", "value")).select(
        "node", (F.shiftleft(F.col("at").cast("long"), 32) + F.col("value")).alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # a document's rarest pairs: those it has alone come first and meet nobody
    mine = tokens.join(shared, "token").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"))
    posted = mine.select("node", F.explode(F.slice("t", 1, F.greatest(F.lit(0), prefix - coords + F.size("t")))).alias("t")) \
        .select("node", F.col("t.token").alias("token"))
    posts = stage(posted, "near-posts")
    lists = posts.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    posts = stage(posts.join(lists.select("token"), "token"), "near-met")
    nodes = stage(posts.select("node").distinct(), "near-nodes")
    sigs = stage(big.select("node", "sig").join(nodes, "node"), "near-sigs")
    sets = stage(full_sets(docs, nodes, id_col, text_col, k), "near-sets")
    posts = stage(posts.join(_reach(sets, threshold), "node"), "near-lists")
    # the two can reach the threshold even if they share all that either shares with anyone
    common = "least(common, common2)"
    close = F.expr(f"100 * {common} >= {threshold} * (size + size2 - {common})")
    mate = [F.col(f"hub.{c}").alias(f"{c}2") for c in ("node", "size", "common")]

    links, labels, seek, new = None, None, None, True
    at = posts.withColumn("label", F.col("node"))
    for turn in range(star_rounds + 1):
        # without new links the lists stay as they are, and another star round would compare the same pairs
        if turn < star_rounds and not new:
            continue
        if labels is not None and new:
            at = posts.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
            open_lists = at.groupBy("token").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a < b")
            at = stage(at.join(open_lists.select("token"), "token"), "near-open")
        # a list's hub is the member with the fewest shingles of its own, of the list's largest component
        members = at.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("own", "node", "size", "common")).alias("hub"))
        best = F.max_by(F.struct(F.col("label").alias("main"), "hub"), F.struct("n", -F.col("hub.own"), -F.col("hub.node")))
        main = members.groupBy("token").agg(best.alias("m"), F.sum("n").alias("listed"))
        main = stage(main.select("token", "m.main", "m.hub", "listed").select("token", "main", *mate, "listed"), "near-main")
        outside = at.join(main, "token").where("label <> main")
        if turn < star_rounds:
            # one hub a member: the one it shares most lists with
            pairs = outside.where(close).groupBy("node", "node2").agg(F.count(F.lit(1)).alias("n")) \
                .groupBy("node").agg(F.max_by("node2", F.struct("n", "node2")).alias("node2")) \
                .select(F.col("node").alias("u"), F.col("node2").alias("v"))
        else:
            pairs = _small_list_pairs(outside, at, close, small_list)
            big = main.where(F.col("listed") > small_list)
            if not big.isEmpty():
                certain, seek, find = _crowded_lists(at.join(big, "token"), sets, threshold)
                # first one member a list, the one nearest to the hub: sets that link with it need no others
                one = F.min_by(F.struct("node2", "label2"), F.struct("s2", "node2")).alias("o")
                nearest = find.groupBy("main", "e").agg(one).select("main", "e", "o.node2", "o.label2")
                pairs = pairs.unionByName(certain).unionByName(stage(_met(seek, nearest), "near-met-hub"))
            pairs = pairs.distinct()
        found = _verified(pairs, sigs, sets, need, threshold)
        links = found if links is None else links.unionByName(found)
        new = not found.isEmpty()
        if labels is None or new:
            labels = components(links)
    if seek is not None:
        # sets that are still outside their lists' component meet everybody whom they can reach
        home = labels.select(F.col("node").alias("main"), F.col("label").alias("home"))
        rest = _relabelled(seek, labels, "node", "label").join(home, "main", "left") \
            .where(F.col("label") != F.coalesce("home", "main")).drop("home")
        last = stage(_met(rest, _relabelled(find, labels, "node2", "label2")).distinct(), "near-rest")
        if not last.isEmpty():
            more = _verified(last, sigs, sets, need, threshold)
            if not more.isEmpty():
                labels = components(links.unionByName(more))
    node_of = classes.select("n_shingles", "d1", "d2", "node").join(labels, "node", "left") \
        .select("n_shingles", "d1", "d2", F.coalesce("label", "node").alias("component_id"))
    own = prints.select("doc_id", "n_shingles", "d1", "d2")
    out = own.where("doc_id is not null and n_shingles > 0").join(node_of, ["n_shingles", "d1", "d2"]) \
        .select("doc_id", "n_shingles", "component_id")
    alone = own.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, with one row of each group of near-duplicates: the one of the smallest id.

    A row is judged by its id and text: rows that share an id but not the text are documents of their own, equal
    rows are one.  Rows without an id are documents like others and come after those with one.
    """
    seed = 0
    while True:
        uid = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
        ids = stage(docs.select(uid.alias("uid"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th")), "near-ids")
        known = ids.groupBy("uid").agg(F.min(F.struct("id", "th")).alias("a"), F.max(F.struct("id", "th")).alias("b"),
                                       F.count(F.lit(1)).alias("n"))
        known = stage(known.select("uid", F.col("a.id").alias("id"), (F.col("a") != F.col("b")).alias("clash"), "n"), "near-rows")
        if known.where("clash").isEmpty():
            break
        seed += 1  # two documents with one hash: draw anew
    judged = near_duplicates(docs.select(uid.alias("uid"), F.col(text_col).alias("text")), "uid", "text", threshold=threshold)
    group = judged.select(F.col("doc_id").alias("uid"), "component_id").distinct().join(known, "uid")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("uid").alias("uid"), F.col("n").alias("n")))
    kept = stage(group.groupBy("component_id").agg(first.alias("f")).select(F.col("f.uid").alias("_uid"), F.col("f.n").alias("_n")), "near-kept")
    # the kept ids grow with the corpus: a sort-merge join at every size
    rows = docs.withColumn("_uid", uid).join(kept.hint("merge"), "_uid")
    single, many = rows.where("_n = 1"), rows.where("_n > 1")
    return single.select(*docs.columns).unionByName(many.dropDuplicates(["_uid"]).select(*docs.columns))
