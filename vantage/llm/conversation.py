"""Conversation structure repair: the cheapest edits that give every conversation a legal order of turns.

Rows are numbered once in (conversation, turn, role, text) order by a range partitioning, so a conversation of any
length is spread over tasks.  Each row has one symbol: role class and first fault (blank, a copy of an
earlier row, truncated).  Legal role initials are ``(s?(ua)+)?``: four states, and each symbol is a 4 x 4 min-plus
transition whose entries also hold the cheapest insertions before the row.

A *piece* is what one segment of ``2**bits`` consecutive rows holds of one conversation.  Its equal consecutive
symbols are collapsed; a run of them is advanced through cached binary powers of its transition.  Almost
all conversations are one piece and are solved there.  For the others the pieces' transitions, 16 numbers each,
are chained backwards per conversation, each piece is unrolled from its four possible entry states, and the entry states
are chained forwards: only these few numbers of a conversation ever meet in one task.

Unrolling chooses, row by row, the ASCII-least letter that still reaches the least cost; a letter fixes the
next state, so this gives the ASCII-least of the cheapest audits.  Inside a run the cost-to-go is halved down
with the same cached powers.

Edits: Keep 0, Rerole to user/assistant 2, Delete 3 (required for blank rows and copies), Insert an empty
user/assistant row 2; a truncated row that stays adds 1.

Defined results: a null role or text is one space; a null conversation id is a conversation of its own; null turns come
first; rows of one turn are ordered by role and text, equal rows are copies of the first of them; an empty text is blank;
extra columns are ignored; an empty table gives empty results.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

BITS = 12
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FAR = 1 << 40
START, AFTER_S, AFTER_U, AFTER_A = range(4)
GIVEN = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)        # state after an inserted or re-roled row
GIVEN_ROLE = ("user", "user", "assistant", "user")
ALLOWED = {"s": {START: AFTER_S}, "u": {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}}
CLASSES = "sua"
MUST_DELETE = 0                                     # other symbols: 1 + 2 * place in CLASSES (3: none) + truncated
DONE = (0, 2 * INSERT, INSERT, 0)                   # cost from each state when no rows are left

# ------------------------------------------------------------------ min-plus kernel


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def _kept_to(symbol: int, state: int) -> int | None:
    k = (symbol - 1) // 2
    return ALLOWED[CLASSES[k]].get(state) if k < len(CLASSES) else None


@lru_cache(maxsize=None)
def power(symbol: int, k: int) -> np.ndarray:
    """Transition of ``2**k`` rows of one symbol."""
    if k:
        half = power(symbol, k - 1)
        return product(half, half)
    insert = np.full((4, 4), FAR)
    row = np.full((4, 4), FAR)
    for s in range(4):
        insert[s, s] = 0
        row[s, s] = DELETE
    for s in range(4):
        insert[s, GIVEN[s]] = INSERT
        if symbol != MUST_DELETE:
            extra = TRUNCATED * ((symbol - 1) % 2)
            row[s, GIVEN[s]] = min(row[s, GIVEN[s]], REROLE + extra)
            to = _kept_to(symbol, s)
            if to is not None:
                row[s, to] = min(row[s, to], KEEP + extra)
    return product(product(product(insert, insert), insert), row)


def transition(runs: list[tuple[int, int]]) -> np.ndarray:
    """Transition of a whole piece."""
    out = np.where(np.eye(4, dtype=bool), 0, FAR)
    for symbol, n in runs:
        for k in range(n.bit_length()):
            if n >> k & 1:
                out = product(out, power(symbol, k))
    return np.minimum(out, FAR)


@lru_cache(maxsize=1 << 14)
def _back(symbol: int, k: int, after: tuple) -> tuple[tuple, int]:
    """Cost-to-go before ``2**k`` rows, its least value taken out."""
    v = (power(symbol, k) + np.array(after)).min(axis=1)
    return tuple((v - v.min()).tolist()), int(v.min())


def _level(v) -> tuple[tuple, int]:
    low = min(v)
    return tuple(int(x) - int(low) for x in v), int(low)


@lru_cache(maxsize=1 << 14)
def _choose(symbol: int, after: tuple, state: int) -> tuple[str, int]:
    """Letters of one row and the state after it."""
    before, low = _back(symbol, 0, after)
    letters = ""
    extra = TRUNCATED * ((symbol - 1) % 2) if symbol != MUST_DELETE else 0
    while True:
        goal = before[state] + low
        if DELETE + after[state] == goal:
            return letters + "D", state
        if INSERT + before[GIVEN[state]] == before[state]:
            letters += "I"
            state = GIVEN[state]
            continue
        to = _kept_to(symbol, state) if symbol != MUST_DELETE else None
        if to is not None and KEEP + extra + after[to] == goal:
            return letters + "K", to
        return letters + "R", GIVEN[state]


def _unroll_run(symbol: int, n: int, after: tuple, state: int, out: list[str]) -> int:
    if n == 1:
        letters, state = _choose(symbol, after, state)
        out.append(letters)
        return state
    k = (n - 1).bit_length() - 1
    state = _unroll_run(symbol, n - (1 << k), _back(symbol, k, after)[0], state, out)
    return _unroll_run(symbol, 1 << k, after, state, out)


def chain(runs: list[tuple[int, int]], after) -> tuple[list[tuple], tuple, int]:
    """Levelled cost-to-go after every run, and before the first one with what was taken out."""
    v, total = _level(after)
    behind = []
    for symbol, n in reversed(runs):
        behind.append(v)
        for k in range(n.bit_length()):
            if n >> k & 1:
                v, low = _back(symbol, k, v)
                total += low
    return behind[::-1], v, total


def unroll(runs: list[tuple[int, int]], behind: list[tuple], state: int) -> tuple[str, int]:
    out: list[str] = []
    for (symbol, n), after in zip(runs, behind, strict=True):
        state = _unroll_run(symbol, n, after, state, out)
    return "".join(out), state


def ending(state: int) -> str:
    """Letters after the last row."""
    return "I" * (DONE[state] // INSERT)


# ------------------------------------------------------------------ pieces

PIECE = ("seg long, lo long, n long, blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, "
         "first_turn long, last_turn long, turns long, low_turn long, runs binary, cost long, audit string")


def _pieces(tab: pa.Table) -> pa.Table:
    """Pieces of one segment's rows, each solved as if it were its whole conversation."""
    tab = tab.sort_by("pos")
    conv = tab.column("conv").combine_chunks()
    code = conv.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False) if len(conv) else np.zeros(0, int)
    col = {c: tab.column(c).to_pylist() for c in ("pos", "turn", "initial", "blank", "truncated", "first")}
    head = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    tail = np.append(head[1:], len(code))
    seg = tab.column("seg")[0].as_py()
    out: dict[str, list] = {c.split()[0]: [] for c in PIECE.split(", ")}
    for a, b in zip(head.tolist(), tail.tolist(), strict=True):
        blank = duplicate = truncated = illegal = 0
        runs: list[list[int]] = []
        for i in range(a, b):
            ini = col["initial"][i]
            if i > a and col["initial"][i - 1] + ini not in ("su", "ua", "au"):
                illegal += 1
            if col["blank"][i]:
                blank += 1
                symbol = MUST_DELETE
            elif not col["first"][i]:
                duplicate += 1
                symbol = MUST_DELETE
            else:
                truncated += col["truncated"][i]
                k = CLASSES.find(ini) if ini else -1
                symbol = 1 + 2 * (k if k >= 0 else len(CLASSES)) + col["truncated"][i]
            if runs and runs[-1][0] == symbol:
                runs[-1][1] += 1
            else:
                runs.append([symbol, 1])
        behind, v, total = chain(runs, DONE)
        audit, state = unroll(runs, behind, START)
        turns = [t for t in col["turn"][a:b] if t is not None]
        row = (seg, col["pos"][a], b - a, blank, duplicate, truncated, illegal, col["initial"][a], col["initial"][b - 1],
               col["turn"][a], col["turn"][b - 1], len(set(turns)), min(turns, default=None),
               np.array(runs, np.int32).tobytes(), v[START] + total, audit + ending(state))
        for c, x in zip(out, row, strict=True):
            out[c].append(x)
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.table([conv.take(pa.array(head))] + [pa.array(out[n], kinds[t]) for n, t in (c.split() for c in PIECE.split(", "))],
                    names=["conv", *out])


def _runs(raw: bytes) -> list[tuple[int, int]]:
    return [tuple(x) for x in np.frombuffer(raw, np.int32).reshape(-1, 2).tolist()]


def _transitions(pieces: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("conv"), b.column("lo"),
                 pa.array([transition(_runs(x)).ravel().tolist() for x in b.column("runs").to_pylist()], pa.list_(pa.int64()))],
                names=["conv", "lo", "matrix"])
    return pieces.select("conv", "lo", "runs").mapInArrow(run, f"conv {_type(pieces, 'conv')}, lo long, matrix array<bigint>")


def _type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def _joined_pieces(multi: DataFrame) -> DataFrame:
    """``lo, start, audit, cost`` of the pieces of conversations that several segments share."""
    conv_type = _type(multi, "conv")

    def backwards(tab: pa.Table) -> pa.Table:
        tab = tab.sort_by("lo")
        after, v = [], np.array(DONE)
        for m in reversed(tab.column("matrix").to_pylist()):
            after.append(v.tolist())
            v = (np.array(m).reshape(4, 4) + v).min(axis=1)
        return pa.table({"lo": tab.column("lo"), "after": pa.array(after[::-1], pa.list_(pa.int64())),
                         "cost": pa.array([int(v[START])] * len(after), pa.int64())})

    ends = stage(_transitions(multi).groupBy("conv").applyInArrow(backwards, "lo long, after array<bigint>, cost long"), "talk-after")

    def four(batches):
        for b in batches:
            audits, states = [], []
            for raw, after in zip(b.column("runs").to_pylist(), b.column("after").to_pylist(), strict=True):
                runs = _runs(raw)
                behind, _, _ = chain(runs, after)
                got = [unroll(runs, behind, s) for s in range(4)]
                audits.append([x for x, _ in got])
                states.append([s for _, s in got])
            yield pa.RecordBatch.from_arrays(
                [b.column("conv"), b.column("lo"), b.column("cost"), pa.array(audits, pa.list_(pa.string())), pa.array(states, pa.list_(pa.int32()))],
                names=["conv", "lo", "cost", "audits", "states"])

    ways = stage(multi.select("conv", "lo", "runs").join(ends, "lo").select("conv", "lo", "runs", "after", "cost").mapInArrow(
        four, f"conv {conv_type}, lo long, cost long, audits array<string>, states array<int>"), "talk-ways")

    def forwards(tab: pa.Table) -> pa.Table:
        tab = tab.sort_by("lo")
        starts, s = [], START
        for states in tab.column("states").to_pylist():
            starts.append(s)
            s = states[s]
        tails = [""] * (len(starts) - 1) + [ending(s)]
        return pa.table({"lo": tab.column("lo"), "start": pa.array(starts, pa.int32()), "tail": pa.array(tails, pa.string())})

    begun = ways.select("conv", "lo", "states").groupBy("conv").applyInArrow(forwards, "lo long, start int, tail string")
    return ways.join(begun, "lo").select("lo", "start", F.concat(F.element_at("audits", F.col("start") + 1), "tail").alias("audit"), "cost")


# ------------------------------------------------------------------ the operator

@dataclass
class Repair:
    """``report``: one row a conversation; ``rows``: the repaired conversations' rows."""

    report: DataFrame
    rows: DataFrame


def _emit(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """Rows of the repaired conversations: ``conv, pos, k, role, text, edit`` in (pos, k) order (K, R or I)."""
    marks = solved.select("conv", F.col("lo").alias("pos"), "seg", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("role"),
                          F.col("audit").alias("text"), F.col("start").alias("state"))
    both = marks.unionByName(rows.select("conv", "pos", "seg", F.lit(1).alias("kind"), "role", "text", F.lit(0).alias("state")))
    both = both.repartition("seg").sortWithinPartitions("pos", "kind").select("conv", "pos", "kind", "role", "text", "state")
    conv_type = _type(rows, "conv")

    def run(batches):
        audit, at, last, state = "", 0, 0, START
        for b in batches:
            take, where, nth, roles, texts, edits = [], [], [], [], [], []

            def line(i, pos, k, role, text, edit):
                take.append(i)
                where.append(pos)
                nth.append(k)
                roles.append(role)
                texts.append(text)
                edits.append(edit)

            cols = (b.column(c).to_pylist() for c in ("pos", "kind", "role", "text", "state"))
            for i, (pos, kind, role, text, entry) in enumerate(zip(*cols, strict=True)):
                if kind == 0:
                    audit, at, last, state = text, 0, len(text.rstrip("I")), entry
                    continue
                k = 0
                while audit[at] == "I":
                    line(i, pos, k, GIVEN_ROLE[state], "", "I")
                    state, at, k = GIVEN[state], at + 1, k + 1
                letter = audit[at]
                at += 1
                if letter == "R":
                    role, state = GIVEN_ROLE[state], GIVEN[state]
                elif letter == "K":
                    state = ALLOWED[role[0]][state]
                if letter != "D":
                    line(i, pos, k, role, text, letter)
                    k += 1
                while last <= at < len(audit):  # after the last row
                    line(i, pos, k, GIVEN_ROLE[state], "", "I")
                    state, at, k = GIVEN[state], at + 1, k + 1
            yield pa.RecordBatch.from_arrays(
                [b.column("conv").take(pa.array(take, pa.int64())), pa.array(where, pa.int64()), pa.array(nth, pa.int32()),
                 pa.array(roles, pa.string()), pa.array(texts, pa.string()), pa.array(edits, pa.string())],
                names=["conv", "pos", "k", "role", "text", "edit"])

    return both.mapInArrow(run, f"conv {conv_type}, pos long, k int, role string, text string, edit string")


def repair_conversations(talks: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", bits: int = BITS) -> Repair:
    """Repair of all conversations.

    ``report``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.  ``rows``: conv_id, pos, k, role,
    text, edit (K kept, R re-roled, I inserted), a conversation's rows in (pos, k) order.
    """
    def said(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    base = talks.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), said(role_col).alias("role"),
                        said(text_col).alias("text")).withColumn("_at", F.monotonically_increasing_id())
    keys = ["conv", "turn", "role", "text", "_at"]  # the last one spreads equal rows over ranges
    rows = base.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_at").withColumn("pos", F.monotonically_increasing_id())
    rows = stage(rows, "talk-rows").withColumn("seg", F.shiftright("pos", bits))
    same = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    body = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    marked = rows.select("conv", "turn", "pos", "seg", F.substring("role", 1, 1).alias("initial"), (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
                         (~F.substring(body, -1, 1).isin(".", "!", "?")).cast("int").alias("truncated"), same.alias("same"))
    # the first of equal rows is known by its place: a join on places has no hot key
    first = marked.where("not blank").groupBy("conv", "same").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    symbols = marked.drop("same").join(first, "pos", "left").withColumn("first", F.coalesce("first", F.lit(False)))
    symbols = symbols.select("conv", "turn", "pos", "seg", "initial", "blank", "truncated", "first")
    pieces = stage(symbols.groupBy("seg").applyInArrow(_pieces, f"conv {_type(rows, 'conv')}, " + PIECE), "talk-pieces")

    mine = Window.partitionBy("conv")
    line = mine.orderBy("lo")
    pieces = pieces.withColumn("of", F.count(F.lit(1)).over(mine)) \
        .withColumn("seam", F.concat(F.lag("last_initial").over(line), "first_initial")) \
        .withColumn("again", (F.lag("last_turn").over(line) == F.col("first_turn")).cast("int"))
    pieces = stage(pieces, "talk-parts")
    multi = pieces.where("of > 1")
    solved = pieces.where("of = 1").select("conv", "seg", "lo", F.lit(START).alias("start"), "audit", "cost")
    if not multi.isEmpty():
        solved = solved.unionByName(multi.select("conv", "seg", "lo").join(_joined_pieces(multi), "lo").select(*solved.columns))
        solved = stage(solved, "talk-solved")
    counts = pieces.groupBy("conv").agg(
        F.min("low_turn").alias("low"), F.max("last_turn").alias("high"), (F.sum("turns") - F.sum(F.coalesce("again", F.lit(0)))).alias("turns"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        (F.sum("illegal") + F.sum(F.when(~F.col("seam").isin("su", "ua", "au"), 1).otherwise(0))).cast("long").alias("illegal"))
    audits = solved.groupBy("conv").agg(F.min("cost").alias("cost"), F.concat_ws("", F.transform(
        F.array_sort(F.collect_list(F.struct("lo", "audit"))), lambda x: x["audit"])).alias("audit"))
    other = audits.withColumnRenamed("conv", "_conv")
    report = counts.join(other, F.col("conv").eqNullSafe(F.col("_conv"))).select(
        F.col("conv").alias("conv_id"), F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return Repair(report, _emit(rows, solved).withColumnRenamed("conv", "conv_id"))


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of ``role:text`` lines, streamed: a digest is sequential, so a conversation's lines
    pass through one task, a batch at a time."""
    conv_type = _type(rows, "conv_id")
    lines = rows.select("conv_id", "pos", "k", F.concat("role", F.lit(":"), "text").alias("line"))
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "k").select("conv_id", "line")

    def run(batches):
        current = digest = None

        def out(pairs):
            ids, sums = zip(*pairs, strict=True)
            return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.array(sums, pa.string())], names=["conv_id", "repaired_sha256"])

        for b in batches:
            done = []
            ids = b.column("conv_id")
            code = ids.to_pylist()
            for i, (c, line) in enumerate(zip(code, b.column("line").to_pylist(), strict=True)):
                if digest is not None and c == current[0].as_py():
                    digest.update(b"\n")
                else:
                    if digest is not None:
                        done.append((current, digest.hexdigest()))
                    current, digest = ids.slice(i, 1), hashlib.sha256()
                digest.update(line.encode())
            if done:
                yield out(done)
        if digest is not None:
            yield out([(current, digest.hexdigest())])

    return lines.mapInArrow(run, f"conv_id {conv_type}, repaired_sha256 string")


def damaged(talks: DataFrame) -> DataFrame:
    """Rows damaged by the checksum of their ``conv_id:turn`` (nulls: one space) modulo 20: 0 drops the row, 1 empties
    its text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes its role user; other rows stay."""
    def said(c) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    d = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    text = F.when(d == 1, "").when(d == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    times = F.when(d == 0, 0).when(d == 3, 2).otherwise(1)
    return talks.select("conv_id", "turn", F.when(d == 4, "user").otherwise(said("role")).alias("role"), text.alias("text"),
                        F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")).drop("_copy")
