"""Personal data by weak supervision, in DataFrame and SQL functions only.

Candidates are spans found by patterns: the four base kinds (kept whatever happens) and
further kinds that a pattern alone cannot settle (secrets behind a name, keys by their issuers' formats, names, ids,
local phones, unchecked cards).  Four labelers vote on every candidate (+1, 0, -1): the strict pattern, a gazetteer
(domains, calling codes, issuers, given names, values that are no plain words), the words before it, and the characters
around it.  Expectation-maximisation over the table of vote patterns (at most a few
thousand rows, whatever the corpus) estimates how reliable each labeler is; a logistic
span classifier trained on its posteriors, which also sees the kind, the length and the mixture of characters, decides on
the further kinds.

Spans are counted in code points, end exclusive.  Every pattern is written so that a
match is found in time linear in the text (possessive parts, starts only at the border
of a run or where the last match ended), which also holds for very long texts.

Defined results: null text is empty and has no spans; repeated rows are searched each;
null ids are kept; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents_view, stage

BASE = ("email", "ip", "card", "phone")
EXTRA = ("secret", "key", "name", "national_id", "phone_local", "card_unchecked")
LABELERS = ("pattern", "gazetteer", "context", "shape")

# fixed values: patterns
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?i)(?<![a-z0-9])(?:password|passwd|passphrase|pwd|token|secret|api[_-]?key|(?:secret|access|private|auth)[_-]?(?:key|token))"
              r"[\"']? ?[:=] ?[\"']?[a-z0-9+/_.~!@#$%^&*-]{6,200}+",
    "key": r"(?<![A-Za-z0-9])(?:A[KS]IA[0-9A-Z]{16}(?![0-9A-Za-z])|gh[pousr]_[A-Za-z0-9]{36,255}+|sk-[A-Za-z0-9_-]{20,200}+"
           r"|xox[abpr]-[A-Za-z0-9-]{10,200}+|AIza[0-9A-Za-z_-]{35}|eyJ[A-Za-z0-9_-]{8,2000}+\.eyJ[A-Za-z0-9_-]{8,4000}+\.[A-Za-z0-9_-]{8,1000}+)",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\. [A-Z][a-z]++(?: [A-Z][a-z]++)?",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone_local": r"(?<![0-9(+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
# fixed values: gazetteers
TLDS = "com org net edu gov io de fr es it uk nl eu info biz co us ca ch at be pl ru jp cn br au in".split()
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92".split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|36|38|30[0-5]|35|6011|65|64[4-9])"
GIVEN_NAMES = ("james mary john patricia robert jennifer michael linda william elizabeth david barbara richard susan joseph jessica thomas sarah "
               "charles karen anna maria peter paul mark laura emma marie jean pierre claire hans klaus petra sabine jose juan carmen "
               "luis ana giulia marco paolo elena olga ivan chen wei li yuki ahmed fatima").split()
# fixed values: words that speak for or against a kind when they stand shortly before it
CUES = {
    "email": "mail e-mail email contact write reach to",
    "ip": "ip address host server from client",
    "card": "card visa mastercard amex credit payment pay",
    "phone": "phone tel telephone call mobile cell fax contact",
    "secret": "credentials login config key env user account",
    "key": "credentials login config key token env export secret authorization bearer",
    "name": "dear from by signed contact patient",
    "national_id": "ssn social security id number",
    "phone_local": "phone tel telephone call mobile cell fax contact",
    "card_unchecked": "card visa mastercard amex credit payment pay",
}
AGAINST = "version isbn issn order invoice item build release chapter section figure price"

BLOCK = 256
AROUND = 24


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _empty() -> Column:
    return F.expr("cast(array() as array<struct<start:int,end:int,value:string,before:string,after:string>>)")


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, value, before, after).

    The text between matches and the matches give the places by running sums; these are kept in
    blocks, so that a text with very many matches needs no quadratic work.
    """
    parts = F.struct(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def with_lengths(x):
        steps = F.transform(x["hit"], lambda v, i: F.length(F.get(x["gap"], i)) + F.length(v))
        return _let(F.struct(x["gap"].alias("gap"), x["hit"].alias("hit"), steps.alias("step")), with_blocks)

    def total(a):
        return F.aggregate(a, F.lit(0), lambda s, v: s + v)

    def with_blocks(x):
        n = F.ceil(F.size(x["hit"]) / F.lit(BLOCK)).cast("int")
        sums = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda b: total(F.slice(x["step"], b * BLOCK + 1, F.lit(BLOCK))))
        base = F.aggregate(sums, F.array(F.lit(0)), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))
        return _let(F.struct(x["gap"].alias("gap"), x["hit"].alias("hit"), x["step"].alias("step"), base.alias("base")), placed)

    def placed(x):
        def one(v, i):
            b = F.floor(i / F.lit(BLOCK)).cast("int")
            start = F.get(x["base"], b) + total(F.slice(x["step"], b * BLOCK + 1, i - b * BLOCK)) + F.length(F.get(x["gap"], i))
            return F.struct(start.cast("int").alias("start"), (start + F.length(v)).cast("int").alias("end"), v.alias("value"),
                            F.right(F.get(x["gap"], i), F.lit(AROUND)).alias("before"),
                            F.left(F.get(x["gap"], i + 1), F.lit(1)).alias("after"))
        return F.transform(x["hit"], one)

    return F.when(text.rlike(pattern), _let(parts, with_lengths)).otherwise(_empty())


def _luhn(digits: Column) -> Column:
    """Luhn check of a digit string of at least two digits."""
    def sum_of(rev):
        def add(s, i):
            d = F.substring(rev, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
            return s + F.when(d > 9, d - 9).otherwise(d)
        return F.aggregate(F.sequence(F.lit(1), F.length(rev)), F.lit(0), add)
    return _let(F.reverse(digits), sum_of) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _octets_ok(value: Column) -> Column:
    return F.forall(F.split(value, "\\."), lambda o: _let(F.regexp_replace(o, "^0+(?=[0-9])", ""), lambda s: (F.length(s) <= 3) & (
        F.when(F.length(s) <= 3, s.cast("int")).otherwise(F.lit(999)) <= 255)))


def _card_length(value: Column) -> Column:
    return F.length(_digits(value)).between(13, 19)


def base_spans(text: Column) -> Column:
    """Struct of the valid spans of the base kinds, and the card-like chains that fail the check sum."""
    def valid_cards(cards):
        sized = F.filter(cards, lambda s: _card_length(s["value"]))
        return _let(sized, lambda c: F.struct(F.filter(c, lambda s: _luhn(_digits(s["value"]))).alias("card"),
                                              F.filter(c, lambda s: ~_luhn(_digits(s["value"]))).alias("card_unchecked")))
    return F.struct(
        F.when(F.contains(text, F.lit("@")), matches(text, PATTERNS["email"])).otherwise(_empty()).alias("email"),
        F.filter(matches(text, PATTERNS["ip"]), lambda s: _octets_ok(s["value"])).alias("ip"),
        _let(matches(text, PATTERNS["card"]), valid_cards).alias("cards"),
        F.filter(F.when(F.contains(text, F.lit("+")), matches(text, PATTERNS["phone"])).otherwise(_empty()),
                 lambda s: F.length(_digits(s["value"])).between(9, 15)).alias("phone"))


def _gazetteer(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.when(F.lower(F.substring_index(value, ".", -1)).isin(TLDS), 1).otherwise(-1)
    if kind == "ip":
        return F.when(value.rlike(r"^(?:0+|10|127|22[4-9]|2[345][0-9])\."), -1).otherwise(1)
    if kind in ("card", "card_unchecked"):
        return F.when(_digits(value).rlike(ISSUERS), 1).otherwise(-1)
    if kind == "phone":
        return F.when(_digits(value).rlike("^(?:" + "|".join(CALLING_CODES) + ")"), 1).otherwise(-1)
    if kind == "secret":  # a value that is no plain word or number
        tail = F.regexp_extract(value, "[:=] ?[\"']?(.*)$", 1)
        return F.when(tail.rlike("[0-9]") & tail.rlike("[A-Za-z]") | tail.rlike("[A-Za-z0-9][~!@#$%^&*+/][A-Za-z0-9]"), 1).otherwise(-1)
    if kind == "key":
        return F.when(value.rlike("[0-9]"), 1).otherwise(-1)
    if kind == "name":
        return F.when(F.lower(F.regexp_extract(value, "\\. ([A-Z][a-z]+)", 1)).isin(GIVEN_NAMES), 1).otherwise(0)
    if kind == "national_id":
        return F.when(value.rlike("^(?:000|666|9)"), -1).otherwise(1)
    return F.lit(0)


PATTERN_VOTE = {"email": 1, "ip": 1, "card": 1, "phone": 1, "secret": 1, "key": 1, "name": 0, "national_id": 1, "phone_local": 1, "card_unchecked": -1}


def _labelled(kind: str, spans: Column) -> Column:
    """Spans of a kind with the votes of all labelers, a length class and the number of character classes in it."""
    cue = "(?i)(?<![A-Za-z])(?:" + "|".join(CUES[kind].split()) + ")(?![A-Za-z])"
    against = "(?i)(?<![A-Za-z])(?:" + "|".join(AGAINST.split()) + ")(?![A-Za-z])"

    def one(s):
        context = F.when(s["before"].rlike(against), -1).when(s["before"].rlike(cue), 1).otherwise(0)
        glued = s["before"].rlike("[\\p{L}0-9_]$") | s["after"].rlike("^[\\p{L}0-9_]")
        shape = F.when(glued, -1).otherwise(1)
        n = s["end"] - s["start"]
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        F.lit(PATTERN_VOTE[kind]).alias("pattern"), _gazetteer(kind, s["value"]).alias("gazetteer"),
                        context.alias("context"), shape.alias("shape"),
                        F.when(n < 12, 0).when(n < 20, 1).otherwise(2).alias("size"),
                        sum(s["value"].rlike(c).cast("int") for c in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")).alias("mix"))
    return F.transform(spans, one)


def candidates(text: Column) -> Column:
    """All candidates of a text with their votes, by kind as listed, then start."""
    def rest(b):
        base = F.concat(*[F.transform(x, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
                          for x in (b["email"], b["ip"], b["cards"]["card"], b["phone"])])

        def free(base_spans_):
            def apart(spans):
                return F.filter(spans, lambda s: ~F.exists(base_spans_, lambda t: (s["start"] < t["end"]) & (t["start"] < s["end"])))
            extra = {k: matches(text, PATTERNS[k]) for k in EXTRA if k in PATTERNS}
            extra["card_unchecked"] = b["cards"]["card_unchecked"]
            return F.concat(
                _labelled("email", b["email"]), _labelled("ip", b["ip"]), _labelled("card", b["cards"]["card"]),
                _labelled("phone", b["phone"]), *[_labelled(k, apart(extra[k])) for k in EXTRA])
        return _let(base, free)
    return _let(base_spans(text), rest)


# ------------------------------------------------------------------ reliabilities and the classifier

@dataclass
class Model:
    """Reliabilities by labeler (chance of each vote on true and on false spans), and the span classifier."""

    votes: dict[str, dict[int, tuple[float, float]]]
    weights: dict[tuple[str, object], float]
    bias: float

    def score(self, s: Column) -> Column:
        """Probability that a candidate is personal data."""
        z = F.lit(self.bias)
        for (field, value), w in sorted(self.weights.items(), key=str):
            z = z + F.when(s[field] == F.lit(value), F.lit(w)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def reliabilities(rows: list[dict], rounds: int = 50) -> tuple[list[float], dict[str, dict[int, tuple[float, float]]]]:
    """Expectation-maximisation over vote patterns with counts ``n``: posteriors and vote chances."""
    post = [1 / (1 + math.exp(-sum(r[k] for k in LABELERS))) for r in rows]
    chance: dict[str, dict[int, tuple[float, float]]] = {}
    for _ in range(rounds):
        yes = sum(r["n"] * p for r, p in zip(rows, post, strict=True))
        no = sum(r["n"] * (1 - p) for r, p in zip(rows, post, strict=True))
        prior = (yes + 1) / (yes + no + 2)
        for k in LABELERS:
            chance[k] = {v: ((sum(r["n"] * p for r, p in zip(rows, post, strict=True) if r[k] == v) + 1) / (yes + 3),
                             (sum(r["n"] * (1 - p) for r, p in zip(rows, post, strict=True) if r[k] == v) + 1) / (no + 3))
                         for v in (-1, 0, 1)}
        new = []
        for r in rows:
            z = math.log(prior / (1 - prior)) + sum(math.log(chance[k][r[k]][0] / chance[k][r[k]][1]) for k in LABELERS)
            new.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        moved = max(abs(a - b) for a, b in zip(post, new, strict=True))
        post = new
        if moved < 1e-6:
            break
    return post, chance


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of the least weighted mean loss plus ridge / 2 * |coefficients|^2, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = weight / weight.sum()
    pull = np.append(np.full(x.shape[1] - 1, ridge), 0.0)  # the intercept is free

    def loss(b):
        z = x @ b
        return w @ (np.logaddexp(0.0, z) - y * z) + pull @ (b * b) / 2

    b = np.zeros(x.shape[1])
    now = loss(b)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -500, 500)))
        step = np.linalg.solve((x.T * (w * p * (1 - p))) @ x + np.diag(pull + 1e-12), x.T @ (w * (p - y)) + pull * b)
        size = 1.0
        while size > 1e-6 and loss(b - size * step) > now:
            size /= 2
        if size <= 1e-6 or now - loss(b - size * step) < 1e-14:
            break
        b = b - size * step
        now = loss(b)
    return b[:-1], float(b[-1])


def fit(found: DataFrame) -> Model | None:
    """Model from a table of candidates (array column ``spans``); None where there is no candidate.

    The table of vote patterns has at most 10 kinds x 3^4 votes x 3 sizes x 4 mixtures rows, so the classifier is
    fitted on it in place: a distributed fit of so few rows would be a job and two broadcasts for every step.
    """
    keys = ["kind", *LABELERS, "size", "mix"]
    table = found.select(F.explode("spans").alias("s")).select("s.*").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    rows = [r.asDict() for r in table.collect()]
    if not rows:
        return None
    rows.sort(key=lambda r: [str(r[k]) for k in keys])
    post, chance = reliabilities(rows)
    fields = [("kind", k) for k in (*BASE, *EXTRA)] + [(k, v) for k in LABELERS for v in (-1, 1)] \
        + [("size", v) for v in (0, 2)] + [("mix", v) for v in (1, 3, 4)]
    x = np.array([[float(r[f] == v) for f, v in fields] for r in rows])
    n, p = np.array([float(r["n"]) for r in rows]), np.clip(np.array(post), 1e-3, 1 - 1e-3)
    coefficients, bias = logistic(np.concatenate([x, x]), np.repeat([1.0, 0.0], len(rows)), np.concatenate([n * p, n * (1 - p)]))
    return Model(chance, {f: float(w) for f, w in zip(fields, coefficients, strict=True)}, bias)


def accepted(spans: Column, model: Model | None, least: float = 0.5) -> Column:
    """Base spans, and the further ones the classifier takes."""
    if model is None:
        return F.filter(spans, lambda s: s["kind"].isin(*BASE))
    return F.filter(spans, lambda s: s["kind"].isin(*BASE) | (model.score(s) >= least))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans (array of kind, start, end and votes) of every row."""
    found = stage(documents_view(docs, id_col, text_col).select("doc_id", candidates(F.col("text")).alias("spans")), "pii-candidates")
    return found.select("doc_id", accepted(F.col("spans"), fit(found)).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every accepted span replaced by its kind in brackets; overlapping spans make one.

    The candidates are found once to fit the classifier and once more in the rewriting scan.
    """
    found = stage(docs.select(candidates(F.coalesce(F.col(text_col), F.lit(""))).alias("spans")), "pii-candidates")
    return docs.withColumn(text_col, redacted(F.col(text_col), fit(found)))


def redacted(text: Column, model: Model | None) -> Column:
    spans = F.transform(accepted(candidates(F.coalesce(text, F.lit(""))), model),
                        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))

    def rebuild(s):
        # pieces before each span, cut where the last span ended; spans inside an earlier one vanish
        zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))

        def step(acc, t):
            lead = F.substring(text, acc["at"] + 1, F.greatest(t["start"] - acc["at"], F.lit(0)))
            piece = F.when(t["start"] >= acc["at"], F.concat(lead, F.lit("["), F.upper(t["kind"]), F.lit("]"))).otherwise(F.lit(""))
            return F.struct(F.greatest(acc["at"], t["end"]).alias("at"), F.concat(acc["out"], F.array(piece)).alias("out"))
        return F.aggregate(s, zero, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, _let(F.array_sort(spans), rebuild)).otherwise(text)


def digest(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
