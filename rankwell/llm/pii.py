"""Personal data in texts: patterns, and further spans found by weak supervision.

Only DataFrame functions touch the texts. Spans are code-point offsets, end exclusive.

Base spans, leftmost and non-overlapping per kind: email, ip (parts at most 255), card (12 to 19 digits that
pass the Luhn test), phone ("+", 9 to 15 digits). A match that fails its test is dropped and not retried.

Weak supervision adds spans of two more kinds: ``person`` (a capitalised name after a title or a frequent
first name) and ``number`` (phone numbers without "+", social-security-like and IBAN-like numbers).
1. Every match of any pattern, the failing ones too, is a candidate.
2. Four labelers vote yes, no or nothing on it: the format (the kind's strict test), a gazetteer (first
   names, titles, IBAN countries), the words before it, and its digits or letters.
3. Spark counts the candidates by kind, length class and votes, a table of at most ``6 * 3 * 3**4`` rows
   whatever the corpus. Expectation maximisation on these counts estimates each labeler's
   reliability and a posterior for each row (one hidden class, votes independent given it).
4. A logistic model of kind, length class and votes is fitted to the posteriors. Candidates of the two new kinds with
   a probability of 0.5 or more that touch no base span are the spans that are added; base spans always stay.
The fitted weights are literals of the final projection, which reads the texts once more and shuffles nothing.

The patterns take the contract's expressions in a form without backtracking: possessive quantifiers, and a
look-behind that starts a match only at the start of a run of its first characters, so a very long run of
letters or digits costs linear time and no stack.

Defined cases: null text counts as empty; null ids, repeated rows and an empty table are fine (without
candidates the classifier keeps its prior weights); other columns are ignored, or kept by ``mask_pii``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwell.llm.frames import read
from rankwell.llm.quality_rules import let

KINDS = ["email", "ip", "card", "phone", "person", "number"]
N_BASE = 4
VOTERS = ["format", "gazetteer", "context", "shape"]
#: Fixed values.
FIRST_NAMES = [
    "James", "John", "Robert", "Michael", "William", "David", "Richard", "Joseph", "Thomas", "Charles", "Mary", "Patricia", "Jennifer",
    "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Sarah", "Karen", "Hans", "Peter", "Klaus", "Wolfgang", "Ursula", "Monika",
    "Sabine", "Jean", "Pierre", "Michel", "Marie", "Nathalie", "Isabelle", "José", "Juan", "Carlos", "Carmen", "Pilar", "Ana",
]
TITLES = ["Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Mme", "Señor", "Señora"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "person": r"(?<![\p{L}\p{N}])(?:(?:" + "|".join(TITLES) + r")\.?|" + "|".join(FIRST_NAMES) + r") \p{Lu}\p{Ll}{1,30}(?: \p{Lu}\p{Ll}{1,30})?(?!\p{L})",
    "number": r"(?<![0-9A-Za-z.+@-])(?:\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7})(?![0-9A-Za-z@-])",
}
CONTEXT = {
    "email": r"(?i)(mail|contact|write|kontakt|correo|courriel)\P{L}*+(\p{L}++\P{L}*+)?$",
    "ip": r"(?i)(\bip|address|host|server|adresse|dirección)\P{L}*+(\p{L}++\P{L}*+)?$",
    "card": r"(?i)(card|visa|credit|karte|carte|tarjeta)\P{L}*+(\p{L}++\P{L}*+)?$",
    "phone": r"(?i)(phone|call|tel|fax|mobile|telefon|llam)\P{L}*+(\p{L}++\P{L}*+)?$",
    "person": r"(?i)(name|dear|by|from|am|contact|von|par|señor)\P{L}*+$",
    "number": r"(?i)(phone|call|tel|fax|mobile|ssn|social|iban|account|konto|compte|cuenta)\P{L}*+(\p{L}++\P{L}*+)?$",
}
#: What a pattern cannot do without; texts that lack it skip the pattern.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+", "person": None, "number": None}
PART = r"(?:0++(?![0-9])|0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9][0-9]?))"
_SPAN = "array<struct<start:int,end:int,value:string,left:string>>"
ROUNDS = 50


def matches(text: Column, pattern: str) -> Column:
    """start, end, value and the 40 characters before, for each match in order."""
    none = F.array().cast(_SPAN)

    def walk(found: Column) -> Column:
        def sums(parts: Column) -> Column:
            def step(a: Column, i: Column) -> Column:
                start = a["at"] + F.length(F.get(parts, i))
                end = start + F.length(F.get(found, i))
                span = F.struct(start.alias("start"), end.alias("end"), F.get(found, i).alias("value"), F.right(F.get(parts, i), F.lit(40)).alias("left"))
                return F.struct(end.alias("at"), F.concat(a["out"], F.array(span)).alias("out"))
            start = F.struct(F.lit(0).alias("at"), none.alias("out"))
            return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), start, step, lambda a: a["out"])
        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), sums)).otherwise(none)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), walk)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def _luhn(value: Column) -> Column:
    def check(d: Column) -> Column:
        digit = lambda i: F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
        twice = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        total = F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda a, i: a + F.when(i % 2 == 1, twice(digit(i))).otherwise(digit(i)))
        return F.when(F.length(d).between(12, 19), total % 10 == 0).otherwise(False)
    return let(_digits(value), check)


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _votes(kind: str, s: Column) -> list[Column]:
    """Each labeler's vote on a span: 1 yes, 2 no, 0 nothing."""
    value, left = s["value"], s["left"]
    yes_no = lambda c: F.when(c, 1).otherwise(2)
    known = {"email": value.rlike(r"(?i)\.(com|org|net|edu|gov|de|fr|es|uk|io)$"), "person": value.rlike("(?:" + "|".join(FIRST_NAMES) + ") "),
             "number": value.rlike(r"^(?:DE|FR|ES|GB|IT|NL)[0-9]{2}")}.get(kind, F.lit(False))
    n = F.length(_digits(value))
    shape = {"email": ~value.rlike(r"\.\.|^[.-]"), "ip": n.between(4, 12), "card": n.between(15, 16), "phone": n.between(10, 13),
             "person": F.length(value) >= 6, "number": n.between(9, 24)}[kind]
    form = {"person": value.rlike("^(?:" + "|".join(TITLES) + r")\.? "),
            "number": value.rlike(r"^(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|\([0-9]{3}\) .*|[A-Z]{2}.*)$")}.get(kind)
    return [yes_no(_passes(kind, value)) if form is None else F.when(form, 1).otherwise(0), F.when(known, 1).otherwise(0),
            F.when(left.rlike(CONTEXT[kind]), 1).otherwise(0), yes_no(shape)]


def _size(s: Column) -> Column:
    n = s["end"] - s["start"]
    return F.when(n < 12, 0).when(n < 18, 1).otherwise(2)


def candidates(text: Column) -> Column:
    """All matches of all patterns: kind (its place in KINDS), start, end, ok (the kind's test), size and votes."""
    def of(rank: int, kind: str):
        return lambda s: F.struct(
            F.lit(rank).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), _passes(kind, s["value"]).alias("ok"),
            _size(s).alias("size"), F.array(*_votes(kind, s)).alias("votes"))

    out = []
    for rank, kind in enumerate(KINDS):
        judged = F.transform(matches(text, PATTERNS[kind]), of(rank, kind))
        need = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else None
        out.append(judged if need is None else F.when(need, judged).otherwise(F.array().cast(
            "array<struct<kind:int,start:int,end:int,ok:boolean,size:int,votes:array<int>>>")))
    return F.concat(*out)


def vote_counts(docs: DataFrame, text_col: str = "text") -> list[tuple[int, int, tuple[int, ...], int]]:
    """(kind, size, votes, candidates) for every combination that occurs; their number does not depend on the corpus."""
    rows = docs.select(F.explode(candidates(F.coalesce(F.col(text_col), F.lit("")))).alias("c")).groupBy(
        F.col("c.kind"), F.col("c.size"), F.col("c.votes")).agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted((r["kind"], r["size"], tuple(r["votes"]), r["n"]) for r in rows)


def estimate(counts: list[tuple[int, int, tuple[int, ...], int]]) -> tuple[float, list[list[list[float]]], list[float]]:
    """Expectation maximisation: the share of true candidates, P(vote | class) by labeler, and a posterior for each row."""
    share = 0.5
    table = [[[0.2, 0.2, 0.6], [0.3, 0.6, 0.1]] for _ in VOTERS]  # [labeler][false, true][nothing, yes, no]
    posterior = [0.5] * len(counts)
    for _ in range(ROUNDS):
        for i, (_, _, votes, _) in enumerate(counts):
            yes, no = math.log(share), math.log(1 - share)
            for j, v in enumerate(votes):
                yes, no = yes + math.log(table[j][1][v]), no + math.log(table[j][0][v])
            posterior[i] = 1 / (1 + math.exp(min(50.0, max(-50.0, no - yes))))
        total = sum(c[3] for c in counts)
        if not total:
            break
        share = (1 + sum(p * c[3] for p, c in zip(posterior, counts))) / (2 + total)
        for j in range(len(VOTERS)):
            for true in (0, 1):
                seen = [1.0, 1.0, 1.0]  # one pseudo-count each
                for p, (_, _, votes, n) in zip(posterior, counts):
                    seen[votes[j]] += n * (p if true else 1 - p)
                table[j][true] = [x / sum(seen) for x in seen]
    return share, table, posterior


def _features(kind: int, size: int, votes: tuple[int, ...]) -> list[int]:
    """The indices of the model's active features."""
    return [1 + kind, 1 + len(KINDS) + size, *(4 + len(KINDS) + 3 * j + v for j, v in enumerate(votes))]


N_WEIGHTS = 4 + len(KINDS) + 3 * len(VOTERS)


def train(counts: list[tuple[int, int, tuple[int, ...], int]], posterior: list[float]) -> list[float]:
    """Logistic regression on the posteriors, each row weighted by the logarithm of its candidates; the prior
    weights (a yes speaks for, a no against) also carry features that never occur."""
    weights = [0.0] * N_WEIGHTS
    for j in range(len(VOTERS)):
        weights[4 + len(KINDS) + 3 * j + 1], weights[4 + len(KINDS) + 3 * j + 2] = 1.0, -1.0
    prior = list(weights)
    mass = [math.log1p(c[3]) for c in counts]
    for _ in range(500):
        slope = [0.02 * (w - p) for w, p in zip(weights, prior)]
        for (kind, size, votes, _), target, m in zip(counts, posterior, mass):
            active = [0, *_features(kind, size, votes)]
            p = 1 / (1 + math.exp(-max(-50.0, min(50.0, sum(weights[k] for k in active)))))
            for k in active:
                slope[k] += (p - target) * m / sum(mass)
        weights = [w - 1.0 * s for w, s in zip(weights, slope)]
    return weights


def fit(docs: DataFrame, text_col: str = "text") -> list[float]:
    """The span classifier's weights, learned on all texts of ``docs``."""
    counts = vote_counts(docs, text_col)
    return train(counts, estimate(counts)[2])


def pii_spans(text: Column, weights: list[float]) -> Column:
    """Sorted array of (start, kind, end, base) structs, ``kind`` as its place in KINDS."""
    w = [F.lit(float(x)) for x in weights]
    pick = lambda at, first, n: F.get(F.array(*w[first:first + n]), at)

    def score(c: Column) -> Column:
        total = w[0] + pick(c["kind"], 1, len(KINDS)) + pick(c["size"], 1 + len(KINDS), 3)
        for j in range(len(VOTERS)):
            total = total + pick(F.get(c["votes"], j), 4 + len(KINDS) + 3 * j, 3)
        return total

    def select(found: Column) -> Column:
        def add(base: Column) -> Column:
            clear = lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
            return F.concat(base, F.filter(found, lambda c: (c["kind"] >= N_BASE) & (score(c) >= 0) & clear(c)))
        return let(F.filter(found, lambda c: (c["kind"] < N_BASE) & c["ok"]), add)

    spans = F.transform(let(candidates(text), select), lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), (c["kind"] < N_BASE).alias("base")))
    return F.array_sort(spans)


def _listed(spans: Column) -> Column:
    name = lambda k: F.get(F.array(*map(F.lit, KINDS)), k)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: list[float] | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id and spans, an array of (start, kind, end, base)."""
    weights = fit(docs, text_col) if weights is None else weights
    return docs.select(F.col(id_col).alias("doc_id"), pii_spans(F.coalesce(F.col(text_col), F.lit("")), weights).alias("spans"))


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span (overlapping ones as one, named by the first) replaced by its kind in brackets."""
    weights = fit(docs, text_col)
    text = F.col(text_col)
    tag = lambda k: F.get(F.array(*[F.lit(f"[{x.upper()}]") for x in KINDS]), k)

    def masked(spans: Column) -> Column:
        def step(a: Column, s: Column) -> Column:
            fresh = s["start"] >= a["at"]
            piece = F.concat(F.substring(text, a["at"] + 1, s["start"] - a["at"]), tag(s["kind"]))
            return F.struct(F.greatest(a["at"], s["end"]).alias("at"),
                            F.when(fresh, F.concat(a["out"], F.array(piece))).otherwise(a["out"]).alias("out"))
        def done(a: Column) -> Column:
            return F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text)))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
        return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, done))

    return docs.withColumn(text_col, F.when(text.isNotNull(), let(pii_spans(text, weights), masked)))


def op9_pii(spark, sf_dir: str) -> DataFrame:
    found = find_pii(read(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", count("email"), count("ip"), count("card"), count("phone"),
                        F.sha2(_listed(F.filter("spans", lambda s: s["base"])).cast("binary"), 256).alias("base_sha256"),
                        _listed(F.col("spans")).alias("spans"))
