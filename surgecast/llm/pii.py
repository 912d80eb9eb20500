"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Every document is searched for base spans (strict patterns, always kept) and for further candidates
(loose patterns). Four labelers vote on each span: its shape, a checksum or range, a gazetteer of
typical parts and the words before it. Expectation-maximisation over the counts of vote patterns
estimates, without labels, how reliable each labeler is for each kind; a logistic classifier is
trained on the resulting posteriors and decides which candidates are added to the base spans.

All text work is done by built-in expressions. The driver sees only the counts of vote patterns, of
which there are at most ``len(KINDS) * 3**4``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: In the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")

# Possessive quantifiers and the look-behinds match as the plain patterns do: a run that fails from
# its first character fails from every other one. They keep long runs linear.
_LOCAL = "[A-Za-z0-9._%+-]"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
STRICT = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++ ?[\[(] ?(?:at|@) ?[\])] ?[A-Za-z0-9-]++(?:(?: ?[\[(] ?(?:dot|\.) ?[\])] ?|\.)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
#: Cheap tests without which a text holds no strict and no loose span.
_NEEDS = {"email": r"@|[\[(] ?at ?[\])]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
# Typical parts and words that announce a kind of span.
GAZETTEER = {
    "email": r"(?i)(?:\.|dot ?[\])] ?)(?:com|org|net|edu|gov|info|io|de|fr|es|uk)$",
    "ip": r"^(?!0|255)",
    "card": "^(?:4|5[1-5]|2[2-7]|3[47]|6)",
    "phone": r"^\+(?:1|33|34|44|49)\b|555",
}
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|kontakt|correo|courriel)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|client)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(?:phone|tel|call|fax|mobile|telefon|t[eé]l[eé]phone|tel[eé]fono)\b",
}
AGAINST = r"(?i)\b(?:order|isbn|issn|version|invoice|id|no|nr|total|token)\b\W*$"
CONTEXT_CHARS = 24
VOTES = ("shape", "check", "gazetteer", "context")
ABSTAIN, NO, YES = -1, 0, 1
_SPAN = "array<struct<s:int,e:int,m:string>>"


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, end, text), in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    steps = F.arrays_zip(gaps.alias("gap"), found.alias("m"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(x["gap"])
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.array_append(acc["out"], F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m"))).alias("out"))

    return F.aggregate(steps, start, step, lambda acc: acc["out"])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the checksum over a string of digits holds."""
    each = F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0))
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 1, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def checked(kind: str, m: Column) -> Column:
    """Whether a match passes the test of its kind."""
    if kind == "ip":
        return F.regexp_replace(m, r"[\[\]]", "").rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.length(_digits(m)).between(13, 19) & luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    """Yes where ``yes``; no where ``no``, or wherever it isn't yes if no such test is given."""
    return F.when(yes, YES).otherwise(NO if no is None else F.when(no, NO).otherwise(ABSTAIN)).cast("int")


def _judged(text: Column, kind: str, spans: Column, base: bool) -> Column:
    """Spans with the labelers' votes."""

    def one(x: Column) -> Column:
        left = F.greatest(x["s"] - CONTEXT_CHARS, F.lit(0))
        before = F.substring(text, left + 1, x["s"] - left)
        compact = F.regexp_replace(x["m"], r"[ ().\[\]-]", "")
        votes = {
            "shape": _vote(F.lit(base) | x["m"].rlike(r"^[^ ]+$|^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$")),
            "check": _vote(checked(kind, x["m"])),
            "gazetteer": _vote((x["m"] if kind in ("email", "phone") else compact).rlike(GAZETTEER[kind])),
            "context": _vote(before.rlike(CONTEXT[kind]), before.rlike(AGAINST)),
        }
        return F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), F.lit(base).alias("base"), *(votes[v].alias(v) for v in VOTES))

    return F.transform(spans, one)


def _apart(a: Column, b: Column) -> Column:
    return (a["e"] <= b["s"]) | (b["e"] <= a["s"])


def with_candidates(df: DataFrame, text: str, to: str = "__spans") -> DataFrame:
    """``df`` with an array of all base spans and further candidates; those overlap no base span.

    Null texts have none.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast(_SPAN)
    base, loose = {}, {}

    def passing(kind: str) -> Column:
        return F.filter(matches(body, STRICT[kind]), lambda x: checked(kind, x["m"]))

    def free(kind: str) -> Column:
        return F.filter(F.col(f"__loose_{kind}"), lambda x: F.forall(taken, lambda b: _apart(x, b)))

    for kind in KINDS:
        has = body.rlike(_NEEDS[kind])
        base[f"__base_{kind}"] = F.when(has, passing(kind)).otherwise(none)
        loose[f"__loose_{kind}"] = F.when(has, matches(body, LOOSE[kind])).otherwise(none)
    found = df.withColumns(base | loose)
    taken = F.concat(*(F.col(c) for c in base))
    judged = []
    for kind in KINDS:
        judged += [_judged(body, kind, F.col(f"__base_{kind}"), True), _judged(body, kind, free(kind), False)]
    return found.withColumn(to, F.concat(*judged)).drop(*base, *loose)


def _posteriors(counts: dict, rounds: int) -> dict:
    """P(personal data) of every (kind, votes) by EM over independent labelers, started from the majority."""
    result = {}
    for kind in KINDS:
        own = {votes: n for (k, votes), n in counts.items() if k == kind}
        belief = {v: min(0.95, max(0.05, (1 + sum(x == YES for x in v)) / (2 + sum(x != ABSTAIN for x in v)))) for v in own}
        for _ in range(rounds if own else 0):
            mass = {y: sum(n * (belief[v] if y else 1 - belief[v]) for v, n in own.items()) for y in (0, 1)}
            prior = (mass[1] + 1) / (mass[0] + mass[1] + 2)
            says = {
                (j, x, y): (sum(n * (belief[v] if y else 1 - belief[v]) for v, n in own.items() if v[j] == x) + (1.5 if x == y else 0.5)) / (mass[y] + 2.5)
                for j in range(len(VOTES)) for x in (ABSTAIN, NO, YES) for y in (0, 1)
            }
            for v in own:
                odds = math.log(prior / (1 - prior)) + sum(math.log(says[j, x, 1] / says[j, x, 0]) for j, x in enumerate(v))
                belief[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        result |= {(kind, v): (n, belief[v]) for v, n in own.items()}
    return result


def _features(votes: Sequence[int]) -> list[float]:
    return [1.0, *(float(x == YES) - float(x == NO) for x in votes)]


def fit(spans: DataFrame, column: str = "__spans", rounds: int = 30, steps: int = 400) -> dict[str, list[float]]:
    """Weights of the span classifier of each kind: bias, then one for each labeler.

    Counts vote patterns over all spans; without spans of a kind its classifier adds nothing.
    """
    each = spans.select(F.explode(column).alias("x")).groupBy("x.kind", *(f"x.{v}" for v in VOTES)).count()
    counts = {(r["kind"], tuple(r[v] for v in VOTES)): r["count"] for r in each.collect()}
    soft = _posteriors(counts, rounds)
    model = {}
    for kind in KINDS:
        rows = [(_features(v), p, math.log1p(n)) for (k, v), (n, p) in sorted(soft.items()) if k == kind]
        w = [-1.0] + [0.0] * len(VOTES)
        for _ in range(steps):
            grad = [0.01 * x for x in w]
            for f, p, n in rows:
                miss = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, f, strict=True)))) - p
                grad = [g + n * miss * x for g, x in zip(grad, f, strict=True)]
            size = sum(n for *_, n in rows) or 1.0
            w = [a - 2.0 * g / size for a, g in zip(w, grad, strict=True)]
        model[kind] = w
    return model


def decide(spans: Column, model: dict[str, list[float]]) -> Column:
    """The base spans and the candidates that the classifier takes, by kind, then start."""

    def score(x: Column) -> Column:
        out = F.lit(None).cast("double")
        for kind in KINDS:
            w = model[kind]
            total = F.lit(w[0])
            for v, a in zip(VOTES, w[1:], strict=True):
                total = total + F.lit(a) * F.when(x[v] == YES, 1.0).when(x[v] == NO, -1.0).otherwise(0.0)
            out = F.when(x["kind"] == kind, total).otherwise(out)
        return out

    taken = F.filter(spans, lambda x: x["base"] | (score(x) > 0))
    order = F.create_map(*(F.lit(v) for i, k in enumerate(KINDS) for v in (k, i)))
    keyed = F.transform(taken, lambda x: F.struct(order[x["kind"]].alias("o"), x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"), x["base"].alias("base")))
    return F.array_sort(keyed)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first decides."""
    by_start = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), x["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        here = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], -x["e"]).alias("at"), F.when(x["s"] >= acc["at"], here).otherwise(acc["out"]).alias("out"))

    rest = F.aggregate(by_start, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def find_spans(df: DataFrame, key: str, text: str) -> DataFrame:
    """The key and ``spans``: all spans of every row's text, as structs with kind, s, e and base.

    A null text is empty and has none; repeated rows and null keys are treated like any other; an
    empty table gives no rows; other columns are not read. The texts are searched once: what the
    labelers said is kept and read again for the decision.
    """
    from surgecast.llm.common import cut

    found = cut(with_candidates(df.select(F.col(key).alias("k"), F.col(text).alias("t")), "t").select("k", "__spans"))
    return found.select(F.col("k").alias(key), decide(F.col("__spans"), fit(found)).alias("spans"))


def mask_spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` with personal data in ``text`` replaced by the kind in brackets; null stays null."""
    model = fit(with_candidates(df.select(F.col(text).alias("t")), "t").select("__spans"))
    return with_candidates(df, text).withColumn(text, masked(F.col(text), decide(F.col("__spans"), model))).drop("__spans")
