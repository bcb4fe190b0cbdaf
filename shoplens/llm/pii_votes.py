"""Operator 7: personal data by weak supervision (built-in functions only).

1. Candidate spans with code-point offsets, per kind. The base pattern of a
   kind gives its certain spans; a looser pattern gives further candidates.
   Offsets are running sums of the lengths of matches and of the pieces
   between them, so each text is scanned once per pattern.
2. Three labelers vote on every candidate (yes, no, abstain): a regex or
   checksum labeler, a gazetteer labeler and a context labeler.
3. Expectation-maximisation estimates, per kind, how often each labeler
   votes what on true and on false spans. The likelihood depends only on
   the counts of vote patterns (at most 27 a kind), summed over all
   documents; those counts are all that reaches the driver.
4. A naive Bayes span classifier is trained on the posteriors as soft
   labels: weighted counts of shape features, summed over all candidates.
   Candidates it accepts are added; base spans stay whatever it says.

Defined results: null or empty text has no spans (empty string, zero
counts, hash of the empty string); repeated rows are judged each for
itself; an empty table gives no rows; other columns are carried by
``find_spans`` under free names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.config import store
from shoplens.llm.common import free_name, let

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "gazetteer", "context")
FEATURES = ("pattern", "gazetteer", "context", "size", "digits", "edge")
#: Posterior from which a candidate that is no base span is added.
ACCEPT = 0.95
ROUNDS = 50

# The base patterns. Possessive runs and look-behinds only spare
# backtracking (Java matches a repeated group by recursion, which a host name of
# thousands of labels would exhaust); what they match, leftmost and without
# overlap, is the same.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser candidates: spelled-out mail signs, eight-group addresses, grouped
#: card numbers, numbers without the international prefix.
LOOSE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++\x20?[(\[]at[)\]]\x20?{_LABEL}++(?:\x20?(?:\.|[(\[]dot[)\]])\x20?{_LABEL}++)++",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){2}[\x20-][0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: A text without the sign has no match of the pattern.
_NEEDS = {"email": "@", "phone": "+"}

#: Gazetteers: top-level names, first digits of card issuers, first octets in
#: public or private use, first digits of dialling prefixes.
_TOP_LEVEL = "com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|us"
_GAZETTEER = {
    "email": rf"(?i)(?:\.|dot[)\]]\x20?)(?:{_TOP_LEVEL})$",
    "ip": r"^(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\.|^(?:20|fd|fe)[0-9A-Fa-f]*:",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)",
    "phone": r"^(?:\+[1-9]|\(?[2-9])",
}
_CONTEXT = {
    "email": r"(?i)(?:e-?mail|mailto|contact|write|courriel|correo|schreib)",
    "ip": r"(?i)\b(?:ip|host|server|client|adress|address|from)\b",
    "card": r"(?i)(?:card|visa|credit|karte|carte|tarjeta|payment)",
    "phone": r"(?i)(?:\btel|phone|call|mobile|mobil|fax|tél|anruf|llam)",
}
_AGAINST = r"(?i)\b(?:version|isbn|issn|order|invoice|serial|build|page|doi|no\.|nr\.|nº)\W*$"


def running_sums(sizes: Column) -> Column:
    """Exclusive running sums of an array of n entries, in three levels of about n^(1/3) each."""
    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0).cast("bigint"), lambda x, y: x + y)

    def blocks_of(a: Column, width: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(a) / width).cast("int")),
                           lambda b: total(F.slice(a, b * width + 1, width)))

    def by_width(width: Column) -> Column:
        def by_small(small: Column) -> Column:
            def at(i: Column, large: Column) -> Column:
                block = F.floor(i / width).cast("int")
                above = F.floor(block / width).cast("int")
                return (total(F.slice(large, 1, above)) + total(F.slice(small, above * width + 1, block - above * width))
                        + total(F.slice(sizes, block * width + 1, i - block * width)))

            return let(blocks_of(small, width), lambda large: F.transform(sizes, lambda _, i: at(i, large)))

        return let(blocks_of(sizes, width), by_small)

    return let(F.greatest(F.lit(1), F.ceil(F.cbrt(F.size(sizes))).cast("int")), by_width)


def matches(text: Column, pattern: str, needs: str | None) -> Column:
    """Array of (start, end, match, left, right); offsets in code points."""
    empty = F.from_json(F.lit("[]"), "array<struct<start:bigint,end:bigint,match:string,left:string,right:string>>")

    def located(found: Column) -> Column:
        def with_gaps(gaps: Column) -> Column:
            sizes = F.transform(found, lambda m, i: (F.length(F.get(gaps, i)) + F.length(m)).cast("bigint"))

            def spans(before: Column) -> Column:
                def one(m: Column, i: Column) -> Column:
                    start = F.get(before, i) + F.length(F.get(gaps, i))
                    return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("match"),
                                    F.right(F.get(gaps, i), F.lit(32)).alias("left"),
                                    F.left(F.get(gaps, i + 1), F.lit(16)).alias("right"))
                return F.transform(found, one)

            return let(sizes, lambda s: let(running_sums(s), spans))

        return F.when(F.size(found) == 0, empty).otherwise(let(F.split(text, pattern, -1), with_gaps))

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)
    return found if needs is None else F.when(F.contains(text, F.lit(needs)), found).otherwise(empty)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def step(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))
    total = F.aggregate(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), step), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _octets_ok(match: Column) -> Column:
    return F.forall(F.split(match, "\\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^[0-9]{1,3}$")
                    & (F.right(p, F.lit(3)).cast("int") <= 255))


def is_base(kind: str, match: Column) -> Column:
    """The base checks after the base pattern."""
    n = F.length(_digits(match))
    return {"email": lambda: F.lit(True), "ip": lambda: _octets_ok(match),
            "card": lambda: F.when(n.between(14, 19), luhn(_digits(match))).otherwise(F.lit(False)),
            "phone": lambda: n.between(10, 15)}[kind]()


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0).cast("tinyint")


def _judged(kind: str, m: Column, strict: bool) -> Column:
    """One match as a candidate struct: kind, start, end, base, votes and shape features."""
    n = F.length(_digits(m["match"]))
    checked = {"card": n.between(13, 19) & luhn(_digits(m["match"])), "email": F.lit(True),
               "ip": F.lit(not strict) | _octets_ok(m["match"]), "phone": n.between(10, 15)}[kind]
    known = m["match"].rlike(_GAZETTEER[kind])
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
        (is_base(kind, m["match"]) if strict else F.lit(False)).alias("base"),
        _vote(checked, ~checked).alias("pattern"), _vote(known, ~known).alias("gazetteer"),
        _vote(m["left"].rlike(_CONTEXT[kind]), m["left"].rlike(_AGAINST)).alias("context"),
        F.least(F.length(m["match"]) / 8, F.lit(5)).cast("tinyint").alias("size"),
        F.least(n / 4, F.lit(6)).cast("tinyint").alias("digits"),
        (F.when(m["left"].rlike("[0-9A-Za-z]$"), 1).otherwise(0)
         + F.when(m["right"].rlike("^[0-9A-Za-z]"), 2).otherwise(0)).cast("tinyint").alias("edge"))


def _of_kind(text: Column, kind: str) -> list[Column]:
    base = F.transform(matches(text, BASE[kind], _NEEDS.get(kind)), lambda m: _judged(kind, m, True))
    loose = F.transform(matches(text, LOOSE[kind], None), lambda m: _judged(kind, m, False))
    return [F.filter(base, lambda c: c["base"]), loose]


def candidates(text: Column) -> Column:
    """Array of the candidate structs of all kinds."""
    return F.concat(*[c for kind in KINDS for c in _of_kind(text, kind)])


def estimate(patterns: list[tuple[int, tuple[int, ...], int]], rounds: int = ROUNDS) -> dict:
    """Posterior of a true span for each (kind, votes), by expectation-maximisation.

    ``patterns``: (kind, votes, count). Each labeler has, per kind, one
    probability of each vote on true and one on false spans; the start is
    the share of yes votes among those cast.
    """
    posterior = {}
    for kind in {p[0] for p in patterns}:
        rows = [(v, n) for k, v, n in patterns if k == kind]
        belief = {v: (1 + sum(x > 0 for x in v)) / (2 + sum(x != 0 for x in v)) for v, _ in rows}
        for _ in range(rounds):
            total = sum(n for _, n in rows)
            true = sum(n * belief[v] for v, n in rows)
            prior = (true + 1) / (total + 2)
            rate = {}
            for j in range(len(LABELERS)):
                for vote in (-1, 0, 1):
                    t = sum(n * belief[v] for v, n in rows if v[j] == vote)
                    f = sum(n * (1 - belief[v]) for v, n in rows if v[j] == vote)
                    # A prior count keeps a labeler better than chance where votes are few.
                    rate[j, vote] = ((t + 1 + 2 * (vote > 0)) / (true + 5),
                                     (f + 1 + 2 * (vote < 0)) / (total - true + 5))
            for v, _ in rows:
                odds = math.log(prior / (1 - prior))
                odds += sum(math.log(rate[j, x][0] / rate[j, x][1]) for j, x in enumerate(v))
                belief[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        posterior.update({(kind, v): b for v, b in belief.items()})
    return posterior


def classifier(spans: DataFrame) -> Callable[[Column], Column]:
    """A function from a span struct to its log-odds, trained on all rows of ``spans``."""
    found = spans.groupBy("kind", *LABELERS).agg(F.count(F.lit(1)).alias("n")).collect()    # 27 a kind at most
    posterior = estimate([(r["kind"], tuple(r[x] for x in LABELERS), r["n"]) for r in found])
    key = lambda kind, parts: F.concat_ws("/", kind, *parts)
    soft = _lookup({"/".join(map(str, (k, *v))): p for (k, v), p in posterior.items()},
                   key(F.col("kind"), [F.col(x) for x in LABELERS]), 0.5)
    long = spans.withColumn("p", soft).select("kind", "p", F.explode(F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f).cast("int").alias("value")) for f in FEATURES])).alias("x"))
    sums = long.groupBy("kind", "x.feature", "x.value").agg(F.sum("p").alias("t"), F.sum(1 - F.col("p")).alias("f"))
    rows = sums.collect()                              # a few values per kind and feature
    weights: dict[str, float] = {}
    priors: dict[str, float] = {}
    for kind in {r["kind"] for r in rows}:
        for feature in FEATURES:
            mine = [r for r in rows if r["kind"] == kind and r["feature"] == feature]
            t, f = sum(r["t"] for r in mine), sum(r["f"] for r in mine)
            priors[str(kind)] = math.log((t + 1) / (f + 1))
            for r in mine:
                weights[f"{kind}/{feature}/{r['value']}"] = math.log(
                    (r["t"] + 1) / (t + len(mine)) * (f + len(mine)) / (r["f"] + 1))

    def score(span: Column) -> Column:
        return sum((_lookup(weights, key(span["kind"], [F.lit(f), span[f]]), 0.0) for f in FEATURES),
                   _lookup(priors, span["kind"].cast("string"), 0.0))

    return score


def _lookup(values: dict[str, float], key: Column, default: float) -> Column:
    """A small map as an expression."""
    if not values:
        return F.lit(default)
    table = F.create_map(*[F.lit(x) for kv in sorted(values.items()) for x in kv])
    return F.coalesce(F.try_element_at(table, key), F.lit(default))


def find_spans(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` (columns ``carry``, by default all) plus an array of (kind, start, end, base)
    sorted by start, then kind; and that column's name."""
    carry = docs.columns if carry is None else carry
    name = free_name(docs.columns, "spans")
    table = store(docs.select(*carry, candidates(F.coalesce(F.col(text_col), F.lit(""))).alias(name)), "pii_spans")
    each = table.filter(F.size(name) > 0).select(F.explode(name).alias("s")).select("s.*")
    score = classifier(each)
    accept = math.log(ACCEPT / (1 - ACCEPT))

    def chosen(spans: Column) -> Column:
        def clear(s: Column) -> Column:
            return ~F.exists(spans, lambda b: b["base"] & (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return F.filter(spans, lambda s: s["base"] | ((score(s) >= accept) & clear(s)))

    final = F.when(F.exists(name, lambda s: ~s["base"]), let(F.col(name), chosen)).otherwise(F.col(name))
    ordered = F.array_sort(F.transform(final, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["base"].alias("base"))))
    return table.withColumn(name, ordered), name


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; what a span
    shares with one before it counts for that one, the rest is replaced too."""
    found, name = find_spans(docs, text_col)
    tags = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    none = F.expr("CAST(array() AS array<struct<start:bigint,end:bigint,kind:int,from:bigint>>)")

    def apart(spans: Column) -> Column:
        """What each span covers beyond those before it, with the end of these."""
        def step(acc: Column, s: Column) -> Column:
            start = F.greatest(s["start"], acc["at"])
            return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(s["end"].alias("at"), F.array_append(
                acc["kept"], F.struct(start.alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
                                      acc["at"].alias("from"))).alias("kept")))
        return F.aggregate(spans, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("kept")), step)

    def rewritten(done: Column) -> Column:
        text = F.col(text_col)
        parts = F.transform(done["kept"], lambda s: F.concat(
            F.substring(text, (s["from"] + 1).cast("int"), (s["start"] - s["from"]).cast("int")), F.get(tags, s["kind"])))
        return F.concat(F.array_join(parts, ""), F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))

    text = F.when(F.size(name) > 0, let(apart(F.col(name)), rewritten)).otherwise(F.col(text_col))
    out = found.withColumn(text_col, text)
    return out.select(*docs.columns)
