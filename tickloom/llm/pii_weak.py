"""Personal data by weak supervision, in DataFrame functions alone.

Patterns propose candidate spans. Labelers vote on each: its form, gazetteers of domains,
issuers, networks and calling codes, the words before it, and what it touches. Expectation
maximisation over the counts of vote patterns estimates how often each labeler is right,
and with that the probability of each pattern. A logistic classifier learns these
probabilities from votes, kind and length, and decides about the candidates that the
strict patterns don't settle. Spans of the strict patterns always stay.

The driver sees one row per kind, vote pattern and length class, never a text.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import stored

#: The strict kinds in their order, then the ones that only the classifier can accept.
STRICT = ("email", "ip", "card", "phone")
OTHERS = ("local", "number", "name")
KINDS = (*STRICT, *OTHERS)
_LOCAL = "A-Za-z0-9._%+-"
#: Possessive forms of the patterns: they find the same spans, without a stack that grows
#: with the match or a run that is tried again from each of its characters. ``\G`` lets a
#: match begin where the last one ended.
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "local": r"(?<![0-9+(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
    "number": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "name": r"(?<!\p{L})(?:Mrs?|Ms|Dr|Herr|Frau|Señora?|Madame|Monsieur)\.? \p{Lu}\p{Ll}++",
}
#: What a text must hold before a pattern is tried on it.
NEEDS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9]", "phone": "\\+[0-9]", "local": "[0-9]{4}", "number": "[0-9]{4}",
         "name": " \\p{Lu}"}
#: Gazetteers, as prefixes or endings of the span.
GAZETTEER = {
    "email": r"\.(?:com|org|net|edu|gov|io|info|de|fr|es|uk|eu)$",
    "card": "^(?:4|5[1-5]|2[2-7]|6011|65|35|3[47])",
    "phone": r"^\+(?:1|2[07]|3[0-469]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])",
    "local": r"^\(?[2-9]",
    "number": "^(?!000|666|9)",
}
RESERVED = r"^(?:0|10|127|169\.254|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|2(?:2[4-9]|[34][0-9]|5[0-5]))\."
#: Words before a span that speak for and against personal data.
FOR = r"(?i)(?:mail|contact|tel|phone|call|fax|mobil|card|visa|ssn|social|address|host|from|ip|name)\W{0,3}$"
AGAINST = r"(?i)(?:version|release|section|chapter|order|isbn|page|build|\bv|#|=|/|\$|€|§)\s{0,2}$"
LABELERS = ("form", "gazetteer", "context", "edges")
ACCEPT = 0.9
LENGTHS = (10, 16, 24)


def found(text: Column, kind: str) -> Column:
    """Matches of a kind in order, each with the length of the gap before it."""
    pattern = F.lit(PATTERNS[kind])
    gaps = F.split(text, PATTERNS[kind], -1)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    n = F.size(matches)
    rows = F.transform(
        F.arrays_zip(matches.alias("m"), F.slice(gaps, F.lit(1), n).alias("a"), F.slice(gaps, F.lit(2), n).alias("b")),
        lambda z, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.char_length(z["a"]).alias("gap"), z["m"].alias("match"),
            F.right(z["a"], F.lit(24)).alias("before"), F.left(z["b"], F.lit(2)).alias("after")))
    none = F.array().cast("array<struct<kind:string,i:int,gap:int,match:string,before:string,after:string>>")
    return F.when(text.rlike(NEEDS[kind]), rows).otherwise(none)


def luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    plain = F.regexp_replace(back, "(.)(.)?", "$1")
    doubled = F.translate(F.regexp_replace(back, "(.)(.)?", "$2"), "0123456789", "0246813579")
    total = F.aggregate(F.split(F.concat(plain, doubled), ""), F.lit(0), lambda s, x: s + F.coalesce(F.try_to_number(x, F.lit("9")).cast("int"), F.lit(0)))
    return total % 10 == 0


def strict(kind: Column, match: Column) -> Column:
    """Whether a match of a strict kind passes its check; false for other kinds."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    small = F.forall(parts, lambda p: (F.char_length(p) < 3) | ((F.char_length(p) == 3) & (p <= "255")))
    return (
        F.when(kind == "email", F.lit(True)).when(kind == "ip", small)
        .when(kind == "card", F.char_length(digits).between(16, 19) & F.when(F.char_length(digits).between(16, 19), luhn(digits)).otherwise(False))
        .when(kind == "phone", F.char_length(digits).between(8, 15)).otherwise(False))


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate with its place in code points, and one without for a document
    that has none. ``row`` numbers the documents."""
    text = F.coalesce("text", F.lit(""))
    every = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text.alias("text"))
    listed = stored(every.select("doc_id", "row", F.explode_outer(F.concat(*[found(F.col("text"), k) for k in KINDS])).alias("c"))
                    .select("doc_id", "row", "c.*"), "candidates")
    before = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.char_length("match")).over(before).cast("long")
    return listed.withColumn("end", end).withColumn("start", F.col("end") - F.char_length("match"))


def voted(spans: DataFrame) -> DataFrame:
    """Adds ``base`` and a vote of each labeler: 1 for, 0 against, -1 none."""
    kind, match = F.col("kind"), F.col("match")
    base = strict(kind, match)
    plain = F.translate(match, " -", "")
    gazetteer = reduce(
        lambda c, k: c.when(kind == k, F.when((plain if k == "card" else match).rlike(GAZETTEER[k]), 1).otherwise(0)), GAZETTEER,
        F.when(kind == "ip", F.when(match.rlike(RESERVED), 0).otherwise(1))).otherwise(-1)
    context = F.when(F.col("before").rlike(AGAINST), 0).when(F.col("before").rlike(FOR), 1).otherwise(-1)
    touches = F.col("before").rlike(r"[\p{L}0-9.-]$") | F.col("after").rlike(r"^(?:[\p{L}0-9]|[.-][\p{L}0-9])")
    return spans.withColumns({
        "base": base, "form": F.when(kind.isin(*STRICT), base.cast("int")).otherwise(-1), "gazetteer": gazetteer, "context": context,
        "edges": F.when(touches, 0).otherwise(1),
        "size": reduce(lambda c, n: c + (F.char_length("match") > n).cast("int"), LENGTHS, F.lit(0))})


def estimate(patterns: Sequence[dict], rounds: int = 40) -> list[float]:
    """P(personal) of each vote pattern (kind, votes, n) by expectation maximisation.

    A labeler votes right with one rate for personal data and one for the rest; each kind
    has its share of personal data. Votes start as a majority; abstentions say nothing.
    """
    def start(p):
        votes = [p[v] for v in LABELERS if p[v] >= 0]
        return (sum(votes) + 1) / (len(votes) + 2)

    belief = [start(p) for p in patterns]
    for _ in range(rounds):
        share, right = {}, {}
        for k in {p["kind"] for p in patterns}:
            own = [(b, p["n"]) for b, p in zip(belief, patterns) if p["kind"] == k]
            share[k] = (sum(b * n for b, n in own) + 1) / (sum(n for _, n in own) + 2)
        for v in LABELERS:
            said = [(b, p["n"], p[v]) for b, p in zip(belief, patterns) if p[v] >= 0]
            right[v] = tuple(
                (sum(weight(b) * n for b, n, x in said if x == vote) + 2) / (sum(weight(b) * n for b, n, _ in said) + 3)
                for vote, weight in ((1, lambda b: b), (0, lambda b: 1 - b)))
        belief = []
        for p in patterns:
            odds = math.log(share[p["kind"]] / (1 - share[p["kind"]]))
            for v in LABELERS:
                if p[v] >= 0:
                    yes, no = right[v]
                    odds += math.log(yes / (1 - no)) if p[v] else math.log((1 - yes) / no)
            belief.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return belief


def inputs(p: dict) -> list[str]:
    return ["bias", f"kind={p['kind']}", f"size={p['size']}", *(f"{v}={p[v]}" for v in LABELERS)]


def classifier(patterns: Sequence[dict], belief: Sequence[float], rounds: int = 300) -> dict[str, float]:
    """Weights of a logistic model, fitted to the beliefs; every pattern counts by the
    logarithm of its rows."""
    weights: dict[str, float] = {}
    mass = [math.log1p(p["n"]) for p in patterns]
    total = sum(mass) or 1.0
    for _ in range(rounds):
        slope: dict[str, float] = {}
        for p, b, m in zip(patterns, belief, mass):
            x = inputs(p)
            guess = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights.get(f, 0.0) for f in x)))))
            for f in x:
                slope[f] = slope.get(f, 0.0) + m * (b - guess) / total
        for f, s in slope.items():
            weights[f] = weights.get(f, 0.0) + 2.0 * (s - 0.001 * weights.get(f, 0.0))
    return weights


def probability(weights: dict[str, float]) -> Column:
    total = F.lit(weights.get("bias", 0.0))
    for name, w in weights.items():
        if name != "bias":
            column, value = name.split("=")
            total = total + F.when(F.col(column).cast("string") == value, F.lit(w)).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def personal_data(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, spans (kind, start, end, base, p).

    Places are code points, end exclusive; spans come in the order of the kinds, then of
    their start. Base spans are the matches of the strict patterns that pass their checks;
    others are accepted by the classifier from ``accept`` on, if no base span overlaps.
    A null text is an empty one and has none; repeated rows each come back.
    """
    spans = stored(voted(candidates(docs)), "votes")
    rows = spans.where("kind is not null").groupBy("kind", "size", *LABELERS).agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = sorted((r.asDict() for r in rows), key=lambda p: [p["kind"], p["size"], *(p[v] for v in LABELERS)])
    p = probability(classifier(patterns, estimate(patterns)))
    place = reduce(lambda c, k: c.when(F.col("kind") == k, KINDS.index(k)), KINDS, F.when(F.lit(False), -1))
    kept = F.when(F.col("kind").isNotNull() & (F.col("base") | (F.col("p") >= accept)),
                  F.struct(place.alias("place"), "start", "end", "kind", "base", "p"))
    grouped = spans.withColumn("p", F.when(F.col("base"), F.greatest(p, F.lit(accept))).otherwise(p)).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(kept)).alias("all"))
    base = F.filter("all", lambda s: s["base"])
    free = lambda s: ~F.exists("strict", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return grouped.withColumn("strict", base).select(
        "doc_id", F.transform(F.filter("all", lambda s: s["base"] | free(s)),
                              lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                                 s["base"].alias("base"), s["p"].alias("p"))).alias("spans"))


def digest(docs: DataFrame) -> DataFrame:
    written = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return personal_data(docs).select("doc_id", *map(count, STRICT), F.sha2(written(base), 256).alias("base_sha256"), written("spans").alias("spans"))
