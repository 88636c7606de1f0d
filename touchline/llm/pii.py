"""Personal data by weak-supervision aggregation, with Spark expressions only.

Method: patterns propose spans; labelers of three sorts (form by regular expression, gazetteer, context) vote on each for,
against, or abstain. Proposals with the same kind, votes and features are counted, which leaves a table whose size is
bounded by the numbers of kinds, votes and bins. On it expectation-maximisation estimates, kind by kind, how reliable
each labeler is, and the resulting probabilities train the final span classifier: a log-linear one whose weights are the
log-odds of each feature. Spans of the four base kinds whose form is valid always stay; the classifier decides on others.

The time of a text follows its length and the number of its spans; neither is bounded. A text is read twice, once to count and once to decide, and is never shuffled; Python touches the counts only.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.quality import estimate

KINDS = ("email", "ip", "card", "phone", "secret", "person")
BASE = KINDS[:4]
# Patterns in Java's syntax. Possessive repeats find what greedy ones would, without backtracking or recursion. Where a
# run of characters can't match from its first on, it can't from a later one: the looks behind spare these attempts.
# A run of fewer than 12 digits is never a card and holds none, so it is left out here.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{20,}+(?![A-Za-z0-9_+/-])",
    "person": r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora)\.? \p{Lu}\p{Ll}++(?: \p{Lu}\p{Ll}++)?",
}
#: What a text must hold for a pattern to be tried at all.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
# Words before a span that speak for its kind, and words that speak against all kinds.
CUES = {
    "email": "mail email e-mail contact correo courriel kontakt write",
    "ip": "ip host server address client addr from",
    "card": "card visa mastercard amex credit debit carte tarjeta karte",
    "phone": "phone tel call mobile fax telefon téléphone teléfono",
    "secret": "token key secret password passwd pwd api apikey credential bearer",
    "person": "name dear from by signed contact",
}
AGAINST = "version isbn issn order invoice page chapter sha commit md5 checksum doi id"
# Given names and surnames that many people have.
NAMES = "anna maria john james robert michael david peter paul thomas hans klaus karl jean pierre marie claire jose juan carlos ana smith johnson brown miller müller schmidt martin bernard garcia lopez"
# What stands in manuals and tests, not for anybody.
PLACEHOLDERS = "0.0.0.0 127.0.0.1 255.255.255.255 user@example.com name@example.com 0000000000000000 4111111111111111"
CONTEXT = 24
#: Code points of a part of a text, of which a span's surroundings are cut.
PART = 4096


def _words(words: str) -> str:
    return "|".join(w.replace(".", r"\.") for w in words.split())


def _let(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value), with value worked out once."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = digit * (1 + i % 2)
        return total + F.when(doubled > 9, doubled - 9).otherwise(doubled)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _form(kind: str, found: Column) -> Column:
    """Whether what the pattern found has a valid form."""
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False)))
    if kind == "card":
        return _let(_digits(found), lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(found)).between(9, 15)
    if kind == "secret":
        return found.rlike("[0-9]") & found.rlike("[A-Za-z]") & (F.length(_digits(found)) * 8 >= F.length(found)) & ~found.rlike("[a-z]{12}")
    return F.lit(True)


def _add(a: Column, b: Column) -> Column:
    return a + b


def _running(values: Column, combine: Callable[[Column, Column], Column] = _add) -> Column:
    """Sums (or what `combine` makes of them) of numbers from 0 up to each, itself included. Takes time that grows with
    their number times its square root, as an array grows by a copy."""

    def along(part: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), F.array().cast("array<int>").alias("all"))

        def step(s: Column, v: Column) -> Column:
            return F.struct(combine(s["at"], v).alias("at"), F.array_append(s["all"], combine(s["at"], v)).alias("all"))

        return F.aggregate(part, start, step, lambda s: s["all"])

    def cut(all_: Column) -> Column:
        width = F.greatest(F.sqrt(F.size(all_)).cast("int"), F.lit(1))
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / width).cast("int")), lambda i: F.slice(all_, i * width + 1, width))
        total = lambda part: F.aggregate(part, F.lit(0), combine)
        firsts = lambda ps: along(F.concat(F.array(F.lit(0)), F.transform(F.slice(ps, 1, F.size(ps) - 1), total)), F.lit(0))
        return _let(parts, lambda ps: F.flatten(F.zip_with(ps, firsts(ps), along)))

    return F.when(F.size(values) > 0, _let(values, cut)).otherwise(F.array().cast("array<int>"))


def _found(text: Column, kind: str) -> Column:
    """Spans (begin, end, said, before, after) of a pattern, leftmost and non-overlapping, in code points.

    The text is split once at the matches, and places are running sums of the lengths of what lies between and of the
    matches, so that many spans in one text cost no more than many texts. `before` holds the last CONTEXT characters in
    front of a span, `after` the next one behind it.
    """
    pattern = F.lit(PATTERNS[kind])
    all_ = F.regexp_extract_all(text, pattern, F.lit(0))
    if kind in NEEDS:
        all_ = F.when(F.contains(text, F.lit(NEEDS[kind])), all_).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<struct<begin:int,end:int,said:string,before:string,after:string>>")

    def placed(said: Column, between: Column) -> Column:
        # matches have two characters or more: with what lies between, so many of them hold a context
        near = CONTEXT // 2
        pair = F.zip_with(F.slice(between, 1, F.size(said)), said, lambda b, m: F.struct(b.alias("between"), m.alias("said")))
        ends = _running(F.transform(pair, lambda p: F.length(p["between"]) + F.length(p["said"])))

        def span(pairs: Column, ends: Column, i: Column) -> Column:
            p = F.get(pairs, i)
            earlier = F.transform(F.slice(pairs, F.greatest(i - near, F.lit(0)) + 1, F.least(i, F.lit(near))), lambda q: F.right(F.concat(q["between"], q["said"]), F.lit(CONTEXT)))
            before = F.right(F.concat(F.array_join(earlier, ""), F.right(p["between"], F.lit(CONTEXT))), F.lit(CONTEXT))
            after = F.left(F.concat(F.left(F.get(between, i + 1), F.lit(1)), F.coalesce(F.get(pairs, i + 1)["said"], F.lit(""))), F.lit(1))
            end = F.get(ends, i)
            return F.struct((end - F.length(p["said"])).alias("begin"), end.alias("end"), p["said"].alias("said"), before.alias("before"), after.alias("after"))

        held = F.struct(pair.alias("pairs"), ends.alias("ends"))
        return _let(held, lambda h: F.transform(F.sequence(F.lit(0), F.size(said) - 1), lambda i: span(h["pairs"], h["ends"], i)))

    return _let(all_, lambda said: F.when(F.size(said) > 0, _let(F.split(text, PATTERNS[kind], -1), lambda between: placed(said, between))).otherwise(none))


def _candidate(kind: str, span: Column) -> Column:
    before = F.lower(span["before"])
    around = F.concat(F.right(span["before"], F.lit(1)), F.lit(" "), span["after"])
    low = F.lower(span["said"])
    cue = before.rlike(rf"(?<!\p{{L}})(?:{_words(CUES[kind])})(?!\p{{L}})")
    against = before.rlike(rf"(?<!\p{{L}})(?:{_words(AGAINST)})(?!\p{{L}})")
    known = low.rlike(rf"(?<!\p{{L}})(?:{_words(NAMES)})(?!\p{{L}})") if kind == "person" else F.lit(False)
    glued = around.rlike(r"[\p{L}\p{N}]")
    valid = _form(kind, span["said"])
    digits = F.floor(4 * F.length(_digits(span["said"])) / (F.length(span["said"]) + 1)).cast("int")
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        span["begin"].alias("begin"),
        span["end"].alias("end"),
        (valid if kind in BASE else F.lit(False)).alias("base"),
        F.array(
            F.when(valid, 1).otherwise(-1),
            F.when(low.isin(*PLACEHOLDERS.split()), -1).when(known, 1).otherwise(0),
            F.when(cue & ~against, 1).when(against & ~cue, -1).otherwise(0),
            F.when(glued, -1).otherwise(0),
        ).alias("votes"),
        F.array(F.least(F.floor(F.log2(F.length(span["said"]))).cast("int"), F.lit(7)), digits, cue.cast("int"), against.cast("int"), glued.cast("int"), valid.cast("int")).alias("features"),
    )


def candidates(text: Column) -> Column:
    """All proposals in a text (null: none): array of struct kind, begin, end, base, votes, features."""
    text = F.coalesce(text, F.lit(""))
    return F.concat(*(F.transform(_found(text, k), functools.partial(_candidate, k)) for k in KINDS))


LABELERS, FEATURES = 4, 6


def train(docs: DataFrame) -> dict[tuple[int, int, int], float]:
    """Weights of the classifier by kind, feature and value, from rows with a `text`; feature -1 is the constant."""
    each = docs.select(F.explode(candidates(F.col("text"))).alias("c")).groupBy("c.kind", "c.votes", "c.features").agg(F.count("*").alias("n")).collect()
    weights: dict[tuple[int, int, int], float] = {}
    for kind in range(len(KINDS)):
        rows = [r for r in each if r["kind"] == kind]
        counts: dict[tuple[int, ...], int] = {}
        for r in rows:
            votes = tuple(r["votes"])
            counts[votes] = counts.get(votes, 0) + r["n"]
        found = estimate(counts, LABELERS)
        yes, no = 1.0, 1.0
        seen: dict[tuple[int, int], list[float]] = {}
        for r in rows:
            p = found.posterior(tuple(r["votes"]))
            yes, no = yes + r["n"] * p, no + r["n"] * (1 - p)
            for feature, value in enumerate(r["features"]):
                pair = seen.setdefault((feature, value), [0.5, 0.5])
                pair[0] += r["n"] * p
                pair[1] += r["n"] * (1 - p)
        weights[kind, -1, 0] = math.log(yes / no)
        for (feature, value), (a, b) in seen.items():
            weights[kind, feature, value] = math.log(a / yes) - math.log(b / no)
    return weights


def _score(c: Column, weights: dict[tuple[int, int, int], float]) -> Column:
    table = F.create_map(*(x for (k, f, v), w in weights.items() for x in (F.lit(f"{k} {f} {v}"), F.lit(w))))
    weight = lambda f, v: F.coalesce(F.try_element_at(table, F.concat_ws(" ", c["kind"], f, v)), F.lit(0.0))
    return F.aggregate(F.sequence(F.lit(0), F.lit(FEATURES - 1)), weight(F.lit(-1), F.lit(0)), lambda s, f: s + weight(f, F.get(c["features"], f)))


def find(docs: DataFrame, text_column: str = "text", out: str = "spans", threshold: float = 0.5) -> DataFrame:
    """docs with the column `out`: array of struct kind (name), begin, end, base, by begin and then kind.

    Positions count code points, end exclusive. base: of the four base kinds and valid. Others are there if the
    classifier gives them a probability of at least `threshold` and they overlap no base span. A null or empty text has
    no spans. Every row is judged for itself, repeated ones alike; an empty table gives no row; a column of docs named
    `out` is replaced, all others stay.
    """
    weights = train(docs.select(F.col(text_column).cast("string").alias("text")))
    least = math.log(threshold / (1 - threshold))
    found = candidates(docs[text_column].cast("string"))

    def chosen(cs: Column) -> Column:
        def stays(c: Column) -> Column:
            overlaps = F.exists(cs, lambda b: b["base"] & (b["begin"] < c["end"]) & (c["begin"] < b["end"]))
            return c["base"] | ((F.element_at(c["votes"], 1) > 0) & ~overlaps & (_score(c, weights) >= least))

        return F.array_sort(F.transform(F.filter(cs, stays), lambda c: F.struct(c["begin"].alias("begin"), c["kind"].alias("k"), c["end"].alias("end"), c["base"].alias("base"))))

    names = F.array(*map(F.lit, KINDS))
    spans = F.transform(_let(found, chosen), lambda s: F.struct(F.get(names, s["k"]).alias("kind"), s["begin"].alias("begin"), s["end"].alias("end"), s["base"].alias("base")))
    return docs.withColumn(out, spans)


def _without(text: Column, spans: Column) -> Column:
    """The text with each span, in the order of their begins, replaced by its kind; overlapping ones go as one."""

    def between(parts: Column, a: Column, b: Column) -> Column:
        # from place a to b: the parts that hold it are joined, so that a text is not walked from its start again
        first = F.floor(a / PART).cast("int")
        held = F.array_join(F.slice(parts, first + 1, F.floor(b / PART).cast("int") - first + 1), "")
        return F.substr(held, a - first * PART + 1, b - a)

    def joined(parts: Column) -> Column:
        ends = _running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))

        def piece(i: Column, ends: Column) -> Column:
            s, at = F.get(spans, i), F.coalesce(F.get(ends, i - 1), F.lit(0))
            return F.when(s["begin"] >= at, F.concat(between(parts, at, s["begin"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise("")

        def whole(ends: Column) -> Column:
            pieces = F.transform(F.sequence(F.lit(0), F.size(spans) - 1), lambda i: piece(i, ends))
            return F.concat(F.array_join(pieces, ""), between(parts, F.element_at(ends, -1), F.length(text)))

        return _let(ends, whole)

    parts = F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / PART).cast("int")), lambda i: F.substr(text, i * PART + 1, F.lit(PART)))
    return _let(parts, joined)


def redact(docs: DataFrame, text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """docs with each span of its texts replaced by its kind, as `<EMAIL>`; overlapping spans go as one.

    Null and empty texts stay, repeated rows are alike, an empty table gives no row, and columns keep their names.
    """
    spans = "__spans"
    while spans in docs.columns:
        spans += "_"
    text = F.col(text_column)
    found = find(docs, text_column, spans, threshold)
    return found.withColumn(text_column, F.when(F.size(spans) > 0, _without(text, F.col(spans))).otherwise(text)).select(*docs.columns)
