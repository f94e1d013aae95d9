"""Personal data by weak supervision, in DataFrame functions only.

Strict patterns give the base spans. Wider patterns give candidates, which regular-expression, gazetteer
and context labelers vote on. Expectation-maximisation over the counts of vote vectors estimates how
reliable each labeler is, without labels; its posteriors train the final span classifier, a logistic
regression over votes and span features, which decides about candidates that are not base spans.

What reaches the driver is counts of (kind, votes, features), a table whose size is fixed by the numbers
of labelers and feature values and not by the corpus. The classifier goes back as constants of a Column,
so finding spans is a projection of the documents: nothing is shuffled, joined or collected for it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds, in the order that breaks ties, and their strict patterns. Look-behinds and
# possessive repeats keep the matches and make the search linear and free of recursion.
KINDS = ("email", "ip", "card", "phone")
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider forms: spelled-out e-mail signs, long addresses, other card separators, numbers without a plus.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[(\[{]at[)\]}]\x20?[A-Za-z0-9-]++"
    r"(?:(?:\.|\x20?[(\[{]dot[)\]}]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9.-])[0-9]{4}(?:[\x20.-]{1,2}[0-9]{4}){2}[\x20.-]{1,2}[0-9]{3,7}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,5}\)?(?:[\x20.-]{1,2}\(?[0-9]{2,5}\)?){1,5}(?![0-9A-Za-z])",
}
# Gazetteer of words that announce a kind, and of words that announce other numbers.
ANNOUNCES = {
    "email": r"(?i)\b(e-?mail|mail|courriel|correo|contact|kontakt|contacto|write|schreib)",
    "ip": r"(?i)\b(ip|host|server|serveur|servidor|address|adresse|login|from|client)\b",
    "card": r"(?i)\b(card|carte|karte|tarjeta|visa|mastercard|amex|credit|kredit|iban)\b",
    "phone": r"(?i)\b(tel|tele?phone|telefon|t[eé]l[eé]fono|phone|call|fax|mobile?|handy|m[oó]vil|appel)",
}
DENIES = r"(?i)\b(version|release|licen[cs]e|isbn|issn|doi|section|chapter|page|fig|figure|no|nr|order|ref|v)\.?\s*$"
CONTEXT = 32  # characters before a span that labelers see
LABELERS = ("strict", "shape", "gazetteer", "denied", "edges")
FEATURES = ("digits", "marks", "before", "after")
_SPAN = "array<struct<kind:string,start:int,end:int,value:string,left:string,right:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum, from the right, every second digit doubled."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c: c.try_cast("int"))
    doubled = F.transform(
        each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0)))
    return total % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    """What a strict match must also satisfy."""
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    ip = F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    digits = _digits(value)
    card = F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
    phone = F.length(digits).between(9, 15)
    return (
        F.when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", phone).otherwise(True)
    )


def _needs(text: Column, kind: str, wide: bool) -> Column:
    """A quick test that every text with a match passes: most texts have no such character."""
    if kind == "email":
        if not wide:
            return F.contains(text, F.lit("@"))
        return F.contains(text, F.lit("at)")) | F.contains(text, F.lit("at]")) | F.contains(text, F.lit("at}"))
    if kind == "phone" and not wide:
        return F.contains(text, F.lit("+"))
    if kind == "ip":
        return F.contains(text, F.lit(":")) if wide else F.regexp_like(text, F.lit(r"[0-9]\.[0-9]"))
    return F.regexp_like(text, F.lit(r"[0-9][0-9\x20.)(-]{6}"))


def _located(text: Column, kind: str, wide: bool) -> Column:
    """All matches of a pattern with their places in code points and what stands around them.

    Java's splitter and matcher walk the text alike, so the pieces between matches give their places.
    """
    pattern = (WIDE if wide else STRICT)[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)

    def step(acc: Column, i: Column) -> Column:
        piece, match = F.get(acc["pieces"], i), F.get(acc["found"], i)
        start = acc["at"] + F.length(piece)
        end = start + F.length(match)
        one = F.struct(
            F.lit(kind).alias("kind"),
            start.alias("start"),
            end.alias("end"),
            match.alias("value"),
            F.right(piece, F.lit(CONTEXT)).alias("left"),
            F.left(F.get(acc["pieces"], i + 1), F.lit(2)).alias("right"),
        )
        return F.struct(
            acc["pieces"].alias("pieces"),
            acc["found"].alias("found"),
            F.concat(acc["spans"], F.array(one)).alias("spans"),
            end.alias("at"),
        )

    return F.when(
        _needs(text, kind, wide) & F.regexp_like(text, F.lit(pattern)),
        F.transform(
            F.array(F.struct(pieces.alias("pieces"), found.alias("found"))),
            lambda held: F.aggregate(
                F.sequence(F.lit(0), F.size(held["found"]) - 1),
                F.struct(
                    held["pieces"].alias("pieces"),
                    held["found"].alias("found"),
                    F.array().cast(_SPAN).alias("spans"),
                    F.lit(0).alias("at"),
                ),
                step,
                lambda acc: acc["spans"],
            ),
        )[0],
    ).otherwise(F.array().cast(_SPAN))


def _all_spans(text: Column) -> Column:
    """Base spans, and candidates that overlap none of them."""
    return F.struct(
        F.concat(*[_located(text, k, False) for k in KINDS]).alias("strict"),
        F.concat(*[_located(text, k, True) for k in KINDS]).alias("wide"),
    )


def _sorted(spans: Column) -> Column:
    """By start, then kind as listed, then end."""
    order = F.array(*[F.lit(k) for k in KINDS])
    placed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("a"), F.array_position(order, s["kind"]).alias("b"), s["end"].alias("c"), s.alias("s")
        ),
    )
    return F.transform(F.array_sort(placed), lambda p: p["s"])


def _by(kind: Column, choices: dict[str, Column]) -> Column:
    out = F.lit(None)
    for name, value in choices.items():
        out = F.when(kind == name, value).otherwise(out)
    return out


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    if no is not None:
        out = out.when(no, -1)
    return out.otherwise(0)


def _judged(span: Column, strict: Column) -> Column:
    """Votes and features of a span. ``strict``: 1 for a base span, -1 for a wide one that fails the kind's test."""
    kind, value, left, right = span["kind"], span["value"], span["left"], span["right"]
    n = F.length(_digits(value))
    shape = _by(
        kind,
        {
            "email": F.regexp_like(value, F.lit(r"(?i)[a-z]{2,24}$")),
            "ip": F.length(value) >= 7,
            "card": n.isin(15, 16),
            "phone": n.between(9, 13),
        },
    )
    announced = _by(kind, {k: F.regexp_like(left, F.lit(p)) for k, p in ANNOUNCES.items()})
    before = F.right(left, F.lit(1))
    glued = F.regexp_like(before, F.lit(r"[\p{L}\p{N}_=/#]")) | F.regexp_like(
        right, F.lit(r"^([\p{L}\p{N}_=/#]|[.:-][0-9])")
    )
    clean = F.regexp_like(before, F.lit(r"^[\s(:,;<]?$")) & F.regexp_like(
        right, F.lit(r"^([\s).,;:>!?]|$)")
    )
    # votes are small integers, features short strings, so that their combinations are few
    return F.struct(
        strict.cast("int").alias("strict"),
        _vote(shape, ~shape).alias("shape"),
        _vote(announced).alias("gazetteer"),
        F.when(F.regexp_like(left, F.lit(DENIES)), -1).otherwise(0).alias("denied"),
        _vote(clean, glued).alias("edges"),
        F.least(F.floor(n / 4), F.lit(5)).cast("string").alias("digits"),
        F.when(F.regexp_like(value, F.lit(r"\(")), "bracket")
        .when(F.regexp_like(value, F.lit(" ")), "space")
        .when(F.regexp_like(value, F.lit("-")), "hyphen")
        .when(F.regexp_like(value, F.lit(r"\.")), "dot")
        .otherwise("none")
        .alias("marks"),
        F.when(before == "", "start")
        .when(F.regexp_like(before, F.lit(r"\s")), "space")
        .when(F.regexp_like(before, F.lit(r"[\p{L}\p{N}]")), "word")
        .otherwise("mark")
        .alias("before"),
        F.when(right == "", "end")
        .when(F.regexp_like(right, F.lit(r"^\s")), "space")
        .when(F.regexp_like(right, F.lit(r"^[\p{L}\p{N}]")), "word")
        .otherwise("mark")
        .alias("after"),
    )


def _candidates(found: Column) -> Column:
    """The spans that are voted on: base spans, and wide ones apart from them.

    A strict form that fails its test is dropped and not tried again in another form: no wide span of its
    kind may overlap it.
    """

    def judged(spans: Column, vote: int) -> Column:
        def one(s: Column) -> Column:
            strict = F.lit(1) if vote else F.when(_valid(s["kind"], s["value"]), 0).otherwise(-1)
            return F.struct(s.alias("span"), _judged(s, strict).alias("seen"))

        return F.transform(spans, one)

    def apart(s: Column) -> Column:
        return ~F.exists(
            found["strict"],
            lambda b: (b["start"] < s["end"])
            & (s["start"] < b["end"])
            & ((b["kind"] == s["kind"]) | _valid(b["kind"], b["value"])),
        )

    base = F.filter(found["strict"], lambda s: _valid(s["kind"], s["value"]))
    return F.concat(judged(base, 1), judged(F.filter(found["wide"], apart), 0))


@dataclass(frozen=True)
class PiiModel:
    """Weights of the span classifier per kind; ``reliability`` is what EM found about the labelers."""

    weights: dict[str, dict[tuple[str, str], float]] = field(default_factory=dict)
    bias: dict[str, float] = field(default_factory=dict)
    reliability: dict[str, dict[str, float]] = field(default_factory=dict)
    threshold: float = 0.5


def _expectation_maximisation(
    rows: Sequence[tuple[tuple[int, ...], float]], rounds: int
) -> tuple[list[float], dict[str, float]]:
    """Posterior of each vote vector, and each labeler's reliability, from counts alone.

    Labelers are independent given the truth; an added count of one keeps all estimates inside (0, 1).
    The start takes the majority of the votes.
    """
    posterior = [min(0.9, max(0.1, 0.5 + 0.2 * sum(votes))) for votes, _ in rows]
    values = (-1, 0, 1)
    chance: list[dict[tuple[int, int], float]] = []
    for _ in range(rounds):
        total = sum(n for _, n in rows)
        yes = sum(n * p for (_, n), p in zip(rows, posterior))
        prior = (yes + 1) / (total + 2)
        chance = []
        for i in range(len(LABELERS)):
            table = {}
            for truth, mass in ((1, yes), (0, total - yes)):
                for v in values:
                    seen = sum(
                        n * (p if truth else 1 - p)
                        for (votes, n), p in zip(rows, posterior)
                        if votes[i] == v
                    )
                    table[truth, v] = (seen + 1) / (mass + 3)
            chance.append(table)
        posterior = []
        for votes, _ in rows:
            a = math.log(prior) + sum(math.log(c[1, v]) for c, v in zip(chance, votes))
            b = math.log(1 - prior) + sum(math.log(c[0, v]) for c, v in zip(chance, votes))
            posterior.append(1 / (1 + math.exp(max(-500, min(500, b - a)))))
    reliability = {
        name: round(c[1, 1] / (c[1, 1] + c[0, 1]), 6) for name, c in zip(LABELERS, chance)
    }
    return posterior, reliability


def _logistic(
    rows: Sequence[tuple[list[tuple[str, str]], float, float]], rounds: int = 300, rate: float = 1.0
) -> tuple[dict[tuple[str, str], float], float]:
    """Weights from (features, posterior, count) by gradient steps with a small penalty."""
    weights: dict[tuple[str, str], float] = {f: 0.0 for feats, _, _ in rows for f in feats}
    bias, total = 0.0, sum(n for _, _, n in rows) or 1.0
    for _ in range(rounds):
        slope, b = dict.fromkeys(weights, 0.0), 0.0
        for feats, p, n in rows:
            z = bias + sum(weights[f] for f in feats)
            error = n * (1 / (1 + math.exp(-max(-30, min(30, z)))) - p)
            b += error
            for f in feats:
                slope[f] += error
        bias -= rate * b / total
        for f in weights:
            weights[f] -= rate * (slope[f] / total + 1e-3 * weights[f])
    return weights, bias


def fit(docs: DataFrame, text: str = "text", rounds: int = 30) -> PiiModel:
    """Learn labelers' reliabilities and the span classifier from unlabelled documents.

    Every candidate of every document is counted. Null texts have none; without any candidate of a kind
    the model has no weights for it and adds no span.
    """
    spans = docs.select(_all_spans(F.coalesce(F.col(text), F.lit(""))).alias("found")).select(
        F.explode(_candidates(F.col("found"))).alias("c")
    )
    names = [*LABELERS, *FEATURES]
    counted = (
        spans.select(F.col("c.span.kind").alias("kind"), *[F.col(f"c.seen.{n}").alias(n) for n in names])
        .groupBy("kind", *names)
        .count()
        .collect()  # at most the product of the votes' and features' few values
    )
    weights, bias, reliability = {}, {}, {}
    for kind in KINDS:
        mine = sorted((tuple(r[n] for n in names), r["count"]) for r in counted if r["kind"] == kind)
        if not mine:
            continue
        rows = [(key[: len(LABELERS)], float(n)) for key, n in mine]
        posterior, reliability[kind] = _expectation_maximisation(rows, rounds)
        seen = [
            ([(name, str(v)) for name, v in zip(names, key)], p, float(n))
            for (key, n), p in zip(mine, posterior)
        ]
        weights[kind], bias[kind] = _logistic(seen)
    return PiiModel(weights, bias, reliability)


def _accepted(candidate: Column, model: PiiModel) -> Column:
    """Whether the classifier takes a candidate; a value never met in training has no weight."""
    kind, seen = candidate["span"]["kind"], candidate["seen"]
    score = F.lit(None).cast("double")
    for name, weights in model.weights.items():
        z = F.lit(float(model.bias[name]))
        for column in (*LABELERS, *FEATURES):
            own = {v: w for (c, v), w in weights.items() if c == column}
            part = F.lit(0.0)
            for v, w in sorted(own.items()):
                part = F.when(seen[column].cast("string") == v, F.lit(float(w))).otherwise(part)
            z = z + part
        score = F.when(kind == name, z).otherwise(score)
    bound = math.log(model.threshold / (1 - model.threshold))
    return F.coalesce(score >= bound, F.lit(False))


def with_spans(
    docs: DataFrame, model: PiiModel, text: str = "text", base: str = "base_spans", spans: str = "spans"
) -> DataFrame:
    """Add the base spans and all spans, arrays of (kind, start, end, value), ordered by start and kind.

    Places are code points, the end is exclusive. Null and empty texts have empty arrays. All rows and
    columns stay; a row's spans depend on its text and the model alone.
    """
    kept = list(docs.columns)

    def slim(s: Column) -> Column:
        return F.struct(*[s[f].alias(f) for f in ("kind", "start", "end", "value")])

    found = docs.withColumn("__found", _all_spans(F.coalesce(F.col(text), F.lit(""))))
    found = found.withColumn("__voted", _candidates(F.col("__found")))
    found = found.withColumn(
        "__base",
        F.transform(
            F.filter("__voted", lambda c: c["seen"]["strict"] == 1), lambda c: c["span"]
        ),
    )
    added = F.transform(
        F.filter(
            "__voted",
            lambda c: (c["seen"]["strict"] != 1) & _accepted(c, model),
        ),
        lambda c: c["span"],
    )
    return found.select(
        *kept,
        F.transform(_sorted(F.col("__base")), slim).alias(base),
        F.transform(_sorted(F.concat(F.col("__base"), added)), slim).alias(spans),
    )


def joined(spans: Column | str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    col = F.col(spans) if isinstance(spans, str) else spans
    return F.array_join(
        F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redacted(text: str, spans: str) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        between = F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.when(apart, F.concat(acc["out"], between, F.lit("["), F.upper(s["kind"]), F.lit("]")))
            .otherwise(acc["out"])
            .alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        )

    rebuilt = F.aggregate(
        F.col(spans),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        step,
        lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.length(F.col(text)))),
    )
    return F.when(F.size(spans) == 0, F.col(text)).otherwise(rebuilt)


def redact(docs: DataFrame, model: PiiModel, text: str = "text") -> DataFrame:
    """All rows and columns, with personal data replaced in the text; texts without any do not change."""
    kept = list(docs.columns)
    spanned = with_spans(docs, model, text, "__base_spans", "__spans")
    return spanned.withColumn(text, redacted(text, "__spans")).select(*kept)
