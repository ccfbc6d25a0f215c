"""Personal data in text, as Spark SQL expressions only.

Four kinds are found by format (the base spans). Beyond these, generators with high recall
propose spans that may overlap each other: numbers in groups, spelled-out or bare mail
addresses, colon-separated network addresses. Gradient-boosted trees score each candidate by
its format and its neighbouring text, and those above the kind's calibrated threshold are
added where they touch no base span and no better candidate.

The trees learn on a bounded sample of rows. Positive are candidates inside a base span of
their kind, spelled-out addresses and IPv6 addresses that are valid by themselves, and looser
forms derived from base spans: mail spelled out, cards with dots, phones without the country
code, IPv4 as IPv6. Other candidates are negative, but those of the very shape of such a
phone are left out, as nothing tells whether they are one. What defines a base span (a leading
plus, the check digit, the number of address parts) is not among the features, so the trees
carry over to looser forms. Nothing is added that its kind rules out, such as a date.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txspark.llm import trees
from txspark.llm.common import bounded_sample, once
from txspark.llm.spans import found, literal

KINDS = ["email", "ip", "card", "phone"]

# The base formats. Possessive repeats and the looks at what stands before only spare
# fruitless attempts inside a run; the leftmost matches are those of the plain forms.
_NAME = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_NAME})){_NAME}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_GATES = {
    "email": "contains({b}, '@')",
    "ip": "{b} RLIKE " + literal(r"[0-9]\.[0-9]"),
    "card": "{b} RLIKE " + literal(r"[0-9](?:[ -]?+[0-9]){13}"),
    "phone": "contains({b}, '+')",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# Candidates: kind and a loose pattern.
GENERATORS = {
    "email": r"[A-Za-z0-9._%+-]{1,64}+(?:@| ?[(\[](?:at|AT)[)\]] ?)[A-Za-z0-9-]++(?:(?:\.| ?[(\[](?:dot|DOT)[)\]] ?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{1,4}(?:::?[0-9A-Fa-f]{1,4}){1,7}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[ ./-]?[0-9]{4}){2}(?:[ ./-]?[0-9]{1,7})(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])\(?[0-9]{2,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,4}\)?){1,4}(?![0-9A-Za-z])",
}
_GENERATOR_GATES = {
    "email": "(contains({b}, '@') OR {b} RLIKE " + literal(r"[(\[](?:at|AT)[)\]]") + ")",
    "ip": "{b} RLIKE " + literal("[0-9A-Fa-f]:(?::|[0-9A-Fa-f]{1,4}:)[0-9A-Fa-f]"),
    "card": "{b} RLIKE " + literal(r"[0-9]{4}(?:[ ./-]?[0-9]{4}){2}"),
    "phone": "{b} RLIKE " + literal(r"[0-9]{2}\)?[ ./-]{1,2}\(?[0-9]{2}"),
}
_AT, _DOT = r" ?[(\[](?:at|AT)[)\]] ?", r" ?[(\[](?:dot|DOT)[)\]] ?"
_MAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$"
_DATE = (
    r"(?<![0-9])(?:(?:19|20)[0-9]{2}([ ./-])[01][0-9]\1[0-3][0-9]|[0-3][0-9]([./-])[0-3][0-9]\2(?:19|20)?[0-9]{2}"
    r"|(?:19|20)[0-9]{2}[ ./-]{1,2}(?:19|20)[0-9]{2})(?![0-9])"
)
CONTEXT = 24
_WORDS_BEFORE = "(?:mail|phone|tel|call|fax|mobile|cell|card|visa|credit|account|address|host|contact|reach)"

# Features as SQL over a candidate x = struct(k, s, e, m, before, after).
FEATURES = [
    "x.k",
    "length(x.m)",
    f"length(regexp_replace(x.m, {literal('[^0-9]')}, ''))",
    f"length(regexp_replace(x.m, {literal('[^A-Za-z]')}, ''))",
    f"length(regexp_replace(x.m, {literal('[^ ]')}, ''))",
    f"length(regexp_replace(x.m, {literal('[^.]')}, ''))",
    f"length(regexp_replace(x.m, {literal('[^-]')}, ''))",
    "CASE WHEN contains(x.m, '(') THEN 1 ELSE 0 END",
    "CASE WHEN contains(x.m, '@') THEN 1 ELSE 0 END",
    f"CASE WHEN lower(x.before) RLIKE {literal(_WORDS_BEFORE)} THEN 1 ELSE 0 END",
    f"CASE WHEN x.before RLIKE {literal('[0-9] ?$')} THEN 1 ELSE 0 END",
    f"CASE WHEN x.before RLIKE {literal('[=:#\"] ?$')} THEN 1 ELSE 0 END",
    f"CASE WHEN x.after RLIKE {literal('^[ .,;]')} OR x.after = '' THEN 1 ELSE 0 END",
    f"CASE WHEN x.after RLIKE {literal('^ ?[%$€:/]')} THEN 1 ELSE 0 END",
]


@dataclass(frozen=True)
class Training:
    """max_candidates bounds the sample: chosen by a hash of their text."""

    max_candidates: int = 4000
    rounds: int = 25
    depth: int = 3
    rate: float = 0.3
    precision: float = 0.995
    least_positives: int = 20


@dataclass
class Model:
    """Log odds are base + sum(trees); a kind without a threshold adds nothing."""

    base: float = 0.0
    trees: list[trees.Tree] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)


def _luhn(digits: str) -> str:
    """SQL: the check sum over a digit string, doubling every second digit from the right."""
    n = f"length({digits})"
    digit = f"CAST(substring({digits}, {n} - i, 1) AS int)"
    twice = f"(2 * {digit} - CASE WHEN {digit} > 4 THEN 9 ELSE 0 END)"
    return (
        f"aggregate(transform(sequence(0, {n} - 1), i -> CASE WHEN i % 2 = 1 THEN {twice} ELSE {digit} END), "
        "0, (a, y) -> a + y) % 10 = 0"
    )


def _digits(m: str) -> str:
    return f"regexp_replace({m}, {literal('[^0-9]')}, '')"


def _fits() -> str:
    """SQL: whether a candidate x can be of its kind at all."""
    mail = f"regexp_replace(regexp_replace(x.m, {literal(_AT)}, '@'), {literal(_DOT)}, '.') RLIKE {literal(_MAIL)}"
    groups = f"size(split(x.m, {literal('::?')}))"
    ip = (
        f"(NOT contains(x.m, '::') AND {groups} = 8) OR "
        f"(size(split(x.m, '::')) = 2 AND {groups} <= 7 AND x.m RLIKE '[0-9]')"
    )
    card = f"length({_digits('x.m')}) BETWEEN 13 AND 19 AND {_luhn(_digits('x.m'))}"
    phone = f"length({_digits('x.m')}) BETWEEN 7 AND 15 AND NOT x.m RLIKE {literal(_DATE)}"
    return f"CASE x.k WHEN 0 THEN {mail} WHEN 1 THEN {ip} WHEN 2 THEN {card} ELSE {phone} END"


def _looser() -> str:
    """SQL: candidates that base spans would be in a looser form, where they were found."""
    hexed = f"array_join(transform(split(x.m, {literal('[.]')}), p -> lower(hex(CAST(p AS int)))), ':')"
    forms = {
        "email": "concat(substring_index(x.m, '@', 1), ' (at) ', replace(substring_index(x.m, '@', -1), '.', ' (dot) '))",
        "ip": f"CASE WHEN crc32(x.m) % 2 = 0 THEN concat('2001:db8:', {hexed}, ':0:1') ELSE concat('2001:db8::', {hexed}) END",
        "card": f"regexp_replace(x.m, {literal('[ -]')}, '.')",
        "phone": f"regexp_replace(x.m, {literal('^[+][0-9]{1,3}[ .-]*')}, '')",
    }
    parts = []
    for number, kind in enumerate(KINDS):
        made = f"transform(_{kind}, x -> struct({number} AS k, {forms[kind]} AS m, {_around()}))"
        proposed = f"x.m RLIKE {literal('^(?:' + GENERATORS[kind] + ')$')}"
        parts.append(f"filter({made}, x -> {proposed} AND {_fits()})")
    return f"concat({', '.join(parts)})"


def _around() -> str:
    return (
        f"substring(_body, greatest(x.s - {CONTEXT}, 0) + 1, least(x.s, {CONTEXT})) AS before, "
        f"substring(_body, x.e + 1, {CONTEXT}) AS after"
    )


def _base(body: str, kind: str) -> str:
    spans = found(body, BASE[kind], _GATES[kind].format(b=body))
    digits = _digits("x.m")
    valid = {
        "email": "true",
        "ip": f"x.m RLIKE {literal(rf'^{_PART}(?:[.]{_PART}){{3}}$')}",
        "card": _luhn(digits),
        "phone": f"length({digits}) BETWEEN 10 AND 15",
    }[kind]
    return f"filter({spans}, x -> {valid})"


def base_spans(docs: DataFrame, text: str) -> DataFrame:
    """Adds _body (null text: empty) and one array of spans for each kind, _<kind>."""
    out = once(docs, _body=F.coalesce(F.col(text), F.lit("")))
    return once(out, **{f"_{k}": F.expr(_base("_body", k)) for k in KINDS})


def candidates(docs: DataFrame) -> DataFrame:
    """Adds _candidates: struct(k, s, e, m, before, after, fits, inside, touching) from base spans.

    fits: it can be of its kind; inside: it covers or lies in a base span of its kind;
    touching: it overlaps a base span of any kind.
    """
    parts = []
    for number, kind in enumerate(KINDS):
        spans = found("_body", GENERATORS[kind], _GENERATOR_GATES[kind].format(b="_body"))
        parts.append(f"transform({spans}, x -> struct({number} AS k, x.s AS s, x.e AS e, x.m AS m))")
    bases = [f"transform(_{kind}, x -> struct({number} AS k, x.s AS s, x.e AS e))" for number, kind in enumerate(KINDS)]
    out = once(docs, _proposed=F.expr(f"concat({', '.join(parts)})"), _base=F.expr(f"concat({', '.join(bases)})"))
    made = (
        "transform(_proposed, x -> struct(x.k AS k, x.s AS s, x.e AS e, x.m AS m, "
        f"{_around()}, {_fits()} AS fits, "
        "exists(_base, b -> b.k = x.k AND ((b.s <= x.s AND x.e <= b.e) OR (x.s <= b.s AND b.e <= x.e))) AS inside, "
        "exists(_base, b -> b.s < x.e AND x.s < b.e) AS touching))"
    )
    return once(out, _candidates=F.expr(made)).drop("_proposed", "_base")


def train(docs: DataFrame, text: str, how: Training = Training()) -> Model:
    """Fit trees and thresholds on at most how.max_candidates candidates of the documents."""
    seen = (
        "transform(_candidates, x -> struct(x.k AS k, x.m AS m, x.before AS before, x.after AS after, x.fits AS fits, "
        "x.inside OR (x.fits AND x.k < 2) AS label, x.fits AND x.k = 3 AND NOT x.touching AS open))"
    )
    derived = (
        f"transform({_looser()}, x -> struct(x.k AS k, x.m AS m, x.before AS before, x.after AS after, true AS fits, "
        "true AS label, false AS open))"
    )
    shape = f"CASE WHEN x.k = 3 THEN regexp_replace(x.m, {literal('[0-9]')}, '0') END"
    rows = (
        candidates(base_spans(docs.select(F.col(text).alias("_text")), "_text"))
        .select(F.explode(F.expr(f"concat({seen}, {derived})")).alias("x"))
        .select(
            F.xxhash64("x.before", "x.m", "x.after").alias("h"),
            F.col("x.label").cast("double").alias("label"),
            F.array(*[F.expr(f).cast("double") for f in FEATURES]).alias("features"),
            F.col("x.fits").alias("fits"),
            F.col("x.open").alias("open"),
            F.expr(shape).alias("shape"),
        )
    )
    rows = bounded_sample(rows, "h", how.max_candidates).collect()
    phones = {r["shape"] for r in rows if r["label"] == 1}
    rows = [r for r in rows if not (r["open"] and r["shape"] in phones)]
    y = np.array([r["label"] for r in rows])
    if len(y) < how.least_positives or y.min() == y.max():
        return Model()
    x = np.array([r["features"] for r in rows])
    fits = np.array([r["fits"] for r in rows])
    # every fourth row by hash order calibrates the thresholds and trains nothing
    apart = np.arange(len(y)) % 4 == 3
    base, grown = trees.boost(x[~apart], y[~apart], how.rounds, how.depth, how.rate)
    # in the order in which added_spans() sums, as a threshold is the very score of a candidate
    score = sum((trees.predict(t, x[apart]) for t in grown), np.full(apart.sum(), base))
    model = Model(base, grown)
    for number, kind in enumerate(KINDS):
        mine = (x[apart][:, 0] == number) & fits[apart]
        threshold = _calibrated(score[mine], y[apart][mine], how)
        if threshold is not None:
            model.thresholds[kind] = threshold
    return model


def _calibrated(score: np.ndarray, y: np.ndarray, how: Training) -> float | None:
    """The lowest score above which the wanted share of candidates is right; None where
    there are too few positive ones to tell."""
    if y.sum() < how.least_positives:
        return None
    order = np.argsort(-score, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.append(score[order][1:] < score[order][:-1], True)  # never cut between equals
    fine = np.flatnonzero((right >= how.precision) & last)
    return float(score[order][fine[-1]]) if len(fine) else None


def added_spans(model: Model) -> str:
    """SQL over _candidates: array of struct(s, e, k) that the trees add."""
    if not model.thresholds:
        return "CAST(array() AS array<struct<s: int, e: int, k: int>>)"
    names = [f"x.f[{i}]" for i in range(len(FEATURES))]
    score = " + ".join([f"{model.base!r}D", *[f"({trees.to_sql(t, names)})" for t in model.trees]])
    floor = "CASE x.k " + " ".join(
        f"WHEN {i} THEN {model.thresholds[k]!r}D" for i, k in enumerate(KINDS) if k in model.thresholds
    ) + " END"
    features = "array(" + ", ".join(f"CAST({f} AS double)" for f in FEATURES) + ")"
    featured = f"transform(filter(_candidates, x -> x.fits AND NOT x.touching), x -> struct(x.k AS k, x.s AS s, x.e AS e, {features} AS f))"
    scored = f"filter(transform({featured}, x -> struct(x.k AS k, x.s AS s, x.e AS e, {score} AS p, {floor} AS t)), x -> x.p >= x.t)"
    better = (
        "y.s < x.e AND x.s < y.e AND "
        "(y.p > x.p OR (y.p = x.p AND struct(y.s, y.e, y.k) < struct(x.s, x.e, x.k)))"
    )
    return (
        f"flatten(transform(array({scored}), all -> transform(filter(all, x -> NOT exists(all, y -> {better})), "
        "x -> struct(x.s AS s, x.e AS e, x.k AS k))))"
    )


def detect(docs: DataFrame, text: str, model: Model) -> DataFrame:
    """Adds n_email, n_ip, n_card, n_phone (base spans), base_spans and spans, both text of
    kind:start:end by start and then kind, and all_spans: struct(s, e, k), likewise.

    Code points count; ends are exclusive. A null text has no spans. Expects the caller to
    have packed away columns whose names begin with an underscore.
    """
    out = once(candidates(base_spans(docs, text)), _added=F.expr(added_spans(model)))
    tagged = [f"transform(_{k}, x -> struct(x.s AS s, {i} AS k, x.e AS e))" for i, k in enumerate(KINDS)]
    added = "transform(_added, x -> struct(x.s AS s, x.k AS k, x.e AS e))"
    out = once(
        out,
        _sure=F.expr(f"array_sort(concat({', '.join(tagged)}))"),
        all_spans=F.expr(f"array_sort(concat({', '.join([*tagged, added])}))"),
        **{f"n_{k}": F.size(f"_{k}").cast("long") for k in KINDS},
    )
    kinds = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    spelled = lambda c: F.expr(f"array_join(transform({c}, x -> concat({kinds}[x.k], ':', x.s, ':', x.e)), ',')")
    return once(out, base_spans=spelled("_sure"), spans=spelled("all_spans")).drop(
        "_sure", "_added", "_candidates", "_body", *[f"_{k}" for k in KINDS]
    )


def redacted(text: str, spans: str) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans merge
    into the first. Null text stays null."""
    kinds = "array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS) + ")"
    step = (
        f"CASE WHEN x.s >= a.at THEN struct(concat(a.out, substring({text}, a.at + 1, x.s - a.at), {kinds}[x.k]) AS out, x.e AS at) "
        "ELSE struct(a.out AS out, greatest(a.at, x.e) AS at) END"
    )
    return F.expr(
        f"CASE WHEN size({spans}) = 0 THEN {text} ELSE aggregate({spans}, struct('' AS out, 0 AS at), (a, x) -> {step}, "
        f"a -> concat(a.out, substring({text}, a.at + 1))) END"
    )


def redact_documents(docs: DataFrame, text: str, model: Model) -> DataFrame:
    """The documents with personal data redacted, all columns and rows kept."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(text).alias("text"))
    out = once(detect(packed, "text", model), clean=redacted("text", "all_spans"))
    return out.select(*[(F.col("clean") if c == text else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
