"""Secrets in text, as Spark SQL expressions only.

A loose pattern proposes every long token. A random forest then removes the false ones by
length, character transitions, how much of the token a dictionary of common letter pairs
covers, the document's path, and the neighbouring words. The forest is trained on the driver
from a bounded sample of findings with either label and scored as nested CASE expressions.
Findings that carry the label themselves are secrets whatever the forest says.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txspark.llm import trees
from txspark.llm.common import bounded_sample, once, spread
from txspark.llm.spans import found, literal

TOKEN = r"(?<![\p{L}\p{N}+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}(?![\p{L}\p{N}])"
CONTEXT = 32
_KEYWORDS = "(?:password|passwd|pwd|token|secret|api[_-]?key|auth|credential|private)"

# Labels of findings. Published forms of access keys.
_KNOWN_FORMS = (
    r"^(?:AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^glpat-[A-Za-z0-9_-]{20}$|^AIza[A-Za-z0-9_-]{35}$"
    r"|^github_pat_[A-Za-z0-9_]{82}$|^[sr]k_(?:live|test)_[A-Za-z0-9]{24,}$|^xox[abeprs]-[A-Za-z0-9-]{10,}$|^npm_[A-Za-z0-9]{36}$"
)


@dataclass(frozen=True)
class Training:
    """max_findings bounds the labelled findings that train, half of them for either label or
    more where the other has fewer; pairs the dictionary."""

    max_findings: int = 4000
    pairs: int = 120
    trees: int = 15
    depth: int = 6
    seed: int = 5


@dataclass
class Model:
    """Trees vote with shares of true findings; a token is a secret from `least` on. With
    `labelled` a token whose label is 1 always is one, also without trees. train() sets it."""

    pairs: list[str] = field(default_factory=list)
    trees: list[trees.Tree] = field(default_factory=list)
    least: float = 0.5
    labelled: bool = False


def _size(pattern: str, keep: str = "") -> str:
    return f"length(regexp_replace(x.m, {literal(pattern)}, '{keep}'))"


def features(pairs: list[str]) -> list[str]:
    """SQL over a finding x = struct(s, e, m, before, after, path)."""
    covered = _size("(?i)" + "|".join(map(re.escape, pairs))) if pairs else "length(x.m)"
    return [
        "length(x.m)",
        _size("[^0-9]"),
        _size("[^A-Z]"),
        _size("[^a-z]"),
        _size("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+", "x"),
        "size(array_distinct(split(x.m, '')))",
        f"1 - {covered} / length(x.m)",
        f"{_size('[^aeiouAEIOU]')} / length(x.m)",
        f"CASE WHEN x.m RLIKE {literal('^[0-9a-f]+$')} THEN 1 ELSE 0 END",
        f"CASE WHEN contains(x.m, '/') THEN 1 ELSE 0 END",
        f"CASE WHEN lower(x.path) RLIKE {literal('test|example|sample|mock|doc')} THEN 1 ELSE 0 END",
        f"CASE WHEN lower(x.before) RLIKE {literal(_KEYWORDS)} THEN 1 ELSE 0 END",
        f"CASE WHEN x.before RLIKE {literal('[=:] ?[\"]?$')} THEN 1 ELSE 0 END",
        f"CASE WHEN x.after RLIKE {literal('^[\"]')} THEN 1 ELSE 0 END",
    ]


def findings(docs: DataFrame, text: str, path: str) -> DataFrame:
    """Adds candidates: struct(s, e, m, before, after, path); s and e in code points."""
    out = once(docs, _body=F.coalesce(F.col(text), F.lit("")), _path=F.coalesce(F.col(path).cast("string"), F.lit("")))
    spans = found("_body", TOKEN, f"_body RLIKE {literal('[A-Za-z0-9+/_-]{16}')}")
    made = (
        f"transform({spans}, x -> struct(x.s AS s, x.e AS e, x.m AS m, "
        f"substring(_body, greatest(x.s - {CONTEXT}, 0) + 1, least(x.s, {CONTEXT})) AS before, "
        f"substring(_body, x.e + 1, {CONTEXT}) AS after, _path AS path))"
    )
    return once(out, candidates=F.expr(made)).drop("_body", "_path")


def _known() -> str:
    assigned = literal(_KEYWORDS + "[\"']? ?[=:] ?[\"']?$")
    return f"(x.m RLIKE {literal(_KNOWN_FORMS)} OR (lower(x.before) RLIKE {assigned} AND x.m RLIKE '[0-9]'))"


def known_label() -> Column:
    """1 for findings x of a published form, or assigned to a telling name and holding a
    digit; else 0."""
    return F.expr(f"CASE WHEN {_known()} THEN 1D ELSE 0D END")


def train(labelled: DataFrame, how: Training = Training()) -> Model:
    """Fit on a frame of findings x with a label (1: a secret).

    The sample is drawn for each label by itself, so that rare secrets are in it however
    large the corpus. Where one label is missing no tree can grow: labelled findings are then
    all that is reported.
    """
    rows = labelled.select(
        F.xxhash64("x.before", "x.m", "x.after").alias("h"),
        "label",
        "x.s", "x.e", "x.m", "x.before", "x.after", "x.path",
    )
    sizes = rows.groupBy("label").agg(F.count("*"), F.min(spread("h"))).orderBy("label").collect()
    if len(sizes) < 2:
        return Model(labelled=True)
    total, seen = sum(r[1] for r in sizes), []
    for label, count, least in sizes:
        most = max(how.max_findings // 2, how.max_findings - (total - count))
        seen += bounded_sample(rows.where(F.col("label") == label), "h", most, (count, least)).collect()
    count: Counter[str] = Counter()
    for r in seen:
        if r["label"] == 0:
            low = re.sub("[^a-z]", "", r["m"].lower())
            count.update(low[i : i + 2] for i in range(len(low) - 1))
    pairs = sorted(p for p, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))[: how.pairs])
    sample = labelled.sparkSession.createDataFrame(seen, rows.schema)
    packed = sample.select("label", F.struct("s", "e", "m", "before", "after", "path").alias("x"))
    table = packed.select("label", F.array(*[F.expr(f).cast("double") for f in features(pairs)]).alias("f")).collect()
    y = np.array([r["label"] for r in table])
    x = np.array([r["f"] for r in table])
    return Model(pairs, trees.forest(x, y, how.trees, how.depth, how.seed), labelled=True)


def scan(docs: DataFrame, text: str, path: str, model: Model) -> DataFrame:
    """Adds n_candidates, n_secrets and secrets: struct(s, e, score), by start.

    A null or empty text has none; a null path is an empty one. Labelled findings score 1.
    """
    out = findings(docs, text, path)
    known = _known() if model.labelled else "false"
    if not model.trees:
        kept = F.expr(f"transform(filter(candidates, x -> {known}), x -> struct(x.s AS s, x.e AS e, 1D AS score))")
    else:
        names = [f"x.f[{i}]" for i in range(len(features(model.pairs)))]
        votes = " + ".join(f"({trees.to_sql(t, names)})" for t in model.trees)
        described = "array(" + ", ".join(f"CAST({f} AS double)" for f in features(model.pairs)) + ")"
        score = f"CASE WHEN x.known THEN 1D ELSE ({votes}) / {len(model.trees)} END"
        kept = F.expr(
            f"filter(transform(transform(candidates, x -> struct(x.s AS s, x.e AS e, {known} AS known, {described} AS f)), "
            f"x -> struct(x.s AS s, x.e AS e, {score} AS score)), x -> x.score >= {model.least!r}D)"
        )
    return once(out, secrets=kept, n_candidates=F.size("candidates").cast("long")).withColumn(
        "n_secrets", F.size("secrets").cast("long")
    ).drop("candidates")
