"""Quality rules by distribution divergence, as Spark SQL expressions only.

A document's histogram of character classes and its histogram of common words are compared
with those of languages by Jensen-Shannon distance (base 2, so from 0 to 1). The language
histograms are summed over all documents of that language. A document fails where it is far
from every language; too short documents are not judged by a distance that they cannot
estimate. Countable base rules come first.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txspark.llm.common import fresh, once

WORD_BREAK = r"[\x20\x09-\x0D]+"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Frequent function words of four languages.
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "des", "auf", "ist"],
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "for", "with", "was", "as"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "con"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
}
WORDS = sorted({w for words in COMMON_WORDS.values() for w in words})

# Classes of characters, taken in this order; what is left over is the last class.
CLASSES = [r"\p{Ll}", r"\p{Lu}", r"\p{N}", r"\s", r"[.,;:!?'()\"-]"]


@dataclass(frozen=True)
class Limits:
    """Distances above which a document fails, and the sizes below which it is not judged.

    The limit of the word distance is word_distance + word_noise / sqrt(words): a short
    sample of the same language lies farther from it by chance.
    """

    least_words: int = 10
    repeat_percent: int = 20
    class_distance: float = 0.32
    class_characters: int = 200
    word_distance: float = 0.17
    word_noise: float = 1.0
    word_count: int = 60


def base_counts(docs: DataFrame, text: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base columns
    for the histograms. A null text counts as an empty one. Windows are told apart by a
    64-bit hash of their words."""
    body, words, lines, windows, placed, spots = fresh(
        docs, "body", "words", "lines", "windows", "placed", "spots"
    )
    c = F.col
    out = once(docs, **{body: F.coalesce(c(text), F.lit(""))})
    out = once(
        out,
        **{
            words: F.array_remove(F.split(body, WORD_BREAK), ""),
            lines: F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD_CHARACTER)),
        },
    )
    last = f"size(`{words}`) - {WINDOW}"
    out = once(
        out,
        **{
            windows: F.expr(
                f"CASE WHEN {last} >= 0 THEN transform(sequence(0, {last}), i -> xxhash64("
                + ", ".join(f"`{words}`[i + {k}]" for k in range(WINDOW))
                + ")) ELSE CAST(array() AS array<bigint>) END"
            )
        },
    )
    repeated = F.size(F.array_distinct(windows)) < F.size(windows)
    out = once(
        out,
        **{
            placed: F.when(
                repeated,
                F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            )
        },
    )
    out = once(
        out,
        **{
            spots: F.expr(
                f"array_sort(transform(filter(`{placed}`, (x, k) -> "
                f"(k > 0 AND x.h = `{placed}`[greatest(k - 1, 0)].h) OR "
                f"(k < size(`{placed}`) - 1 AND x.h = `{placed}`[least(k + 1, size(`{placed}`) - 1)].h)), x -> x.i))"
            )
        },
    )
    covered = F.expr(
        f"coalesce(aggregate(`{spots}`, CAST(struct(0 AS n, -{WINDOW} AS p) AS struct<n: int, p: int>), "
        f"(a, p) -> CAST(struct(a.n + least({WINDOW}, p - a.p) AS n, p AS p) AS struct<n: int, p: int>), a -> a.n), 0)"
    )
    return once(
        out,
        n_words=F.size(words).cast("long"),
        word_chars=F.length(F.array_join(words, "")).cast("long"),
        n_symbols=(F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
        n_dup_lines=(F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        n_repeat_words=covered.cast("long"),
        _words=c(words),
        _body=c(body),
    ).drop(body, words, lines, windows, placed, spots)


def words_of(docs: DataFrame, text: str) -> DataFrame:
    """Adds _words and _body, which is all that the histograms need."""
    out = once(docs, _body=F.coalesce(F.col(text), F.lit("")))
    return once(out, _words=F.array_remove(F.split("_body", WORD_BREAK), ""))


def histograms(docs: DataFrame) -> DataFrame:
    """Adds class_counts and word_counts (the last bin holds all other words) from _words
    and _body, which go. Each common word is one character of _codes, others are `@`."""
    codes = F.array_join(
        F.transform(
            "_words",
            lambda w: F.char(F.find_in_set(F.lower(w), F.lit(",".join(WORDS))) + 64),
        ),
        "",
    )
    names = [f"_rest{i}" for i in range(len(CLASSES) + 1)]
    out = once(docs, _codes=codes, **{names[0]: F.col("_body")})
    for before, name, kind in zip(names, names[1:], CLASSES, strict=False):
        out = once(out, **{name: F.regexp_replace(before, f"{kind}+", "")})
    sizes = [F.length(n) for n in names]
    seen = [
        F.length("_codes") - F.length(F.replace("_codes", F.lit(chr(65 + i))))
        for i in range(len(WORDS))
    ]
    counts = F.array(*[x.cast("long") for x in seen])
    classes = [a - b for a, b in zip(sizes, sizes[1:], strict=False)] + [sizes[-1]]
    out = once(out, class_counts=F.array(*[x.cast("long") for x in classes]), _seen=counts)
    others = F.size("_words").cast("long") - F.aggregate("_seen", F.lit(0).cast("long"), lambda a, x: a + x)
    return once(out, word_counts=F.concat("_seen", F.array(others))).drop(
        "_words", "_body", "_codes", "_seen", *names
    )


@dataclass(frozen=True)
class References:
    """Histograms by language; only languages with a list of common words have one."""

    classes: dict[str, list[int]]
    words: dict[str, list[int]]


def references(histogram: DataFrame, lang: str) -> References:
    """Sums over all documents of each language: at most a few short rows, whatever the input."""
    bins = {"class_counts": len(CLASSES) + 1, "word_counts": len(WORDS) + 1}
    sums = [F.sum(F.col(c)[i]).alias(f"{c}{i}") for c, n in bins.items() for i in range(n)]
    rows = histogram.where(F.col(lang).isin(sorted(COMMON_WORDS))).groupBy(lang).agg(*sums).collect()
    pick = lambda r, c: [int(r[f"{c}{i}"]) for i in range(bins[c])]
    kept = {r[lang]: r for r in sorted(rows, key=lambda r: r[lang])}
    return References(
        {k: p for k, r in kept.items() if sum(p := pick(r, "class_counts"))},
        {k: p for k, r in kept.items() if sum(p := pick(r, "word_counts"))},
    )


def js_distance(shares: str, reference: list[int]) -> Column:
    """Jensen-Shannon distance between an array of shares and a reference histogram."""
    total = sum(reference)
    others = ", ".join(f"{x / total!r}D" for x in reference)
    term = lambda v: f"CASE WHEN {v} > 0 THEN {v} * ln(2 * {v} / (p + q)) ELSE 0D END"
    parts = f"zip_with(`{shares}`, array({others}), (p, q) -> {term('p')} + {term('q')})"
    return F.expr(f"sqrt(greatest(aggregate({parts}, 0D, (a, x) -> a + x), 0D) / {2 * math.log(2)!r}D)")


def with_shares(docs: DataFrame, counts: str, shares: str) -> DataFrame:
    """Adds an array of counts as shares of their sum, which is taken once for each row; null
    where there is nothing to share."""
    size, = fresh(docs, "size")
    out = once(docs, **{size: F.expr(f"aggregate(`{counts}`, 0D, (a, x) -> a + x)")})
    divided = F.expr(f"CASE WHEN `{size}` > 0 THEN transform(`{counts}`, x -> x / `{size}`) END")
    return once(out, **{shares: divided}).drop(size)


def judge(docs: DataFrame, refs: References, limits: Limits) -> DataFrame:
    """Adds base_failed, class_distance, word_distance (to the nearest language; null where
    the document is too short or there is no reference) and kept."""
    size = F.aggregate("class_counts", F.lit(0).cast("long"), lambda a, x: a + x)

    def nearest(shares: str, by_language: dict[str, list[int]]) -> Column:
        found = [js_distance(shares, r) for r in by_language.values()]
        return F.array_min(F.array(*found)) if found else F.lit(None).cast("double")

    classes, words = fresh(docs, "class_shares", "word_shares")
    shared = with_shares(with_shares(docs, "class_counts", classes), "word_counts", words)
    out = once(
        shared,
        base_failed=(F.col("n_words") < limits.least_words)
        | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words")),
        class_distance=F.when(size >= limits.class_characters, nearest(classes, refs.classes)),
        word_distance=F.when(F.col("n_words") >= limits.word_count, nearest(words, refs.words)),
    ).drop(classes, words)
    far = F.coalesce(F.col("class_distance") > limits.class_distance, F.lit(False)) | F.coalesce(
        F.col("word_distance") > limits.word_distance + limits.word_noise / F.sqrt("n_words"), F.lit(False)
    )
    return out.withColumn("kept", ~F.col("base_failed") & ~far)


def keep_documents(docs: DataFrame, text: str, lang: str, limits: Limits = Limits()) -> DataFrame:
    """The documents that pass all rules, with their columns as they were.

    Null, empty and short texts fail by the number of words. Any names of other columns are
    fine: the row is packed away while it is judged.
    """
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(text).alias("text"),
        F.col(lang).alias("lang"),
    )
    plain = packed.select("text", "lang")
    refs = references(histograms(words_of(plain, "text")), "lang")
    judged = judge(histograms(base_counts(packed, "text")), refs, limits)
    return judged.where("kept").select("doc.*")
