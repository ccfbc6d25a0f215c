"""Which values break a rule, and how often.

One scan of the table takes a frequent-items sketch of the breaking values of each rule; such
sketches are small, can be stored, and merge. Where a rule has no more different breaking
values than a sketch tracks, its counts are exact. Where it has more, every value above the
sketch's error bound is among its items, and a second scan counts just these items exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txspark.functions.sqltext import ident, literal
from txspark.operators.expectations import _value
from txspark.rules import NOT_NULL, ROW_COUNT, Rule

# Items that a sketch tracks: below this number of different values it is exact.
TRACKED = 1000
# A sketch's estimates are off by at most this share of all its values.
ERROR = 3.5 / TRACKED

EXAMPLES = "position int, rule string, column string, value string, unexpected_count bigint, certain boolean"


def _judged(suite: list[Rule]) -> list[tuple[int, Rule]]:
    return [(i, r) for i, r in enumerate(suite) if r.type not in (NOT_NULL, ROW_COUNT)]


def _breaking(schema: T.StructType, rule: Rule) -> tuple[str, str]:
    """The value as text, and when it breaks the rule."""
    value = _value(schema, rule.column)
    return f"CAST({value} AS STRING)", f"coalesce({rule.violated(value)}, false)"


def sketches(df: DataFrame, suite: list[Rule], tracked: int = TRACKED) -> DataFrame:
    """One row with a sketch and a count of the values that break each rule, from one scan."""
    columns = ["count(1) AS rows"]
    for i, rule in _judged(suite):
        text, broken = _breaking(df.schema, rule)
        columns.append(f"approx_top_k_accumulate({text}, {tracked}) FILTER (WHERE {broken}) AS sketch_{i}")
        columns.append(f"count_if({broken}) AS broken_{i}")
    return df.selectExpr(*columns)


def merged_sketches(stored: DataFrame, suite: list[Rule], tracked: int = TRACKED) -> DataFrame:
    """Sketches of several parts of a table as those of the whole."""
    columns = ["coalesce(sum(rows), 0) AS rows"]
    for i, _ in _judged(suite):
        columns.append(f"approx_top_k_combine(sketch_{i}, {tracked}) AS sketch_{i}")
        columns.append(f"coalesce(sum(broken_{i}), 0) AS broken_{i}")
    return stored.selectExpr(*columns)


def unexpected_values(
    df: DataFrame | None, suite: list[Rule], k: int = 20, taken: DataFrame | None = None, tracked: int = TRACKED
) -> DataFrame:
    """The k most frequent values that break each rule, by rule and count, equal counts by value.

    taken: sketches of all of df, where they are stored. `certain` holds for counts that are
    exact and belong to a value that no other one can outrank unseen: all of a rule whose sketch
    was not full, else those above the error bound. df is read again only for rules whose sketch
    was full; without it their counts are the sketch's estimates, none of them certain.

    At most `tracked` items of each rule reach the driver.
    """
    row = (sketches(df, suite, tracked) if taken is None else taken).persist()
    found: list[tuple] = []
    try:
        for i, rule in _judged(suite):
            total = row.select(f"broken_{i}").first()[0]
            if not total:
                continue
            items = row.select(F.explode(F.expr(f"approx_top_k_estimate(sketch_{i}, {tracked})")).alias("x"))
            counts = {r["x"]["item"]: r["x"]["count"] for r in items.collect()}
            whole = len(counts) < tracked and sum(counts.values()) == total
            if not whole and df is not None:
                counts = _counted(df, rule, list(counts))
            least = 0 if whole else total * 3.5 / tracked
            best = sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:k]
            sure = whole or df is not None
            found += [(i + 1, rule.type, rule.column, v, n, sure and n > least) for v, n in best]
    finally:
        row.unpersist()
    return row.sparkSession.createDataFrame(found, EXAMPLES)


def _counted(df: DataFrame, rule: Rule, values: list[str]) -> dict[str, int]:
    """Exact counts of some breaking values: a scan of one column."""
    text, broken = _breaking(df.schema, rule)
    asked = ", ".join(literal(v) for v in values)
    rows = df.where(broken).selectExpr(f"{text} AS value").where(f"value IN ({asked})")
    return {r["value"]: r["n"] for r in rows.groupBy("value").agg(F.count(F.lit(1)).alias("n")).collect()}
