"""Expected rows of every query as SQL for another engine on the same tables.

Written independently of the Spark plans: only the fixture's own column expressions and the
suite's layout are shared.
"""

from __future__ import annotations

from txspark import rules as R
from txspark.fixtures import (
    ADDRESSES,
    DUPLICATED,
    EVENTS_PER_PART,
    RAW_EXPRESSIONS,
    LACKING,
    ODD_FORM,
    ODD_NAN,
    ODD_NOTE,
    ODD_PADDED,
    RECORD,
    record_text,
)
from txspark.functions.text import NULL_TOKENS
from txspark.registry.queries import EXAMPLES, MIXED, MOSTLY_SUITE, RUN_ID, RUN_TIME
from txspark.schema import COLUMNS

_COLS = ", ".join(COLUMNS)
_NUMBERS = ("amount", "risk_score")
_TEXT_COLUMNS = [
    c
    for c in COLUMNS
    if c not in (*_NUMBERS, "timestamp", "login_frequency", "session_duration")
]


def _with(source: str, body: str, *more: str) -> str:
    return f"WITH {', '.join([source, *more])} {body}"


def _copies(select: str) -> str:
    return f"SELECT {select} FROM events UNION ALL SELECT {select} FROM events WHERE {DUPLICATED}"


RAW = f"raw AS ({_copies(', '.join(f'{e} AS {c}' for c, e in RAW_EXPRESSIONS.items()))})"


def _from_csv(column: str, string_nulls: bool = False) -> str:
    """What a CSV round trip makes of a column."""
    expr = f"({RAW_EXPRESSIONS[column]})"
    if column in _NUMBERS:
        expr = f"CAST(CAST({expr} AS DECIMAL(18,2)) AS DOUBLE)"
    elif column in _TEXT_COLUMNS and not string_nulls:
        expr = f"coalesce({expr}, '')"
    return f"{expr} AS {column}"


CSV = f"raw AS ({_copies(', '.join(_from_csv(c) for c in COLUMNS))})"
CSV_NULLS = f"raw AS ({_copies(', '.join(_from_csv(c, True) for c in COLUMNS))})"



def _from_odd(column: str, padded: bool) -> str:
    """What the odd exporter's file makes of a column; cleaning takes the padding away."""
    if column == "note":
        return f"{ODD_NOTE} AS note"
    plain = _from_csv(column)
    expr = plain[: -len(f" AS {column}")]
    if column == "risk_score":
        return f"CASE WHEN {ODD_NAN} THEN 'NaN'::DOUBLE ELSE {expr} END AS {column}"
    if padded and column in ("location_region", "age_group"):
        return f"CASE WHEN {ODD_PADDED} AND {expr} <> '' THEN '\u00a0' || {expr} || '\u2003' ELSE {expr} END AS {column}"
    return plain


ODD_RAW = f"raw AS ({_copies(', '.join(_from_odd(c, True) for c in ODD_FORM))})"
ODD_TRIMMED = f"raw AS ({_copies(', '.join(_from_odd(c, False) for c in COLUMNS))})"
_NAN_APART = "SELECT * REPLACE (CASE WHEN isnan(risk_score) THEN NULL ELSE risk_score END AS risk_score), coalesce(isnan(risk_score), false) AS risk_is_nan FROM "

# Fixed forms of the data contract, one column a line.
NORMAL = """normal AS (SELECT
  make_timestamp(timestamp * 1000000) AS timestamp,
  lower(trim(sending_address)) AS sending_address,
  lower(trim(receiving_address)) AS receiving_address,
  amount,
  lower(trim(transaction_type)) AS transaction_type,
  trim(location_region) AS location_region,
  trim(ip_prefix) AS ip_prefix,
  CAST(login_frequency AS INTEGER) AS login_frequency,
  CAST(session_duration AS INTEGER) AS session_duration,
  trim(purchase_pattern) AS purchase_pattern,
  trim(age_group) AS age_group,
  risk_score,
  lower(trim(anomaly)) AS anomaly
  FROM raw)"""


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# Fixed rule values of the data contract, stated again so that a wrong one in the rules shows.
_IN_SETS = """transaction_type IN ('sale', 'purchase', 'transfer')
  AND anomaly IN ('low_risk', 'moderate_risk', 'high_risk')
  AND age_group IN ('new', 'established', 'veteran')
  AND purchase_pattern IN ('focused', 'random', 'high_value')"""
_PRESENT = """timestamp IS NOT NULL AND sending_address IS NOT NULL AND receiving_address IS NOT NULL
  AND amount IS NOT NULL AND transaction_type IS NOT NULL AND location_region IS NOT NULL
  AND risk_score IS NOT NULL AND anomaly IS NOT NULL"""
_ABSENT = """timestamp IS NULL OR sending_address IS NULL OR receiving_address IS NULL
  OR amount IS NULL OR transaction_type IS NULL OR location_region IS NULL
  OR risk_score IS NULL OR anomaly IS NULL"""
_REGION = "regexp_matches(location_region, '^[A-Za-z]')"

CLEAN = f"""clean AS (
  SELECT * FROM (SELECT DISTINCT * FROM normal)
  WHERE {_PRESENT} AND amount > 0 AND {_REGION} AND {_IN_SETS})"""

LATEST = """latest AS (
  SELECT receiving_address, amount, timestamp FROM (
    SELECT *, row_number() OVER (
      PARTITION BY receiving_address ORDER BY timestamp DESC, amount DESC) AS rn
    FROM clean WHERE transaction_type = 'sale')
  WHERE rn = 1)"""

REGIONS = """SELECT location_region, round(avg(risk_score), 6) AS avg_risk_score,
  count(*) AS transaction_count FROM clean GROUP BY location_region"""
RECEIVERS = "SELECT * FROM latest ORDER BY amount DESC, receiving_address LIMIT 3"

METRICS = f"""SELECT total_raw, total_cleaned, total_raw - total_cleaned AS total_dropped,
    total_raw - distinct_raw AS duplicates_removed, null_critical_dropped, invalid_amount_dropped
  FROM (SELECT
    (SELECT count(*) FROM raw) AS total_raw,
    (SELECT count(*) FROM clean) AS total_cleaned,
    (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS distinct_raw,
    (SELECT count(*) FROM (SELECT DISTINCT * FROM raw) WHERE {_ABSENT}) AS null_critical_dropped,
    (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)
      WHERE amount IS NOT NULL AND amount <= 0) AS invalid_amount_dropped)"""


def _raw(body: str) -> str:
    return _with(RAW, body)


def _normal(body: str) -> str:
    return _with(RAW, body, NORMAL)


def _clean(body: str, source: str = RAW) -> str:
    return _with(source, body, NORMAL, CLEAN)


def _receivers(body: str, source: str = RAW) -> str:
    return _with(source, body, NORMAL, CLEAN, LATEST)


def _not_address(column: str) -> str:
    return f"NOT regexp_matches({column}, '^0x[0-9a-f]{{40}}$')"


def _null_profile(table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {table}"
        for c in COLUMNS
    )


def _dq_metrics(table: str) -> str:
    nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in COLUMNS)
    low, high = 0, 100
    bad = {c: _not_address(c) for c in ADDRESSES}
    return f"""SELECT *, CASE WHEN total_records > 0 THEN
        round(CAST(total_records - error_count AS DOUBLE) / CAST(total_records AS DOUBLE) * 100, 4)
        ELSE 0.0 END AS compliance_pct
      FROM (SELECT *, total_nulls + invalid_amount_rows + invalid_sending_addresses
          + invalid_receiving_addresses AS error_count
        FROM (SELECT count(*) AS total_records, {nulls} AS total_nulls,
          count(*) FILTER (WHERE amount IS NULL OR amount <= 0) AS invalid_amount_rows,
          count(*) FILTER (WHERE {bad['sending_address']}) AS invalid_sending_addresses,
          count(*) FILTER (WHERE {bad['receiving_address']}) AS invalid_receiving_addresses,
          count(*) FILTER (WHERE risk_score < {low} OR risk_score > {high})
            AS risk_score_out_of_range
        FROM {table}))"""


def _broken(rule: R.Rule) -> str:
    c, kw = rule.column, rule.kwargs
    if rule.type == R.IN_SET:
        return f"{c} NOT IN ({_quoted(kw['value_set'])})"
    if rule.type == R.REGEX:
        return f"NOT regexp_matches({c}, '{kw['regex']}')"
    bounds = []
    if kw.get("min_value") is not None:
        bounds.append(f"{c} {'<=' if kw.get('strict_min') else '<'} {kw['min_value']}")
    if kw.get("max_value") is not None:
        bounds.append(f"{c} {'>=' if kw.get('strict_max') else '>'} {kw['max_value']}")
    return " OR ".join(bounds)


def _suite(table: str, suite: list[R.Rule]) -> str:
    rows = []
    for i, rule in enumerate(suite):
        head = f"CAST({i + 1} AS INTEGER) AS position, '{rule.type}' AS rule"
        if rule.type == R.ROW_COUNT:
            low, high = rule.kwargs["min_value"], rule.kwargs["max_value"] or 10**18
            rows.append(
                f"SELECT {head}, CAST(NULL AS VARCHAR) AS \"column\", count(*) AS element_count, "
                "CAST(0 AS BIGINT) AS missing_count, "
                f"greatest(0, {low} - count(*), count(*) - {high}) AS unexpected_count, "
                f"count(*) >= {low} AND count(*) <= {high} AS success FROM {table}"
            )
            continue
        missing = f"count(*) FILTER (WHERE {rule.column} IS NULL)"
        broken = missing
        if rule.type != R.NOT_NULL:
            broken = f"count(*) FILTER (WHERE {_broken(rule)})"
        judged = "count(*)" if rule.type == R.NOT_NULL else f"count({rule.column})"
        tolerated = (1 - rule.kwargs.get("mostly", 1)) if "mostly" in rule.kwargs else 0
        rows.append(
            f"SELECT {head}, '{rule.column}' AS \"column\", count(*) AS element_count, "
            f"{missing} AS missing_count, {broken} AS unexpected_count, "
            f"{broken} <= {tolerated} * {judged} AS success FROM {table}"
        )
    return " UNION ALL ".join(rows)


def _examples(table: str, suite: list[R.Rule], k: int) -> str:
    """The most frequent breaking values of each set and pattern rule."""
    rows = [
        f"SELECT * FROM (SELECT CAST({i + 1} AS INTEGER) AS position, '{rule.type}' AS rule, '{rule.column}' AS \"column\", "
        f"{rule.column} AS value, count(*) AS unexpected_count, true AS certain FROM {table} "
        f"WHERE {_broken(rule)} GROUP BY {rule.column} ORDER BY count(*) DESC, {rule.column} LIMIT {k})"
        for i, rule in enumerate(suite)
        if rule.type in (R.IN_SET, R.REGEX)
    ]
    return " UNION ALL ".join(rows)


def _expect(rule_type: str) -> str:
    return _normal(_suite("normal", [r for r in CONTRACT_SUITE if r.type == rule_type]))


def _frequency(table: str, column: str) -> str:
    return f'SELECT {column}, count(*) AS "count" FROM {table} GROUP BY {column}'


# Sizes of the part files, from the lengths of the records and the planned cuts.
_HEADER_BYTES = len(",".join(COLUMNS)) + 1
PARTS = f"""records AS (
    SELECT event_id, {RECORD} AS record, 1 AS copy FROM events
    UNION ALL SELECT event_id, {RECORD}, 2 FROM events WHERE {DUPLICATED}),
  lines AS (
    SELECT event_id // width AS part, length(record) + 1 AS size,
      1 + event_id % (length(record) - 1) AS cut,
      event_id % width = width - 1
        AND copy = CASE WHEN {DUPLICATED} THEN 2 ELSE 1 END AS is_cut
    FROM (SELECT *, {EVENTS_PER_PART} AS width FROM records)),
  pieces AS (
    SELECT part, CASE WHEN is_cut THEN cut ELSE size END AS size FROM lines
    UNION ALL SELECT part + 1, size - cut FROM lines WHERE is_cut
    UNION ALL SELECT 0, {_HEADER_BYTES}),
  parts AS (SELECT part, CAST(sum(size) AS BIGINT) AS size_bytes FROM pieces GROUP BY part)"""

_SUMMARY = """SELECT bool_and(success) AS success, count(*) AS evaluated_expectations,
  count(*) FILTER (WHERE success) AS successful_expectations,
  count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations"""

_TOKEN_TEXT = _copies(", ".join(f"{record_text(c)} AS {c}" for c in _NUMBERS))


# The suite of the data contract: fixed values, stated again.
CONTRACT_SUITE = [
    R.Rule(R.ROW_COUNT, {"min_value": 1, "max_value": 10_000_000}),
    R.Rule(R.NOT_NULL, {"column": "timestamp"}),
    R.Rule(R.NOT_NULL, {"column": "sending_address"}),
    R.Rule(R.NOT_NULL, {"column": "receiving_address"}),
    R.Rule(R.NOT_NULL, {"column": "amount"}),
    R.Rule(R.NOT_NULL, {"column": "transaction_type"}),
    R.Rule(R.NOT_NULL, {"column": "location_region"}),
    R.Rule(R.NOT_NULL, {"column": "risk_score"}),
    R.Rule(R.NOT_NULL, {"column": "anomaly"}),
    R.Rule(R.IN_SET, {"column": "transaction_type", "value_set": ["sale", "purchase", "transfer"]}),
    R.Rule(R.IN_SET, {"column": "anomaly", "value_set": ["low_risk", "moderate_risk", "high_risk"]}),
    R.Rule(R.IN_SET, {"column": "age_group", "value_set": ["new", "established", "veteran"]}),
    R.Rule(R.IN_SET, {"column": "purchase_pattern", "value_set": ["focused", "random", "high_value"]}),
    R.Rule(R.BETWEEN, {"column": "risk_score", "min_value": 0, "max_value": 100}),
    R.Rule(R.BETWEEN, {"column": "amount", "min_value": 0, "strict_min": True}),
    R.Rule(R.BETWEEN, {"column": "login_frequency", "min_value": 0}),
    R.Rule(R.BETWEEN, {"column": "session_duration", "min_value": 0}),
    R.Rule(R.REGEX, {"column": "sending_address", "regex": "^0x[0-9a-f]{40}$"}),
    R.Rule(R.REGEX, {"column": "receiving_address", "regex": "^0x[0-9a-f]{40}$"}),
]


def oracle_sql() -> dict[str, str]:
    suite = CONTRACT_SUITE
    open_suite = [R.Rule(R.ROW_COUNT, {"min_value": 1, "max_value": None}), *suite[1:]]
    region, receivers, metrics = _clean(REGIONS), _receivers(RECEIVERS), _clean(METRICS)
    csv_region, csv_receivers = _clean(REGIONS, CSV), _receivers(RECEIVERS, CSV)
    latest = _receivers("SELECT * FROM latest")
    clean = _clean("SELECT * FROM clean")
    csv_rows = _with(CSV, "SELECT * FROM raw")
    results = _suite("clean", suite)
    return {
        "scan_raw": _raw("SELECT * FROM raw"),
        "list_parts": _with(
            PARTS,
            "SELECT 'part_' || lpad(CAST(part AS VARCHAR), 8, '0') || '.csv' AS file, size_bytes, "
            "CAST(sum(size_bytes) OVER (ORDER BY part) - size_bytes AS BIGINT) AS pos FROM parts",
        ),
        "ingest_lines": _copies(f"{RECORD} AS value"),
        "ingest_parse": csv_rows,
        "ingest_parse_string_nulls": _with(CSV_NULLS, "SELECT * FROM raw"),
        "ingest_metadata": _with(
            PARTS,
            "SELECT (SELECT count(*) FROM records) AS row_count, count(*) AS file_count, "
            "CAST(sum(size_bytes) AS BIGINT) AS bytes_read, "
            f"CAST({len(COLUMNS)} AS INTEGER) AS column_count FROM parts",
        ),
        "null_token_counts": f"WITH texts AS ({_TOKEN_TEXT}) "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, "
            f"count(*) FILTER (WHERE {c} IN ({_quoted(NULL_TOKENS)})) AS null_count FROM texts"
            for c in _NUMBERS
        ),
        "parquet_round_trip": clean,
        "csv_export": region,
        "result_store": _clean(
            f"SELECT *, '{RUN_TIME.date()}' AS run_date, '{RUN_ID}' AS run_id FROM ({results})"
        ),
        "epoch_to_ts": _raw(
            "SELECT timestamp AS epoch, make_timestamp(timestamp * 1000000) AS ts FROM raw"
        ),
        "normalise_address": _normal("SELECT sending_address, receiving_address FROM normal"),
        "normalise_category": _normal("SELECT transaction_type, anomaly FROM normal"),
        "trim_columns": _normal(
            "SELECT location_region, ip_prefix, purchase_pattern, age_group FROM normal"
        ),
        "narrow_cast": _normal("SELECT login_frequency, session_duration FROM normal"),
        "project_columns": _normal(f"SELECT {_COLS} FROM normal"),
        "filter_critical_not_null": _normal(f"SELECT * FROM normal WHERE {_PRESENT}"),
        "filter_critical_null": _normal(f"SELECT * FROM normal WHERE {_ABSENT}"),
        "filter_amount_positive": _normal("SELECT * FROM normal WHERE amount > 0"),
        "filter_regex": _normal(f"SELECT * FROM normal WHERE {_REGION}"),
        "filter_in_set": _normal(f"SELECT * FROM normal WHERE {_IN_SETS}"),
        "filter_sales": _normal("SELECT * FROM normal WHERE transaction_type = 'sale'"),
        "dedupe_exact": _normal("SELECT DISTINCT * FROM normal"),
        "row_count": _raw("SELECT count(*) AS row_count FROM raw"),
        "anomaly_breakdown": _clean(_frequency("clean", "anomaly")),
        "region_frequency": _normal(_frequency("normal", "location_region")),
        "null_profile": _normal(_null_profile("normal")),
        "invalid_addresses": _normal(
            "SELECT "
            + ", ".join(
                f"count(*) FILTER (WHERE {_not_address(c)}) AS invalid_{c}" for c in ADDRESSES
            )
            + " FROM normal"
        ),
        "amount_checks": _normal(
            "SELECT count(*) FILTER (WHERE amount IS NULL OR amount <= 0) AS null_or_not_positive, "
            "count(*) FILTER (WHERE amount <= 0) AS not_positive FROM normal"
        ),
        "cleaning_metrics": metrics,
        "dq_metrics": _clean(_dq_metrics("clean")),
        "dq_metrics_uncleaned": _normal(_dq_metrics("normal")),
        "expect_row_count": _expect(R.ROW_COUNT),
        "expect_not_null": _expect(R.NOT_NULL),
        "expect_in_set": _expect(R.IN_SET),
        "expect_between": _expect(R.BETWEEN),
        "expect_regex": _expect(R.REGEX),
        "dq_suite_results": _clean(results),
        "dq_suite_uncleaned": _normal(_suite("normal", suite)),
        "dq_suite_summary": _clean(f"{_SUMMARY} FROM ({results})"),
        "dq_failed_rules": _clean(
            f'SELECT position, rule, "column" FROM ({results}) WHERE NOT success'
        ),
        "clean_transactions": clean,
        "region_risk": region,
        "latest_sale_per_receiver": latest,
        "latest_sale_aggregate": latest,
        "top_receivers": receivers,
        "stored_region_risk": region,
        "stored_top_receivers": receivers,
        "pipeline_region_risk": csv_region,
        "pipeline_top_receivers": csv_receivers,
        "pipeline_cleaning_metrics": _clean(METRICS, CSV),
        "pipeline_dq_results": _clean(_suite("clean", open_suite), CSV),
        "ingest_lines_by_spark": _copies(f"{RECORD} AS value"),
        "ingest_odd_by_spark": _with(ODD_RAW, _NAN_APART + "raw"),
        "ingest_odd": _with(ODD_RAW, _NAN_APART + "raw"),
        "clean_odd": _clean(_NAN_APART + "clean", ODD_TRIMMED),
        "column_contract_broken": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, EXISTS (SELECT 1 FROM events WHERE '{c}' NOT IN ({_quoted(LACKING)})) AS present"
            for c in COLUMNS
        ),
        "column_contract": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, EXISTS (SELECT 1 FROM events) AS present" for c in COLUMNS
        ),
        "preview_rows": receivers,
        "receivers_csv": _receivers(
            "SELECT receiving_address, CAST(amount AS VARCHAR) AS amount, "
            f"strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%gZ') AS timestamp FROM ({RECEIVERS})"
        ),
        "gate_verdict": _clean(
            "SELECT bool_and(success) AS success, "
            "coalesce(string_agg(rule, ', ' ORDER BY position) FILTER (WHERE NOT success), '') AS failed "
            f"FROM ({results})"
        ),
        "suite_mostly": _normal(_suite("normal", R.suite_from_json(MOSTLY_SUITE))),
        "profile_slots_results": _clean(results),
        "profile_slots_metrics": _clean(_dq_metrics("clean")),
        "unexpected_values": _normal(_examples("normal", suite, EXAMPLES)),
        "unexpected_values_small_sketch": _normal(
            "SELECT CAST(1 AS INTEGER) AS position, '" + R.IN_SET + "' AS rule, 'mixed' AS \"column\", value, "
            f"count(*) AS unexpected_count, true AS certain FROM (SELECT {MIXED} AS value FROM normal) "
            "WHERE value <> 'none' GROUP BY value ORDER BY count(*) DESC, value LIMIT 3"
        ),
        "stream_quality_results": _clean(results),
        "stream_out_of_order": _clean("SELECT * FROM clean"),
        "stream_ingest": csv_rows,
        "stream_region_risk": csv_region,
        "stream_top_receivers": receivers,
        "stream_latest_sales": latest,
        "stream_distinct_rows": _clean("SELECT * FROM clean"),
        "stream_distinct_region_risk": csv_region,
    }
