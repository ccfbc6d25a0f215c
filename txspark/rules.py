"""Declared rules. One `TransactionRules` object drives both the cleaning filter
and the validation suite, so the two cannot drift apart."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from txspark.functions.predicates import (
    all_present,
    any_null,
    in_set,
    matches,
    not_in_set,
    not_matches,
    outside,
    positive,
)
from txspark.functions.sqltext import ident

# The public names of the supported expectation types and their arguments.
ROW_COUNT = "expect_table_row_count_to_be_between"
NOT_NULL = "expect_column_values_to_not_be_null"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
REGEX = "expect_column_values_to_match_regex"

_REQUIRED = {
    ROW_COUNT: (),
    NOT_NULL: ("column",),
    IN_SET: ("column", "value_set"),
    BETWEEN: ("column",),
    REGEX: ("column", "regex"),
}
_OPTIONAL = {
    ROW_COUNT: ("min_value", "max_value"),
    NOT_NULL: ("mostly",),
    IN_SET: ("mostly",),
    BETWEEN: ("min_value", "max_value", "strict_min", "strict_max", "mostly"),
    REGEX: ("mostly",),
}


@dataclass(frozen=True)
class Rule:
    """One expectation: its type and its keyword arguments."""

    type: str
    kwargs: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.type not in _REQUIRED:
            raise ValueError(f"Unsupported expectation type: {self.type}")
        absent = [k for k in _REQUIRED[self.type] if k not in self.kwargs]
        if absent:
            raise ValueError(f"{self.type} needs {absent}")
        known = {*_REQUIRED[self.type], *_OPTIONAL[self.type]}
        if unknown := sorted(set(self.kwargs) - known):
            raise ValueError(f"{self.type} does not know {unknown}")
        if not 0 <= self.mostly <= 1:
            raise ValueError(f"mostly lies outside 0 to 1: {self.mostly}")

    @property
    def column(self) -> str | None:
        return self.kwargs.get("column")

    @property
    def mostly(self) -> float:
        """The share of values that must keep the rule."""
        return self.kwargs.get("mostly", 1)

    def violated(self, value: str) -> str:
        """True where the value breaks the rule, NULL where there is none."""
        kw = self.kwargs
        if self.type == IN_SET:
            return not_in_set(value, kw["value_set"])
        if self.type == BETWEEN:
            return outside(
                value,
                kw.get("min_value"),
                kw.get("max_value"),
                kw.get("strict_min", False),
                kw.get("strict_max", False),
            )
        if self.type == REGEX:
            return not_matches(value, kw["regex"])
        raise ValueError(f"{self.type} has no row predicate")


def suite_to_json(name: str, suite: list[Rule]) -> str:
    """Serialise a suite in the public expectation-suite layout."""
    body = {
        "expectation_suite_name": name,
        "expectations": [
            {"expectation_type": r.type, "kwargs": r.kwargs, "meta": {}} for r in suite
        ],
    }
    return json.dumps(body, indent=2)


def suite_from_json(text: str) -> list[Rule]:
    """Read a suite in the public expectation-suite layout."""
    return [
        Rule(e["expectation_type"], dict(e["kwargs"]))
        for e in json.loads(text)["expectations"]
    ]


@dataclass(frozen=True)
class TransactionRules:
    """What a valid transaction is. The defaults are fixed values of the data contract."""

    critical: tuple[str, ...] = (
        "timestamp",
        "sending_address",
        "receiving_address",
        "amount",
        "transaction_type",
        "location_region",
        "risk_score",
        "anomaly",
    )
    allowed: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "transaction_type": ("sale", "purchase", "transfer"),
            "anomaly": ("low_risk", "moderate_risk", "high_risk"),
            "age_group": ("new", "established", "veteran"),
            "purchase_pattern": ("focused", "random", "high_value"),
        }
    )
    # A region must start with a letter: a bare number is what a badly cut record leaves.
    region_pattern: str = "^[A-Za-z]"
    address_pattern: str = "^0x[0-9a-f]{40}$"
    risk_range: tuple[float, float] = (0, 100)
    # The bound on the number of rows. A table may be of any size unless one is given.
    min_rows: int | None = 1
    max_rows: int | None = None

    def critical_present(self) -> str:
        return all_present(self.critical)

    def critical_missing(self) -> str:
        return any_null(self.critical)

    def valid_region(self) -> str:
        return matches("location_region", self.region_pattern)

    def allowed_values(self) -> str:
        return " AND ".join(in_set(ident(c), v) for c, v in self.allowed.items())

    def valid_raw(self) -> str:
        """The part of the cleaning filter that raw and clean columns answer alike:
        normalisation never turns a value into NULL or NULL into a value."""
        return f"{self.critical_present()} AND {positive('amount')}"

    def valid_values(self) -> str:
        """The part that needs clean spellings. A NULL outcome drops the row."""
        return f"{self.valid_region()} AND {self.allowed_values()}"

    def suite(self) -> list[Rule]:
        """The validation suite, in reporting order."""
        low, high = self.risk_range
        return [
            Rule(ROW_COUNT, {"min_value": self.min_rows, "max_value": self.max_rows}),
            *(Rule(NOT_NULL, {"column": c}) for c in self.critical),
            *(
                Rule(IN_SET, {"column": c, "value_set": list(v)})
                for c, v in self.allowed.items()
            ),
            Rule(BETWEEN, {"column": "risk_score", "min_value": low, "max_value": high}),
            Rule(BETWEEN, {"column": "amount", "min_value": 0, "strict_min": True}),
            Rule(BETWEEN, {"column": "login_frequency", "min_value": 0}),
            Rule(BETWEEN, {"column": "session_duration", "min_value": 0}),
            Rule(REGEX, {"column": "sending_address", "regex": self.address_pattern}),
            Rule(REGEX, {"column": "receiving_address", "regex": self.address_pattern}),
        ]


RULES = TransactionRules()

__all__ = [
    "BETWEEN",
    "IN_SET",
    "NOT_NULL",
    "REGEX",
    "ROW_COUNT",
    "RULES",
    "Rule",
    "TransactionRules",
    "suite_from_json",
    "suite_to_json",
]
