"""Quality profiles that add up.

A profile holds nothing but counters and sketches, so that of a whole table is the sum of those
of its parts. A store keeps one for each slot, a part or a batch: a new part costs a scan of
that part, a part that comes again replaces its own, and the suite, the metrics and the gate
are answered for everything from a few rows.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from txspark.operators.unexpected import merged_sketches, sketches, unexpected_values
from txspark.plans.quality import QualityReport, gate, quality_profile
from txspark.rules import RULES, TransactionRules, suite_to_json
from txspark.sinks.publish import documents, folders, get_document, new_name, put_document, publish_tables, remove_folder
from txspark.streaming.distinct import start_distinct
from txspark.streaming.live import Drain

PROFILES = "profiles"
# Slots beyond this many become one.
MOST_SLOTS = 64


class ProfileStore:
    """Profiles of slots in `path`, for one set of rules. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, rules: TransactionRules = RULES) -> None:
        self.spark, self.path, self.rules = spark, path.rstrip("/"), rules
        self.suite = rules.suite()
        self.kind = hashlib.sha256(suite_to_json(PROFILES, self.suite).encode()).hexdigest()

    def _state(self) -> dict:
        if PROFILES not in documents(self.path):
            return {"rules": self.kind, "slots": {}, "schemas": {}}
        state = get_document(self.path, PROFILES)
        if state["rules"] != self.kind:
            raise ValueError(f"The profiles in {self.path} were taken with other rules")
        return state

    @property
    def slots(self) -> list[str]:
        return list(self._state()["slots"])

    def put(self, slot: str, rows: DataFrame, reset: bool = False) -> None:
        """Take the profile of a slot's rows, in place of an older one of the slot or, with reset,
        of all that is stored."""
        state = self._state()
        if reset:
            state["slots"] = {}
        self._publish(state, slot, quality_profile(rows, self.rules), sketches(rows, self.suite))

    def fold(self, slots: list[str], into: str) -> None:
        """Make one slot of several; they can then no longer be replaced one by one."""
        state = self._state()
        chosen = {s: state["slots"].pop(s) for s in slots}
        profile = _added(self._read(state, chosen, "profile"))
        self._publish(state, into, profile, merged_sketches(self._read(state, chosen, "sketches"), self.suite))

    def _publish(self, state: dict, slot: str, profile: DataFrame, sketch: DataFrame) -> None:
        name = new_name()
        for table, df in (("profile", profile), ("sketches", sketch)):
            df.coalesce(1).write.parquet(f"{self.path}/data/{name}/{table}")
            state["schemas"][table] = df.schema.json()
        before = set(state["slots"].values()) | set(self._state()["slots"].values())
        state["slots"][slot] = name
        put_document(self.path, PROFILES, state)
        # what the state before named stays for its readers, all else goes
        for folder in folders(f"{self.path}/data"):
            if folder not in before and folder < name:
                remove_folder(f"{self.path}/data", folder)

    def _read(self, state: dict, slots: dict[str, str], table: str) -> DataFrame:
        if not slots:
            raise FileNotFoundError(f"No profile is stored in {self.path}")
        schema = T.StructType.fromJson(json.loads(state["schemas"][table]))
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{n}/{table}" for n in slots.values()])

    def merged(self) -> DataFrame:
        """The profile of all slots, as one scan of all their rows would give it."""
        state = self._state()
        return _added(self._read(state, state["slots"], "profile"))

    def report(self) -> QualityReport:
        return QualityReport(self.merged(), self.rules)

    def unexpected(self, k: int = 20) -> DataFrame:
        """The most frequent values that break each rule, from the stored sketches alone."""
        state = self._state()
        taken = merged_sketches(self._read(state, state["slots"], "sketches"), self.suite)
        return unexpected_values(None, self.suite, k, taken)


def _added(profiles: DataFrame) -> DataFrame:
    counters = [c for c in profiles.columns if c != "anomaly"]
    return profiles.groupBy("anomaly").agg(*[F.sum(c).alias(c) for c in counters])


def start_quality(
    valid: DataFrame,
    path: str,
    checkpoint: str,
    rules: TransactionRules = RULES,
    raise_on_failure: bool = True,
    buckets: int = 32,
    **trigger: object,
) -> StreamingQuery | Drain:
    """Judge everything that has arrived, after every batch of it.

    `valid` may hold copies (`valid_rows`): distinct rows are kept in `path`, and a batch's
    profile is that of its new rows. The suite's outcome, the metrics and the breaking values
    are published in `path`/report before the gate may stop the query. A batch the gate refuses
    does not count: it is judged again by the next run.
    """
    spark = valid.sparkSession
    store = ProfileStore(spark, f"{path}/profiles", rules)

    def then(fresh: DataFrame, before: str, now: str) -> None:
        batch = int(now.split("-")[1])
        store.put(f"{batch:019d}", fresh, reset=not before)
        old = sorted(store.slots)[:-1]
        if len(old) >= MOST_SLOTS:
            store.fold(old, old[-1])
        report = store.report()
        results = report.results()
        tables = {"dq_results": results, "dq_metrics": report.metrics(), "unexpected": store.unexpected()}
        publish_tables(tables, f"{path}/report", "now")
        gate(results, raise_on_failure)

    return start_distinct(valid, path, checkpoint, then, buckets, **trigger)
