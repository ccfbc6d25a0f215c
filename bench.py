"""Headline queries on the given tables. Prints one JSON line.

Each query runs once to warm up, then several times; the median counts. Results are
consumed in full by a sink that drops them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from txspark import fixtures  # noqa: E402
from txspark.plans.clean import clean, cleaning_metrics  # noqa: E402
from txspark.plans.quality import dq_metrics, dq_suite_results  # noqa: E402
from txspark.plans.tables import latest_sale_per_receiver, region_risk, top_receivers  # noqa: E402
from txspark.session import configure  # noqa: E402
from txspark.sources.lines import read_lines, read_transactions  # noqa: E402

RUNS = 5


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("txspark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    # What a run finds in storage: parts, the raw table and the clean table.
    base = tempfile.mkdtemp(prefix="txspark-bench-")
    fixtures.write_byte_split(fixtures.events(spark, sf_dir), f"{base}/parts")
    parts = f"{base}/parts"
    read_transactions(spark, parts).write.parquet(f"{base}/raw")
    raw = spark.read.parquet(f"{base}/raw")
    clean(raw).write.parquet(f"{base}/clean")
    cleaned = spark.read.parquet(f"{base}/clean")

    def ingest_and_store() -> None:
        read_transactions(spark, parts).write.mode("overwrite").parquet(f"{base}/raw2")

    def clean_and_store() -> None:
        clean(raw).write.mode("overwrite").parquet(f"{base}/clean2")

    work = {
        "ingest_lines": lambda: consume(read_lines(spark, parts)),
        "ingest_parse": lambda: consume(read_transactions(spark, parts)),
        "ingest_store": ingest_and_store,
        "clean_transactions": lambda: consume(clean(raw)),
        "clean_store": clean_and_store,
        "cleaning_metrics": lambda: consume(cleaning_metrics(raw, cleaned)),
        "dq_metrics": lambda: consume(dq_metrics(cleaned)),
        "dq_suite_results": lambda: consume(dq_suite_results(cleaned)),
        "region_risk": lambda: consume(region_risk(cleaned)),
        "latest_sale_per_receiver": lambda: consume(latest_sale_per_receiver(cleaned)),
        "top_receivers": lambda: top_receivers(cleaned).collect(),
    }
    seconds = {}
    for name, run in work.items():
        run()
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)

    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(sf_dir.rstrip("/")).name.removeprefix("sf") or 0),
                "cpus": int(cpus),
                "input_rows": raw.count(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
