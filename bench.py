"""Headline timings: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) holds the tables, BENCH_CPUS (default 8) sets local[n].
The session is warmed on the smallest scale first, so JVM start and code loading are left out;
every query is then run three times, its whole result is consumed, and the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stratalake.context import RunContext  # noqa: E402
from stratalake.operators.checks import require  # noqa: E402
from stratalake.plans.report import churn_rate_report  # noqa: E402
from stratalake.plans.run import load_bronze, load_gold, load_silver  # noqa: E402
from stratalake.plans.validate import gold_not_empty  # noqa: E402
from stratalake.sources.layers import LayerStore  # noqa: E402
from stratalake.sources.staging import Staging, staged_results  # noqa: E402
from stratalake.workload.queries import QUERIES  # noqa: E402
from stratalake.workload.subscribers import subscriber_raw  # noqa: E402

HEADLINE = [
    "column_medians", "lineitem_medians", "dedupe_lineitem", "dense_key_distinct",
    "dense_key_digest", "dense_key_rows", "check_unique", "check_fk", "check_domain",
    "counts_by_table", "normalize_documents", "fact_churn", "end_to_end_report",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def medians(runs: list[dict[str, float]]) -> dict[str, float]:
    return {name: statistics.median(run[name] for run in runs) for name in runs[0]}


def stage_timings(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """The stages of one full refresh, each from and to written tables."""
    with Staging(spark) as staging:
        store, ctx = LayerStore(spark, staging.folder()), RunContext()
        return {
            "stage_bronze": timed(lambda: load_bronze(subscriber_raw(spark, sf_dir), store, ctx)),
            "stage_silver": timed(lambda: load_silver(store, ctx)),
            "stage_gold": timed(lambda: load_gold(store, ctx)),
            "stage_validate": timed(lambda: require(gold_not_empty(store.gold()))),
            "stage_report": timed(lambda: churn_rate_report(store.gold()).collect()),
        }


def query_timings(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    def run(name: str) -> None:
        with staged_results():
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    return {name: timed(lambda: run(name)) for name in HEADLINE}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("stratalake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    smallest = Path(sf_dir).parent / "sf0.001"
    warm_dir = str(smallest) if smallest.exists() else sf_dir
    stage_timings(spark, warm_dir)
    query_timings(spark, warm_dir)

    runs = [stage_timings(spark, sf_dir) | query_timings(spark, sf_dir) for _ in range(3)]
    seconds = medians(runs)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
