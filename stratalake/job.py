"""Command line for spark-submit: a whole refresh or one stage of it.

    spark-submit run_job.py all --source /landing/subscribers.csv --store /lake
    spark-submit run_job.py report --store /lake

Settings of the cluster (memory, partitions, spark.checkpoint.dir) come from spark-submit.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import SparkSession

from stratalake.context import RunContext
from stratalake.plans.report import churn_rate_report
from stratalake.plans.run import (
    METRICS, Store, load_bronze, load_gold, load_silver, run_layers, validate_gold,
)
from stratalake.sources.csv import read_csv_raw
from stratalake.sources.layers import LayerStore
from stratalake.sources.relational import RelationalStore
from stratalake.sources.shadow import ShadowStore

STAGES = ["all", "bronze", "silver", "gold", "validate", "report"]


def parse(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("stage", choices=STAGES)
    parser.add_argument("--store", help="root folder of the layer tables")
    parser.add_argument("--jdbc-url", help="database of the layer tables, instead of --store")
    parser.add_argument(
        "--jdbc-option", action="append", default=[], metavar="NAME=VALUE",
        help="driver, user and the like; passwords are better kept in the driver's own files",
    )
    parser.add_argument(
        "--jdbc-swap", action="store_true",
        help="load gold beside the tables in use and swap all names in one transaction",
    )
    parser.add_argument("--source", help="CSV file or folder (stages all and bronze)")
    parser.add_argument(
        "--record-files", action="store_true",
        help="record each row's own file instead of the source's name",
    )
    parser.add_argument("--run-id", help="recorded with every bronze row")
    parser.add_argument(
        "--run-ts", type=datetime.fromisoformat,
        help="ISO time of the run: the same for all its stages and for their repeats",
    )
    parser.add_argument(
        "--on-bad", choices=["error", "null"], default="error",
        help="what unreadable numbers and over-long rows of the source do",
    )
    parser.add_argument(
        "--keep-null", nargs="*", default=(), metavar="COLUMN",
        help="numeric columns whose gaps are not filled with the median",
    )
    parser.add_argument("--on-conflict", choices=["own", "fanout", "error", "pick"], default="own")
    parser.add_argument(
        "--customer-buckets", type=int, default=0, metavar="N",
        help="lay silver and customers out side by side, about one bucket for each 128 MB of silver",
    )
    parser.add_argument("--null-safe", action="store_true", help="match NULL natural keys")
    parser.add_argument("--hash-salt", help="salt of the customer pseudonyms")
    args = parser.parse_args(argv)
    if args.stage in ("all", "bronze") and not args.source:
        parser.error(f"stage {args.stage} needs --source")
    if bool(args.store) == bool(args.jdbc_url):
        parser.error("give either --store or --jdbc-url")
    if args.jdbc_swap and not args.jdbc_url:
        parser.error("--jdbc-swap needs --jdbc-url")
    if args.customer_buckets and args.on_conflict != "own":
        parser.error("--customer-buckets needs --on-conflict own")
    if any("=" not in option for option in args.jdbc_option):
        parser.error("--jdbc-option takes NAME=VALUE")
    return args


def store_of(spark: SparkSession, args: argparse.Namespace) -> Store:
    if args.store:
        return LayerStore(spark, args.store)
    options = dict(option.split("=", 1) for option in args.jdbc_option)
    kind = ShadowStore if args.jdbc_swap else RelationalStore
    return kind(spark, {"url": args.jdbc_url, **options})


def run(spark: SparkSession, args: argparse.Namespace) -> Iterable[dict]:
    """Do the stage; returns its metrics, failed or passed checks, or report rows."""
    given = {"run_id": args.run_id, "run_ts": args.run_ts}
    settings = {name: value for name, value in given.items() if value}
    ctx = RunContext(
        **settings, source_file=args.source or "", impute_exclude=tuple(args.keep_null),
        on_conflict=args.on_conflict, null_safe_lookup=args.null_safe, hash_salt=args.hash_salt,
        customer_buckets=args.customer_buckets,
    )
    store = store_of(spark, args)
    files = "source_file" if args.record_files else None

    def metrics(rows: list[tuple]) -> list[dict]:
        return [dict(zip(METRICS.names, row)) for row in rows]

    if args.stage == "all":
        raw = read_csv_raw(spark, args.source, file_column=files, on_bad=args.on_bad)
        return [r.asDict() for r in run_layers(spark, raw, store, ctx, files).collect()]
    if args.stage == "bronze":
        raw = read_csv_raw(spark, args.source, file_column=files, on_bad=args.on_bad)
        return metrics(load_bronze(raw, store, ctx, files))
    if args.stage == "silver":
        return metrics(load_silver(store, ctx))
    if args.stage == "gold":
        return metrics(load_gold(store, ctx))
    if args.stage == "validate":
        return [r.asDict() for r in validate_gold(store)]
    # One row for each pair of labels; labels are free text, so row by row.
    return (r.asDict() for r in churn_rate_report(store.gold()).toLocalIterator())


def main(argv: Sequence[str] | None = None) -> None:
    args = parse(argv)
    spark = SparkSession.builder.appName(f"stratalake-{args.stage}").getOrCreate()
    try:
        for line in run(spark, args):
            print(json.dumps(line))
    finally:
        spark.stop()
