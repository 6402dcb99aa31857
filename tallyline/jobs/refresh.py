"""Keeps statement state, indicators and averages up to date from a change log.

    spark-submit … refresh.py --kind indicators --base s3a://…/statements \\
        --log-format kafka --option kafka.bootstrap.servers=… --option subscribe=… \\
        --every "5 seconds"

Without ``--every`` the program works off what the log holds and ends.  Under the
base folder it keeps ``state``, ``indicators`` or ``averages``, ``dead`` and
``checkpoint``; ``--csv`` writes a CSV copy of the result when the query has ended.
``--load`` starts from stored rows (a parquet folder or a catalog table) if the state is
new.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyline.functions.periods import period_order
from tallyline.operators.filters import complete_rows, exclude_prefix, order_statements
from tallyline.schema import COMPANY, MEASURES, PERIOD, statement_schema, whole_number_schema
from tallyline.sinks import Snapshot, write_csv, write_single_csv
from tallyline.sinks.jdbc import jdbc_executor
from tallyline.sources import read_changes, read_state_jdbc
from tallyline.streaming import Averages, DatabaseCopy, FollowUp, Indicators, Refresh, run_refresh

KINDS = ("average", "company", "indicators")


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--kind", choices=KINDS, default="indicators")
    parser.add_argument("--base", required=True, help="folder for state, results and checkpoint")
    parser.add_argument("--log-format", default="kafka", choices=["kafka", "parquet", "json", "text"])
    parser.add_argument("--log-path")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--mode", choices=["coalesce", "fill", "replace"], default="replace")
    parser.add_argument("--whole-numbers", action="store_true", help="money arrives as bigint")
    parser.add_argument("--buckets", type=int, default=64)
    parser.add_argument("--every", help='trigger interval, e.g. "5 seconds"')
    parser.add_argument("--keep-versions", type=int, default=10)
    parser.add_argument("--csv", help="folder for a CSV copy of the result, written at the end")
    parser.add_argument("--load", help="stored rows to start a new state from: folder or table")
    parser.add_argument("--jdbc-url", help="database that gets the state's rows after each commit")
    parser.add_argument("--jdbc-table", help="its table; also what a new state starts from")
    parser.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
    return parser.parse_args(argv)


def result(kind: str, snapshot: Snapshot, follow: FollowUp | None) -> DataFrame:
    """The table a finished commit stands for."""
    if kind == "indicators":
        return follow.read()
    if kind == "company":
        return exclude_prefix(snapshot.read())
    rows = exclude_prefix(snapshot.read())
    summed = rows.unionByName(follow.average(digits=2))
    return complete_rows(summed, [PERIOD, *MEASURES])


def write_result(args: argparse.Namespace, refresh: Refresh) -> None:
    """The CSV copy of what the last commit stands for."""
    follow = next((step for step in refresh.after if isinstance(step, FollowUp)), None)
    table = result(args.kind, refresh.snapshot, follow)
    if args.kind == "average":
        # One company's table is a report: one file, the average row last.
        is_average = table[PERIOD].eqNullSafe("Average").cast("int")
        write_single_csv(table, args.csv, order=[is_average, *period_order(PERIOD)])
    else:
        write_csv(order_statements(table), args.csv)


def start(spark: SparkSession, args: argparse.Namespace) -> tuple[StreamingQuery, Refresh]:
    multi = args.kind != "average"
    row = whole_number_schema(multi) if args.whole_numbers else statement_schema(multi)
    keys = [PERIOD, COMPANY] if multi else [PERIOD]
    state = Snapshot(
        spark, f"{args.base}/state", row, keys, args.buckets, [COMPANY] if multi else None
    )
    follow: FollowUp | None = None
    if args.kind == "indicators":
        follow = Indicators(spark, f"{args.base}/indicators", row, args.buckets)
    elif args.kind == "average":
        follow = Averages(spark, f"{args.base}/averages", buckets=args.buckets)
    after: list[Callable[[Snapshot, int], None]] = [follow] if follow else []
    jdbc = dict(o.split("=", 1) for o in args.jdbc_option)
    if args.jdbc_url:
        execute = jdbc_executor(spark, args.jdbc_url, **jdbc)
        after.append(DatabaseCopy(args.jdbc_url, args.jdbc_table, execute, **jdbc))
    if (args.load or args.jdbc_url) and not state.version():
        if not args.load:
            stored = read_state_jdbc(spark, args.jdbc_url, args.jdbc_table, **jdbc)
        else:
            stored = spark.read.parquet(args.load) if "/" in args.load else spark.table(args.load)
        version = state.load(stored)
        # Without an event the tables that follow would wait for the first one.
        for step in after:
            step(state, version)
    options = dict(o.split("=", 1) for o in args.option)
    changes = read_changes(spark, args.log_format, args.log_path, streaming=True, **options)
    refresh = Refresh(
        state,
        row,
        keys,
        args.mode,
        dead_letter_path=f"{args.base}/dead",
        keep_versions=args.keep_versions,
        after=after,
    )
    return run_refresh(changes, refresh, f"{args.base}/checkpoint", args.every), refresh


def main(argv: Sequence[str] | None = None) -> None:
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    args = arguments(argv)
    query, refresh = start(spark, args)
    query.awaitTermination()
    if args.csv:
        write_result(args, refresh)


if __name__ == "__main__":
    main()
