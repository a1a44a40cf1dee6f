"""Command line: ``python -m aerostage run --landing L --warehouse W [--day YYYY-MM-DD ...]``.

Runs the daily job (load, stage, check) on the current Spark master (``--master`` for local runs).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="aerostage")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="load landed feeds, rebuild staging for the touched days, run checks")
    run.add_argument("--landing", required=True, help="landing root with schedules/ and flights/")
    run.add_argument("--warehouse", required=True, help="warehouse root for raw/, staging/, checks")
    run.add_argument("--day", action="append", default=None, help="flight day (repeatable); default: all landed")
    run.add_argument("--airports", default=None, help="airport CSV folder (rebuilds the airport dimension)")
    run.add_argument("--batch-id", type=int, default=None, help="default: seconds since epoch of the run")
    run.add_argument("--master", default=None, help="Spark master for local runs, e.g. local[8]")
    run.add_argument("--input-gb", type=float, default=None,
                     help="size of the day's input; sizes shuffle and scan partitions (scale_settings)")
    args = parser.parse_args(argv)

    from aerostage.functions.time import parse_flight_date
    from aerostage.plans.daily import Layout, run_days
    from aerostage.session import apply_settings, build_session, scale_settings

    days = [parse_flight_date(d) for d in args.day] if args.day else None
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    batch_id = args.batch_id if args.batch_id is not None else int(now.timestamp())
    spark = build_session(args.master, app="aerostage-daily")
    if args.input_gb:
        cores = spark.sparkContext.defaultParallelism
        apply_settings(spark, scale_settings(int(args.input_gb * (1 << 30)), cores))
    results = run_days(spark, Layout(args.landing, args.warehouse), batch_id, now, days, args.airports)
    failed = results.where("NOT passed")
    results.orderBy("model", "check_name").show(200, truncate=False)
    return 1 if failed.take(1) else 0


if __name__ == "__main__":
    sys.exit(main())
