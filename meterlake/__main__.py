"""Command line of the lake (J8): ``spark-submit`` this file or ``python -m meterlake``."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from datetime import date, datetime, timezone

from meterlake.functions.calendar import month_before, resolve_months
from meterlake.plans import jobs
from meterlake.schema import TAXI_TYPES
from meterlake.session import lake_session
from meterlake.sources.tables import Lake


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="meterlake", description="Trip-record lakehouse jobs")
    root.add_argument("--root", required=True, help="Root folder of the lake")
    root.add_argument("--source-base", default="", help="Folder of the raw trip files")
    root.add_argument("--zone-csv", default="", help="Path of the zone list")
    commands = root.add_subparsers(dest="command", required=True)
    commands.add_parser("bootstrap", help="Create the tables and load the zone list")
    commands.add_parser("ensure-warehouse", help="Create the tables")
    commands.add_parser("load-zones", help="Refresh the zone list")
    commands.add_parser("build-gold", help="Refresh dimensions, fact, marts and monitoring")
    commands.add_parser("check", help="Run the data checks")

    def loading(name: str, text: str) -> argparse.ArgumentParser:
        command = commands.add_parser(name, help=text)
        command.add_argument("--taxi-type", default="yellow", choices=TAXI_TYPES)
        return command

    month = loading("run-month", "Load one month")
    month.add_argument("--year-month", required=True, help="For example 2024-01")
    months = loading("run-range", "Load a range of months, both ends included")
    months.add_argument("--start-month", required=True)
    months.add_argument("--end-month", required=True)
    months.add_argument("--continue-on-error", action="store_true")
    everything = loading("run-all", "Load, build, check, and fail on error alerts")
    for option in ("--year-month", "--start-month", "--end-month"):
        everything.add_argument(option)
    everything.add_argument(
        "--run-date",
        type=date.fromisoformat,
        help="Day of the run; the month before it is loaded by default (today in UTC)",
    )
    return root


def main(arguments: Sequence[str] | None = None) -> dict:
    args = parser().parse_args(arguments)
    lake = Lake(args.root, args.source_base, args.zone_csv)
    spark = lake_session()
    done = {"status": "success", "action": args.command}
    match args.command:
        case "bootstrap":
            jobs.bootstrap(spark, lake)
            result = done
        case "ensure-warehouse":
            jobs.ensure_warehouse(spark, lake)
            result = done
        case "load-zones":
            result = {**done, "rows": jobs.load_zones(spark, lake)}
        case "build-gold":
            jobs.build_gold(spark, lake)
            result = done
        case "check":
            rows = jobs.check_tables(spark, lake).collect()
            result = {**done, "checks": [row.asDict() for row in rows]}
        case "run-month":
            result = jobs.run_month(spark, lake, args.taxi_type, args.year_month)
        case "run-range":
            result = jobs.run_range(
                spark,
                lake,
                args.taxi_type,
                args.start_month,
                args.end_month,
                args.continue_on_error,
            )
        case _:
            months = resolve_months(
                month_before(args.run_date or datetime.now(timezone.utc).date()),
                args.year_month,
                args.start_month,
                args.end_month,
            )
            result = jobs.run_all(spark, lake, args.taxi_type, months)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main()
