"""Run the daily run from landing folders: ``python -m ordermill --landing ... --raw ...``.

A failed step or check ends the process with an error.
"""

from __future__ import annotations

import argparse
import logging

from ordermill.plans.daily_run import Places, landing_tables, run_daily
from ordermill.session import build_session
from ordermill.sinks.warehouse import MODES


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ordermill")
    parser.add_argument("--run_date", nargs="+", required=True, metavar="YYYY-MM-DD")
    parser.add_argument("--landing", required=True, help="root of <table>/run_date=YYYY-MM-DD/ Parquet folders")
    parser.add_argument("--raw", required=True)
    parser.add_argument("--processed", required=True)
    parser.add_argument("--database", required=True)
    parser.add_argument("--database_location")
    parser.add_argument("--mode", choices=MODES, default="reload")
    parser.add_argument("--all_runs", action="store_true", help="check all runs of the warehouse")
    parser.add_argument("--resume", action="store_true", help="leave out steps that are done for the same input files")
    parser.add_argument("--widen", action="store_true", help="give columns of the warehouse wider types where new rows need them")
    parser.add_argument("--verbose", action="store_true")
    options = parser.parse_args(arguments)

    logging.basicConfig(level=logging.INFO if options.verbose else logging.WARNING)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = build_session()
    run_daily(
        spark,
        landing_tables(spark, options.landing, options.run_date),
        Places(options.raw, options.processed, options.database, options.database_location),
        options.run_date,
        options.mode,
        options.verbose,
        options.all_runs,
        options.resume,
        widen=options.widen,
    )


if __name__ == "__main__":
    main()
