"""Command line for ``spark-submit``: ``python -m wattframe <job> --root <folder> ...``."""

from __future__ import annotations

import argparse
from datetime import date, datetime, timezone

from pyspark.sql import SparkSession

from wattframe.feeds import FEEDS
from wattframe.operators.increments import FULL, MODES, WINDOW_DAYS
from wattframe.plans import jobs
from wattframe.plans.build import run
from wattframe.plans.warehouse import Warehouse
from wattframe.sources.files import exists


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="wattframe")
    top.add_argument("--root", required=True, help="folder of all tables, shared storage on a cluster")
    job = top.add_subparsers(dest="job", required=True)

    seeds = job.add_parser("seeds", help="store reference tables")
    seeds.add_argument("folder", help="folder of <seed>.csv files")

    for name, text in (("daily", "land one day"), ("monthly", "land one month")):
        land = job.add_parser(name, help=text)
        land.add_argument("--date", type=date.fromisoformat, required=True)
        if name == "daily":
            land.add_argument("--today", type=date.fromisoformat, default=None)
        land.add_argument("--ingestion-time", default=None, help="default: now")
        if name == "daily":
            land.add_argument("--window-days", type=int, default=WINDOW_DAYS)
            land.add_argument("--window-only", action="store_true", help="rebuild only the window")
        for feed in FEEDS:
            land.add_argument(f"--{feed.replace('_', '-')}", dest=feed, help="page files")

    exports = job.add_parser("exports", help="land one Parquet export per feed")
    for feed in FEEDS:
        exports.add_argument(f"--{feed.replace('_', '-')}", dest=feed, help="Parquet export")

    job.add_parser("catch-up", help="land all extracts that have not landed as they are now")

    job.add_parser("recluster", help="write the days again whose files overlap or are out of order")

    build = job.add_parser("run", help="transform landed readings")
    build.add_argument("--as-of", type=date.fromisoformat, required=True)
    build.add_argument("--mode", choices=MODES, default=FULL)
    build.add_argument("--window-days", type=int, default=WINDOW_DAYS)
    build.add_argument("--merge-days", type=int, default=None)
    build.add_argument("--window-only", action="store_true", help="rebuild only what a refresh changed")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"wattframe-{args.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    house = Warehouse(spark, args.root)
    given = {f: getattr(args, f) for f in FEEDS if getattr(args, f, None)}
    if args.job == "seeds":
        jobs.load_seeds(house, args.folder)
    elif args.job == "exports":
        jobs.exports(house, given)
    elif args.job == "catch-up":
        jobs.catch_up(house)
    elif args.job == "recluster":
        for feed in FEEDS.values():
            if exists(spark, house.path(feed.landing_table)):
                jobs.recluster(house, feed)
    elif args.job == "run":
        run(house, args.as_of, args.mode, args.window_days, args.merge_days, not args.window_only)
    else:
        stamp = args.ingestion_time or datetime.now(timezone.utc).replace(tzinfo=None)
        if args.job == "monthly":
            jobs.monthly(house, args.date, given, stamp)
        else:
            today = args.today or date.today()
            jobs.daily(
                house, args.date, today, given, stamp, args.window_days, not args.window_only
            )


if __name__ == "__main__":
    main()
