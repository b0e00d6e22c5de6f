"""The runs a scheduler calls: seeds, one day, one month, historical exports."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame

from wattframe.feeds import FEEDS, Feed
from wattframe.operators.increments import REFRESH, WINDOW_DAYS, mode_for
from wattframe.plans.build import run
from wattframe.plans.warehouse import Warehouse
from wattframe.sources.extracts import write_checked_extract
from wattframe.sources.files import exists
from wattframe.sources.landing import extract_path, extracts_folder, load_all, load_daily, load_exports
from wattframe.sources.layout import layout_report, recluster_days
from wattframe.sources.pages import read_pages
from wattframe.sources.seeds import SEED_COLUMNS, write_seed


def load_seeds(warehouse: Warehouse, folder: str, names=tuple(SEED_COLUMNS)) -> None:
    """Store ``<folder>/<seed>.csv`` files, with published or normalised headers, as seeds."""
    for name in names:
        raw = warehouse.spark.read.csv(f"{folder}/{name}.csv", header=True, escape='"')
        write_seed(raw, warehouse.path(name))


def ingest(
    warehouse: Warehouse,
    feed: Feed,
    pages: str,
    day: date,
    ingestion_time: datetime | str,
    monthly: bool = False,
    lines: bool = False,
) -> str | None:
    """Pages of one feed and day (or month) -> checked extract -> landing table.

    Returns the extract's path. An extract that declares no rows writes nothing. What lands is
    entered in the feed's ledger, so that :func:`catch_up` leaves it out.
    """
    spark = warehouse.spark
    path = extract_path(warehouse.root, feed, day, monthly)
    raw = read_pages(spark, pages, feed, lines)
    if not write_checked_extract(raw, feed, ingestion_time, path, warehouse.building("extracts")):
        return None
    load_daily(spark, path, feed, warehouse.path(feed.landing_table), warehouse.ledger(feed))
    return path


def catch_up(warehouse: Warehouse, feeds: Iterable[str] = tuple(FEEDS)) -> dict[str, int]:
    """Land all extracts of the feeds that have not landed as they are now, in one load a feed.

    Returns the number of files landed. A feed without extracts has none.
    """
    landed = {}
    for name in feeds:
        feed = FEEDS[name]
        folder = extracts_folder(warehouse.root, feed)
        landed[name] = 0
        if exists(warehouse.spark, folder):
            target = warehouse.path(feed.landing_table)
            landed[name] = load_all(warehouse.spark, [folder], feed, target, warehouse.ledger(feed))
    return landed


def recluster(warehouse: Warehouse, feed: Feed) -> list[date]:
    """Write the days of a feed's landing table again whose files overlap or are out of order.

    Returns the days; there are as many at most as the table has partitions.
    """
    path = warehouse.path(feed.landing_table)
    report = layout_report(warehouse.spark, path, feed)
    bad = report.where("misplaced > 0 OR overlapping > 0").select("partition_date")
    days = sorted(r["partition_date"] for r in bad.collect())
    recluster_days(warehouse.spark, path, feed, days)
    return days


def daily(
    warehouse: Warehouse,
    logical_date: date,
    today: date,
    pages: dict[str, str],
    ingestion_time: datetime | str,
    window_days: int = WINDOW_DAYS,
    rebuild_all: bool = True,
    lines: bool = False,
) -> dict[str, DataFrame] | None:
    """Land one day's pages, given per feed. Only a run dated today also transforms.

    ``rebuild_all=False`` rebuilds only what the window changed, see :func:`run`.
    """
    for name, path in pages.items():
        feed = FEEDS[name]
        day = logical_date - timedelta(days=feed.lag_days)
        ingest(warehouse, feed, path, day, ingestion_time, lines=lines)
    if mode_for(logical_date, today) == REFRESH:
        return run(warehouse, today, REFRESH, window_days, rebuild_all=rebuild_all)
    return None


def monthly(
    warehouse: Warehouse, month: date, pages: dict[str, str], ingestion_time: datetime | str
) -> None:
    """Land one month's pages, given per feed."""
    for name, path in pages.items():
        ingest(warehouse, FEEDS[name], path, month, ingestion_time, monthly=True)


def exports(warehouse: Warehouse, files: dict[str, str]) -> None:
    """Land one pre-exported Parquet file per feed."""
    landing = {name: warehouse.path(FEEDS[name].landing_table) for name in files}
    load_exports(warehouse.spark, files, FEEDS, landing)
