"""Full and incremental builds."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.feeds import FEEDS, Feed
from wattframe.functions.grid import as_date
from wattframe.operators.dimensions import dim_generation, dim_interchange
from wattframe.operators.increments import FULL, MODES, REFRESH, WINDOW_DAYS, incoming
from wattframe.operators.latest import latest_readings
from wattframe.operators.marts import (
    FORECAST_DAYS,
    forecast_lines,
    generation_lines,
    interchange_lines,
)
from wattframe.operators.staging import stage
from wattframe.operators.upsert import upsert
from wattframe.plans.kept import KeptMart, Lines
from wattframe.plans.warehouse import Warehouse
from wattframe.sources.landing import write_days

T = TypeVar("T")


def _together(spark: SparkSession, works: Sequence[Callable[[], T]]) -> list[T]:
    """Independent builds at the same time, so that one's last tasks overlap the next's
    first. The first error is raised after all have ended."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(works)) as pool:
        started = [pool.submit(inherit(work)) for work in works]
    return [work.result() for work in started]


def build_readings(
    warehouse: Warehouse,
    feed: Feed,
    mode: str,
    as_of: date | str,
    window_days: int = WINDOW_DAYS,
    merge_days: int | None = None,
    staged: DataFrame | None = None,
) -> str:
    """Bring the feed's de-duplicated table up to date; returns the mode that was run.

    * ``full`` replaces the table once the new one is complete. A table that does not exist
      or is empty is always built in full.
    * ``refresh`` merges the look-back window. Only days inside it are read from the
      table and rewritten; a day without rows in the result is left as it is.
    * ``backfill`` adds days newer than the table's newest. No stored day is touched.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    merge_days = window_days if merge_days is None else merge_days
    target = warehouse.readings(feed)
    if target is None or target.isEmpty():
        mode = FULL
    if staged is None:
        staged = stage(warehouse.landing(feed), feed)
    taken = incoming(staged, mode, as_of=as_of, window_days=window_days, target=target)
    rows = latest_readings(taken, feed)
    if mode == REFRESH:
        lookback = max(window_days, merge_days)
        recent = target.where(F.col("recorded_date") >= F.date_sub(as_date(as_of), lookback))
        rows = upsert(recent, rows, feed, as_of, merge_days)

    store = partial(write_days, rows, day="recorded_date", cluster_by=feed.cluster_by)
    if mode == FULL:
        warehouse.rebuild(feed.readings_table, partial(store, mode="append"))
    else:
        store(warehouse.path(feed.readings_table), mode="overwrite")
    return mode


def build_dimensions(
    warehouse: Warehouse, since: date | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rebuild ``dim_generation`` and ``dim_interchange``, whole or from a day on.

    A row depends on one reading and the seeds only, so rebuilding the days from
    ``since`` is exact as long as the seeds have not changed. Nothing is measured here:
    whether a seed is broadcast is known from the size of its files.
    """

    def readings(name: str) -> DataFrame:
        rows = warehouse.readings(FEEDS[name])
        return rows if since is None else rows.where(F.col("recorded_date") >= F.lit(since))

    authorities, fuels = warehouse.seed("balancing_authorities"), warehouse.fuels()
    generation = dim_generation(readings("generation"), fuels, authorities)
    interchange = dim_interchange(readings("interchange"), authorities)
    # broadcast joins leave the rows in the tasks that scanned their days
    shuffled = not all(map(warehouse.small_seed, ("balancing_authorities", "energy_sources")))

    def store(name: str, rows: DataFrame, cluster_by: tuple[str, str]) -> None:
        write = partial(
            write_days, rows, day="recorded_date", cluster_by=cluster_by, rebalance=shuffled
        )
        if since is None:
            warehouse.rebuild(name, partial(write, mode="append"))
        else:
            write(warehouse.path(name), mode="overwrite")

    _together(
        warehouse.spark,
        [
            partial(store, "dim_generation", generation, ("ba", "fuel")),
            partial(store, "dim_interchange", interchange, ("provider_id", "recipient_id")),
        ],
    )
    return warehouse.table("dim_generation"), warehouse.table("dim_interchange")


def _mart_lines(warehouse: Warehouse, as_of: date | str) -> dict[str, Lines]:
    """The lines of each mart, from the tables as they are when they are asked for."""

    def dated(table: str, make: Callable[[DataFrame], DataFrame]) -> Lines:
        def lines(since: date | None, until: date | None) -> DataFrame:
            rows = warehouse.table(table)
            if since is not None:
                rows = rows.where(F.col("recorded_date") >= F.lit(since))
            if until is not None:
                rows = rows.where(F.col("recorded_date") < F.lit(until))
            return make(rows)

        return lines

    forecast = FEEDS["demand_forecast"].readings_table
    # the first day is the caller's, so that what is taken off is what was added
    no_horizon = partial(forecast_lines, as_of="0001-01-31")
    return {
        "marts_generation": dated("dim_generation", generation_lines),
        "marts_interchange": dated("dim_interchange", interchange_lines),
        "marts_forecast": dated(forecast, no_horizon),
    }


def _first_days(as_of: date | str) -> dict[str, date | None]:
    """The first day each mart holds."""
    trailing = date.fromisoformat(str(as_of)) - timedelta(days=FORECAST_DAYS)
    return {"marts_generation": None, "marts_interchange": None, "marts_forecast": trailing}


def build_marts(warehouse: Warehouse, as_of: date | str) -> dict[str, DataFrame]:
    """Rebuild the dimension tables and the three marts from the de-duplicated tables."""
    build_dimensions(warehouse)
    lines, first = _mart_lines(warehouse, as_of), _first_days(as_of)
    works = {n: partial(KeptMart(warehouse, n).build, lines[n], first[n]) for n in lines}
    return dict(zip(works, _together(warehouse.spark, list(works.values()))))


def can_follow(warehouse: Warehouse, as_of: date | str) -> bool:
    """Whether the dimension tables and marts are there to be changed by a window only."""
    if not (warehouse.has("dim_generation") and warehouse.has("dim_interchange")):
        return False
    for name, first in _first_days(as_of).items():
        state = KeptMart(warehouse, name).state()
        # a mart that starts later than wanted lacks days
        if state is None or (state[1] is not None and state[1] > first):
            return False
    return True


def take_off_window(warehouse: Warehouse, as_of: date | str, since: date) -> dict[str, date]:
    """Before readings change: store what each mart has from the days from ``since`` on."""
    lines = _mart_lines(warehouse, as_of)
    works = {n: partial(KeptMart(warehouse, n).take_off, lines[n], since) for n in lines}
    return dict(zip(works, _together(warehouse.spark, list(works.values()))))


def follow_window(
    warehouse: Warehouse, as_of: date | str, since: dict[str, date]
) -> dict[str, DataFrame]:
    """After readings have changed: rewrite the window's dimension days and change the marts by
    the difference. Neither reads an older day."""
    build_dimensions(warehouse, min(since.values()))
    lines, first = _mart_lines(warehouse, as_of), _first_days(as_of)
    works = {n: partial(KeptMart(warehouse, n).add, lines[n], since[n], first[n]) for n in lines}
    return dict(zip(works, _together(warehouse.spark, list(works.values()))))


def run(
    warehouse: Warehouse,
    as_of: date | str,
    mode: str = FULL,
    window_days: int = WINDOW_DAYS,
    merge_days: int | None = None,
    rebuild_all: bool = True,
) -> dict[str, DataFrame]:
    """One transformation run: staging views, readings of the four feeds, dims, marts.

    Dims and marts are rebuilt whole. With ``rebuild_all=False`` a refresh changes only
    what its window can have changed: the window's dimension days, and the marts by the
    difference between the window's rows before and after. Use that only while the seeds stay
    the same. A run that was broken off is made good by the next refresh or rebuild.
    """
    staged = warehouse.register_views()
    since = None
    if mode == REFRESH and not rebuild_all and can_follow(warehouse, as_of):
        begin = date.fromisoformat(str(as_of)) - timedelta(days=window_days)
        since = take_off_window(warehouse, as_of, begin)
    done = _together(
        warehouse.spark,
        [
            partial(build_readings, warehouse, feed, mode, as_of, window_days, merge_days, staged[name])
            for name, feed in FEEDS.items()
        ],
    )
    if since is not None and set(done) == {REFRESH}:
        return follow_window(warehouse, as_of, since)
    return build_marts(warehouse, as_of)
