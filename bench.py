"""Wall-clock of the headline queries and of whole builds.

Prints one JSON line. ``BENCH_SF_DIR`` names the input, ``BENCH_CPUS`` the cores.
Every query runs once to warm up and is then timed on a second run into a sink that
discards rows. The builds write real tables below a fresh temporary folder.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from checks.queries import QUERIES
from checks.tables import balancing_authorities, energy_sources, history, landing
from wattframe.feeds import FEEDS
from wattframe.plans.build import build_marts, build_readings, run
from wattframe.plans.warehouse import Warehouse
from wattframe.session import local_session
from wattframe.sources.landing import append_landing
from wattframe.sources.seeds import SEED_COLUMNS, write_seed

HEADLINE = (
    "stg_generation",
    "int_generation",
    "int_generation_history",
    "dim_generation",
    "dim_interchange",
    "marts_generation",
    "marts_generation_history",
    "marts_interchange",
    "marts_forecast",
    "upsert_generation",
    "upsert_wide_window",
    "fuel_series_share",
    "flow_series",
    "page_ingest",
    "reconcile_counts",
    "page_index",
)
AS_OF = "2024-01-30"
#: Last days of the history.
LAST_DAY = "2001-10-01"


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def seeds(house: Warehouse, sf_dir: str) -> None:
    spark = house.spark
    columns = SEED_COLUMNS["balancing_authorities"]
    seed = balancing_authorities(spark, sf_dir)
    missing = {c: F.lit(None).cast("string") for c in columns if c not in seed.columns}
    write_seed(seed.withColumns(missing).select(*columns), house.path("balancing_authorities"))
    write_seed(energy_sources(spark, sf_dir), house.path("energy_sources"))


def land_feeds(house: Warehouse, sf_dir: str) -> None:
    """The four feeds, 30 days each."""
    for feed in FEEDS.values():
        rows = landing(house.spark, sf_dir, feed)
        append_landing(rows, feed, house.path(feed.landing_table))


def land_history(house: Warehouse, sf_dir: str) -> None:
    """The generation feed over about 2,400 days."""
    feed = FEEDS["generation"]
    append_landing(history(house.spark, sf_dir), feed, house.path(feed.landing_table))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session("bench", cores, "16g")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        for _ in range(2):
            seconds[name] = timed(
                lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            )
    root = tempfile.mkdtemp(prefix="bench-")
    house, old = Warehouse(spark, f"{root}/recent"), Warehouse(spark, f"{root}/history")
    for warehouse in (house, old):
        seeds(warehouse, sf_dir)
    generation = FEEDS["generation"]
    builds = {
        "land_feeds": lambda: land_feeds(house, sf_dir),
        "full_build": lambda: run(house, AS_OF),
        "refresh_build": lambda: run(house, AS_OF, "refresh", rebuild_all=False),
        "rebuild_marts": lambda: build_marts(house, AS_OF),
        "land_history": lambda: land_history(old, sf_dir),
        "full_readings_history": lambda: build_readings(old, generation, "full", LAST_DAY),
        "refresh_readings_history": lambda: build_readings(old, generation, "refresh", LAST_DAY),
    }
    for name, work in builds.items():
        seconds[name] = timed(work)
    print(
        json.dumps(
            {
                "metric": "total wall-clock of headline queries and builds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cores": cores,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
