"""Where the tables live, and their names as views."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.feeds import FEEDS, Feed
from wattframe.operators.dimensions import DIM_SCHEMAS, fuel_lookup
from wattframe.operators.staging import stage
from wattframe.sources import files
from wattframe.sources.landing import read_landing
from wattframe.sources.marts import MART_SCHEMAS
from wattframe.sources.seeds import SEED_COLUMNS, read_seed

#: Tables that builds write, with their columns.
BUILT: dict[str, T.StructType] = {
    **{feed.readings_table: feed.readings_schema for feed in FEEDS.values()},
    **DIM_SCHEMAS,
    **MART_SCHEMAS,
}
#: Bytes of a seed's files up to which it is broadcast. Seeds are plain text files, so this bounds
#: what is sent: a row's columns, and some tens of bytes for it.
SEED_BROADCAST_BYTES = 8 * 1024 * 1024


@dataclass(frozen=True)
class Warehouse:
    """A root folder (shared storage on a cluster) with one folder per table."""

    spark: SparkSession
    root: str

    def _below(self, *names: str) -> str:
        return "/".join([self.root.rstrip("/"), *names])

    def path(self, table: str) -> str:
        layer = "seeds" if table in SEED_COLUMNS else table.split("_", 1)[0]
        return self._below(layer, table)

    def ledger(self, feed: Feed) -> str:
        """Where the feed's landed extracts are entered."""
        return self._below("ledger", feed.name)

    def building(self, table: str) -> str:
        """Where a table stands until it is complete."""
        return self._below("building", table)

    def _aside(self, table: str) -> str:
        """Where a table stands while the one that replaces it is put in its place."""
        return self._below("replaced", table)

    def landing(self, feed: Feed) -> DataFrame:
        return read_landing(self.spark, self.path(feed.landing_table), feed)

    def small_seed(self, name: str) -> bool:
        """Whether a seed's files are small enough to broadcast it. Asks the store, starts no job."""
        return files.size(self.spark, self.path(name)) <= SEED_BROADCAST_BYTES

    def seed(self, name: str) -> DataFrame:
        """A seed, with a broadcast hint if it is a small one."""
        seed = read_seed(self.spark, name, self.path(name))
        return F.broadcast(seed) if self.small_seed(name) else seed

    def fuels(self) -> DataFrame:
        return fuel_lookup(self.seed("energy_sources"))

    def _open(self, table: str) -> DataFrame | None:
        schema = BUILT.get(table)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        for place in (self.path(table), self._aside(table)):
            if files.exists(self.spark, place):
                found = reader.parquet(place)
                # a partition column comes last from the files
                return found if schema is None else found.select(schema.names)
        return None

    def has(self, table: str) -> bool:
        return self._open(table) is not None

    def readings(self, feed: Feed) -> DataFrame | None:
        """The feed's de-duplicated table, or None before its first build."""
        return self._open(feed.readings_table)

    def table(self, name: str) -> DataFrame:
        """A built table with its declared columns, published under its name."""
        built = self._open(name)
        if built is None:
            raise FileNotFoundError(self.path(name))
        built.createOrReplaceTempView(name)
        return built

    def fingerprint(self, name: str) -> tuple:
        """What a built table consists of now."""
        return files.fingerprint(self.spark, self.path(name))

    def rebuild(self, name: str, write: Callable[[str], None]) -> None:
        """Full rebuild of a table: ``write`` is given a new folder, which takes the table's place
        when it is complete. Until then, and if it fails, the table stays as it is."""
        path, fresh, aside = self.path(name), self.building(name), self._aside(name)
        files.mend(self.spark, path, aside)
        files.remove(self.spark, fresh)
        write(fresh)
        files.switch(self.spark, fresh, path, aside)

    def replace(self, name: str, rows: DataFrame) -> DataFrame:
        """Full rebuild of a table from ``rows``."""
        self.rebuild(name, lambda folder: rows.write.parquet(folder))
        return self.table(name)

    def publish(self) -> list[str]:
        """Views of all tables built so far, for a session that only reads them."""
        names = [t for t in BUILT if self.has(t)]
        for name in names:
            self.table(name)
        return names

    def register_views(self) -> dict[str, DataFrame]:
        """Landing and staging views and the fuel lookup, lazily, under their names.

        Returns the staged feeds. Opening a partitioned table lists its folders, so a run
        opens each landing table here, once.
        """
        staged = {}
        for feed in FEEDS.values():
            landing = self.landing(feed)
            landing.createOrReplaceTempView(feed.landing_table)
            staged[feed.name] = stage(landing, feed)
            staged[feed.name].createOrReplaceTempView(feed.staging_view)
        self.fuels().createOrReplaceTempView("fuel_lookup")
        return staged
