"""Marts kept in the session's cache while their tables stay as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wattframe.plans.warehouse import Warehouse
from wattframe.sources.marts import coerce_mart


class MartCache:
    """Marts as a dashboard reads them. A table that has not been rebuilt is read once; the first
    read after a rebuild sees the new rows. Whether it was rebuilt is asked of the store on every
    read, which starts no job and opens no file."""

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse
        self.kept: dict[str, tuple[tuple, DataFrame]] = {}

    def get(self, name: str) -> DataFrame:
        now = self.warehouse.fingerprint(name)
        before = self.kept.get(name)
        if before is not None:
            if before[0] == now:
                return before[1]
            before[1].unpersist()
        mart = coerce_mart(self.warehouse.table(name)).cache()
        self.kept[name] = now, mart
        return mart

    def clear(self) -> None:
        for _, mart in self.kept.values():
            mart.unpersist()
        self.kept.clear()
