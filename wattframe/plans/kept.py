"""The marts' totals as tables, and their change from one state to the next.

A state of a mart's totals is a folder, ``version=<n>``; it counts once Spark has marked it
complete, so writing the next one is one step that happens or doesn't. What a refresh takes off is
stored before any reading is rewritten, together with the version it is taken off from. A run that
is broken off is made good by the next one: it finds what was to be taken off, and takes the new rows
from the tables as they are by then.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.operators.marts import MART_KEYS, MART_MEASURE
from wattframe.operators.totals import KEPT, apply_change, shown, totals
from wattframe.plans.warehouse import Warehouse
from wattframe.sources import files
from wattframe.sources.marts import MART_SCHEMAS

#: Lines of a mart dated within [from, to); an open end is None.
Lines = Callable[[date | None, date | None], DataFrame]


@dataclass(frozen=True)
class KeptMart:
    """A mart and the totals it is shown from."""

    warehouse: Warehouse
    name: str

    @property
    def keys(self) -> tuple[str, ...]:
        return MART_KEYS[self.name]

    @property
    def _schema(self) -> T.StructType:
        kinds = MART_SCHEMAS[self.name]
        return T.StructType([*(kinds[k] for k in self.keys), *KEPT])

    def _folder(self, *names: str) -> str:
        return "/".join([self.warehouse.root.rstrip("/"), "totals", self.name, *names])

    def _complete(self, prefix: str) -> list[str]:
        """Names of the folders with ``prefix`` that Spark has finished, the newest last."""
        spark = self.warehouse.spark
        names = [n for n in files.names(spark, self._folder()) if n.startswith(prefix)]
        whole = [n for n in names if files.exists(spark, self._folder(n, "_SUCCESS"))]
        return sorted(whole, key=lambda n: int(n.removeprefix(prefix).split(",")[0]))

    def _read(self, name: str) -> DataFrame:
        return self.warehouse.spark.read.schema(self._schema).parquet(self._folder(name))

    def state(self) -> tuple[int, date | None] | None:
        """The newest state and the first day it holds (None: it holds all); None without a state."""
        whole = self._complete("version=")
        if not whole:
            return None
        number, _, first = whole[-1].removeprefix("version=").partition(",from=")
        return int(number), date.fromisoformat(first) if first else None

    def _name(self, number: int, first: date | None) -> str:
        return f"version={number}" + (f",from={first}" if first else "")

    def _store(self, kept: DataFrame, number: int, first: date | None) -> DataFrame:
        """Store a state, show it as the mart, and remove what is behind it."""
        spark = self.warehouse.spark
        kept.write.mode("overwrite").parquet(self._folder(self._name(number, first)))
        mart = shown(self._read(self._name(number, first)), self.keys, MART_MEASURE[self.name])
        published = self.warehouse.replace(self.name, mart)
        for name in files.names(spark, self._folder()):
            # the state before this one stays for those who read it
            if int(name.partition("=")[2].split(",")[0]) < number - (name.startswith("version=")):
                files.remove(spark, self._folder(name))
        return published

    def build(self, lines: Lines, first: date | None = None) -> DataFrame:
        """The mart of all lines from ``first`` on, computed whole."""
        state = self.state()
        number = 0 if state is None else state[0] + 1
        kept = totals(lines(first, None), self.keys, MART_MEASURE[self.name])
        return self._store(kept, number, first)

    def take_off(self, lines: Lines, since: date) -> date:
        """Store what the lines from ``since`` on add to the present state. To be called before
        they change; returns the day from which they are to be added again.

        If a run was broken off after this, its lines may have changed already. What it stored
        stays, and days before its own are added to it.
        """
        number, first = self.state()
        since = max(since, first) if first else since
        prefix = f"taken={number},since="
        taken = [n for n in files.names(self.warehouse.spark, self._folder()) if n.startswith(prefix)]
        taken = [
            n for n in taken if files.exists(self.warehouse.spark, self._folder(n, "_SUCCESS"))
        ]
        # the one that reaches farthest back holds all the others
        before = min((date.fromisoformat(n.removeprefix(prefix)) for n in taken), default=None)
        if before is not None and before <= since:
            return before
        off = totals(lines(since, before), self.keys, MART_MEASURE[self.name])
        if before is not None:
            earlier = self._read(f"{prefix}{before}")
            none = earlier.where(F.lit(False))
            off = apply_change(off, none, earlier, self.keys)
        off.write.mode("overwrite").parquet(self._folder(f"{prefix}{since}"))
        return since

    def add(self, lines: Lines, since: date, first: date | None = None) -> DataFrame:
        """The mart after what was taken off is replaced by the lines from ``since`` on. Lines
        before ``first`` go."""
        number, held = self.state()
        added = totals(lines(since, None), self.keys, MART_MEASURE[self.name])
        kept = apply_change(
            self._read(self._name(number, held)),
            self._read(f"taken={number},since={since}"),
            added,
            self.keys,
        )
        if first:
            kept = kept.where(F.col("recorded_date") >= F.lit(first))
        return self._store(kept, number + 1, first)
