"""Which staged rows an incremental run takes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.functions.grid import as_date

FULL, REFRESH, BACKFILL = "full", "refresh", "backfill"
MODES = (FULL, REFRESH, BACKFILL)

#: Look-back, in days, of a refresh and of the merge.
WINDOW_DAYS = 7


def mode_for(run_date: date, today: date) -> str:
    """A run dated today refreshes the look-back window; any other run backfills."""
    return REFRESH if run_date == today else BACKFILL


def within_window(as_of: date | str | None = None, window_days: int = WINDOW_DAYS) -> Column:
    return F.col("recorded_date") >= F.date_sub(as_date(as_of), window_days)


def high_water_mark(target: DataFrame) -> DataFrame:
    """One row: the newest date already in the target (NULL when it is empty)."""
    return target.agg(F.max("recorded_date").alias("high_water_mark"))


def beyond_high_water_mark(target: DataFrame) -> Column:
    """Rows newer than anything in the target; no row at all when the target is empty.

    The mark is a scalar subquery, so it is computed once inside the query and prunes
    the date partitions of the scan at run time.
    """
    return F.col("recorded_date") > high_water_mark(target).scalar()


def incoming(
    staged: DataFrame,
    mode: str,
    *,
    as_of: date | str | None = None,
    window_days: int = WINDOW_DAYS,
    target: DataFrame | None = None,
) -> DataFrame:
    """Staged rows selected by ``mode``. The mode is chosen here, not in the query, so
    the plan carries a single predicate that can reach the partition filter."""
    if mode == FULL:
        return staged
    if mode == REFRESH:
        if as_of is None:
            raise ValueError("a refresh needs as_of")
        return staged.where(within_window(as_of, window_days))
    if mode == BACKFILL:
        if target is None:
            raise ValueError("a backfill needs its target")
        return staged.where(beyond_high_water_mark(target))
    raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
