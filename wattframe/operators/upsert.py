"""Keyed upsert with a bounded look-back."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.feeds import Feed
from wattframe.functions.grid import as_date
from wattframe.operators.increments import WINDOW_DAYS


def upsert(
    target: DataFrame,
    source: DataFrame,
    feed: Feed,
    as_of: date | str,
    merge_days: int = WINDOW_DAYS,
) -> DataFrame:
    """Target after merging ``source``: matched rows take the source's columns, unmatched
    source rows are added, all other target rows stay.

    Only target rows dated within ``merge_days`` before ``as_of`` can match; an older
    source row is added even if its key exists. Keep the source's window within
    ``merge_days`` unless that is wanted.

    One full outer join. The source comes from :func:`latest_readings`, which leaves it
    hash-partitioned on this very key, so only the target is exchanged here, and
    both sides hold one row per key, so no join partition can be hot.
    """
    lower = F.date_sub(as_date(as_of), merge_days)
    t, s = target.alias("t"), source.alias("s")
    same_key = reduce(and_, (F.col(f"t.{k}") == F.col(f"s.{k}") for k in feed.key))
    from_source = F.col("s.recorded_date").isNotNull()
    merged = t.join(s, same_key & (F.col("t.recorded_date") >= lower), "full_outer")
    return merged.select(
        *(
            F.when(from_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            for c in feed.reading_columns
        )
    )
