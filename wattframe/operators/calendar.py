"""Which extract to pull for which run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.feeds import FEEDS
from wattframe.operators.increments import WINDOW_DAYS

DAILY, REFRESH, MONTHLY = "daily", "refresh", "monthly"


def _first_hour(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd'T'00")


def _last_hour(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd'T'23")


def ingest_windows(
    runs: DataFrame, kind: str, *, window_days: int = WINDOW_DAYS, base_url: str = ""
) -> DataFrame:
    """One row per run (column ``logical_date``) and feed: period range and object path.

    * ``daily``: the day before the run; the forecast feed takes the run's own day.
    * ``refresh``: as daily, starting ``window_days`` earlier.
    * ``monthly``: from the run's day to the end of its month.

    The feeds are an array exploded on every row, so no join is involved.
    """
    feeds = F.array(
        *(
            F.struct(F.lit(f.name).alias("feed"), F.lit(f.route).alias("route"), F.lit(f.lag_days).alias("lag"))
            for f in FEEDS.values()
        )
    )
    logical = F.col("logical_date")
    if kind == MONTHLY:
        day, start, end = logical, logical, F.last_day(logical)
        folder, file = "yyyy", "MM'.parquet'"
    elif kind in (DAILY, REFRESH):
        day = F.date_sub(logical, F.col("f.lag"))
        start = F.date_sub(day, window_days) if kind == REFRESH else day
        end = day
        folder, file = "yyyy/MM", "dd'.parquet'"
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return runs.select("logical_date", F.explode(feeds).alias("f")).select(
        "logical_date",
        F.col("f.feed").alias("feed"),
        F.concat(F.lit(base_url), F.col("f.route"), F.lit("/data/")).alias("url"),
        day.alias("run_date"),
        F.concat(F.lit("api/"), F.col("f.feed"), F.date_format(day, "'/'yyyy'/'MM'/'")).alias("directory"),
        F.concat(
            F.lit("api/"), F.col("f.feed"), F.lit("/"), F.date_format(day, f"{folder}/{file}")
        ).alias("object_path"),
        _first_hour(start).alias("start_date"),
        _last_hour(end).alias("end_date"),
    )
