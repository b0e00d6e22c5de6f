"""Landing -> staging: rename, type, drop unusable rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.feeds import MEASURE, Feed
from wattframe.functions.grid import hour_of_period


def usable(feed: Feed) -> Column:
    """All required columns are present.

    Written as plain ``IS NOT NULL`` terms because those reach the Parquet reader as
    pushed filters, which ``dropna`` does not.
    """
    return reduce(and_, (F.col(c).isNotNull() for c in feed.required))


def stage(landing: DataFrame, feed: Feed) -> DataFrame:
    """Typed readings of one feed. Ids are upper-cased, display names kept as they are."""
    measure = F.col("value").cast(MEASURE)
    if feed.zero_fill:
        measure = F.coalesce(measure, F.lit(0).cast(MEASURE))
    entities = [
        column
        for p in feed.parties
        for column in (
            F.col(p.raw_name).cast("string").alias(p.name),
            F.upper(F.col(p.raw_id).cast("string")).alias(p.id),
        )
    ]
    return landing.where(usable(feed)).select(
        F.col("partition_date").cast("date").alias("recorded_date"),
        hour_of_period(F.col("period")).alias("recorded_hour"),
        *entities,
        measure.alias("num_units"),
        F.col("value_units").cast("string").alias("unit"),
        F.col("ingestion_time").cast("timestamp").alias("ingestion_time"),
    )
