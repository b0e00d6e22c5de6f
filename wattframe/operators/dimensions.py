"""Reference data and dimension joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.feeds import MEASURE
from wattframe.functions.grid import country_of_flag, country_of_region, energy_class

#: A dimension is broadcast only when it is proven to stay within both bounds.
BROADCAST_MAX_ROWS = 100_000
BROADCAST_MAX_BYTES = 32 * 1024 * 1024


def fits_broadcast(
    dimension: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> bool:
    """Whether the measured size is within the bounds.

    Runs one small job that reads at most ``max_rows + 1`` rows.
    """
    size = (
        dimension.limit(max_rows + 1)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("n_bytes"),
        )
        .first()
    )
    return size["n_rows"] <= max_rows and (size["n_bytes"] or 0) <= max_bytes


def bounded_broadcast(
    dimension: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """``dimension`` with a broadcast hint if its measured size allows one.

    A larger dimension is returned without a hint: the join is then a shuffle join, in
    which adaptive execution splits the partitions of hot keys.
    """
    return F.broadcast(dimension) if fits_broadcast(dimension, max_rows, max_bytes) else dimension


DIM_SCHEMAS = {
    "dim_generation": T.StructType(
        [
            T.StructField("recorded_date", T.DateType()),
            T.StructField("recorded_hour", T.LongType()),
            T.StructField("ba", T.StringType()),
            T.StructField("name", T.StringType()),
            T.StructField("fuel", T.StringType()),
            T.StructField("num_units", MEASURE),
            T.StructField("energy_type", T.StringType()),
            T.StructField("region_or_country_code", T.StringType()),
            T.StructField("country", T.StringType()),
        ]
    ),
    "dim_interchange": T.StructType(
        [
            T.StructField("recorded_date", T.DateType()),
            T.StructField("provider_id", T.StringType()),
            T.StructField("provider_name", T.StringType()),
            T.StructField("provider_country", T.StringType()),
            T.StructField("recipient_id", T.StringType()),
            T.StructField("recipient_name", T.StringType()),
            T.StructField("recipient_country", T.StringType()),
            T.StructField("interchange", MEASURE),
        ]
    ),
}


def fuel_lookup(energy_sources: DataFrame) -> DataFrame:
    return energy_sources.select(
        F.col("energy_source_code").alias("fuel_id"),
        F.col("energy_source_name").alias("fuel"),
        energy_class(F.col("energy_source_name")).alias("energy_type"),
    )


def dim_generation(readings: DataFrame, fuels: DataFrame, authorities: DataFrame) -> DataFrame:
    """Generation readings with fuel and authority attributes.

    Inner joins: readings of an unknown fuel or authority are dropped. No job measures the
    dimensions: one that its owner knows to be small comes with a broadcast hint, others are
    planned by the sizes of their files, and joined by shuffle where these are large.
    """
    authority = authorities.select(
        F.col("ba_code").alias("ba"),
        F.col("ba_name").alias("name"),
        "region_or_country_code",
        country_of_region(F.col("region_or_country_name")).alias("country"),
    )
    return (
        readings.withColumnRenamed("respondent_id", "ba")
        .join(fuels, "fuel_id")
        .join(authority, "ba")
        .select(
            "recorded_date",
            "recorded_hour",
            "ba",
            "name",
            "fuel",
            "num_units",
            "energy_type",
            "region_or_country_code",
            "country",
        )
    )


def dim_interchange(readings: DataFrame, authorities: DataFrame) -> DataFrame:
    """Interchange readings with both authorities' names and countries.

    The same slim authority table plays both roles, so one broadcast serves both joins.
    """
    authority = authorities.select(
        "ba_code",
        "ba_name",
        country_of_flag(F.col("us_ba"), F.col("region_or_country_name")).alias("country"),
    )
    provider, recipient = authority.alias("provider"), authority.alias("recipient")
    return (
        readings.join(provider, F.col("provider_id") == F.col("provider.ba_code"))
        .join(recipient, F.col("recipient_id") == F.col("recipient.ba_code"))
        .select(
            "recorded_date",
            "provider_id",
            F.col("provider.ba_name").alias("provider_name"),
            F.col("provider.country").alias("provider_country"),
            "recipient_id",
            F.col("recipient.ba_name").alias("recipient_name"),
            F.col("recipient.country").alias("recipient_country"),
            F.col("num_units").alias("interchange"),
        )
    )
