"""Static reference tables as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Seed tables and their columns. Flags are Yes/No text, dates M/d/yyyy text.
SEED_COLUMNS = {
    "balancing_authorities": (
        "ba_code",
        "ba_name",
        "time_zone",
        "region_or_country_code",
        "region_or_country_name",
        "generation_only_ba",
        "demand_by_ba_subregion",
        "us_ba",
        "active_ba",
        "activation_date",
        "retirement_date",
    ),
    "energy_sources": ("energy_source_code", "energy_source_name"),
    "regions": ("region_or_country_code", "region_or_country_name", "time_zone"),
    "ba_subregions": (
        "ba_code",
        "ba_name",
        "ba_subregion_code",
        "ba_subregion_name",
        "active_subregion",
        "activation_date",
        "retirement_date",
    ),
    "ba_connections": (
        "ba_code",
        "ba_name",
        "directly_interconnected_ba_code",
        "directly_interconnected_ba_name",
        "country_of_foreign_directly_interconnected_ba",
        "active_connection",
        "activation_date",
        "retirement_date",
    ),
}


def seed_schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in SEED_COLUMNS[name]])


def normalize_seed_columns(seed: DataFrame) -> DataFrame:
    """``Region/Country Code`` -> ``region_or_country_code``; dots go, blanks become ``_``."""
    return seed.toDF(
        *(
            "_".join(c.lower().replace("/", "_or_").replace(".", "").split())
            for c in seed.columns
        )
    )


def read_seed(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A seed with its declared columns, all text; an empty field is NULL."""
    return spark.read.schema(seed_schema(name)).csv(
        path, header=True, enforceSchema=False, escape='"', mode="FAILFAST"
    )


def write_seed(seed: DataFrame, path: str) -> None:
    normalize_seed_columns(seed).write.mode("overwrite").csv(path, header=True, escape='"')
