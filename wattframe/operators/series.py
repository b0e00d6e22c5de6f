"""Series a dashboard draws from the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions.grid import at_hour, date_from_text, flow_label, short_country

# Fuels shown before a choice is made.
DEFAULT_FUELS = ("Solar", "Petroleum", "Natural gas", "Nuclear", "Wind", "Coal")


def fuel_series_absolute(mart: DataFrame, fuels: Sequence[str] = DEFAULT_FUELS) -> DataFrame:
    """Chosen fuels' generation in millions."""
    return (
        mart.where(F.col("fuel").isin(*fuels))
        .withColumn("value", F.col("total_generation").cast("double") / 1_000_000)
        .withColumnsRenamed({"fuel": "Fuel", "year": "Year"})
    )


def fuel_series_share(mart: DataFrame, fuels: Sequence[str] = DEFAULT_FUELS) -> DataFrame:
    """Chosen fuels' share of the year, in percent of the chosen fuels' total.

    A year whose total is zero, or an unknown year, has no share (NULL). The mart holds
    one row per year, fuel and energy type, so a year's window is a few rows per
    chosen fuel, and the mart is computed once.
    """
    in_year = F.sum("total_generation").over(Window.partitionBy("year")).cast("double")
    share = F.try_divide(F.col("total_generation").cast("double"), in_year) * 100
    return (
        mart.where(F.col("fuel").isin(*fuels))
        .withColumn("value", F.when(F.col("year").isNotNull(), share))
        .withColumnsRenamed({"fuel": "Fuel", "year": "Year"})
    )


def energy_mix(mart: DataFrame) -> DataFrame:
    """Renewable and non-renewable totals by year, in display order.

    Rows of an unknown year are left out; a total of unknown measures only is 0."""
    none = F.lit(0).cast(mart.schema["total_generation"].dataType)
    total = F.sum(F.coalesce("total_generation", none))
    return (
        mart.where(F.col("year").isNotNull())
        .groupBy("year", "energy_type")
        .agg(total.alias("total_generation"))
        .orderBy("year", "energy_type")
    )


def demand_series(mart: DataFrame) -> DataFrame:
    """Forecast mart with an hourly zone-less timestamp."""
    day = date_from_text(F.col("recorded_date"))
    if dict(mart.dtypes)["recorded_date"] == "date":
        day = F.col("recorded_date")
    return mart.withColumn("recorded_date", day).withColumn(
        "datetime", at_hour(F.col("recorded_date"), F.col("recorded_hour"))
    )


def labelled_flows(mart: DataFrame) -> DataFrame:
    """Interchange mart with short country names and a ``provider → recipient`` label."""
    return mart.withColumns(
        {
            "provider_country": short_country(F.col("provider_country")),
            "recipient_country": short_country(F.col("recipient_country")),
        }
    ).withColumn("flow", flow_label(F.col("provider_country"), F.col("recipient_country")))


def flow_series(mart: DataFrame, flows: Sequence[str]) -> DataFrame:
    """Labelled flows, restricted to the chosen labels."""
    return labelled_flows(mart).where(F.col("flow").isin(*flows))


def distinct_fuels(mart: DataFrame) -> DataFrame:
    return mart.select("fuel").distinct().orderBy("fuel")


def distinct_flows(mart: DataFrame) -> DataFrame:
    """Every pair that occurs, as a sorted list of labels."""
    return labelled_flows(mart).select("flow").distinct().orderBy("flow")


def default_flows(mart: DataFrame, n: int = 2) -> DataFrame:
    """The first flows of the sorted list, as an initial selection."""
    return distinct_flows(mart).limit(n)
