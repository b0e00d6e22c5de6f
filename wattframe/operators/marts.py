"""Analytics tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.functions.grid import DEMAND_LABELS, as_date, demand_label

#: Days of history in the forecast mart.
FORECAST_DAYS = 30


#: The columns each mart's sums are by, and the sum.
MART_KEYS = {
    "marts_generation": ("year", "fuel", "energy_type"),
    "marts_interchange": ("recorded_date", "provider_country", "recipient_country"),
    "marts_forecast": ("recorded_date", "recorded_hour", "demand_type"),
}
MART_MEASURE = {
    "marts_generation": "total_generation",
    "marts_interchange": "interchange",
    "marts_forecast": "value",
}


def _summed(lines: DataFrame, mart: str) -> DataFrame:
    measure = MART_MEASURE[mart]
    return lines.groupBy(*MART_KEYS[mart]).agg(F.sum(measure).alias(measure))


def generation_lines(generation: DataFrame) -> DataFrame:
    """Generation with the keys of its mart."""
    return generation.select(
        F.year("recorded_date").cast("bigint").alias("year"),
        "fuel",
        "energy_type",
        F.col("num_units").alias("total_generation"),
    )


def marts_generation(generation: DataFrame) -> DataFrame:
    """Generation by year, fuel and energy type."""
    return _summed(generation_lines(generation), "marts_generation")


def by_fuel_and_size(mart: DataFrame) -> DataFrame:
    """Reading order of the generation mart. Files keep no order, so it is set on read."""
    return mart.orderBy("fuel", F.col("total_generation").desc_nulls_last())


def interchange_lines(interchange: DataFrame) -> DataFrame:
    """Flow between different countries; a flow with an unknown country is left out."""
    return interchange.where(F.col("provider_country") != F.col("recipient_country")).select(
        *MART_KEYS["marts_interchange"], "interchange"
    )


def marts_interchange(interchange: DataFrame) -> DataFrame:
    """Daily flow between different countries."""
    return _summed(interchange_lines(interchange), "marts_interchange")


def trailing(as_of: date | str | None = None, days: int = FORECAST_DAYS) -> Column:
    return F.col("recorded_date") >= F.date_sub(as_date(as_of), days)


def forecast_lines(
    readings: DataFrame,
    as_of: date | str | None = None,
    days: int = FORECAST_DAYS,
    respondents: DataFrame | None = None,
) -> DataFrame:
    """Readings of the kept demand types over the trailing ``days``, with their labels."""
    kept = readings.where(F.col("demand_type_id").isin(*DEMAND_LABELS) & trailing(as_of, days))
    if respondents is not None:
        wanted = respondents.select("respondent_id").distinct()
        kept = kept.join(wanted, "respondent_id", "left_semi")
    return kept.select(
        "recorded_date",
        "recorded_hour",
        demand_label(F.col("demand_type_id")).alias("demand_type"),
        F.col("num_units").alias("value"),
    )


def marts_forecast(
    readings: DataFrame,
    as_of: date | str | None = None,
    days: int = FORECAST_DAYS,
    respondents: DataFrame | None = None,
) -> DataFrame:
    """Hourly demand, forecast and net generation over the trailing ``days``.

    Sums every respondent. Pass ``respondents`` (a ``respondent_id`` column) to leave
    out others, such as roll-up regions that would be counted twice.
    """
    return _summed(forecast_lines(readings, as_of, days, respondents), "marts_forecast")
