"""Domain column expressions: periods, countries, energy classes, labels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fuels counted as renewable; every other fuel is non-renewable.
RENEWABLE_FUELS = (
    "Wind",
    "Solar",
    "Hydro and pumped storage",
    "Geothermal",
    "Wind with integrated battery storage",
    "Solar with integrated battery storage",
    "Battery storage",
    "Pumped storage",
    "Nuclear",
)

# Demand type codes kept in the forecast mart, with their labels.
DEMAND_LABELS = {
    "DF": "Demand Forecast",
    "D": "Actual Demand",
    "NG": "Net Generation",
}

# Country names.
USA = "United States of America"
USA_SHORT = "USA"
FOREIGN_REGIONS = ("Canada", "Mexico")


def as_date(day: date | str | Column | None) -> Column:
    """A run date given as a literal or an expression, always typed DATE.

    None stands for the current date; give a date where reruns must agree.
    """
    if day is None:
        return F.current_date()
    return (day if isinstance(day, Column) else F.lit(str(day))).cast("date")


def day_of_period(period: Column) -> Column:
    """``2024-01-31T05`` -> DATE. The text is cut, never read as a zoned timestamp."""
    return F.to_date(F.substring(period, 1, 10), "yyyy-MM-dd")


def hour_of_period(period: Column) -> Column:
    """``2024-01-31T05`` -> 5. Raises under ANSI when the hour is missing."""
    return F.substring(period, 12, 2).cast("bigint")


def energy_class(fuel: Column) -> Column:
    return F.when(fuel.isin(*RENEWABLE_FUELS), "renewable").otherwise("non-renewable")


def country_of_region(region_name: Column) -> Column:
    """Country by region name: foreign regions are countries, all others are domestic."""
    return F.when(region_name.isin(*FOREIGN_REGIONS), region_name).otherwise(USA)


def country_of_flag(is_domestic: Column, region_name: Column) -> Column:
    """Country by the seed's Yes/No flag: a foreign authority's region is its country."""
    return F.when(is_domestic == "Yes", USA).otherwise(region_name)


def demand_label(code: Column) -> Column:
    """Label of a demand type code; a code without a label gives NULL."""
    label = F.lit(None).cast("string")
    for known, text in DEMAND_LABELS.items():
        label = F.when(code == known, text).otherwise(label)
    return label


def short_country(country: Column) -> Column:
    return F.when(country == USA, USA_SHORT).otherwise(country)


def flow_label(provider: Column, recipient: Column) -> Column:
    return F.concat(provider, F.lit(" → "), recipient)


def at_hour(day: Column, hour: Column) -> Column:
    """Zone-less timestamp of an hour of a day."""
    return day.cast("timestamp_ntz") + F.make_dt_interval(hours=hour.cast("int"))


def date_from_text(text: Column) -> Column:
    """Date text with stray dots, e.g. ``2024.01.31``, ``2024-01-31`` or ``Jan. 31, 2024``, also
    with a time after a blank or ``T``, with or without a fraction, and ``01/31/2024``.

    NULL and blank text give NULL; other text in none of the accepted layouts is an error.
    """
    whole = F.regexp_replace(text.cast("string"), r"([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)Z?$", "")
    bare = F.replace(whole, F.lit("."), F.lit(""))
    layouts = ("yyyy-M-d", "yyyyMMdd", "MMM d, yyyy", "M/d/yyyy")
    known = F.coalesce(*(F.try_to_timestamp(bare, F.lit(p)) for p in layouts)).cast("date")
    refused = F.raise_error(F.concat(F.lit("no date: "), text.cast("string"))).cast("date")
    return F.when(F.trim(bare) != "", F.coalesce(known, refused))
