"""Grid feeds and seeds derived from the given tables.

========================  ==========================================================
landing feeds             ``events``, one reading per event. Ids are lower case; users
                          give 30 authorities of which only 25 exist as nations, and
                          the fuel ``zzz`` is in no seed, so inner joins drop rows.
                          Every 17th event has no measure.
generation history        ``lineitem``, one reading per line, several years.
energy_sources            distinct part types of ``part``
balancing_authorities     ``nation`` with ``region``; two regions are foreign countries, and
                          the flag of foreign authorities goes by another rule
extract pages             one JSON envelope per event; an ``error`` event is a page
                          that arrived empty
========================  ==========================================================

The result frames are compared with another engine by value, so :func:`portable`
renders dates and timestamps as text and exact decimals as doubles at the very end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.feeds import FEEDS, MEASURE, Feed
from wattframe.operators.dimensions import bounded_broadcast
from wattframe.sources.pages import page_schema

FUEL_OF_EVENT = {"view": "wnd", "click": "col", "purchase": "sun", "signup": "nuc"}
TYPE_OF_EVENT = {"view": "d", "click": "df", "purchase": "ng"}
FUEL_OF_LINE = {"AF": "wnd", "AO": "sun", "NF": "nuc", "NO": "ng", "RF": "col"}
SOURCE_OF_PART = {
    "ECONOMY": ("WND", "Wind"),
    "STANDARD": ("COL", "Coal"),
    "MEDIUM": ("SUN", "Solar"),
    "PROMO": ("NUC", "Nuclear"),
    "LARGE": ("NG", "Natural gas"),
    "SMALL": ("BAT", "Battery storage"),
}
COUNTRY_OF_REGION = {0: "Canada", 1: "Mexico"}
#: Every so many nations are flagged as foreign, whatever their region, so that the two rules for
#: countries (by region, by flag) disagree.
FLAG_EVERY = 3
UNITS = "megawatthours"
AUTHORITIES = 30
NEIGHBOURS = 5


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _lookup(key: Column, values: dict, default: str | None) -> Column:
    out = F.lit(default).cast("string")
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def _numbered(prefix: str, number: Column, modulus: int) -> Column:
    return F.concat(F.lit(prefix), (number % modulus).cast("string"))


def landing(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    user, event = F.col("user_id"), F.col("event_id")
    operator = _numbered("nation_", user, AUTHORITIES), _numbered("Nation ", user, AUTHORITIES)
    fuel = _lookup(F.col("event_type"), FUEL_OF_EVENT, "zzz")
    kind = _lookup(F.col("event_type"), TYPE_OF_EVENT, "ti")
    entities = {
        "respondent": operator,
        "fromba": operator,
        "parent": operator,
        "toba": (_numbered("nation_", event, NEIGHBOURS), _numbered("Nation ", event, NEIGHBOURS)),
        "subba": (_numbered("sub_", event, NEIGHBOURS), _numbered("Sub ", event, NEIGHBOURS)),
        "fueltype": (fuel, F.col("event_type")),
        "type": (kind, F.col("event_type")),
    }
    parties = [
        column
        for p in feed.parties
        for column in (
            entities[p.raw_id][0].alias(p.raw_id),
            entities[p.raw_id][1].alias(p.raw_name),
        )
    ]
    return read(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH").alias("period"),
        *parties,
        F.when(event % 17 != 0, F.col("value").cast(MEASURE)).alias("value"),
        F.lit(UNITS).alias("value_units"),
        F.col("ts").cast("timestamp").alias("ingestion_time"),
        F.col("ts").cast("date").alias("partition_date"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows of the generation feed over several years."""
    code = F.concat("l_returnflag", "l_linestatus")
    day = F.col("l_shipdate").cast("date")
    hour = F.lpad((F.col("l_linenumber") - 1).cast("string"), 2, "0")
    return read(spark, sf_dir, "lineitem").select(
        F.concat(day.cast("string"), F.lit("T"), hour).alias("period"),
        _numbered("nation_", F.col("l_suppkey"), AUTHORITIES).alias("respondent"),
        _numbered("Nation ", F.col("l_suppkey"), AUTHORITIES).alias("respondent_name"),
        _lookup(code, FUEL_OF_LINE, "bat").alias("fueltype"),
        code.alias("type_name"),
        F.col("l_extendedprice").cast(MEASURE).alias("value"),
        F.lit(UNITS).alias("value_units"),
        F.col("l_shipdate").cast("timestamp").alias("ingestion_time"),
        day.alias("partition_date"),
    )


def energy_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select("p_type").distinct()
    codes = {t: code for t, (code, _) in SOURCE_OF_PART.items()}
    names = {t: name for t, (_, name) in SOURCE_OF_PART.items()}
    return part.select(
        _lookup(F.col("p_type"), codes, None).alias("energy_source_code"),
        _lookup(F.col("p_type"), names, None).alias("energy_source_name"),
    )


def balancing_authorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    foreign = F.col("n_nationkey") % FLAG_EVERY == 0
    country = F.col("r_name")
    for k, name in COUNTRY_OF_REGION.items():
        country = F.when(F.col("r_regionkey") == k, name).otherwise(country)
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.upper("n_name").alias("ba_code"),
        F.initcap(F.lower("n_name")).alias("ba_name"),
        F.substring("r_name", 1, 3).alias("region_or_country_code"),
        country.alias("region_or_country_name"),
        F.when(foreign, "No").otherwise("Yes").alias("us_ba"),
    )


def envelopes(
    spark: SparkSession, sf_dir: str, feed: Feed, lossy: bool = False, extract: str = "partition_date"
) -> DataFrame:
    """Pages as JSON text (``body``), with the ``extract_date`` (day, or ``extract``) of their
    extract. ``lossy`` pages of errors came without their rows."""
    lost = F.col(feed.parties[1].raw_name) == "error" if lossy else F.lit(False)
    events = landing(spark, sf_dir, feed).withColumn("lost", lost)
    events = events.withColumn("extract", F.expr(extract))
    declared = events.groupBy("extract").agg(F.count(F.lit(1)).alias("total"))
    names = ["period"]
    for p in feed.parties:
        names += [p.raw_id, p.raw_name]
    row = F.struct(
        *(F.col(c).alias(c.replace("_", "-")) for c in [*names, "value", "value_units"])
    )
    page = F.struct("total", F.when(F.col("lost"), F.array()).otherwise(F.array(row)).alias("data"))
    return events.join(bounded_broadcast(declared), "extract").select(
        F.col("extract").alias("extract_date"),
        F.col(feed.parties[1].raw_name).alias("kind"),
        F.to_json(F.struct(page.alias("response"))).alias("body"),
    )


def pages(spark: SparkSession, sf_dir: str, feed: Feed, lossy: bool = False) -> DataFrame:
    """Pages parsed with the page schema, as page files are."""
    parsed = F.from_json("body", page_schema(feed)).alias("page")
    return envelopes(spark, sf_dir, feed, lossy).select("extract_date", parsed).select(
        "extract_date", "page.*"
    )


def portable(rows: DataFrame) -> DataFrame:
    """Dates and timestamps as text, decimals as doubles. Inputs have two decimals, and
    sums are exact until here."""
    out = []
    for field in rows.schema:
        column = F.col(f"`{field.name}`")
        kind = field.dataType.typeName()
        if kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        elif kind in ("timestamp", "timestamp_ntz"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "decimal":
            column = column.cast("decimal(18,2)").cast("double")
        out.append(column.alias(field.name))
    return rows.select(*out)


GENERATION = FEEDS["generation"]
INTERCHANGE = FEEDS["interchange"]
FORECAST = FEEDS["demand_forecast"]
SUBREGION = FEEDS["demand_by_subregion"]
