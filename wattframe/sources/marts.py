"""Reading marts for display, with a CSV to fall back on."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.feeds import MEASURE
from wattframe.functions.grid import date_from_text

MART_SCHEMAS = {
    "marts_generation": T.StructType(
        [
            T.StructField("year", T.LongType()),
            T.StructField("fuel", T.StringType()),
            T.StructField("energy_type", T.StringType()),
            T.StructField("total_generation", MEASURE),
        ]
    ),
    "marts_interchange": T.StructType(
        [
            T.StructField("recorded_date", T.DateType()),
            T.StructField("provider_country", T.StringType()),
            T.StructField("recipient_country", T.StringType()),
            T.StructField("interchange", MEASURE),
        ]
    ),
    "marts_forecast": T.StructType(
        [
            T.StructField("recorded_date", T.DateType()),
            T.StructField("recorded_hour", T.LongType()),
            T.StructField("demand_type", T.StringType()),
            T.StructField("value", MEASURE),
        ]
    ),
}


def _date(mart: DataFrame):
    """The mart's date: typed dates and times are cast, text is parsed."""
    kind = dict(mart.dtypes).get("recorded_date", "string")
    if kind == "date" or kind.startswith("timestamp"):
        return F.col("recorded_date").cast("date")
    return date_from_text(F.col("recorded_date"))


def coerce_mart(mart: DataFrame) -> DataFrame:
    """Display types: unreadable numbers become NULL, a missing energy type ``Unknown``;
    unreadable dates are an error. Columns the mart does not have are skipped."""
    rules = {
        "total_generation": F.col("total_generation").try_cast("double"),
        "year": F.col("year").try_cast("double").try_cast("bigint"),
        "energy_type": F.coalesce(F.col("energy_type").cast("string"), F.lit("Unknown")),
        "fuel": F.col("fuel").cast("string"),
        "recorded_date": _date(mart),
        "interchange": F.col("interchange").try_cast("double"),
    }
    return mart.withColumns({c: rule for c, rule in rules.items() if c in mart.columns})


def read_mart(spark: SparkSession, name: str, csv_path: str) -> tuple[DataFrame, str]:
    """The mart and where it came from: ``table``, or ``csv`` when there is no such table.

    The CSV is read with the mart's declared types, and its header must name its columns.
    """
    try:
        return coerce_mart(spark.table(name)), "table"
    except AnalysisException as error:
        if error.getCondition() not in ("TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND"):
            raise
        fallback = spark.read.schema(MART_SCHEMAS[name]).csv(
            csv_path, header=True, enforceSchema=False, escape='"'
        )
        return fallback, "csv"


def load_marts(
    spark: SparkSession, csv_paths: dict[str, str], cache: bool = False
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Every mart in ``csv_paths`` and its source, kept in the session's cache if asked."""
    read = {name: read_mart(spark, name, path) for name, path in csv_paths.items()}
    marts = {name: mart.cache() if cache else mart for name, (mart, _) in read.items()}
    return marts, {name: source for name, (_, source) in read.items()}
