"""API pages -> flat feed rows (A1-A4, G1)."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.feeds import Feed
from wattframe.functions.grid import day_of_period


class TotalMismatch(ValueError):
    """An extract holds another number of rows than its pages declare."""


def page_schema(feed: Feed) -> T.StructType:
    """Page envelope. Everything is text: the API is not consistent about types."""
    names = ["period"]
    for p in feed.parties:
        names += [p.raw_id, p.raw_name.replace("_", "-")]
    row = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "value", "value-units"]])
    return T.StructType(
        [
            T.StructField(
                "response",
                T.StructType(
                    [
                        T.StructField("total", T.StringType()),
                        T.StructField("data", T.ArrayType(row)),
                    ]
                ),
            )
        ]
    )


def read_pages(
    spark: SparkSession, path: str | list[str], feed: Feed, lines: bool = False
) -> DataFrame:
    """Page files of one envelope each, or of one envelope per line.

    A page has a bounded size, so a file of one page is never a large task; files of
    lines are split.
    """
    return spark.read.schema(page_schema(feed)).json(path, multiLine=not lines, mode="FAILFAST")


def normalize_feed_columns(rows: DataFrame) -> DataFrame:
    """Lower-case column names with ``_`` for ``-``."""
    return rows.toDF(*(c.lower().replace("-", "_") for c in rows.columns))


def page_rows(pages: DataFrame) -> DataFrame:
    rows = pages.select(F.explode("response.data").alias("row")).select("row.*")
    return normalize_feed_columns(rows)


def union_pages(*pages: DataFrame) -> DataFrame:
    """Append by column name; a column missing from one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def page_counts() -> list[Column]:
    """What an extract's pages are counted for."""
    n_rows = F.coalesce(F.array_size("response.data"), F.lit(0))
    return [
        F.max(F.col("response.total").cast("bigint")).alias("declared_rows"),
        F.sum(n_rows).cast("bigint").alias("actual_rows"),
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("response").isNull()).alias("without_response"),
    ]


def reconcile(pages: DataFrame, *by: str) -> DataFrame:
    """Declared and actual row counts, per extract when ``by`` names its columns."""
    matches = F.col("declared_rows") == F.col("actual_rows")
    return pages.groupBy(*by).agg(*page_counts()[:2]).withColumn("matches", matches)


def stamp(rows: DataFrame, ingestion_time: datetime | str) -> DataFrame:
    """One ingestion time per extract, given by the caller so that a rerun agrees, and
    the day of every row's period."""
    return rows.withColumns(
        {
            "ingestion_time": F.lit(str(ingestion_time)).cast("timestamp"),
            "partition_date": day_of_period(F.col("period")),
        }
    )


def whole_extract(totals: dict) -> bool:
    """Whether the ``page_counts`` of an extract are those of a whole one; False if it declares no
    rows and has none.

    Raises :class:`TotalMismatch` for another number of rows than declared. No page at all, a page
    without a response (an error message) and pages that declare no total are mismatches too, not
    empty extracts.
    """
    pages, lost = totals.get("pages") or 0, totals.get("without_response") or 0
    declared, actual = totals.get("declared_rows"), totals.get("actual_rows") or 0
    if not pages or lost:
        raise TotalMismatch(f"{lost} of {pages} pages have no response")
    if declared is None:
        raise TotalMismatch("no page declares a total")
    if declared != actual:
        raise TotalMismatch(f"pages declare {declared} rows, found {actual}")
    return declared > 0


def checked_rows(pages: DataFrame, ingestion_time: datetime | str) -> DataFrame | None:
    """Stamped rows of one extract, or None if it declares no rows.

    Runs one job to compare the totals before anything can be written, see :func:`whole_extract`.
    To write an extract, ``write_checked_extract`` needs one pass over the pages instead of two.
    """
    if not whole_extract(pages.agg(*page_counts()).first().asDict()):
        return None
    return stamp(page_rows(pages), ingestion_time)
