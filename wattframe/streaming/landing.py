"""Page files -> landing table as they arrive."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattframe.feeds import Feed
from wattframe.functions.grid import day_of_period
from wattframe.sources.landing import append_landing
from wattframe.sources.pages import TotalMismatch, page_rows, page_schema


def stream_landing(
    spark: SparkSession,
    pages: str,
    feed: Feed,
    landing: str,
    checkpoint: str,
    lines: bool = False,
    ingestion_time: datetime | str | None = None,
) -> StreamingQuery:
    """Append the pages that are new since the last call, then stop.

    The stream's checkpoint remembers which files were taken, so a file is loaded once
    instead of with every bulk run. If a batch is retried its rows may be appended twice;
    the landing table allows copies, and :func:`latest_readings` resolves them.

    A batch with a page that has no response (an error message) or declares no total fails and
    lands nothing; the checkpoint is not advanced, so it is taken again once the page is mended.
    Rows carry ``ingestion_time``, or the time of their batch if there is none.
    """
    stamp = F.current_timestamp()
    if ingestion_time is not None:
        stamp = F.lit(str(ingestion_time)).cast("timestamp")
    arriving = spark.readStream.schema(page_schema(feed)).json(
        pages, multiLine=not lines, mode="FAILFAST", recursiveFileLookup=True
    )

    def land(batch: DataFrame, _: int) -> None:
        broken = batch.filter("response IS NULL OR response.total IS NULL").count()
        if broken:
            raise TotalMismatch(f"{broken} pages of a batch have no response or declare no total")
        rows = page_rows(batch).withColumns(
            {"ingestion_time": stamp, "partition_date": day_of_period(F.col("period"))}
        )
        append_landing(rows, feed, landing)

    return (
        arriving.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
