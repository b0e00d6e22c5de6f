"""Page files -> landing table, one whole extract at a time.

The pages of an extract may arrive over several micro-batches. What each extract has so far is
state that goes from batch to batch, kept as a table: the rows declared, the rows arrived, the
batch of its first page and whether it has landed. Rows wait in a table of their batches until
their extract is whole; then all of them land together.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wattframe.feeds import Feed
from wattframe.functions.grid import day_of_period
from wattframe.sources.files import exists, remove
from wattframe.sources.landing import append_landing
from wattframe.sources.pages import TotalMismatch, page_rows, page_schema

STATE_SCHEMA = T.StructType(
    [
        T.StructField("extract", T.StringType()),
        T.StructField("declared_rows", T.LongType()),
        T.StructField("arrived_rows", T.LongType()),
        T.StructField("first_batch", T.LongType()),
        T.StructField("landed", T.BooleanType()),
    ]
)


def folder_of_file() -> Column:
    """An extract is the folder that a page's file is in."""
    return F.regexp_extract("_metadata.file_path", "([^/]*)/[^/]*$", 1)


def extract_states(spark: SparkSession, state: str, batch: int | None = None) -> DataFrame:
    """The extracts seen before ``batch`` (by default: so far), a row for each."""
    folder = f"{state}/extracts"
    if not exists(spark, folder):
        return spark.createDataFrame([], STATE_SCHEMA)
    before = "true" if batch is None else f"batch < {batch}"
    whole = T.StructType([*STATE_SCHEMA, T.StructField("batch", T.LongType())])
    kept = spark.read.schema(whole).parquet(folder).where(before)
    newest = kept.agg(F.max("batch")).first()[0]
    return kept.where(F.col("batch") == newest).drop("batch") if newest is not None else kept.drop("batch")


def stream_whole_extracts(
    spark: SparkSession,
    pages: str,
    feed: Feed,
    landing: str,
    state: str,
    extract: Column | None = None,
    lines: bool = False,
    ingestion_time: datetime | str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Take the page files that are new since the last call and land the extracts they complete.

    ``extract`` names the extract of a page, by default the folder its file is in; a new pull of
    the same days needs a new name. An extract lands when its pages hold as many rows as they
    declare, its rows with one ingestion time: the given one, or that of the batch. An extract of
    no rows lands nothing. Files that go on waiting are not read again.

    A batch with a page without response (an error message) or total, and one after which an
    extract has more rows than declared, fails and changes nothing; the stream's checkpoint is not
    advanced. A batch that is retried replaces what it had stored. If it had landed rows before,
    they land twice: the landing table allows copies, and :func:`latest_readings` resolves them.
    While no extract is whole the landing table is there, without rows.

    ``state`` is a folder that all executors share. What waits there is proportional to the
    extracts that are not whole; of others a row each is kept, so that late pages are noticed.
    """
    stamp = F.current_timestamp()
    if ingestion_time is not None:
        stamp = F.lit(str(ingestion_time)).cast("timestamp")
    reader = spark.readStream.schema(page_schema(feed)).options(recursiveFileLookup=True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    arriving = reader.json(pages, multiLine=not lines, mode="FAILFAST").withColumn(
        "extract", folder_of_file() if extract is None else extract
    )
    waiting = f"{state}/pages"

    def tidy(session: SparkSession, number: int) -> None:
        """Remove batches that no open extract has pages in. The batch before this one is done."""
        open_ = extract_states(session, state, number).where("arrived_rows < declared_rows")
        since = open_.agg(F.min("first_batch")).first()[0]
        for old in range((number if since is None else since) - 1, -1, -1):
            if not exists(session, f"{waiting}/batch={old}"):
                break
            remove(session, f"{waiting}/batch={old}")
        remove(session, f"{state}/extracts/batch={number - 2}")

    def land(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        tidy(session, number)
        # the one time that the pages are parsed
        batch.write.mode("overwrite").parquet(f"{waiting}/batch={number}")
        stored = session.read.schema(batch.schema).parquet(f"{waiting}/batch={number}")
        n_rows = F.coalesce(F.array_size("response.data"), F.lit(0))
        counted = stored.groupBy("extract").agg(
            F.max(F.col("response.total").cast("bigint")).alias("declared_rows"),
            F.sum(n_rows).cast("bigint").alias("arrived_rows"),
            F.lit(number).cast("bigint").alias("first_batch"),
            F.lit(False).alias("landed"),
            F.count_if(F.col("response.total").isNull()).alias("broken"),
        )
        earlier = extract_states(session, state, number).withColumn("broken", F.lit(0).cast("bigint"))
        now = earlier.unionByName(counted).groupBy("extract").agg(
            F.max("declared_rows").alias("declared_rows"),
            F.sum("arrived_rows").alias("arrived_rows"),
            F.min("first_batch").alias("first_batch"),
            F.max("landed").alias("landed"),
            F.sum("broken").alias("broken"),
        )
        now = now.withColumn("whole", F.col("arrived_rows") == F.col("declared_rows"))
        checked = f"{state}/counted"
        now.write.mode("overwrite").parquet(checked)
        now = session.read.schema(now.schema).parquet(checked)
        verdict = now.agg(
            F.sum("broken").alias("broken"),
            F.min(F.when(F.col("arrived_rows") > F.col("declared_rows"), F.col("extract"))).alias(
                "over_full"
            ),
            F.min(F.when(F.expr("whole AND NOT landed AND arrived_rows > 0"), F.col("first_batch"))).alias(
                "since"
            ),
        ).first()
        if verdict["broken"]:
            raise TotalMismatch(
                f"{verdict['broken']} pages of a batch have no response or declare no total"
            )
        if verdict["over_full"] is not None:
            raise TotalMismatch(f"extract {verdict['over_full']} has more rows than it declares")
        if verdict["since"] is not None:
            whole = now.where("whole AND NOT landed").select("extract")
            held = session.read.schema(
                T.StructType([*batch.schema, T.StructField("batch", T.LongType())])
            ).parquet(waiting)
            held = held.where(F.col("batch").between(verdict["since"], number))
            rows = page_rows(held.join(whole, "extract", "left_semi")).withColumns(
                {"ingestion_time": stamp, "partition_date": day_of_period(F.col("period"))}
            )
            append_landing(rows, feed, landing)
        states = now.withColumn("landed", F.col("landed") | F.col("whole"))
        states.select(STATE_SCHEMA.names).coalesce(1).write.mode("overwrite").parquet(
            f"{state}/extracts/batch={number}"
        )

    if not exists(spark, landing):
        append_landing(spark.createDataFrame([], feed.landing_schema), feed, landing)
    return (
        arriving.writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{state}/progress")
        .trigger(availableNow=True)
        .start()
    )
