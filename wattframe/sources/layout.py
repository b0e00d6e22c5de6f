"""How a landing table lies on disk, and putting days in order (A10).

Readers skip what their filter on the cluster columns cannot match. That works for a day when the
rows of each file are sorted on these columns and no two files cover the same range of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.feeds import Feed
from wattframe.sources.landing import read_landing, write_days

_KEY = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
_SEGMENT = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("file", T.StringType()),
        T.StructField("first_row", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("misplaced", T.LongType()),
        *(T.StructField(c, _KEY) for c in ("first", "last", "low", "high")),
    ]
)


def _segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each stretch of a file that a batch holds."""
    for batch in batches:
        if not batch.num_rows:
            continue
        day, file, row = (batch.column(i).to_pylist() for i in range(3))
        # a missing id sorts before every text, as NULL does
        one, two = (
            np.array([("",) if x is None else ("", x) for x in batch.column(i).to_pylist()] + [None], object)[:-1]
            for i in (3, 4)
        )
        cuts = [0, *(i for i in range(1, len(file)) if file[i] != file[i - 1]), len(file)]
        out = []
        for start, end in zip(cuts, cuts[1:]):
            a, b = one[start:end], two[start:end]
            less = (a[1:] < a[:-1]) | ((a[1:] == a[:-1]) & (b[1:] < b[:-1]))
            keys = list(zip(a, b))
            ends = [keys[0], keys[-1], min(keys), max(keys)]
            shown = [{"a": (*x, None)[1], "b": (*y, None)[1]} for x, y in ends]
            out.append((day[start], file[start], row[start], end - start, int(less.sum()), *shown))
        kinds = [pa.date32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        kinds += [pa.struct([("a", pa.string()), ("b", pa.string())])] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=_SEGMENT.names
        )


def layout_report(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """(partition_date, n_rows, n_files, misplaced, overlapping) of every day of a landing table.

    ``misplaced`` counts rows that come after a larger one in their file, ``overlapping`` files whose
    range of the cluster columns begins before that of another ends. Rows stay in the tasks that read
    them: what is exchanged is a row for each batch of a file.
    """
    one, two = feed.cluster_raw
    rows = read_landing(spark, path, feed).select(
        "partition_date", "_metadata.file_path", "_metadata.row_index", one, two
    )
    in_file = Window.partitionBy("day", "file").orderBy("first_row")
    before = F.lag("last").over(in_file)
    segments = rows.mapInArrow(_segments, _SEGMENT).withColumn(
        "broken", F.coalesce((F.col("first") < before).cast("long"), F.lit(0))
    )
    files = segments.groupBy("day", "file").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum(F.col("misplaced") + F.col("broken")).alias("misplaced"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    earlier = (
        Window.partitionBy("day").orderBy("low", "high", "file").rowsBetween(Window.unboundedPreceding, -1)
    )
    overlaps = F.coalesce((F.max("high").over(earlier) > F.col("low")).cast("long"), F.lit(0))
    return (
        files.withColumn("overlaps", overlaps)
        .groupBy(F.col("day").alias("partition_date"))
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.count("*").alias("n_files"),
            F.sum("misplaced").alias("misplaced"),
            F.sum("overlaps").alias("overlapping"),
        )
    )


def recluster_days(spark: SparkSession, path: str, feed: Feed, days: Sequence[date]) -> None:
    """Write days of a landing table again, each file a range of its own of the cluster columns.

    Rows are ranged by day and cluster columns, then by period, so a large day is spread over tasks
    and many small ones share them. Only these days are replaced; rows stay the same.
    """
    if not days:
        return
    rows = read_landing(spark, path, feed).where(F.col("partition_date").isin(list(days)))
    ranged = rows.repartitionByRange("partition_date", *feed.cluster_raw, "period")
    write_days(
        ranged, path, "partition_date", (*feed.cluster_raw, "period"), "overwrite", rebalance=False
    )
