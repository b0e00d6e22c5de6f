"""Extract files and landing tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from datetime import date
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.feeds import Feed
from wattframe.sources.files import exists


def extracts_folder(root: str, feed: Feed) -> str:
    return f"{root.rstrip('/')}/api/{feed.name}"


def extract_path(root: str, feed: Feed, day: date, monthly: bool = False) -> str:
    """``api/<feed>/<yyyy>/<mm>/<dd>.parquet``, or ``.../<mm>.parquet`` for a month."""
    tail = f"{day:%m}.parquet" if monthly else f"{day:%m}/{day:%d}.parquet"
    return f"{extracts_folder(root, feed)}/{day:%Y}/{tail}"


def conform(rows: DataFrame, feed: Feed) -> DataFrame:
    """Rows cast to the declared landing schema.

    Extracts disagree about types, and Spark does not read one directory of mixed
    physical types, so types are fixed here, before rows reach the table. Rows without a
    column that readings need, or without a measure, are refused: as NULLs they would
    be dropped or count as zeros. Display names may be missing; unknown columns are dropped.
    """
    present = set(rows.columns)
    absent = [c for c in (*feed.required, "value") if c not in present]
    if absent:
        raise ValueError(f"{feed.name} extract lacks {', '.join(absent)}")
    return rows.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in feed.landing_schema
        )
    )


def write_extract(rows: DataFrame, feed: Feed, path: str) -> None:
    conform(rows, feed).write.mode("overwrite").parquet(path)


def read_extracts(spark: SparkSession, paths: list[str], feed: Feed) -> DataFrame:
    """Extracts of one feed, conformed, whatever physical types they were written with.

    ``paths`` are files or folders, searched to any depth. When all footers agree this is
    one scan. When they do not, one job reads every footer, files are grouped by schema and
    each group is one scan: jobs and plan grow with the number of distinct schemas, not of
    files.
    """
    if not paths:
        raise FileNotFoundError(f"no {feed.name} extract given")
    whole = _agreed_schema(spark, paths)
    if whole is not None:
        return conform(_parquet(spark).schema(whole).parquet(*paths), feed)
    scans = [
        conform(spark.read.schema(schema).parquet(*group), feed)
        for schema, group in _files_by_schema(spark, extract_files(spark, paths))
    ]
    return reduce(DataFrame.unionByName, scans)


def _parquet(spark: SparkSession) -> DataFrameReader:
    return spark.read.options(recursiveFileLookup=True, pathGlobFilter="*.parquet")


def extract_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The Parquet files below ``paths`` (path, size, modified); no file is opened."""
    listed = spark.read.format("binaryFile").options(
        recursiveFileLookup=True, pathGlobFilter="*.parquet"
    )
    return listed.load(paths).select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def _agreed_schema(spark: SparkSession, paths: list[str]) -> T.StructType | None:
    """The merged schema of all files, or None if a column's types conflict.

    Footers are read by tasks."""
    try:
        return _parquet(spark).option("mergeSchema", True).parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        return None


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """A file as Arrow opens it. Spark's names of local files have one slash."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    # other clients of the same object store go by one scheme
    return pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def read_footers(files: DataFrame) -> DataFrame:
    """``files`` with ``layout``: the columns and types that each footer names, as text.

    Tasks read the footers only, of as many files as a scan would give them. A file in a
    store that Arrow has no client for has no layout.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            layouts = []
            for path in batch.column(batch.schema.get_field_index("path")).to_pylist():
                try:
                    store, name = _opened(path)
                except (pa.ArrowException, NotImplementedError, OSError):
                    layouts.append(None)
                    continue
                schema = pq.read_schema(name, filesystem=store)
                layouts.append(", ".join(f"{f.name} {f.type}" for f in schema))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(layouts, pa.string())], names=[*batch.schema.names, "layout"]
            )

    return files.mapInArrow(read, T.StructType([*files.schema, T.StructField("layout", T.StringType())]))


def _files_by_schema(
    spark: SparkSession, files: DataFrame
) -> list[tuple[T.StructType, list[str]]]:
    """Files grouped by schema: one job for all footers, and one for each distinct layout, in
    which Spark reads the schema of one of its files. File names and layouts reach the driver,
    which holds the list of a scan's files anyway."""
    by_layout: dict[str | None, list[str]] = {}
    for r in read_footers(files.select("path")).collect():
        by_layout.setdefault(r["layout"], []).append(r["path"])
    groups = _by_halving(spark, by_layout.pop(None, []))
    for group in by_layout.values():
        groups.append((spark.read.parquet(group[0]).schema, sorted(group)))
    return groups


def _by_halving(spark: SparkSession, files: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files whose footers tasks could not open, grouped by halving until a part agrees."""
    parts, groups = [files] if files else [], {}
    while parts:
        part = parts.pop()
        schema = _agreed_schema(spark, part)
        if schema is None:
            middle = len(part) // 2
            parts += [part[:middle], part[middle:]]
        else:
            groups.setdefault(schema.json(), (schema, []))[1].extend(part)
    return list(groups.values())


def write_days(
    rows: DataFrame,
    path: str,
    day: str,
    cluster_by: tuple[str, ...],
    mode: str,
    rebalance: bool = True,
) -> None:
    """Rows as a table partitioned by ``day``, sorted on ``cluster_by`` inside each file.

    The rebalance brings each day into few files and lets adaptive execution split a day
    that is larger than the advisory size, so a hot day is never one task. Leave it out
    when every task already holds few days, as after a scan of a table of days: nothing
    is exchanged then. The sort gives row groups narrow min/max ranges on the cluster
    columns.

    Overwriting replaces only the days present in ``rows``. A table that is built whole is
    appended to a new folder, which spares replacing its days one by one.
    """
    if rebalance:
        rows = rows.hint("rebalance", F.col(day))
    (
        rows.sortWithinPartitions(day, *cluster_by)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def append_landing(rows: DataFrame, feed: Feed, path: str) -> None:
    """Append to a landing table. Duplicates are allowed here and resolved downstream."""
    write_days(conform(rows, feed), path, "partition_date", feed.cluster_raw, "append")


def read_landing(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """Landing table with its declared types, so no schema or partition type is inferred."""
    return spark.read.schema(feed.landing_schema).parquet(path)


#: Files that were landed, by the state they were in.
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("modified", T.TimestampType()),
    ]
)


def landed_files(spark: SparkSession, ledger: str) -> DataFrame:
    """The files in a ledger; none before its first entry."""
    if not exists(spark, ledger):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


def new_files(spark: SparkSession, extracts: list[str], ledger: str) -> DataFrame:
    """The extracts' files that the ledger lacks, or has with another size or time."""
    landed = landed_files(spark, ledger).distinct()
    return extract_files(spark, extracts).join(landed, LEDGER_SCHEMA.names, "left_anti")


def load_daily(
    spark: SparkSession, extract: str, feed: Feed, landing: str, ledger: str | None = None
) -> None:
    load_all(spark, [extract], feed, landing, ledger)


def load_all(
    spark: SparkSession,
    extracts: list[str],
    feed: Feed,
    landing: str,
    ledger: str | None = None,
) -> int | None:
    """Append every extract of a feed in one job.

    With a ``ledger`` (a table at that path) only files that are not in it as they are now are
    appended, and entered: loading again appends nothing, a changed extract is appended again.
    Returns the number of files appended, if there is a ledger. A load that fails before its files
    are entered is repeated by the next one; the landing table allows copies, and
    :func:`latest_readings` resolves them. One load of a landing table runs at a time.
    """
    if ledger is None:
        append_landing(read_extracts(spark, extracts, feed), feed, landing)
        return None
    # entered as they are before they are read: a file that changes meanwhile lands again
    fresh = new_files(spark, extracts, ledger).collect()
    if fresh:
        append_landing(read_extracts(spark, [r["path"] for r in fresh], feed), feed, landing)
        entries = spark.createDataFrame(fresh, LEDGER_SCHEMA)
        entries.coalesce(1).write.mode("append").parquet(ledger)
    return len(fresh)


def load_exports(
    spark: SparkSession, exports: dict[str, str], feeds: dict[str, Feed], landing: dict[str, str]
) -> None:
    """Append one pre-exported file per feed."""
    for name, path in exports.items():
        load_all(spark, [path], feeds[name], landing[name])


def file_census(spark: SparkSession, root: str) -> DataFrame:
    """Number of Parquet files below ``root``."""
    return extract_files(spark, [root]).agg(F.count("path").alias("n_files"))
