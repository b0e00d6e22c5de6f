"""Ordered offset/limit paging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.checkpoints import cut_lineage

#: Rows per page.
PAGE_SIZE = 5000


def page_count(rows: Column, page_size: int = PAGE_SIZE) -> Column:
    return F.ceil(rows / F.lit(page_size)).cast("bigint")


def _starts(sizes: DataFrame) -> DataFrame:
    """(part, start): the sizes of the partitions before each one. ``sizes`` has a row for each
    partition of a shuffle, so one task holds them, and they are small enough to broadcast."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")
    return F.broadcast(sizes.select("part", start))


def running_totals(sizes: DataFrame, order_by: str) -> DataFrame:
    """``sizes`` (one row for each value of ``order_by``, with its ``size``) with ``start``: the
    sizes of all rows before.

    Prefix sums in two levels: rows are ranged over the partitions and summed within each, and
    the sums of whole partitions are added. No task sees more than its range.
    """
    # both levels must see the same partitions
    ranged = cut_lineage(
        sizes.repartitionByRange(order_by).withColumn("part", F.spark_partition_id())
    )
    before = Window.partitionBy("part").orderBy(order_by).rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(F.sum("size").alias("size"))
    within = ranged.withColumn("within", F.coalesce(F.sum("size").over(before), F.lit(0)))
    started = within.join(_starts(parts), "part")
    return started.withColumn("start", F.col("start") + F.col("within")).drop("part", "within")


def number_rows(rows: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """``rows`` with a ``position`` from 0 in the total order ``order_by``.

    A range shuffle sorts the rows over all tasks; a row's position is its place in its
    partition plus the size of the partitions before it. Only one size per partition
    passes through a single task. The random last range column spreads rows that tie on
    ``order_by``, so a hot value does not fill one partition. The sorted rows are
    checkpointed because both steps must see the same partitions.
    """
    low_bits = F.lit((1 << 33) - 1)  # monotonically_increasing_id counts in its low 33 bits
    placed = cut_lineage(
        rows.withColumn("tie", F.rand(seed=7))
        .repartitionByRange(*order_by, "tie")
        .sortWithinPartitions(*order_by)
        .drop("tie")
        .withColumn("part", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id().bitwiseAND(low_bits))
    )
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    return (
        placed.join(_starts(sizes), "part")
        .withColumn("position", F.col("start") + F.col("place"))
        .drop("part", "place", "start")
    )


def page_slice(
    rows: DataFrame, order_by: Sequence[str], page: int, page_size: int = PAGE_SIZE
) -> DataFrame:
    """Page ``page`` (from 0) of ``rows``.

    ``order_by`` starts with the period and must identify a row: ordered by period
    alone, rows of one period may change places between two calls, and pages would
    overlap or miss rows.

    ``orderBy.offset.limit`` would gather every row up to the end of the page in one
    task. Instead, rows are counted per period, the page is narrowed to the periods it
    touches (a literal range, so it prunes the scan), and only those rows are numbered.
    """
    lead = order_by[0]
    first, last = page * page_size, (page + 1) * page_size
    per_period = rows.groupBy(lead).agg(F.count(F.lit(1)).alias("size"))
    touched = (
        running_totals(per_period, lead)
        .where((F.col("start") < last) & (F.col("start") + F.col("size") > first))
        .agg(
            F.min(lead).alias("low"),
            F.max(lead).alias("high"),
            F.bool_or(F.col(lead).isNull()).alias("has_null"),
            F.min("start").alias("start"),
        )
        .first()
    )
    if touched["start"] is None:
        return rows.where(F.lit(False))
    in_page = F.lit(False)
    if touched["low"] is not None:
        in_page = F.col(lead).between(F.lit(touched["low"]), F.lit(touched["high"]))
    if touched["has_null"]:
        in_page = in_page | F.col(lead).isNull()
    near = rows.where(in_page)
    position = F.col("position") + F.lit(touched["start"])
    return (
        number_rows(near, order_by)
        .where((position >= first) & (position < last))
        .drop("position")
    )
