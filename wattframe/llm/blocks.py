"""Groups of rows dealt out in pairs of blocks, so that no task holds a whole large group."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import cut_lineage, shuffle_width

BLOCK_ROWS = 1024


def deal_blocks(
    rows: DataFrame,
    key: str,
    by: str,
    block_rows: int = BLOCK_ROWS,
    more: DataFrame | None = None,
) -> DataFrame:
    """``rows`` (with a column ``component``) with ``left``, ``right`` and ``block``, sorted by key,
    left and right, so that rows of one key in different components meet.

    Each row is in block ``block`` of its key's group and comes once for each pair of blocks that
    has it. The key's most frequent component has blocks of its own, which don't meet each other:
    where nearly all rows are in one component, they come once for each block of the few others.
    All rows of a key and pair are next to each other in one partition. ``more`` has wide columns of
    ``by``, which are joined when blocks are known.
    """
    rows = rows.repartition(key)  # serves both counts and the join
    parts = rows.groupBy(key, "component").agg(F.count("*").alias("_n"))
    sizes = parts.groupBy(key).agg(
        F.max_by("component", F.struct("_n", "component")).alias("_major"),
        F.max("_n").alias("_inside"),
        F.sum("_n").alias("_all"),
    )
    blocks = lambda n: F.ceil(n / block_rows).cast("int")
    sizes = sizes.select(
        key,
        "_major",
        blocks(F.col("_inside")).alias("_inside"),
        blocks(F.col("_all") - F.col("_inside")).alias("_outside"),
    )
    major = F.col("component") == F.col("_major")
    place = F.xxhash64(by)
    dealt = rows.join(sizes, key).withColumns(
        {
            "block": F.when(major, F.col("_outside") + F.pmod(place, "_inside"))
            .otherwise(F.pmod(place, "_outside"))
            .cast("int"),
            "_last": F.col("_outside") + F.when(major, 0).otherwise(F.col("_inside")) - 1,
        }
    )
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_last").cast("int"))))
    dealt = dealt.withColumns(
        {"left": F.least("block", "_other"), "right": F.greatest("block", "_other")}
    ).drop("_major", "_inside", "_outside", "_last", "_other")
    if more is not None:
        dealt = dealt.join(more, by)
    width = shuffle_width(rows.sparkSession)
    dealt = dealt.repartition(width, key, "left", "right")
    return dealt.sortWithinPartitions(key, "left", "right")


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of adjacent rows with equal keys, from sorted batches."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        n = table.num_rows
        change = np.zeros(max(n - 1, 0), bool)
        for k in keys:
            column = table.column(k).to_numpy()
            change |= column[1:] != column[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for start, end in zip(cuts, cuts[1:]):
            yield table.slice(start, end - start)
        held = table.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield held


def confirm_stars(
    pairs: DataFrame, sets: DataFrame, linked: Callable[[np.ndarray, np.ndarray], bool]
) -> DataFrame:
    """The (a, b) of ``pairs`` whose ``sets`` (node, found: 64-bit values) are linked.

    The pairs of one ``a`` meet in blocks of some ``b``: the set of a is sent once to each block,
    that of b with each of its pairs. Where a node has several sets, one of them is enough.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("_blocks"))
    cell = ["a", "block"]
    dealt = pairs.join(sizes, "a").select(
        "a", F.pmod(F.xxhash64("b"), "_blocks").cast("int").alias("block"), "b"
    )
    dealt = cut_lineage(dealt)
    leaves = dealt.join(sets.withColumnRenamed("node", "b"), "b").select(*cell, "b", "found")
    hubs = dealt.select(*cell).distinct().join(sets.withColumnRenamed("node", "a"), "a")
    rows = leaves.unionAll(hubs.select(*cell, F.lit(None).cast("long").alias("b"), "found"))
    rows = rows.repartition(shuffle_width(pairs.sparkSession), *cell).sortWithinPartitions(*cell)

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, cell):
            hub = run.column("a")[0].as_py()
            bodies = [np.frombuffer(x, np.uint64) for x in run.column("found").to_pylist()]
            nodes = run.column("b").to_pylist()
            own = [x for x, b in zip(bodies, nodes) if b is None]
            found = {
                b
                for x, b in zip(bodies, nodes)
                if b is not None and any(linked(u, x) for u in own)
            }
            yield pa.RecordBatch.from_arrays(
                [pa.array([hub] * len(found), pa.int64()), pa.array(list(found), pa.int64())],
                names=["a", "b"],
            )

    return rows.mapInArrow(check, "a long, b long")
