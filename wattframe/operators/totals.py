"""Totals kept by change instead of computed again.

A mart's rows are sums by key. Kept with the number of rows behind each sum, they follow a change of
their input without the rest of it: the rows that were replaced are taken off, the rows that replace
them are added. A key without rows left goes; one whose measures are all unknown has no sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.feeds import MEASURE

#: What is kept of each key: its sum, its rows, and those of them with a measure.
KEPT = T.StructType(
    [
        T.StructField("total", MEASURE),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_known", T.LongType()),
    ]
)


def totals(lines: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Totals of ``lines``. Rows are summed in each task before they are exchanged."""
    return lines.groupBy(*keys).agg(
        F.coalesce(F.sum(measure), F.lit(0)).cast(MEASURE).alias("total"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count(measure).alias("n_known"),
    )


def apply_change(
    kept: DataFrame, replaced: DataFrame, added: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """``kept`` after the lines behind the totals ``replaced`` have become those behind ``added``.

    All three are as :func:`totals` gives them. Sums are exact decimals, so nothing drifts however
    many changes are applied.
    """
    taken_off = replaced.select(*keys, *((-F.col(c.name)).cast(c.dataType).alias(c.name) for c in KEPT))
    changed = kept.unionByName(taken_off).unionByName(added)
    sums = changed.groupBy(*keys).agg(
        *(F.sum(c.name).cast(c.dataType).alias(c.name) for c in KEPT)
    )
    return sums.where(F.col("n_rows") > 0)


def shown(kept: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """The mart that totals stand for; a key without a known measure has none."""
    return kept.select(*keys, F.when(F.col("n_known") > 0, F.col("total")).alias(measure))
