"""How days lie on disk; prefix sums over ranges."""

from datetime import date
from itertools import accumulate
from pathlib import Path

import pytest
from plans import planned
from pyspark.sql import functions as F

from wattframe.feeds import FEEDS
from wattframe.operators.paging import page_slice, running_totals
from wattframe.plans import jobs
from wattframe.plans.warehouse import Warehouse
from wattframe.sources.landing import append_landing, read_landing
from wattframe.sources.layout import layout_report, recluster_days

FEED = FEEDS["generation"]


def report(spark, path):
    rows = layout_report(spark, path, FEED).collect()
    return {r["partition_date"].day: (r["n_rows"], r["n_files"], r["misplaced"], r["overlapping"]) for r in rows}


@pytest.fixture
def rows(make_landing):
    """Three days; a fuel may be missing."""
    return make_landing(
        "generation",
        [
            (f"2024-01-{d:02d}T{h:02d}", f"r{(h * 7) % 10}", None if h % 5 == 0 else f"f{h % 3}", h, "2024-02-01")
            for d in (1, 2, 3)
            for h in range(24)
        ],
    )


def test_report_of_a_well_kept_table(spark, rows, tmp_path):
    append_landing(rows, FEED, str(tmp_path / "l"))
    assert report(spark, str(tmp_path / "l")) == {d: (24, 1, 0, 0) for d in (1, 2, 3)}


def test_report_finds_disorder_and_overlaps(spark, rows, tmp_path):
    path = str(tmp_path / "l")
    rows.orderBy("period").coalesce(1).write.partitionBy("partition_date").parquet(path)
    # r0 r7 r4 r1 r8 r5 r2 r9 r6 r3 and again: seven falls in each ten, and nulls before texts
    keys = [(f"r{(h * 7) % 10}", "" if h % 5 == 0 else f"f{h % 3}") for h in range(24)]
    falls = sum(b < a for a, b in zip(keys, keys[1:]))
    assert report(spark, path) == {d: (24, 1, falls, 0) for d in (1, 2, 3)}
    append_landing(rows.where("partition_date = date'2024-01-02'"), FEED, path)
    assert report(spark, path)[2] == (48, 2, falls, 1)
    assert report(spark, path)[3] == (24, 1, falls, 0)


def test_stretches_of_a_file_are_joined(spark, rows, tmp_path):
    """Batches of a few rows: a fall between two batches counts, too."""
    path = str(tmp_path / "l")
    rows.orderBy("period").coalesce(1).write.partitionBy("partition_date").parquet(path)
    whole = report(spark, path)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        assert report(spark, path) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_recluster_mends_a_hot_day(spark, tmp_path):
    """A day with a third of the rows, in overlapping files, becomes several files that don't."""
    house = Warehouse(spark, str(tmp_path))
    path = house.path(FEED.landing_table)
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20).cast("int"))
    rows = spark.range(0, 6000, numPartitions=4).select(
        F.concat(day.cast("string"), F.format_string("T%02d", F.col("id") % 24)).alias("period"),
        F.concat(F.lit("r"), (F.col("id") * 7919) % 601).alias("respondent"),
        F.lit("R").alias("respondent_name"), F.lit("wnd").alias("fueltype"), F.lit("Wind").alias("type_name"),
        F.col("id").cast("decimal(38,9)").alias("value"), F.lit("mwh").alias("value_units"),
        F.lit("2024-02-01").cast("timestamp").alias("ingestion_time"), day.alias("partition_date"),
    )
    for part in (0, 1):
        append_landing(rows.where(F.floor(F.col("value") / 20) % 2 == part), FEED, path)
    before = sorted(map(str, read_landing(spark, path, FEED).collect()))
    files = {p: p.stat().st_mtime_ns for p in Path(path).glob("partition_date=2024-01-03/*.parquet")}
    assert report(spark, path)[8][3] > 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        recluster_days(spark, path, FEED, [date(2024, 1, 8)])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = report(spark, path)
    assert hot[8][0] > 2000 and hot[8][1] > 1 and hot[8][2:] == (0, 0)
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())
    assert jobs.recluster(house, FEED) == [date(2024, 1, d) for d in range(1, 21) if d != 8]
    assert jobs.recluster(house, FEED) == []
    assert sorted(map(str, read_landing(spark, path, FEED).collect())) == before


def test_prefix_sums_of_many_values(spark):
    sizes = spark.range(2000).select(((F.col("id") * 37) % 2003).alias("k"), (F.col("id") % 7).alias("size"))
    got = [(r["k"], r["start"]) for r in running_totals(sizes, "k").orderBy("k").collect()]
    rows = sorted((r["k"], r["size"]) for r in sizes.collect())
    starts = [0, *accumulate(s for _, s in rows)][:-1]
    assert got == [(k, s) for (k, _), s in zip(rows, starts)]


def test_no_task_sums_all_values(spark):
    """The one window without a partition is over the sums of the shuffle's partitions."""
    sizes = spark.range(2000).select(F.col("id").alias("k"), F.lit(1).alias("size"))
    plan = planned(running_totals(sizes, "k"))
    single = [x for x in plan.splitlines() if "SinglePartition" in x]
    assert plan.count("Window ") == 2 and len(single) == 1
    below = plan[plan.index("SinglePartition") :]
    assert "HashAggregate(keys=[part" in below.split("SinglePartition")[1].split("Exchange")[0]


def test_page_of_rows_with_missing_and_equal_periods(spark):
    rows = spark.range(100).select(F.when(F.col("id") % 4 > 0, F.lit("p")).alias("period"), "id")
    key = ["period", "id"]
    paged = [r["id"] for p in range(11) for r in page_slice(rows, key, p, 10).orderBy(*key).collect()]
    assert paged == [r["id"] for r in rows.orderBy(*key).collect()]
