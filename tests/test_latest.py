"""E1-E4."""

from decimal import Decimal

import pytest
from plans import count, planned
from pyspark.sql import functions as F

from wattframe.feeds import FEEDS
from wattframe.operators.latest import latest_readings
from wattframe.operators.staging import stage

P = "2024-01-05T07"


@pytest.mark.parametrize("name", FEEDS)
def test_last_write_wins_per_key(make_landing, name):
    feed = FEEDS[name]
    rows = [
        (P, "a", "x", 1, "2024-01-06T00:00:00"),
        (P, "A", "x", 2, "2024-01-08T00:00:00"),  # same key: ids are upper-cased first
        (P, "a", "x", 3, "2024-01-07T00:00:00"),  # an older correction arriving last
        (P, "a", "y", 4, "2024-01-06T00:00:00"),
        ("2024-01-05T08", "a", "x", 5, "2024-01-06T00:00:00"),
        ("2024-01-06T07", "a", "x", 6, "2024-01-06T00:00:00"),
    ]
    got = latest_readings(stage(make_landing(name, rows), feed), feed)
    assert got.columns == list(feed.reading_columns)
    assert sorted(int(r["num_units"]) for r in got.collect()) == [2, 4, 5, 6]


def test_exact_copies_collapse(make_landing):
    feed = FEEDS["interchange"]
    got = latest_readings(stage(make_landing(feed.name, [(P, "a", "b", 1, "2024-01-06")] * 5), feed), feed)
    assert got.count() == 1


def test_ties_are_resolved_the_same_way(make_landing):
    feed = FEEDS["demand_forecast"]
    rows = [(P, "a", "d", v, "2024-01-06") for v in (None, 3, 9, 4)]
    for order in (rows, rows[::-1]):
        got = latest_readings(stage(make_landing(feed.name, order), feed), feed).collect()
        assert [r["num_units"] for r in got] == [Decimal("9.000000000")]


def test_a_hot_key_is_cut_before_the_exchange(spark, make_landing):
    """A third of the rows share one key; each map task sends one of them."""
    feed = FEEDS["generation"]
    n = 30_000
    staged = spark.range(0, n, numPartitions=4).select(
        F.lit("2024-01-05").cast("date").alias("recorded_date"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("bigint").alias("recorded_hour"),
        F.lit("A").alias("respondent_id"),
        F.lit("WND").alias("fuel_id"),
        F.col("id").cast("decimal(38,9)").alias("num_units"),
        F.lit("mwh").alias("unit"),
        F.timestamp_seconds("id").alias("ingestion_time"),
    )
    got = latest_readings(staged, feed)
    plan = planned(got)
    assert count(plan, "WindowGroupLimit") == 2 and count(plan, "Exchange") == 1
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert limits[0].endswith("Final") and limits[1].endswith("Partial")
    rows = {r["recorded_hour"]: int(r["num_units"]) for r in got.collect()}
    brute = {}
    for i in range(n):
        brute[0 if i % 3 == 0 else i] = i
    assert rows == brute
