"""B10-B12, D4, G3, C4."""

from datetime import date
from decimal import Decimal

import pytest
from plans import count, planned
from pyspark.sql import functions as F

from wattframe.feeds import FEEDS
from wattframe.operators.increments import (
    beyond_high_water_mark,
    high_water_mark,
    incoming,
    mode_for,
    within_window,
)
from wattframe.operators.latest import latest_readings
from wattframe.operators.staging import stage
from wattframe.operators.upsert import upsert

FEED = FEEDS["generation"]
AS_OF = "2024-01-20"


def readings(make_landing, rows):
    return latest_readings(stage(make_landing("generation", rows), FEED), FEED)


def day(d, value, who="a", ingested="2024-02-01"):
    return (f"2024-01-{d:02d}T01", who, "w", value, ingested)


def values(frame):
    return sorted((r["recorded_date"].day, r["respondent_id"], int(r["num_units"])) for r in frame.collect())


def test_mode():
    assert mode_for(date(2024, 1, 2), date(2024, 1, 2)) == "refresh"
    assert mode_for(date(2024, 1, 1), date(2024, 1, 2)) == "backfill"


def test_refresh_window_is_inclusive(make_landing):
    rows = readings(make_landing, [day(d, d) for d in (12, 13, 14, 20)])
    assert [v for _, _, v in values(rows.where(within_window(AS_OF, 7)))] == [13, 14, 20]


def test_backfill_takes_only_newer_days(make_landing):
    target = readings(make_landing, [day(10, 1), day(12, 1)])
    rows = readings(make_landing, [day(d, d) for d in (11, 12, 13)])
    assert high_water_mark(target).first()[0] == date(2024, 1, 12)
    assert [v for _, _, v in values(rows.where(beyond_high_water_mark(target)))] == [13]


def test_backfill_on_an_empty_target_selects_nothing(make_landing):
    rows = readings(make_landing, [day(11, 1)])
    empty = rows.where("false")
    assert high_water_mark(empty).first()[0] is None
    assert rows.where(beyond_high_water_mark(empty)).count() == 0


def test_incoming_modes(make_landing):
    rows = readings(make_landing, [day(1, 1), day(20, 2)])
    assert incoming(rows, "full").count() == 2
    assert incoming(rows, "refresh", as_of=AS_OF).count() == 1
    assert incoming(rows, "backfill", target=rows).count() == 0
    with pytest.raises(ValueError):
        incoming(rows, "refresh")
    with pytest.raises(ValueError):
        incoming(rows, "backfill")
    with pytest.raises(ValueError):
        incoming(rows, "weekly")


def test_upsert_replaces_adds_and_keeps(make_landing):
    target = readings(make_landing, [day(1, 1), day(15, 1), day(16, 1), day(16, 1, "b")])
    source = readings(make_landing, [day(15, 2), day(16, 2), day(20, 2), day(16, 2, "c")])
    merged = upsert(target, source, FEED, AS_OF)
    assert values(merged) == [
        (1, "A", 1), (15, "A", 2), (16, "A", 2), (16, "B", 1), (16, "C", 2), (20, "A", 2),
    ]
    assert merged.schema.names == list(FEED.reading_columns)


def test_upsert_replaces_with_null_measures_too(make_landing):
    feed = FEEDS["demand_forecast"]
    frames = [
        latest_readings(stage(make_landing(feed.name, [("2024-01-18T01", "a", "d", v, "2024-02-01")]), feed), feed)
        for v in (5, None)
    ]
    assert [r["num_units"] for r in upsert(*frames, feed, AS_OF).collect()] == [None]


def test_upsert_is_idempotent_within_the_bound(make_landing):
    target = readings(make_landing, [day(d, 1) for d in range(10, 19)])
    source = readings(make_landing, [day(d, 2) for d in range(13, 21)])
    once = upsert(target, source, FEED, AS_OF)
    assert values(upsert(once, source, FEED, AS_OF)) == values(once)


def test_source_older_than_the_bound_is_added_again(make_landing):
    """Parity: a 10-day source with a 7-day bound duplicates the three older days."""
    target = readings(make_landing, [day(d, 1) for d in range(8, 20)])
    source = readings(make_landing, [day(d, 2) for d in range(10, 21)])
    merged = upsert(target, source, FEED, AS_OF, merge_days=7)
    twice = merged.groupBy(*FEED.key).count().where("count > 1")
    assert sorted(r["recorded_date"].day for r in twice.collect()) == [10, 11, 12]


def test_duplicate_target_rows_are_all_replaced(make_landing):
    one = readings(make_landing, [day(15, 1)])
    merged = upsert(one.union(one), readings(make_landing, [day(15, 7)]), FEED, AS_OF)
    assert [v for _, _, v in values(merged)] == [7, 7]


def test_upsert_only_exchanges_the_target(spark, make_landing, tmp_path):
    rows = make_landing("generation", [day(d, 1) for d in range(10, 19)])
    readings(make_landing, [day(1, 1)]).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    plan = planned(upsert(target, latest_readings(stage(rows, FEED), FEED), FEED, AS_OF))
    assert count(plan, "SortMergeJoin") == 1 and "FullOuter" in plan
    assert count(plan, "Exchange") == 2  # one for the target, one inside the source's de-duplication


def test_refresh_equals_full_rebuild_on_its_days(make_landing):
    first = [day(d, 1) for d in range(10, 18)]
    late = [day(d, 2, ingested="2024-02-02") for d in range(13, 21)]
    staged = stage(make_landing("generation", first + late), FEED)
    built = readings(make_landing, first)
    refreshed = upsert(built, latest_readings(incoming(staged, "refresh", as_of=AS_OF), FEED), FEED, AS_OF)
    assert values(refreshed) == values(latest_readings(staged, FEED))
    assert all(isinstance(r["num_units"], Decimal) for r in refreshed.select(F.col("num_units")).collect())
