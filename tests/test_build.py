"""Whole builds on disk."""

import json
from datetime import date
from pathlib import Path

import pytest
from plans import planned
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from wattframe.feeds import FEEDS
from wattframe.operators.increments import incoming, within_window
from wattframe.operators.latest import latest_readings
from wattframe.operators.staging import stage
from wattframe.plans.build import build_dimensions, build_readings, run
from wattframe.plans.warehouse import Warehouse
from wattframe.sources.landing import append_landing, read_landing
from wattframe.sources.seeds import SEED_COLUMNS, write_seed
from wattframe.streaming.landing import stream_landing

FEED = FEEDS["generation"]
ENTITIES = {
    "generation": ("aaa", "wnd"),
    "interchange": ("aaa", "bbb"),
    "demand_forecast": ("aaa", "d"),
    "demand_by_subregion": ("sub", "aaa"),
}


def day(d, value, ids, ingested="2024-02-01"):
    return (f"2024-01-{d:02d}T01", *ids, value, ingested)


@pytest.fixture
def warehouse(spark, tmp_path, authorities, sources):
    house = Warehouse(spark, str(tmp_path))
    columns = SEED_COLUMNS["balancing_authorities"]
    full = authorities.selectExpr(*(c if c in authorities.columns else f"cast(null as string) {c}" for c in columns))
    write_seed(full, house.path("balancing_authorities"))
    write_seed(sources, house.path("energy_sources"))
    return house


def land(house, make_landing, name, days, value, ingested="2024-02-01"):
    rows = [day(d, value, ENTITIES[name], ingested) for d in days]
    append_landing(make_landing(name, rows), FEEDS[name], house.path(f"landing_{name}"))


def stored(house, name="generation"):
    rows = house.readings(FEEDS[name]).collect()
    return sorted((r["recorded_date"].day, int(r["num_units"])) for r in rows)


def files(house):
    root = Path(house.path("int_generation"))
    return {p.parent.name: (p.name, p.stat().st_mtime_ns) for p in root.glob("*/*.parquet")}


def test_full_run(spark, warehouse, make_landing):
    for name in FEEDS:
        land(warehouse, make_landing, name, [1, 2, 2, 3], 5)
        land(warehouse, make_landing, name, [2], 9, "2024-02-02")
    marts = run(warehouse, "2024-01-31")
    for name in FEEDS:
        assert stored(warehouse, name) == [(1, 5), (2, 9), (3, 5)]
        assert spark.table(f"stg_{name}").count() == 5
    assert [tuple(r) for r in marts["marts_generation"].collect()] == [(2024, "Wind", "renewable", 19)]
    usa = "United States of America"
    assert {r["recorded_date"].day: (r[1], r[2], int(r[3])) for r in marts["marts_interchange"].collect()} == {
        1: (usa, "Canada", 5), 2: (usa, "Canada", 9), 3: (usa, "Canada", 5),
    }
    assert sorted(int(r["value"]) for r in marts["marts_forecast"].collect()) == [5, 5, 9]
    assert spark.table("fuel_lookup").count() == 4
    assert spark.table("dim_generation").count() == 3 and spark.table("marts_forecast").count() == 3
    assert spark.read.parquet(warehouse.path("marts_generation")).count() == 1
    again = run(warehouse, "2024-01-31")  # a rebuild replaces, never adds
    assert again["marts_generation"].first()["total_generation"] == 19


def test_refresh_rewrites_only_the_window(warehouse, make_landing):
    land(warehouse, make_landing, "generation", range(1, 19), 1)
    build_readings(warehouse, FEED, "full", "2024-01-18")
    before = files(warehouse)
    land(warehouse, make_landing, "generation", range(5, 21), 2, "2024-02-02")
    for _ in range(2):  # running it again changes nothing
        build_readings(warehouse, FEED, "refresh", "2024-01-20", 7)
        assert stored(warehouse) == [(d, 1) for d in range(1, 13)] + [(d, 2) for d in range(13, 21)]
    after = files(warehouse)
    for d in range(1, 13):
        assert after[f"recorded_date=2024-01-{d:02d}"] == before[f"recorded_date=2024-01-{d:02d}"]


def rows_of(marts):
    return {n: sorted(map(tuple, m.collect()), key=repr) for n, m in marts.items()}


def test_window_rebuild_equals_whole_rebuild(warehouse, make_landing):
    """Readings of two years; a refresh that only touches the last days of the second."""
    for name in FEEDS:
        old = [(f"2023-{m:02d}-15T03", *ENTITIES[name], m, "2023-12-31") for m in range(1, 13)]
        append_landing(make_landing(name, old), FEEDS[name], warehouse.path(f"landing_{name}"))
        land(warehouse, make_landing, name, range(1, 19), 5)
    run(warehouse, "2024-01-18")
    dim = Path(warehouse.path("dim_generation"))
    untouched = {p: p.stat().st_mtime_ns for p in dim.glob("recorded_date=2023-*/*.parquet")}
    for name in FEEDS:
        land(warehouse, make_landing, name, range(10, 21), 7, "2024-02-02")
    partial = rows_of(run(warehouse, "2024-01-20", "refresh", rebuild_all=False))
    assert len(untouched) == 12 and all(p.stat().st_mtime_ns == t for p, t in untouched.items())
    assert partial["marts_generation"] == [
        (2023, "Wind", "renewable", 78), (2024, "Wind", "renewable", 12 * 5 + 8 * 7),
    ]
    whole = rows_of(run(warehouse, "2024-01-20", "refresh"))
    assert whole == partial
    assert len(whole["marts_interchange"]) == 32


def test_window_rebuild_without_tables_is_whole(warehouse, make_landing):
    for name in FEEDS:
        land(warehouse, make_landing, name, [1, 18], 5)
    marts = run(warehouse, "2024-01-18", "refresh", rebuild_all=False)
    assert [tuple(r)[3] for r in marts["marts_generation"].collect()] == [10]


def test_refresh_keeps_days_that_the_source_lacks(warehouse, make_landing):
    """An empty result of a day never deletes what is stored."""
    land(warehouse, make_landing, "generation", [14, 15, 16], 1)
    build_readings(warehouse, FEED, "full", "2024-01-16")
    stage_only = read_landing(warehouse.spark, warehouse.path("landing_generation"), FEED)
    assert stage_only.count() == 3
    other = Warehouse(warehouse.spark, warehouse.root + "/other")
    land(other, make_landing, "generation", [15], 2, "2024-02-02")
    moved = warehouse.readings(FEED)
    moved.write.partitionBy("recorded_date").parquet(other.path("int_generation"))
    build_readings(other, FEED, "refresh", "2024-01-16", 7)
    assert stored(other) == [(14, 1), (15, 2), (16, 1)]


def test_wide_window_duplicates_keys_as_documented(warehouse, make_landing):
    land(warehouse, make_landing, "generation", range(10, 19), 1)
    build_readings(warehouse, FEED, "full", "2024-01-18")
    build_readings(warehouse, FEED, "refresh", "2024-01-18", window_days=10, merge_days=5)
    assert [d for d, _ in stored(warehouse)] == sorted([*range(10, 19), 10, 11, 12])


def test_backfill_adds_newer_days_only(warehouse, make_landing):
    land(warehouse, make_landing, "generation", [1, 2], 1)
    build_readings(warehouse, FEED, "backfill", "2024-01-31")  # no table yet: built in full
    before = files(warehouse)
    land(warehouse, make_landing, "generation", [1, 2, 3, 25], 2, "2024-02-02")
    build_readings(warehouse, FEED, "backfill", "2024-01-31")
    assert stored(warehouse) == [(1, 1), (2, 1), (3, 2), (25, 2)]
    assert all(files(warehouse)[f] == stamp for f, stamp in before.items())


def test_backfill_into_an_empty_table_is_a_full_build(spark, warehouse, make_landing):
    land(warehouse, make_landing, "generation", [1, 2], 1)
    spark.createDataFrame([], FEED.readings_schema).write.parquet(warehouse.path("int_generation"))
    build_readings(warehouse, FEED, "backfill", "2024-01-31")
    assert stored(warehouse) == [(1, 1), (2, 1)]


def test_full_build_drops_days_that_are_gone(warehouse, make_landing, spark):
    land(warehouse, make_landing, "generation", [1, 2], 1)
    build_readings(warehouse, FEED, "full", "2024-01-31")
    other = Warehouse(spark, warehouse.root)
    keep = read_landing(spark, warehouse.path("landing_generation"), FEED).where("partition_date = date'2024-01-02'")
    rows = keep.collect()
    spark.createDataFrame(rows, FEED.landing_schema).write.mode("overwrite").partitionBy("partition_date").parquet(
        other.path("landing_generation")
    )
    build_readings(other, FEED, "full", "2024-01-31")
    assert stored(other) == [(2, 1)]


def test_unknown_mode(warehouse):
    with pytest.raises(ValueError):
        build_readings(warehouse, FEED, "sometimes", "2024-01-31")


def test_streamed_pages_land_once(spark, tmp_path):
    pages, landing, mark = (str(tmp_path / n) for n in ("pages", "landing", "mark"))
    (tmp_path / "pages" / "2024").mkdir(parents=True)

    def deliver(name, value):
        row = {
            "period": "2024-01-05T07", "respondent": "aaa", "respondent-name": "A", "fueltype": "wnd",
            "type-name": "Wind", "value": value, "value-units": "mwh",
        }
        text = json.dumps({"response": {"total": 1, "data": [row]}})
        (tmp_path / "pages" / "2024" / name).write_text(text)
        stream_landing(spark, pages, FEED, landing, mark).awaitTermination(120)
        return read_landing(spark, landing, FEED)

    assert deliver("1.json", 4).count() == 1
    table = deliver("2.json", "6.5")  # a correction: one more row, the first page is not taken again
    assert table.count() == 2
    assert {r["partition_date"] for r in table.collect()} == {date(2024, 1, 5)}
    assert [float(r["num_units"]) for r in latest_readings(stage(table, FEED), FEED).collect()] == [6.5]


def test_stream_refuses_error_pages(spark, tmp_path):
    pages, landing, mark = (str(tmp_path / n) for n in ("pages", "landing", "mark"))
    (tmp_path / "pages").mkdir()
    row = {"period": "2024-01-05T07", "respondent": "aaa", "fueltype": "wnd", "value": "1"}
    good = json.dumps({"response": {"total": 1, "data": [row]}})
    (tmp_path / "pages" / "1.json").write_text(good)
    bad = tmp_path / "pages" / "2.json"
    for text in ({"error": "slow down", "code": 429}, {"response": {"data": [row]}}):
        bad.write_text(json.dumps(text))
        with pytest.raises(StreamingQueryException, match="no response or declare no total"):
            stream_landing(spark, pages, FEED, landing, mark).awaitTermination(120)
        assert not (tmp_path / "landing").exists()
    bad.write_text(good)
    stamp = "2024-02-01 06:00:00"
    stream_landing(spark, pages, FEED, landing, mark, ingestion_time=stamp).awaitTermination(120)
    found = read_landing(spark, landing, FEED).select(F.col("ingestion_time").cast("string")).collect()
    assert [r[0] for r in found] == [stamp, stamp]


def test_window_and_high_water_mark_prune_days(spark, warehouse, make_landing):
    land(warehouse, make_landing, "generation", range(1, 19), 1)
    build_readings(warehouse, FEED, "full", "2024-01-18")
    staged = stage(warehouse.landing(FEED), FEED)
    target = warehouse.readings(FEED)
    for taken in (
        incoming(staged, "refresh", as_of="2024-01-18"),
        incoming(staged, "backfill", target=target),
        target.where(within_window("2024-01-18")),
    ):
        scans = [line for line in planned(taken).splitlines() if "FileScan" in line]
        filters = scans[0].split("PartitionFilters: [")[1].split("], PushedFilters")[0]
        assert ">=" in filters or "> Subquery" in filters or "> scalar-subquery" in filters


def test_dimension_tables_are_written_by_day(warehouse, make_landing):
    for name in ("generation", "interchange"):
        land(warehouse, make_landing, name, range(1, 19), 1)
        build_readings(warehouse, FEEDS[name], "full", "2024-01-18")
    build_dimensions(warehouse)
    for name in ("dim_generation", "dim_interchange"):
        days = sorted(p.name for p in Path(warehouse.path(name)).glob("recorded_date=*"))
        assert len(days) == 18
        assert warehouse.table(name).count() == 18


def test_dimension_too_large_to_broadcast(warehouse, make_landing, monkeypatch):
    for name in ("generation", "interchange"):
        land(warehouse, make_landing, name, [1, 2, 3], 1)
        build_readings(warehouse, FEEDS[name], "full", "2024-01-18")
    small = [sorted(d.collect()) for d in build_dimensions(warehouse)]
    monkeypatch.setattr("wattframe.plans.warehouse.SEED_BROADCAST_BYTES", 0)
    warehouse.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert [sorted(d.collect()) for d in build_dimensions(warehouse)] == small
    finally:
        warehouse.spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
