"""Marts kept by change, safe rebuilds, cached marts."""

import random
from datetime import date
from decimal import Decimal

import pytest
from plans import jobs_of, planned
from pyspark.sql import functions as F
from test_build import ENTITIES, land, rows_of, warehouse  # noqa: F401

from wattframe.feeds import FEEDS
from wattframe.operators.dimensions import dim_generation, dim_interchange
from wattframe.operators.totals import apply_change, shown, totals
from wattframe.plans import build as build_module
from wattframe.plans.build import build_dimensions, build_readings, run
from wattframe.plans.cache import MartCache
from wattframe.plans.kept import KeptMart
from wattframe.plans.warehouse import BUILT, Warehouse
from wattframe.sources import files
from wattframe.sources.landing import append_landing
from wattframe.sources.seeds import write_seed

MARTS = ("marts_generation", "marts_interchange", "marts_forecast")


def test_change_equals_computing_again(spark):
    """Random corrections, new and deleted groups, unknown measures and unknown keys."""
    pick = random.Random(9)

    def lines(rows):
        return spark.createDataFrame(rows, "k string, v decimal(38,9)")

    def some(n):
        return [
            (pick.choice(["a", "b", "c", "d", None]), pick.choice([None, Decimal(pick.randint(-9, 9)) / 8]))
            for _ in range(n)
        ]

    rows = some(30)
    kept = totals(lines(rows), ["k"], "v")
    for _ in range(4):
        pick.shuffle(rows)
        replaced, rows = rows[:12], rows[12:]
        added = some(pick.randint(0, 6))
        rows = rows + added
        kept = apply_change(kept, totals(lines(replaced), ["k"], "v"), totals(lines(added), ["k"], "v"), ["k"])
    again = totals(lines(rows), ["k"], "v")
    assert kept.dtypes == again.dtypes
    assert sorted(kept.collect(), key=repr) == sorted(again.collect(), key=repr)
    plain = lines(rows).groupBy("k").agg(F.sum("v").alias("v"))
    assert sorted(shown(kept, ["k"], "v").collect(), key=repr) == sorted(plain.collect(), key=repr)


def test_all_lines_taken_off_leave_nothing(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None)], "k string, v int")
    kept = totals(rows, ["k"], "v")
    assert apply_change(kept, kept, kept.limit(0), ["k"]).count() == 0


def two_years(house, make_landing, value=5):
    for name in FEEDS:
        old = [(f"2023-{m:02d}-15T03", *ENTITIES[name], m, "2023-12-31") for m in range(1, 13)]
        append_landing(make_landing(name, old), FEEDS[name], house.path(f"landing_{name}"))
        land(house, make_landing, name, range(1, 19), value)


def whole(house, as_of):
    return rows_of(run(house, as_of, "refresh"))


def test_refreshes_in_a_row_equal_a_whole_rebuild(warehouse, make_landing):  # noqa: F811
    two_years(warehouse, make_landing)
    run(warehouse, "2024-01-18")
    for turn, last in enumerate((20, 21, 21, 25)):
        for name in FEEDS:
            land(warehouse, make_landing, name, range(last - 6, last + 1), 7 + turn, f"2024-02-{2 + turn:02d}")
        partial = rows_of(run(warehouse, f"2024-01-{last}", "refresh", rebuild_all=False))
    assert {n: KeptMart(warehouse, n).state()[0] for n in MARTS} == dict.fromkeys(MARTS, 4)
    assert len(partial["marts_forecast"]) == 25  # 30 days back there is 2023-12-26 and later
    assert partial == whole(warehouse, "2024-01-25")


def test_days_before_the_forecast_horizon_go(warehouse, make_landing):  # noqa: F811
    two_years(warehouse, make_landing)
    run(warehouse, "2024-01-18")
    partial = rows_of(run(warehouse, "2024-02-12", "refresh", rebuild_all=False))
    assert [r[0] for r in partial["marts_forecast"]] == [date(2024, 1, d) for d in range(13, 19)]
    assert partial == whole(warehouse, "2024-02-12")
    # an earlier run needs days that the mart has dropped: it is computed whole
    back = rows_of(run(warehouse, "2024-01-18", "refresh", rebuild_all=False))
    assert len(back["marts_forecast"]) == 18


def test_a_window_wider_than_the_horizon(warehouse, make_landing):  # noqa: F811
    two_years(warehouse, make_landing)
    run(warehouse, "2024-01-18")
    for name in FEEDS:
        land(warehouse, make_landing, name, [2, 18], 6, "2024-02-02")
    partial = rows_of(run(warehouse, "2024-01-20", "refresh", 45, rebuild_all=False))
    assert partial == rows_of(run(warehouse, "2024-01-20", "refresh", 45))


def test_a_group_that_is_gone(warehouse, make_landing, spark):  # noqa: F811
    """A fuel that is no longer known takes its rows out of the window, and its group."""
    land(warehouse, make_landing, "generation", [14, 15], 5)
    rows = [("2024-01-15T01", "aaa", "col", 3, "2024-02-01")]
    append_landing(make_landing("generation", rows), FEEDS["generation"], warehouse.path("landing_generation"))
    for name in FEEDS:
        if name != "generation":
            land(warehouse, make_landing, name, [14, 15], 5)
    marts = run(warehouse, "2024-01-16")
    assert sorted(r["fuel"] for r in marts["marts_generation"].collect()) == ["Coal", "Wind"]
    known = warehouse.seed("energy_sources").where("energy_source_code <> 'COL'").collect()
    write_seed(spark.createDataFrame(known), warehouse.path("energy_sources"))
    partial = rows_of(run(warehouse, "2024-01-16", "refresh", rebuild_all=False))
    assert partial["marts_generation"] == [(2024, "Wind", "renewable", 10)]


@pytest.mark.parametrize("where", ["build_readings", "build_dimensions", "follow_window"])
def test_a_broken_run_is_made_good(warehouse, make_landing, monkeypatch, where):  # noqa: F811
    """Whatever was rewritten before the failure, the next refresh gives the right marts."""
    two_years(warehouse, make_landing)
    run(warehouse, "2024-01-18")
    for name in FEEDS:
        land(warehouse, make_landing, name, range(13, 21), 7, "2024-02-02")
    real = getattr(build_module, where)

    def broken(*args, **kwargs):
        real(*args, **kwargs) if where == "build_dimensions" else None
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(build_module, where, broken)
        with pytest.raises(OSError):
            run(warehouse, "2024-01-20", "refresh", rebuild_all=False)
    for name in FEEDS:
        land(warehouse, make_landing, name, range(12, 23), 8, "2024-02-03")
    # a wider window than that of the broken run
    partial = rows_of(run(warehouse, "2024-01-22", "refresh", 10, rebuild_all=False))
    assert partial == rows_of(run(warehouse, "2024-01-22", "refresh", 10))


def test_a_refresh_reads_its_window_only(warehouse, make_landing):  # noqa: F811
    two_years(warehouse, make_landing)
    run(warehouse, "2024-01-18")
    for lines in build_module._mart_lines(warehouse, "2024-01-18").values():
        scans = [x for x in planned(lines(date(2024, 1, 11), None)).splitlines() if "FileScan" in x]
        assert scans and all("recorded_date" in x.split("PartitionFilters: [")[1].split("]")[0] for x in scans)


def test_a_failing_rebuild_keeps_the_old_table(warehouse, make_landing, spark):  # noqa: F811
    two_years(warehouse, make_landing)
    before = rows_of(run(warehouse, "2024-01-18"))
    failing = warehouse.table("marts_generation").withColumn(
        "total_generation", F.raise_error(F.lit("no")).cast("decimal(38,9)")
    )
    with pytest.raises(Exception, match="no"):
        warehouse.replace("marts_generation", failing)
    assert rows_of({"marts_generation": warehouse.table("marts_generation")})["marts_generation"] == (
        before["marts_generation"]
    )
    # the seeds are broken: dimension tables can't be built, and the old ones stay
    fuels = warehouse.path("energy_sources")
    spark.range(1).write.mode("overwrite").csv(fuels, header=True)
    with pytest.raises(Exception, match="CSV header"):
        run(warehouse, "2024-01-18")
    assert warehouse.table("dim_generation").count() == 30


def test_a_switch_that_was_broken_off(warehouse, make_landing):  # noqa: F811
    two_years(warehouse, make_landing)
    run(warehouse, "2024-01-18")
    files.move(warehouse.spark, warehouse.path("marts_generation"), warehouse._aside("marts_generation"))
    assert warehouse.table("marts_generation").count() == 2
    assert run(warehouse, "2024-01-18")["marts_generation"].count() == 2


def test_tables_have_their_declared_columns(warehouse, make_landing):  # noqa: F811
    two_years(warehouse, make_landing)
    run(warehouse, "2024-01-18")
    for name, schema in BUILT.items():
        got = warehouse.table(name).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in schema]


def test_dimensions_start_no_job(warehouse, make_landing):  # noqa: F811
    two_years(warehouse, make_landing)
    for name in ("generation", "interchange"):
        build_readings(warehouse, FEEDS[name], "full", "2024-01-18")
    readings = {n: warehouse.readings(FEEDS[n]) for n in ("generation", "interchange")}
    frames = []

    def work():
        fuels, authorities = warehouse.fuels(), warehouse.seed("balancing_authorities")
        frames.append(dim_generation(readings["generation"], fuels, authorities))
        frames.append(dim_interchange(readings["interchange"], authorities))

    assert jobs_of(warehouse.spark, work) == 0
    for frame in frames:
        plan = planned(frame)
        assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert [d.count() for d in build_dimensions(warehouse)] == [30, 30]


def test_cached_marts_notice_a_rebuild(warehouse, make_landing):  # noqa: F811
    two_years(warehouse, make_landing)
    run(warehouse, "2024-01-18")
    cache = MartCache(warehouse)
    first = cache.get("marts_generation")
    before = sorted(first.collect())
    again = cache.get("marts_generation")
    assert again is first and "InMemoryTableScan" in planned(again)
    # what is read again comes from the cache, not from the files
    kept = warehouse.path("marts_generation")
    files.move(warehouse.spark, kept, kept + "-away")
    assert sorted(again.collect()) == before
    files.move(warehouse.spark, kept + "-away", kept)
    for name in FEEDS:
        land(warehouse, make_landing, name, [18], 105, "2024-02-02")
    run(warehouse, "2024-01-18", "refresh", rebuild_all=False)
    fresh = cache.get("marts_generation")
    assert fresh is not first
    assert max(r["total_generation"] for r in fresh.collect()) == 17 * 5 + 105
    cache.clear()
    assert "InMemoryTableScan" not in planned(Warehouse(warehouse.spark, warehouse.root).table("marts_generation"))
