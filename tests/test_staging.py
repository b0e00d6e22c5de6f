"""B1-B6."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from plans import planned
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from wattframe.feeds import FEEDS, MEASURE
from wattframe.operators.staging import stage
from wattframe.sources.landing import append_landing, read_landing

PERIOD, INGESTED = "2024-01-05T07", "2024-01-06T01:02:03"


@pytest.mark.parametrize("name", FEEDS)
def test_types_and_case(make_landing, name):
    feed = FEEDS[name]
    staged = stage(make_landing(name, [(PERIOD, "abc", "xy", "1.5", INGESTED)]), feed)
    first, second = feed.parties
    row = staged.first().asDict()
    assert row == {
        "recorded_date": date(2024, 1, 5),
        "recorded_hour": 7,
        first.id: "ABC",
        first.name: "Name of abc",
        second.id: "XY",
        second.name: "Name of xy",
        "num_units": Decimal("1.500000000"),
        "unit": "mwh",
        "ingestion_time": datetime(2024, 1, 6, 1, 2, 3),
    }
    kinds = {f.name: f.dataType for f in staged.schema}
    assert kinds["recorded_date"] == T.DateType()
    assert kinds["recorded_hour"] == T.LongType()
    assert kinds["num_units"] == MEASURE
    assert kinds["ingestion_time"] == T.TimestampType()


@pytest.mark.parametrize("name", FEEDS)
def test_null_measure(make_landing, name):
    feed = FEEDS[name]
    row = stage(make_landing(name, [(PERIOD, "a", "b", None, INGESTED)]), feed).first()
    assert row["num_units"] == (Decimal(0) if name != "demand_forecast" else None)


@pytest.mark.parametrize("name", FEEDS)
def test_a_missing_required_column_drops_the_row(make_landing, name):
    feed = FEEDS[name]
    rows = [(PERIOD, "a", "b", 1, INGESTED, {c: None}) for c in feed.required]
    assert len(feed.required) == 6 and "value" not in feed.required
    rows.append((PERIOD, "kept", "b", 1, INGESTED))
    assert [r[feed.parties[0].id] for r in stage(make_landing(name, rows), feed).collect()] == ["KEPT"]


def test_period_without_hour_raises(make_landing):
    staged = stage(make_landing("generation", [("2024-01-05", "a", "b", 1, INGESTED)]), FEEDS["generation"])
    with pytest.raises(PySparkException):
        staged.collect()


def test_null_filters_and_date_filter_reach_the_scan(spark, make_landing, tmp_path):
    feed = FEEDS["generation"]
    rows = [(f"2024-01-{d:02d}T01", "a", "b", d, INGESTED) for d in range(1, 6)]
    append_landing(make_landing("generation", rows), feed, str(tmp_path / "l"))
    staged = stage(read_landing(spark, str(tmp_path / "l"), feed), feed)
    plan = planned(staged.where("recorded_date >= date'2024-01-04'").select("respondent_id"))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "IsNotNull(respondent)" in scan and "IsNotNull(value_units)" in scan
    assert "PartitionFilters: [isnotnull(partition_date" in scan and ">= 2024-01-04" in scan
    assert "respondent_name" not in scan and "value:decimal" not in scan
