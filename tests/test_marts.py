"""B13, B14, B20, D2, F1, S1-S5, D5, D6, F2, F5, F6, E5, A17, A18."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from plans import count, planned
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wattframe.feeds import FEEDS
from wattframe.functions.grid import date_from_text
from wattframe.operators import series
from wattframe.operators.latest import latest_readings
from wattframe.operators.marts import by_fuel_and_size, marts_forecast
from wattframe.operators.staging import stage
from wattframe.sources.marts import MART_SCHEMAS, coerce_mart, load_marts, read_mart

FEED = FEEDS["demand_forecast"]


def forecast(make_landing, rows, **kw):
    staged = stage(make_landing(FEED.name, rows), FEED)
    return marts_forecast(latest_readings(staged, FEED), "2024-01-31", **kw)


def test_forecast_labels_nulls_and_horizon(make_landing):
    t = "2024-02-01"
    rows = [
        ("2024-01-01T00", "a", "d", 1, t),  # exactly 30 days back: kept
        ("2023-12-31T23", "a", "d", 100, t),
        ("2024-01-05T03", "a", "df", 2, t),
        ("2024-01-05T03", "b", "df", 3, t),
        ("2024-01-05T03", "c", "df", None, t),
        ("2024-01-05T03", "a", "ng", None, t),
        ("2024-01-05T03", "a", "ti", 9, t),  # another type: left out
    ]
    got = {
        (r["recorded_date"].isoformat(), r["recorded_hour"], r["demand_type"]): r["value"]
        for r in forecast(make_landing, rows).collect()
    }
    assert got == {
        ("2024-01-01", 0, "Actual Demand"): 1,
        ("2024-01-05", 3, "Demand Forecast"): 5,
        ("2024-01-05", 3, "Net Generation"): None,  # only nulls
    }


def test_horizon_defaults_to_the_current_date(make_landing):
    today = date.today()
    rows = [(f"{today - timedelta(days=n)}T03", "a", "d", n, "2024-02-01") for n in (3, 28, 33)]
    staged = stage(make_landing(FEED.name, rows), FEED)
    got = marts_forecast(latest_readings(staged, FEED)).collect()
    assert sorted(int(r["value"]) for r in got) == [3, 28]


def test_forecast_respondents(spark, make_landing):
    rows = [("2024-01-05T03", who, "d", 1, "2024-02-01") for who in ("a", "b", "rollup")]
    known = spark.createDataFrame([("A",), ("B",), ("B",)], "respondent_id string")
    assert forecast(make_landing, rows, respondents=known).first()["value"] == 2
    assert forecast(make_landing, rows).first()["value"] == 3


@pytest.fixture(scope="module")
def mart(spark):
    rows = [
        (2023, "Wind", "renewable", 30), (2023, "Coal", "non-renewable", 10), (2023, "Solar", "renewable", 60),
        (2024, "Wind", "renewable", 0), (2024, "Coal", "non-renewable", 0), (2024, "Solar", "renewable", 5),
        (None, "Wind", "renewable", 7), (2025, "Wind", "renewable", None), (2025, "Coal", "non-renewable", 8),
    ]
    return spark.createDataFrame(
        [(y, f, e, None if v is None else Decimal(v)) for y, f, e, v in rows], MART_SCHEMAS["marts_generation"]
    )


def test_reading_order(mart):
    got = [(r["fuel"], r["total_generation"]) for r in by_fuel_and_size(mart).collect()]
    assert got == [
        ("Coal", 10), ("Coal", 8), ("Coal", 0), ("Solar", 60), ("Solar", 5),
        ("Wind", 30), ("Wind", 7), ("Wind", 0), ("Wind", None),
    ]


def test_absolute_series(mart):
    got = series.fuel_series_absolute(mart, ["Solar"])
    assert got.columns == ["Year", "Fuel", "energy_type", "total_generation", "value"]
    assert {r["Year"]: r["value"] for r in got.collect()} == {2023: 60e-6, 2024: 5e-6}


def test_share_is_of_the_chosen_fuels(mart):
    got = {(r["Year"], r["Fuel"]): r["value"] for r in series.fuel_series_share(mart, ["Wind", "Coal"]).collect()}
    assert got == {
        (2023, "Wind"): 75.0,
        (2023, "Coal"): 25.0,
        (2024, "Wind"): None,  # zero total
        (2024, "Coal"): None,
        (None, "Wind"): None,
        (2025, "Wind"): None,
        (2025, "Coal"): 100.0,
    }


def test_share_reads_the_mart_once(mart, spark, tmp_path):
    mart.write.parquet(str(tmp_path / "m"))
    plan = planned(series.fuel_series_share(spark.read.parquet(str(tmp_path / "m")), ["Wind"]))
    assert count(plan, "FileScan") == 1 and count(plan, "Exchange") == 1
    assert "PushedFilters: [IsNotNull(fuel), EqualTo(fuel,Wind)]" in plan


def test_energy_mix(mart):
    got = [tuple(r) for r in series.energy_mix(mart).collect()]
    assert got == [
        (2023, "non-renewable", 10), (2023, "renewable", 90),
        (2024, "non-renewable", 0), (2024, "renewable", 5), (2025, "non-renewable", 8), (2025, "renewable", 0),
    ]


def test_distinct_fuels(mart):
    assert [r[0] for r in series.distinct_fuels(mart).collect()] == ["Coal", "Solar", "Wind"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_demand_hours_do_not_shift_with_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [(date(2024, 3, 10), 2, "Actual Demand", Decimal(1)), (date(2024, 3, 10), 23, "Actual Demand", None)]
        got = series.demand_series(spark.createDataFrame(rows, MART_SCHEMAS["marts_forecast"]))
        assert dict(got.dtypes)["datetime"] == "timestamp_ntz"
        assert [r["datetime"] for r in got.collect()] == [datetime(2024, 3, 10, 2), datetime(2024, 3, 10, 23)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.fixture(scope="module")
def flows(spark):
    usa, d = "United States of America", date(2024, 1, 1)
    rows = [(d, usa, "Canada", 1), (d, "Canada", usa, 2), (d, "Mexico", usa, 3), (d, "Mexico", "Canada", 4)]
    return spark.createDataFrame([(*r[:3], Decimal(r[3])) for r in rows], MART_SCHEMAS["marts_interchange"])


def test_flow_series(flows):
    got = series.flow_series(flows, ["USA → Canada", "Mexico → Canada"])
    assert got.columns[-1] == "flow"
    assert sorted((r["flow"], r["provider_country"], int(r["interchange"])) for r in got.collect()) == [
        ("Mexico → Canada", "Mexico", 4),
        ("USA → Canada", "USA", 1),
    ]


def test_flow_list_holds_every_pair(flows):
    every = ["Canada → USA", "Mexico → Canada", "Mexico → USA", "USA → Canada"]
    assert [r[0] for r in series.distinct_flows(flows).collect()] == every
    assert [r[0] for r in series.default_flows(flows).collect()] == every[:2]


def test_coercion(spark):
    rows = [("12.5", "2024.0", None, "2024.01.31", "x"), ("n/a", "y", "renewable", "2024-01-31", " 7 "), (None,) * 5]
    raw = spark.createDataFrame(
        rows, "total_generation string, year string, energy_type string, recorded_date string, interchange string"
    )
    got = [tuple(r) for r in coerce_mart(raw).collect()]
    day = date(2024, 1, 31)
    assert got == [
        (12.5, 2024, "Unknown", day, None),
        (None, None, "renewable", day, 7.0),
        (None, None, "Unknown", None, None),
    ]


def test_date_text(spark):
    texts = ["2024.01.31", "2024-01-31", "20240131", "Jan. 31, 2024", "2024-01-31 00:00:00", " ", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(date_from_text(frame.t)).collect()]
    assert got == [date(2024, 1, 31)] * 5 + [None, None]
    with pytest.raises(PySparkException, match="no date: soon"):
        spark.createDataFrame([("soon",)], "t string").select(date_from_text(F.col("t"))).collect()


def test_mart_or_csv(spark, mart, tmp_path):
    csv = str(tmp_path / "generation.csv")
    (tmp_path / "generation.csv").write_text("year,fuel,energy_type,total_generation\n2025,Wind,renewable,12\n")
    spark.catalog.dropTempView("marts_generation")
    tables, tags = load_marts(spark, {"marts_generation": csv})
    assert tags == {"marts_generation": "csv"}
    assert [tuple(r) for r in tables["marts_generation"].collect()] == [(2025, "Wind", "renewable", Decimal(12))]
    mart.createOrReplaceTempView("marts_generation")
    try:
        frame, source = read_mart(spark, "marts_generation", csv)
        assert source == "table" and frame.count() == mart.count()
        assert dict(frame.dtypes)["total_generation"] == "double"
    finally:
        spark.catalog.dropTempView("marts_generation")
