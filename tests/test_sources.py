"""A1-A13, A19, G1, G2, F3, F4."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wattframe.feeds import FEEDS, MEASURE
from wattframe.operators.calendar import ingest_windows
from wattframe.operators.paging import number_rows, page_count, page_slice
from wattframe.sources.landing import (
    append_landing,
    conform,
    extract_path,
    file_census,
    load_all,
    load_daily,
    load_exports,
    read_extracts,
    read_landing,
    write_days,
    write_extract,
)
from wattframe.sources.pages import (
    TotalMismatch,
    checked_rows,
    normalize_feed_columns,
    page_rows,
    read_pages,
    reconcile,
    stamp,
    union_pages,
)
from wattframe.sources.seeds import SEED_COLUMNS, normalize_seed_columns, read_seed, write_seed

FEED = FEEDS["generation"]
STAMP = "2024-01-06 05:00:00"


def api_row(i, value=1):
    return {
        "period": f"2024-01-05T{i % 24:02d}", "respondent": f"r{i}", "respondent-name": f"R {i}",
        "fueltype": "wnd", "type-name": "Wind", "value": value, "value-units": "mwh",
    }


def write_page(folder, n, total, rows):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / f"{n}.json").write_text(json.dumps({"response": {"total": total, "data": rows}}, indent=1))


def test_page_ingest(spark, tmp_path):
    write_page(tmp_path / "p", 0, "3", [api_row(0, "1.5"), api_row(1, 2)])  # total and value: text or number
    write_page(tmp_path / "p", 1, 3, [api_row(2, None)])
    write_page(tmp_path / "p", 2, 3, [])
    pages = read_pages(spark, str(tmp_path / "p"), FEED)
    assert reconcile(pages).first().asDict() == {"declared_rows": 3, "actual_rows": 3, "matches": True}
    rows = checked_rows(pages, STAMP)
    got = {r["respondent"]: r.asDict() for r in conform(rows, FEED).collect()}
    assert {k: v["value"] for k, v in got.items()} == {"r0": Decimal("1.5"), "r1": Decimal(2), "r2": None}
    assert got["r1"]["respondent_name"] == "R 1" and got["r1"]["value_units"] == "mwh"
    assert got["r1"]["partition_date"] == date(2024, 1, 5)
    assert got["r1"]["ingestion_time"] == datetime(2024, 1, 6, 5)


@pytest.mark.parametrize("total", [1, 3])
def test_total_mismatch_raises(spark, tmp_path, total):
    write_page(tmp_path / "p", 0, total, [api_row(0), api_row(1)])
    with pytest.raises(TotalMismatch):
        checked_rows(read_pages(spark, str(tmp_path / "p"), FEED), STAMP)


def test_zero_total_gives_no_extract(spark, tmp_path):
    write_page(tmp_path / "p", 0, 0, [])
    assert checked_rows(read_pages(spark, str(tmp_path / "p"), FEED), STAMP) is None


def test_broken_page_raises(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"response": {"total": 1, "data": [')
    with pytest.raises(Py4JJavaError, match="FAILED_READ_FILE"):
        read_pages(spark, str(tmp_path / "p.json"), FEED).collect()


def test_normalize_columns(spark):
    raw = spark.createDataFrame([(1, 2)], "`Type-Name` int, `value-units` int")
    assert normalize_feed_columns(raw).columns == ["type_name", "value_units"]
    seed = spark.createDataFrame([(1, 2, 3)], "`Region/Country  Code` int, `U.S. BA` int, `BA Name` int")
    assert normalize_seed_columns(seed).columns == ["region_or_country_code", "us_ba", "ba_name"]


def test_union_pages_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert sorted((tuple(r) for r in union_pages(a, b).collect()), key=str) == [(1, "x", None), (None, "y", 2.0)]


def test_stamp_cuts_the_text(spark):
    row = stamp(spark.createDataFrame([("2024-12-31T23",)], "period string"), STAMP).first()
    assert row["partition_date"] == date(2024, 12, 31)


def extract(spark, path, value_type, n=3, day="2024-01-05"):
    spark.range(n).select(
        F.concat(F.lit(day + "T0"), F.col("id")).alias("period"),
        F.lit("r").alias("respondent"), F.lit("R").alias("respondent_name"),
        F.lit("wnd").alias("fueltype"), F.lit("Wind").alias("type_name"),
        F.col("id").cast(value_type).alias("value"), F.lit("mwh").alias("value_units"),
        F.lit(STAMP).cast("timestamp_ntz").alias("ingestion_time"), F.lit(day).cast("date").alias("partition_date"),
    ).write.parquet(path)
    return path


def test_extract_paths_and_sink(spark, make_landing, tmp_path):
    day = date(2024, 1, 5)
    assert extract_path("/lake/", FEED, day) == "/lake/api/generation/2024/01/05.parquet"
    assert extract_path("/lake", FEED, day, monthly=True) == "/lake/api/generation/2024/01.parquet"
    path = extract_path(str(tmp_path), FEED, day)
    rows = make_landing("generation", [("2024-01-05T01", "a", "w", 1, "2024-01-06")])
    for _ in range(2):  # a repeated extract replaces its file
        write_extract(rows, FEED, path)
    assert spark.read.parquet(path).count() == 1


def test_extracts_of_different_types_load_together(spark, tmp_path):
    kinds = ("string", "bigint", "double", "decimal(10,2)", "string")
    paths = [extract(spark, str(tmp_path / str(i)), kind) for i, kind in enumerate(kinds)]
    rows = read_extracts(spark, paths, FEED)
    assert rows.schema == FEED.landing_schema
    assert rows.count() == 15 and rows.agg(F.sum("value")).first()[0] == 15
    assert rows.groupBy("ingestion_time").count().count() == 1


def test_one_folder_may_hold_files_of_different_types(spark, tmp_path):
    for i, kind in enumerate(("string", "bigint", "string")):
        extract(spark, str(tmp_path / "lake" / f"{i}.parquet"), kind)
    rows = read_extracts(spark, [str(tmp_path / "lake")], FEED)
    assert rows.count() == 9 and rows.agg(F.sum("value")).first()[0] == 9
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2


def test_extracts_of_one_type_are_one_scan(spark, tmp_path):
    paths = [extract(spark, str(tmp_path / str(i)), "string") for i in range(3)]
    rows = read_extracts(spark, paths, FEED)
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert rows.count() == 9


def test_missing_extract_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_extracts(spark, [str(tmp_path / "absent")], FEED)
    with pytest.raises(FileNotFoundError):
        read_extracts(spark, [], FEED)


def test_landing_appends_and_keeps_copies(spark, tmp_path):
    landing = str(tmp_path / "landing")
    daily = extract(spark, str(tmp_path / "d"), "string")
    load_daily(spark, daily, FEED, landing)
    load_daily(spark, daily, FEED, landing)
    other = extract(spark, str(tmp_path / "e"), "bigint", 2, "2024-01-06")
    load_all(spark, [daily, other], FEED, landing)
    load_exports(spark, {"generation": other}, FEEDS, {"generation": landing})
    table = read_landing(spark, landing, FEED)
    assert {r[0].day: r[1] for r in table.groupBy("partition_date").count().collect()} == {5: 9, 6: 4}
    assert dict(table.dtypes)["value"] == MEASURE.simpleString()


def test_layout(spark, make_landing, tmp_path):
    """One folder per day, few files per day, rows sorted on the cluster columns."""
    rows = [
        (f"2024-01-{d:02d}T{h:02d}", f"r{h % 5}", f"f{h % 3}", h, "2024-02-01")
        for d in (3, 1, 2) for h in range(23, -1, -1)
    ]
    append_landing(make_landing("generation", rows).repartition(8), FEED, str(tmp_path / "l"))
    folders = sorted(p.name for p in (tmp_path / "l").glob("partition_date=*"))
    assert folders == [f"partition_date=2024-01-0{d}" for d in (1, 2, 3)]
    for folder in folders:
        files = list((tmp_path / "l" / folder).glob("*.parquet"))
        assert len(files) == 1
        ids = [tuple(r) for r in spark.read.parquet(str(files[0])).select(*FEED.cluster_raw).collect()]
        assert ids == sorted(ids) and len(ids) == 24


def test_a_hot_day_is_split(spark, tmp_path):
    """A day far above the advisory size is written by several tasks, and whole."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.range(0, 60_000, numPartitions=8).select(
            F.when(F.col("id") % 3 > 0, F.col("id") % 20).otherwise(0).alias("n"),
            F.sha2(F.col("id").cast("string"), 256).alias("x"),
        ).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("n").cast("int")).alias("day"), "x")
        write_days(rows, str(tmp_path / "t"), "day", ("x",), "append")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "day=2024-01-01").glob("*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000


def test_layout_sorts_once(spark, tmp_path):
    rows = spark.range(10).select(F.lit("2024-01-01").cast("date").alias("day"), "id")
    placed = rows.hint("rebalance", F.col("day")).sortWithinPartitions("day", "id")
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and plan.count("Sort [") == 1


def test_file_census(spark, make_landing, tmp_path):
    for day in (5, 6):
        rows = make_landing("generation", [(f"2024-01-0{day}T01", "a", "w", 1, "2024-01-06")])
        write_extract(rows.coalesce(1), FEED, extract_path(str(tmp_path), FEED, date(2024, 1, day)))
    (tmp_path / "api" / "note.txt").write_text("not parquet")
    assert file_census(spark, str(tmp_path)).first()["n_files"] == 2


def test_seeds(spark, tmp_path):
    text = 'Energy Source Code,Energy Source Name\nWND,"Wind, on and ""off"" shore"\nXXX,\n'
    (tmp_path / "raw.csv").write_text(text)
    raw = spark.read.csv(str(tmp_path / "raw.csv"), header=True, escape='"')
    write_seed(raw, str(tmp_path / "energy_sources"))
    seed = read_seed(spark, "energy_sources", str(tmp_path / "energy_sources"))
    assert sorted(tuple(r) for r in seed.collect()) == [("WND", 'Wind, on and "off" shore'), ("XXX", None)]
    assert {len(c) for c in SEED_COLUMNS.values()} == {2, 3, 7, 8, 11}


def test_seed_with_other_columns_is_refused(spark, tmp_path):
    (tmp_path / "s.csv").write_text("code,name\nWND,Wind\n")
    with pytest.raises(Py4JJavaError, match="header does not conform"):
        read_seed(spark, "energy_sources", str(tmp_path / "s.csv")).collect()


def windows(spark, kind, day, **kw):
    runs = spark.createDataFrame([(date.fromisoformat(day),)], "logical_date date")
    rows = ingest_windows(runs, kind, **kw).collect()
    return {r["feed"]: (r["start_date"], r["end_date"], r["object_path"]) for r in rows}


def test_daily_windows(spark):
    got = windows(spark, "daily", "2024-03-01")
    assert set(got) == set(FEEDS)
    for feed in ("generation", "interchange", "demand_by_subregion"):
        assert got[feed] == ("2024-02-29T00", "2024-02-29T23", f"api/{feed}/2024/02/29.parquet")
    assert got["demand_forecast"] == ("2024-03-01T00", "2024-03-01T23", "api/demand_forecast/2024/03/01.parquet")


def test_refresh_and_monthly_windows(spark):
    got = windows(spark, "refresh", "2024-03-05", window_days=10)
    assert got["generation"][:2] == ("2024-02-23T00", "2024-03-04T23")
    got = windows(spark, "monthly", "2024-02-01")
    assert got["interchange"] == ("2024-02-01T00", "2024-02-29T23", "api/interchange/2024/02.parquet")
    with pytest.raises(ValueError):
        windows(spark, "yearly", "2024-02-01")


def test_window_urls(spark):
    runs = spark.createDataFrame([(date(2024, 1, 2),)], "logical_date date")
    got = {r["feed"]: r["url"] for r in ingest_windows(runs, "daily", base_url="https://host/rto/").collect()}
    assert got["generation"] == "https://host/rto/fuel-type-data/data/"


@pytest.fixture(scope="module")
def paged(spark):
    """5,000 rows; one period holds a third of them."""
    hour = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 24)
    return spark.range(0, 5000, numPartitions=5).select(
        F.format_string("2024-01-01T%02d", hour).alias("period"), ((F.col("id") * 7919) % 5003).alias("k"), "id"
    )


def test_pages_cover_everything_once(paged):
    key = ["period", "k"]
    brute = sorted((r["period"], r["k"], r["id"]) for r in paged.collect())
    for page in (0, 3, 4, 7, 8):
        got = sorted(tuple(r) for r in page_slice(paged, key, page, 600).collect())
        assert got == brute[page * 600 : (page + 1) * 600]
    assert page_slice(paged, key, 9, 600).count() == 0


def test_rows_without_a_period_come_first(spark):
    rows = spark.range(30).select(F.when(F.col("id") % 3 > 0, F.format_string("p%02d", "id")).alias("period"), "id")
    key = ["period", "id"]
    paged = [r["id"] for p in range(5) for r in page_slice(rows, key, p, 7).orderBy(*key).collect()]
    assert paged == [r["id"] for r in rows.orderBy("period", "id").collect()]


def test_positions_equal_brute_force(paged):
    got = number_rows(paged, ["period", "k"])
    brute = sorted((r["period"], r["k"], r["id"]) for r in paged.collect())
    assert [(r["period"], r["k"], r["id"]) for r in sorted(got.collect(), key=lambda r: r["position"])] == brute
    assert sorted(r["position"] for r in got.collect()) == list(range(5000))


def test_tied_rows_spread_over_tasks(spark):
    """All rows tie: positions are still complete, and no task holds all of them."""
    rows = spark.range(0, 20_000, numPartitions=4).select(F.lit("p").alias("period"), "id")
    got = number_rows(rows, ["period"])
    assert got.agg(F.min("position"), F.max("position"), F.count_distinct("position")).first()[:] == (0, 19_999, 20_000)
    spread = rows.withColumn("tie", F.rand(seed=7)).repartitionByRange(4, "period", "tie")
    assert spread.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 10_000


def test_page_count(spark):
    frame = spark.createDataFrame([(0,), (1,), (5000,), (5001,)], "n bigint")
    assert [r[0] for r in frame.select(page_count(F.col("n"))).collect()] == [0, 1, 1, 2]


def test_page_rows_of_a_lost_page(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"response": {"total": 0}}')
    pages = read_pages(spark, str(tmp_path / "p.json"), FEED)
    assert page_rows(pages).count() == 0 and reconcile(pages).first()["actual_rows"] == 0


def test_incomplete_deliveries_are_refused(spark, tmp_path):
    """An error page, an absent total and no page at all are no empty extracts."""
    bodies = {
        "error": '{"error": "too many requests", "code": 429}',
        "no_total": '{"response": {"data": []}}',
    }
    for name, body in bodies.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "1.json").write_text(body)
        with pytest.raises(TotalMismatch):
            checked_rows(read_pages(spark, str(tmp_path / name), FEED), STAMP)
    none = read_pages(spark, str(tmp_path / "error"), FEED).filter("false")
    with pytest.raises(TotalMismatch):
        checked_rows(none, STAMP)


def test_extract_without_its_columns_is_refused(spark):
    for column in ("value", "period"):
        rows = spark.createDataFrame([], FEED.landing_schema).drop(column)
        with pytest.raises(ValueError, match=column):
            conform(rows, FEED)
