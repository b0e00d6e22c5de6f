"""Whole extracts, mixed types, what is already landed."""

import json
import time
from datetime import date, datetime
from pathlib import Path

import pytest
from plans import jobs_of
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_sources import FEED, STAMP, api_row, extract, write_page

from checks.queries import QUERIES
from wattframe.sources import landing as landing_module
from wattframe.sources.extracts import write_checked_extract
from wattframe.sources.landing import (
    extract_files,
    landed_files,
    load_all,
    read_extracts,
    read_footers,
    read_landing,
)
from wattframe.sources.pages import TotalMismatch, read_pages
from wattframe.streaming.extracts import extract_states, stream_whole_extracts


def test_checked_extract_parses_its_pages_once(spark, tmp_path):
    write_page(tmp_path / "p", 0, 3, [api_row(0), api_row(1)])
    write_page(tmp_path / "p", 1, "3", [api_row(2, None)])
    path = str(tmp_path / "lake/01.parquet")
    pages = read_pages(spark, str(tmp_path / "p"), FEED)
    for _ in range(2):  # a repeated extract replaces its files
        assert jobs_of(spark, lambda: write_checked_extract(pages, FEED, STAMP, path)) == 1
        assert read_extracts(spark, [path], FEED).count() == 3
    assert [p.name for p in (tmp_path / "lake").iterdir() if not p.name.endswith(".crc")] == ["01.parquet"]


@pytest.mark.parametrize(
    "pages",
    [
        [(1, 2)],  # more rows than declared
        [(3, 1), (3, 1)],  # fewer
        [(None, 1)],
        [("error", 0)],
    ],
)
def test_mismatch_leaves_no_extract_and_keeps_the_earlier_one(spark, tmp_path, pages):
    path = str(tmp_path / "lake/01.parquet")
    for n, (total, rows) in enumerate(pages):
        write_page(tmp_path / "p", n, total, [api_row(i) for i in range(rows)])
        if total == "error":
            (tmp_path / "p" / f"{n}.json").write_text('{"error": "slow down"}')
    bad = read_pages(spark, str(tmp_path / "p"), FEED)
    with pytest.raises(TotalMismatch):
        write_checked_extract(bad, FEED, STAMP, path)
    assert not any(p.suffix == ".parquet" for p in (tmp_path / "lake").rglob("*"))
    write_page(tmp_path / "q", 0, 1, [api_row(7)])
    assert write_checked_extract(read_pages(spark, str(tmp_path / "q"), FEED), FEED, STAMP, path)
    with pytest.raises(TotalMismatch):
        write_checked_extract(bad, FEED, STAMP, path)
    assert [r["respondent"] for r in read_extracts(spark, [path], FEED).collect()] == ["r7"]


def test_no_rows_give_no_extract(spark, tmp_path):
    write_page(tmp_path / "p", 0, 0, [])
    path = str(tmp_path / "lake/01.parquet")
    assert not write_checked_extract(read_pages(spark, str(tmp_path / "p"), FEED), FEED, STAMP, path)
    assert not Path(path).exists()
    none = read_pages(spark, str(tmp_path / "p"), FEED).where("response.total = 5")
    with pytest.raises(TotalMismatch):
        write_checked_extract(none, FEED, STAMP, path)


def alternating(spark, folder, n):
    for i in range(n):
        kind = "string" if i % 2 else "double"
        extract(spark, f"{folder}/{i:02d}.parquet", kind, 2, f"2024-01-{i % 28 + 1:02d}")
    return str(folder)


def test_alternating_types_need_a_constant_number_of_jobs(spark, tmp_path):
    few, some, many = (alternating(spark, tmp_path / str(n), n) for n in (4, 40, 80))
    counts = [jobs_of(spark, lambda f=f: read_extracts(spark, [f], FEED)) for f in (few, some, many)]
    # Spark lists more than 32 folders or files in jobs of their own
    assert counts[0] <= 4 and counts[1] == counts[2] <= 8
    rows = read_extracts(spark, [some], FEED)
    assert rows.count() == 80 and rows.agg(F.sum("value")).first()[0] == 40
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2


def test_names_with_blanks_and_signs(spark, tmp_path):
    folder = tmp_path / "a b=c%20d+é"
    alternating(spark, folder, 3)
    layouts = {r["layout"] for r in read_footers(extract_files(spark, [str(folder)])).collect()}
    assert len(layouts) == 2 and all("value " in x for x in layouts)
    assert read_extracts(spark, [str(folder)], FEED).count() == 6


def test_files_that_arrow_cannot_open_are_grouped_by_halving(spark, tmp_path, monkeypatch):
    folder = alternating(spark, tmp_path / "m", 5)
    files = [r["path"] for r in extract_files(spark, [folder]).collect()]
    groups = landing_module._by_halving(spark, files)
    assert len(groups) == 2 and sorted(f for _, g in groups for f in g) == sorted(files)
    unknown = spark.createDataFrame([("nowhere://x/1.parquet",)], "path string")
    assert read_footers(unknown).first()["layout"] is None


def counts_by_day(spark, landing):
    rows = read_landing(spark, landing, FEED).groupBy("partition_date").count().collect()
    return {r[0].day: r[1] for r in rows}


def test_landing_again_appends_nothing(spark, tmp_path):
    lake, landing, ledger = (str(tmp_path / n) for n in ("lake", "landing", "ledger"))
    alternating(spark, lake, 4)
    n_files = extract_files(spark, [lake]).count()
    assert load_all(spark, [lake], FEED, landing, ledger) == n_files
    first = counts_by_day(spark, landing)
    assert first == {1: 2, 2: 2, 3: 2, 4: 2}
    assert load_all(spark, [lake], FEED, landing, ledger) == 0
    assert counts_by_day(spark, landing) == first
    # a new extract, and one that was pulled again
    extract(spark, f"{lake}/05.parquet", "bigint", 3, "2024-01-09")
    changed = tmp_path / "lake/01.parquet"
    time.sleep(0.01)
    spark.read.parquet(str(changed)).limit(1).coalesce(1).write.mode("overwrite").parquet(f"{lake}/new")
    changed.rename(tmp_path / "before")
    (tmp_path / "lake/new").rename(changed)
    assert load_all(spark, [lake], FEED, landing, ledger) > 0
    assert counts_by_day(spark, landing) == {**first, 2: 3, 9: 3}
    assert load_all(spark, [lake], FEED, landing, ledger) == 0
    assert landed_files(spark, ledger).count() == landed_files(spark, ledger).distinct().count()


def test_a_failed_load_is_not_entered(spark, tmp_path, monkeypatch):
    lake, landing, ledger = (str(tmp_path / n) for n in ("lake", "landing", "ledger"))
    alternating(spark, lake, 2)

    def broken(*_):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(landing_module, "append_landing", broken)
        with pytest.raises(OSError):
            load_all(spark, [lake], FEED, landing, ledger)
    assert landed_files(spark, ledger).count() == 0
    assert load_all(spark, [lake], FEED, landing, ledger)
    assert sum(counts_by_day(spark, landing).values()) == 4


@pytest.fixture
def arrival(spark, tmp_path):
    """Deliver page files and take them: ``deliver(extract, file, total, rows)``."""

    class Arrival:
        landing, state = str(tmp_path / "landing"), str(tmp_path / "state")

        def put(self, name, n, total, rows):
            write_page(tmp_path / "pages" / name, n, total, rows)

        def take(self, **options):
            stream = stream_whole_extracts(
                spark, str(tmp_path / "pages"), FEED, self.landing, self.state,
                ingestion_time=STAMP, **options,
            )
            stream.awaitTermination(120)

        def landed(self):
            if not Path(self.landing).exists():
                return []
            return sorted(r["respondent"] for r in read_landing(spark, self.landing, FEED).collect())

        def states(self):
            return {
                r["extract"]: (r["declared_rows"], r["arrived_rows"], r["landed"])
                for r in extract_states(spark, self.state).collect()
            }

    return Arrival()


def test_short_files_land_when_their_extract_is_whole(arrival, tmp_path):
    arrival.put("monday", 0, 3, [api_row(0)])
    arrival.put("tuesday", 0, "2", [api_row(5), api_row(6)])
    arrival.put("empty", 0, 0, [])
    arrival.take()
    assert arrival.landed() == ["r5", "r6"]
    assert arrival.states() == {"monday": (3, 1, False), "tuesday": (2, 2, True), "empty": (0, 0, True)}
    arrival.put("monday", 1, 3, [api_row(1)])
    arrival.take()
    assert arrival.landed() == ["r5", "r6"]
    arrival.take()  # nothing new
    arrival.put("monday", 2, 3, [api_row(2)])
    arrival.take()
    assert arrival.landed() == ["r0", "r1", "r2", "r5", "r6"]
    arrival.put("friday", 0, 1, [api_row(9)])
    arrival.take()
    assert arrival.landed() == ["r0", "r1", "r2", "r5", "r6", "r9"]
    # batches of extracts that are whole are not kept
    left = sorted(p.name for p in (tmp_path / "state/pages").glob("batch=*"))
    assert left == ["batch=3"] and len(list((tmp_path / "state/extracts").glob("batch=*"))) <= 2


def test_one_file_a_batch(arrival):
    for n in range(4):
        arrival.put("monday", n, 4, [api_row(n)])
    arrival.take(files_per_batch=1)
    assert arrival.landed() == ["r0", "r1", "r2", "r3"]


def test_too_many_rows_fail_and_land_nothing(arrival, tmp_path):
    arrival.put("monday", 0, 2, [api_row(0)])
    arrival.put("sunday", 0, 1, [api_row(9)])
    arrival.take()
    arrival.put("monday", 1, 2, [api_row(1), api_row(2)])
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="extract monday has more rows"):
            arrival.take()
        assert arrival.landed() == ["r9"]
    (tmp_path / "pages/monday/1.json").write_text(
        json.dumps({"response": {"total": 2, "data": [api_row(1)]}})
    )
    arrival.take()
    assert arrival.landed() == ["r0", "r1", "r9"]
    arrival.put("sunday", 1, 1, [api_row(8)])  # an extract that has landed takes no more rows
    with pytest.raises(StreamingQueryException, match="extract sunday has more rows"):
        arrival.take()


def test_error_pages_fail(arrival, tmp_path):
    arrival.put("monday", 0, None, [api_row(0)])
    with pytest.raises(StreamingQueryException, match="declare no total"):
        arrival.take()
    assert arrival.landed() == []


def test_extracts_named_by_the_caller(arrival):
    for n, day in enumerate(("2024-01-05", "2024-01-05", "2024-01-06")):
        arrival.put("all", n, 2, [{**api_row(n), "period": f"{day}T01"}])
    by_day = F.substring(F.get("response.data", F.lit(0))["period"], 1, 10)
    arrival.take(extract=by_day)
    assert arrival.landed() == ["r0", "r1"]
    assert arrival.states()["2024-01-06"] == (2, 1, False)


def test_landed_rows_have_their_days(spark, arrival):
    arrival.put("monday", 0, 1, [api_row(3, "2.5")])
    arrival.take()
    (row,) = read_landing(spark, arrival.landing, FEED).collect()
    assert (row["partition_date"], float(row["value"])) == (date(2024, 1, 5), 2.5)


def test_no_extract_is_whole(spark, arrival):
    """The landing table can be read before a first extract has landed."""
    arrival.put("monday", 0, 2, [api_row(0)])
    arrival.take()
    table = read_landing(spark, arrival.landing, FEED)
    assert table.columns == FEED.landing_schema.names and table.count() == 0
    arrival.put("monday", 1, 2, [api_row(1)])
    arrival.take()
    assert arrival.landed() == ["r0", "r1"]


def test_whole_extracts_of_hours_that_all_lack_rows(spark, tmp_path):
    """Each hour has an error, whose page came without its row, so no extract is whole."""
    rows = [(i, datetime(2024, 1, 5, i // 2), i, ("error", "view")[i % 2], 1.5) for i in range(6)]
    events = spark.createDataFrame(
        rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    assert QUERIES["whole_extracts"](spark, str(tmp_path)).collect() == []
