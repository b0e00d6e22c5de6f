"""Runs as a scheduler calls them, and the command line."""

import json
from datetime import date

import pytest

from wattframe.__main__ import main
from wattframe.feeds import FEEDS
from wattframe.plans import jobs
from wattframe.plans.warehouse import Warehouse
from wattframe.sources.extracts import write_checked_extract
from wattframe.sources.landing import extract_path
from wattframe.sources.marts import read_mart
from wattframe.sources.pages import TotalMismatch, read_pages

SEEDS = {
    "balancing_authorities": "BA Code,BA Name,Time Zone,Region/Country Code,Region/Country Name,"
    "Generation Only BA,Demand by BA Subregion,U.S. BA,Active BA,Activation Date,Retirement Date\n"
    "AAA,Alpha,Eastern,MIDW,Midwest,No,No,Yes,Yes,,\nBBB,Beta,Eastern,CAN,Canada,No,No,No,Yes,,\n",
    "energy_sources": "Energy Source Code,Energy Source Name\nWND,Wind\n",
    "regions": "Region/Country Code,Region/Country Name,Time Zone\nMIDW,Midwest,Central\n",
    "ba_subregions": "BA Code,BA Name,BA Subregion Code,BA Subregion Name,Active Subregion,"
    "Activation Date,Retirement Date\nAAA,Alpha,S1,Sub One,Yes,,\n",
    "ba_connections": "BA Code,BA Name,Directly Interconnected BA Code,Directly Interconnected BA Name,"
    "Country of Foreign Directly Interconnected BA,Active Connection,Activation Date,Retirement Date\n"
    "AAA,Alpha,BBB,Beta,Canada,Yes,,\n",
}
IDS = {
    "generation": ("AAA", "WND"),
    "interchange": ("AAA", "BBB"),
    "demand_forecast": ("AAA", "D"),
    "demand_by_subregion": ("S1", "AAA"),
}


def deliver(folder, day, value, total=2):
    """Page files of all feeds for one day: two hours each."""
    given = {}
    for name, ids in IDS.items():
        feed = FEEDS[name]
        rows = []
        for hour in (0, 1):
            row = {"period": f"{day}T{hour:02d}", "value": str(value), "value-units": "mwh"}
            for party, id_ in zip(feed.parties, ids):
                row[party.raw_id] = id_
                row[party.raw_name.replace("_", "-")] = id_.lower()
            rows.append(row)
        path = folder / name
        path.mkdir(parents=True)
        for i, row in enumerate(rows[:total]):
            (path / f"{i}.json").write_text(json.dumps({"response": {"total": total, "data": [row]}}))
        if not total:
            (path / "0.json").write_text(json.dumps({"response": {"total": "0", "data": []}}))
        given[name] = str(path)
    return given


@pytest.fixture
def house(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, text in SEEDS.items():
        (folder / f"{name}.csv").write_text(text)
    warehouse = Warehouse(spark, str(tmp_path / "lake"))
    jobs.load_seeds(warehouse, str(folder))
    return warehouse


def test_seeds_are_stored_with_declared_columns(house):
    for name in SEEDS:
        assert house.seed(name).count() == (2 if name == "balancing_authorities" else 1)


def test_days_land_and_only_today_transforms(house, tmp_path):
    first, second = date(2024, 1, 5), date(2024, 1, 6)
    early = deliver(tmp_path / "p1", "2024-01-04", 5)
    assert jobs.daily(house, first, second, early, "2024-01-05 06:00:00") is None
    assert (tmp_path / "lake/api/generation/2024/01/04.parquet").exists()
    assert (tmp_path / "lake/api/demand_forecast/2024/01/05.parquet").exists()
    assert not house.has("int_generation")
    late = deliver(tmp_path / "p2", "2024-01-05", 7)
    marts = jobs.daily(house, second, second, late, "2024-01-06 06:00:00")
    assert marts["marts_generation"].first()["total_generation"] == 2 * 5 + 2 * 7
    assert sorted(int(r["value"]) for r in marts["marts_forecast"].collect()) == [5, 5, 7, 7]
    assert marts["marts_interchange"].count() == 2


def test_a_day_without_rows_lands_nothing(house, tmp_path):
    jobs.monthly(house, date(2024, 1, 1), deliver(tmp_path / "p", "2024-01-01", 1, total=0), "2024-02-01")
    assert not house.has("landing_generation") and not (tmp_path / "lake/api").exists()


def test_a_wrong_total_lands_nothing(house, tmp_path):
    pages = deliver(tmp_path / "p", "2024-01-01", 1)
    (tmp_path / "p/generation/1.json").write_text('{"response": {"total": 2, "data": []}}')
    with pytest.raises(TotalMismatch):
        jobs.monthly(house, date(2024, 1, 1), {"generation": pages["generation"]}, "2024-02-01")
    assert not house.has("landing_generation")


def test_catch_up_lands_what_is_new(house, tmp_path):
    feed = FEEDS["generation"]
    jobs.monthly(house, date(2024, 1, 1), deliver(tmp_path / "p1", "2024-01-01", 3), "2024-02-01")
    assert set(jobs.catch_up(house).values()) == {0}
    # an extract that was written but not landed, and one that was pulled again
    pages = read_pages(house.spark, deliver(tmp_path / "p2", "2024-02-01", 4)["generation"], feed)
    for month, stamp in ((2, "2024-03-01"), (1, "2024-03-02")):
        path = extract_path(house.root, feed, date(2024, month, 1), monthly=True)
        assert write_checked_extract(pages, feed, stamp, path)
    landed = jobs.catch_up(house)
    assert landed["generation"] > 0 and sum(landed.values()) == landed["generation"]
    assert house.landing(feed).count() == 6
    assert set(jobs.catch_up(house).values()) == {0}


def test_command_line(spark, house, tmp_path, capsys):
    given = deliver(tmp_path / "p", "2024-01-01", 3)
    feeds = [a for f, path in given.items() for a in (f"--{f.replace('_', '-')}", path)]
    root = ["--root", house.root]
    stamp = ["--ingestion-time", "2024-02-01 00:00:00"]
    main([*root, "monthly", "--date", "2024-01-01", *stamp, *feeds])
    export = f"{house.root}/api/generation/2024/01.parquet"
    main([*root, "exports", "--generation", export])  # the same rows again
    main([*root, "run", "--as-of", "2024-01-31"])
    assert house.landing(FEEDS["generation"]).count() == 4
    main([*root, "catch-up"])  # every extract has landed
    assert house.landing(FEEDS["generation"]).count() == 4
    assert house.table("marts_generation").first()["total_generation"] == 6
    with pytest.raises(SystemExit):
        main([*root, "run"])
    reader = spark.newSession()  # a session that has not built anything
    names = Warehouse(reader, house.root).publish()
    assert {"int_generation", "dim_interchange", "marts_forecast"} <= set(names)
    mart, source = read_mart(reader, "marts_generation", "/absent.csv")
    assert source == "table" and mart.first()["total_generation"] == 6.0
