from __future__ import annotations

import sys
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wattframe.feeds import FEEDS  # noqa: E402
from wattframe.session import local_session  # noqa: E402

SF_TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", cores=4, memory="4g")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_landing(spark):
    """Landing rows from short tuples: (period, id1, id2, value, ingested[, overrides])."""

    def make(feed_name: str, rows: list[tuple]):
        feed = FEEDS[feed_name]
        out = []
        for period, first, second, value, ingested, *rest in rows:
            row = {
                "period": period,
                "value": None if value is None else Decimal(str(value)),
                "value_units": "mwh",
                "ingestion_time": datetime.fromisoformat(ingested) if ingested else None,
                "partition_date": date.fromisoformat(period[:10]) if period else None,
            }
            for party, id_ in zip(feed.parties, (first, second)):
                row[party.raw_id] = id_
                row[party.raw_name] = None if id_ is None else f"Name of {id_}"
            row.update(rest[0] if rest else {})
            out.append(tuple(row[c] for c in feed.landing_schema.names))
        return spark.createDataFrame(out, feed.landing_schema)

    return make


@pytest.fixture(scope="session")
def authorities(spark):
    return spark.createDataFrame(
        [
            ("AAA", "Alpha", "MIDW", "Midwest", "Yes"),
            ("BBB", "Beta", "CAN", "Canada", "No"),
            ("CCC", "Gamma", "MEX", "Mexico", "No"),
            ("DDD", "Delta", None, None, "No"),
        ],
        "ba_code string, ba_name string, region_or_country_code string,"
        " region_or_country_name string, us_ba string",
    )


@pytest.fixture(scope="session")
def sources(spark):
    return spark.createDataFrame(
        [("WND", "Wind"), ("COL", "Coal"), ("NUC", "Nuclear"), ("NG", "Natural gas")],
        "energy_source_code string, energy_source_name string",
    )
