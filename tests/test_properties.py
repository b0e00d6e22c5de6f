"""Random readings against brute force in plain Python; output schemas."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

from wattframe.feeds import FEEDS, MEASURE
from wattframe.operators.dimensions import dim_generation, dim_interchange, fuel_lookup
from wattframe.operators.increments import incoming
from wattframe.operators.latest import latest_readings
from wattframe.operators.marts import marts_forecast, marts_generation, marts_interchange
from wattframe.operators.staging import stage
from wattframe.operators.upsert import upsert

FEED = FEEDS["demand_forecast"]


def readings_of(rng, n, days, first=datetime(2024, 2, 1)):
    """Few keys, so most rows are copies or corrections; one key holds a third of all rows."""
    rows = []
    for _ in range(n):
        hot = rng.random() < 1 / 3
        day = days[0] if hot else rng.choice(days)
        rows.append(
            (
                f"2024-01-{day:02d}T{0 if hot else rng.randrange(3):02d}",
                "a" if hot else rng.choice("aBc"),
                "d" if hot else rng.choice(["d", "DF"]),
                rng.choice([None, 1, 2, 3]),
                (first + timedelta(hours=rng.randrange(5))).isoformat(),
            )
        )
    return rows


def brute_latest(rows):
    best = {}
    for period, a, b, value, ingested in rows:
        key = (period, a.upper(), b.upper())
        rank = (ingested, value is not None, value or 0)
        if key not in best or rank > best[key][0]:
            best[key] = (rank, value)
    return {k: v for k, (_, v) in best.items()}


def as_dict(frame):
    rows = frame.collect()
    out = {
        (f"{r['recorded_date']}T{r['recorded_hour']:02d}", r["respondent_id"], r["demand_type_id"]): (
            None if r["num_units"] is None else int(r["num_units"])
        )
        for r in rows
    }
    assert len(out) == len(rows), "keys are not unique"
    return out


@pytest.mark.parametrize("seed", range(3))
def test_latest_upsert_and_modes(make_landing, seed):
    rng = random.Random(seed)
    old = readings_of(rng, 300, range(5, 18))
    new = readings_of(rng, 300, range(8, 21), datetime(2024, 2, 2))
    old_staged = stage(make_landing(FEED.name, old), FEED)
    all_staged = stage(make_landing(FEED.name, old + new), FEED)

    built = latest_readings(old_staged, FEED)
    target = brute_latest(old)
    assert as_dict(built) == target

    source = latest_readings(incoming(all_staged, "refresh", as_of="2024-01-20"), FEED)
    in_window = {k: v for k, v in brute_latest(old + new).items() if k[0] >= "2024-01-13"}
    assert as_dict(source) == in_window
    assert as_dict(upsert(built, source, FEED, "2024-01-20")) == target | in_window

    newest = max(k[0][:10] for k in target)
    added = latest_readings(incoming(all_staged, "backfill", target=built), FEED)
    assert as_dict(added) == {k: v for k, v in brute_latest(old + new).items() if k[0][:10] > newest}


def test_output_schemas(make_landing, authorities, sources):
    text, number, whole, day = T.StringType(), MEASURE, T.LongType(), T.DateType()

    def kinds(frame):
        return {f.name: f.dataType for f in frame.schema}

    frames = {}
    for name, feed in FEEDS.items():
        rows = make_landing(name, [("2024-01-05T01", "a", "b", 1, "2024-02-01")])
        frames[name] = latest_readings(stage(rows, feed), feed)
        expected = {f.name: f.dataType for f in feed.readings_schema}
        assert kinds(frames[name]) == expected
    fuels = fuel_lookup(sources)
    assert kinds(fuels) == {"fuel_id": text, "fuel": text, "energy_type": text}
    generation = dim_generation(frames["generation"], fuels, authorities)
    assert kinds(generation) == {
        "recorded_date": day, "recorded_hour": whole, "ba": text, "name": text, "fuel": text, "num_units": number,
        "energy_type": text, "region_or_country_code": text, "country": text,
    }
    interchange = dim_interchange(frames["interchange"], authorities)
    assert kinds(interchange) == {
        "recorded_date": day, "provider_id": text, "provider_name": text, "provider_country": text,
        "recipient_id": text, "recipient_name": text, "recipient_country": text, "interchange": number,
    }
    assert kinds(marts_generation(generation)) == {
        "year": whole, "fuel": text, "energy_type": text, "total_generation": number,
    }
    assert kinds(marts_interchange(interchange)) == {
        "recorded_date": day, "provider_country": text, "recipient_country": text, "interchange": number,
    }
    assert kinds(marts_forecast(frames["demand_forecast"], "2024-01-31")) == {
        "recorded_date": day, "recorded_hour": whole, "demand_type": text, "value": number,
    }
