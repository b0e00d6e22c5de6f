"""B17-B19, C1-C3."""

from decimal import Decimal

import pytest
from plans import count, executed, planned
from pyspark.sql import functions as F

from wattframe.feeds import FEEDS
from wattframe.functions.grid import RENEWABLE_FUELS
from wattframe.operators.dimensions import (
    bounded_broadcast,
    dim_generation,
    dim_interchange,
    fuel_lookup,
)
from wattframe.operators.latest import latest_readings
from wattframe.operators.marts import marts_generation, marts_interchange
from wattframe.operators.staging import stage

P, T = "2024-01-05T07", "2024-01-06"


def readings(make_landing, name, rows):
    return latest_readings(stage(make_landing(name, rows), FEEDS[name]), FEEDS[name])


def test_energy_classes(spark):
    others = ["Coal", "Natural gas", "Petroleum", "Other", "Unknown", "Other energy storage", "wind"]
    seed = spark.createDataFrame(
        [(str(i), n) for i, n in enumerate([*RENEWABLE_FUELS, *others, None])],
        "energy_source_code string, energy_source_name string",
    )
    got = {r["fuel"]: r["energy_type"] for r in fuel_lookup(seed).collect()}
    assert len(RENEWABLE_FUELS) == 9
    assert all(got[f] == "renewable" for f in RENEWABLE_FUELS)
    assert all(got[f] == "non-renewable" for f in [*others, None])


def test_generation_drops_unknown_fuels_and_authorities(make_landing, authorities, sources):
    rows = [(P, who, fuel, 1, T) for who in ("aaa", "bbb", "ccc", "ddd", "zzz") for fuel in ("wnd", "qqq")]
    dim = dim_generation(readings(make_landing, "generation", rows), fuel_lookup(sources), authorities)
    assert dim.columns == [
        "recorded_date", "recorded_hour", "ba", "name", "fuel", "num_units",
        "energy_type", "region_or_country_code", "country",
    ]
    got = {r["ba"]: (r["name"], r["fuel"], r["energy_type"], r["country"]) for r in dim.collect()}
    assert got == {
        "AAA": ("Alpha", "Wind", "renewable", "United States of America"),
        "BBB": ("Beta", "Wind", "renewable", "Canada"),
        "CCC": ("Gamma", "Wind", "renewable", "Mexico"),
        "DDD": ("Delta", "Wind", "renewable", "United States of America"),  # by region name
    }


def test_interchange_plays_the_dimension_twice(make_landing, authorities):
    pairs = [("aaa", "bbb"), ("bbb", "aaa"), ("aaa", "aaa"), ("aaa", "ddd"), ("ccc", "bbb"), ("zzz", "aaa")]
    rows = [(P, a, b, 10 + i, T) for i, (a, b) in enumerate(pairs)]
    dim = dim_interchange(readings(make_landing, "interchange", rows), authorities)
    got = {
        (r["provider_name"], r["recipient_name"]): (r["provider_country"], r["recipient_country"])
        for r in dim.collect()
    }
    usa = "United States of America"
    assert got == {
        ("Alpha", "Beta"): (usa, "Canada"),
        ("Beta", "Alpha"): ("Canada", usa),
        ("Alpha", "Alpha"): (usa, usa),
        ("Alpha", "Delta"): (usa, None),  # by flag: a foreign authority without a region
        ("Gamma", "Beta"): ("Mexico", "Canada"),
    }
    mart = {(r[1], r[2]): int(r[3]) for r in marts_interchange(dim).collect()}
    assert mart == {(usa, "Canada"): 10, ("Canada", usa): 11, ("Mexico", "Canada"): 14}


def test_one_broadcast_serves_both_roles(make_landing, authorities):
    rows = readings(make_landing, "interchange", [(P, "aaa", "bbb", 1, T)])
    dim = dim_interchange(rows, F.broadcast(authorities))
    final = executed(dim).split("+- == Initial Plan ==")[0]
    assert count(final, "BroadcastHashJoin") == 2 and "SortMergeJoin" not in final
    assert "ReusedExchange" in final


def test_a_dimension_is_broadcast_only_within_its_bounds(spark, make_landing):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        fact = spark.range(1000).withColumn("k", F.col("id") % 10)
        dim = spark.range(10).select(F.col("id").alias("k"), F.lit("name").alias("n"))
        assert "BroadcastHashJoin" in planned(fact.join(bounded_broadcast(dim), "k"))
        for bounds in ({"max_rows": 9}, {"max_bytes": 20}):
            other = fact.join(bounded_broadcast(dim, **bounds), "k")
            assert "BroadcastHashJoin" not in planned(other)
            assert other.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_dimension_gives_the_same_rows(make_landing, authorities, sources):
    rows = [(P, who, fuel, 1, T) for who in ("aaa", "bbb", "zzz") for fuel in ("wnd", "col", "qqq")]
    args = readings(make_landing, "generation", rows), fuel_lookup(sources), authorities
    small = sorted(dim_generation(*args).collect())
    large = dim_generation(args[0], *(d.hint("merge") for d in args[1:]))
    assert "SortMergeJoin" in planned(large)
    assert sorted(large.collect()) == small


@pytest.mark.parametrize("copies", [1, 3])
def test_mart_totals_equal_dim_totals(make_landing, authorities, sources, copies):
    rows = [
        (f"20{y}-03-0{d}T0{d}", who, fuel, y * d, T)
        for y in (22, 23) for d in (1, 2, 3) for who in ("aaa", "bbb") for fuel in ("wnd", "col")
    ] * copies
    dim = dim_generation(readings(make_landing, "generation", rows), fuel_lookup(sources), authorities)
    mart = marts_generation(dim)
    total = mart.agg(F.sum("total_generation")).first()[0]
    assert total == dim.agg(F.sum("num_units")).first()[0] == Decimal((22 + 23) * 6 * 4)
    assert dict(mart.dtypes) == {
        "year": "bigint", "fuel": "string", "energy_type": "string", "total_generation": "decimal(38,9)",
    }
    assert mart.count() == 4
