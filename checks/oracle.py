"""The registered queries as SQL over the given tables.

Formulated on its own: latest rows by ``DISTINCT ON``, the upsert as an anti join plus
the source, shares by a correlated total.
"""

from __future__ import annotations

from checks.queries import (
    AS_OF,
    BUILT_TO,
    FLOWS,
    FUELS,
    LATER,
    PAGE_KEY,
    REFRESHED,
    STAMP,
)
from checks.tables import (
    AUTHORITIES,
    COUNTRY_OF_REGION,
    FLAG_EVERY,
    FORECAST,
    FUEL_OF_EVENT,
    FUEL_OF_LINE,
    GENERATION,
    INTERCHANGE,
    NEIGHBOURS,
    SOURCE_OF_PART,
    SUBREGION,
    TYPE_OF_EVENT,
    UNITS,
)
from wattframe.feeds import FEEDS, Feed

# Written out here, not taken from the package, so that a slip there turns a row red.
RENEWABLE_FUELS = (
    "Wind",
    "Solar",
    "Hydro and pumped storage",
    "Geothermal",
    "Wind with integrated battery storage",
    "Solar with integrated battery storage",
    "Battery storage",
    "Pumped storage",
    "Nuclear",
)
DEMAND_LABELS = {"DF": "Demand Forecast", "D": "Actual Demand", "NG": "Net Generation"}
USA, USA_SHORT = "United States of America", "USA"
KEYS = {
    "generation": "recorded_date recorded_hour respondent_id fuel_id",
    "interchange": "recorded_date recorded_hour provider_id recipient_id",
    "demand_forecast": "recorded_date recorded_hour respondent_id demand_type_id",
    "demand_by_subregion": "recorded_date recorded_hour sub_id parent_id",
}
REQUIRED = {
    "generation": "partition_date period respondent fueltype value_units ingestion_time",
    "interchange": "partition_date period fromba toba value_units ingestion_time",
    "demand_forecast": "partition_date period respondent type value_units ingestion_time",
    "demand_by_subregion": "partition_date period subba parent value_units ingestion_time",
}
#: Feeds whose missing measures count as 0.
ZERO_FILLED = ("generation", "interchange", "demand_by_subregion")

NUM = "DECIMAL(38,9)"


def _case(key: str, values: dict, default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())
    return f"CASE {key} {whens} ELSE {default} END"


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_OPERATOR = (f"'nation_' || (user_id % {AUTHORITIES})", f"'Nation ' || (user_id % {AUTHORITIES})")
_ENTITIES = {
    "respondent": _OPERATOR,
    "fromba": _OPERATOR,
    "parent": _OPERATOR,
    "toba": (f"'nation_' || (event_id % {NEIGHBOURS})", f"'Nation ' || (event_id % {NEIGHBOURS})"),
    "subba": (f"'sub_' || (event_id % {NEIGHBOURS})", f"'Sub ' || (event_id % {NEIGHBOURS})"),
    "fueltype": (_case("event_type", FUEL_OF_EVENT, "'zzz'"), "event_type"),
    "type": (_case("event_type", TYPE_OF_EVENT, "'ti'"), "event_type"),
}


def _landing(feed: Feed) -> str:
    parties = ", ".join(
        f"{_ENTITIES[p.raw_id][0]} AS {p.raw_id}, {_ENTITIES[p.raw_id][1]} AS {p.raw_name}"
        for p in feed.parties
    )
    return (
        f"SELECT strftime(ts, '%Y-%m-%dT%H') AS period, {parties}, "
        f"CASE WHEN event_id % 17 <> 0 THEN CAST(value AS {NUM}) END AS value, "
        f"'{UNITS}' AS value_units, ts AS ingestion_time, CAST(ts AS DATE) AS partition_date "
        "FROM events"
    )


_HISTORY = (
    "SELECT strftime(l_shipdate, '%Y-%m-%d') || 'T0' || (l_linenumber - 1) AS period, "
    f"'nation_' || (l_suppkey % {AUTHORITIES}) AS respondent, "
    f"'Nation ' || (l_suppkey % {AUTHORITIES}) AS respondent_name, "
    f"{_case('l_returnflag || l_linestatus', FUEL_OF_LINE, chr(39) + 'bat' + chr(39))} AS fueltype, "
    f"l_returnflag || l_linestatus AS type_name, CAST(l_extendedprice AS {NUM}) AS value, "
    f"'{UNITS}' AS value_units, l_shipdate AS ingestion_time, "
    "CAST(l_shipdate AS DATE) AS partition_date FROM lineitem"
)


def _staged(feed: Feed, source: str | None = None) -> str:
    parties = ", ".join(
        f"{p.raw_name} AS {p.name}, upper({p.raw_id}) AS {p.id}" for p in feed.parties
    )
    measure = "ifnull(value, 0)" if feed.name in ZERO_FILLED else "value"
    present = " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED[feed.name].split())
    return (
        "SELECT partition_date AS recorded_date, "
        f"CAST(period[12:13] AS BIGINT) AS recorded_hour, {parties}, "
        f"CAST({measure} AS {NUM}) AS num_units, value_units AS unit, ingestion_time "
        f"FROM ({source or _landing(feed)}) WHERE {present}"
    )


def _latest(feed: Feed, source: str | None = None) -> str:
    key = ", ".join(KEYS[feed.name].split())
    return (
        f"SELECT DISTINCT ON ({key}) {key}, num_units, unit, ingestion_time "
        f"FROM ({source or _staged(feed)}) "
        f"ORDER BY {key}, ingestion_time DESC, num_units DESC NULLS LAST, unit DESC"
    )


def _show(sql: str, dates=(), times=(), measures=()) -> str:
    """The text and double rendering that the Spark side applies last."""
    shown = (
        [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates]
        + [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in times]
        + [f"CAST(CAST({c} AS DECIMAL(18,2)) AS DOUBLE) AS {c}" for c in measures]
    )
    return f"SELECT * REPLACE ({', '.join(shown)}) FROM ({sql})"


def _show_readings(sql: str) -> str:
    return _show(sql, ["recorded_date"], ["ingestion_time"], ["num_units"])


_FUELS = (
    "SELECT fuel_id, fuel, "
    f"CASE WHEN fuel IN ({_quoted(RENEWABLE_FUELS)}) THEN 'renewable' ELSE 'non-renewable' END AS energy_type "
    "FROM (SELECT DISTINCT "
    f"{_case('p_type', {t: c for t, (c, _) in SOURCE_OF_PART.items()}, 'NULL')} AS fuel_id, "
    f"{_case('p_type', {t: n for t, (_, n) in SOURCE_OF_PART.items()}, 'NULL')} AS fuel FROM part)"
)

_AUTHORITIES = (
    "SELECT upper(n_name) AS ba_code, n_name[1:1] || lower(n_name[2:]) AS ba_name, "
    "r_name[1:3] AS region_or_country_code, "
    f"{_case('r_regionkey', COUNTRY_OF_REGION, 'r_name')} AS region_or_country_name, "
    f"CASE WHEN n_nationkey % {FLAG_EVERY} = 0 THEN 'No' ELSE 'Yes' END AS us_ba "
    "FROM nation, region WHERE n_regionkey = r_regionkey"
)


def _dim_generation(readings: str) -> str:
    return (
        f"WITH r AS ({readings}), f AS ({_FUELS}), a AS ({_AUTHORITIES}) "
        "SELECT recorded_date, recorded_hour, respondent_id AS ba, ba_name AS name, fuel, "
        "num_units, energy_type, region_or_country_code, "
        "CASE WHEN region_or_country_name IN ('Canada', 'Mexico') THEN region_or_country_name "
        f"ELSE '{USA}' END AS country "
        "FROM r, f, a WHERE r.fuel_id = f.fuel_id AND r.respondent_id = a.ba_code"
    )


def _dim_interchange(readings: str) -> str:
    return (
        f"WITH r AS ({readings}), a AS (SELECT ba_code, ba_name, "
        f"CASE WHEN us_ba = 'Yes' THEN '{USA}' ELSE region_or_country_name END AS country "
        f"FROM ({_AUTHORITIES})) "
        "SELECT recorded_date, provider_id, p.ba_name AS provider_name, p.country AS provider_country, "
        "recipient_id, q.ba_name AS recipient_name, q.country AS recipient_country, "
        "num_units AS interchange FROM r, a p, a q "
        "WHERE provider_id = p.ba_code AND recipient_id = q.ba_code"
    )


_DIM_INTERCHANGE = _dim_interchange(_latest(INTERCHANGE))


def _mart_generation(dim: str) -> str:
    return (
        "SELECT CAST(date_part('year', recorded_date) AS BIGINT) AS year, fuel, energy_type, "
        f"sum(num_units) AS total_generation FROM ({dim}) GROUP BY ALL"
    )


_MART_HISTORY = _mart_generation(
    _dim_generation(_latest(GENERATION, _staged(GENERATION, _HISTORY)))
)
def _mart_interchange(dim: str) -> str:
    return (
        "SELECT recorded_date, provider_country, recipient_country, sum(interchange) AS interchange "
        f"FROM ({dim}) WHERE provider_country <> recipient_country GROUP BY ALL"
    )


_MART_INTERCHANGE = _mart_interchange(_DIM_INTERCHANGE)


def _mart_forecast(as_of: str, only: str = "TRUE", readings: str | None = None) -> str:
    return (
        "SELECT recorded_date, recorded_hour, "
        f"{_case('demand_type_id', DEMAND_LABELS, 'NULL')} AS demand_type, sum(num_units) AS value "
        f"FROM ({readings or _latest(FORECAST)}) WHERE demand_type_id IN ({_quoted(DEMAND_LABELS)}) "
        f"AND recorded_date >= DATE '{as_of}' - 30 AND {only} GROUP BY ALL"
    )


_FLOWS = (
    "SELECT recorded_date, p AS provider_country, q AS recipient_country, interchange, "
    "p || ' → ' || q AS flow FROM (SELECT *, "
    f"CASE provider_country WHEN '{USA}' THEN '{USA_SHORT}' ELSE provider_country END AS p, "
    f"CASE recipient_country WHEN '{USA}' THEN '{USA_SHORT}' ELSE recipient_country END AS q "
    f"FROM ({_MART_INTERCHANGE}))"
)


def _corrected(feed: Feed) -> str:
    return (
        f"SELECT * REPLACE (CAST(num_units + 1 AS {NUM}) AS num_units, "
        f"ingestion_time + INTERVAL 1 DAY AS ingestion_time) FROM ({_staged(feed)})"
    )


def _first_build(feed: Feed) -> str:
    built = f"SELECT * FROM ({_staged(feed)}) WHERE recorded_date <= DATE '{BUILT_TO}'"
    return _latest(feed, built)


def _upsert(feed: Feed, source_days: int, merge_days: int) -> str:
    late = (
        f"SELECT * FROM ({_corrected(feed)}) "
        f"WHERE recorded_date >= DATE '{REFRESHED}' - {source_days}"
    )
    keys = KEYS[feed.name].split()
    same = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    columns = ", ".join([*keys, "num_units", "unit", "ingestion_time"])
    return _show_readings(
        f"WITH t AS ({_first_build(feed)}), s AS ({_latest(feed, late)}) "
        f"SELECT {columns} FROM t WHERE NOT (recorded_date >= DATE '{REFRESHED}' - {merge_days} "
        f"AND EXISTS (SELECT 1 FROM s WHERE {same})) UNION ALL SELECT {columns} FROM s"
    )


_BACKFILL = (
    f"WITH t AS ({_first_build(GENERATION)}), n AS (SELECT * FROM ({_corrected(GENERATION)}) "
    "WHERE recorded_date > (SELECT max(recorded_date) FROM t)) "
    f"SELECT * FROM t UNION ALL SELECT * FROM ({_latest(GENERATION, 'SELECT * FROM n')})"
)


def _stored_refresh(feed: Feed = GENERATION, since: str = f"DATE '{REFRESHED}' - 7") -> str:
    """Readings built to BUILT_TO, then refreshed from a corrected delivery."""
    again = (
        "SELECT * REPLACE (value + 1 AS value, ingestion_time + INTERVAL 1 DAY AS ingestion_time) "
        f"FROM ({_landing(feed)})"
    )
    early = f"SELECT * FROM ({_landing(feed)}) WHERE partition_date <= DATE '{BUILT_TO}'"
    landed = f"SELECT * FROM ({early}) UNION ALL SELECT * FROM ({again})"
    windowed = f"SELECT * FROM ({landed}) WHERE partition_date >= {since}"
    key = ", ".join(KEYS[feed.name].split())
    return (
        f"WITH t AS ({_latest(feed, _staged(feed, early))}), "
        f"s AS ({_latest(feed, _staged(feed, windowed))}) "
        f"SELECT * FROM t ANTI JOIN s USING ({key}) UNION ALL SELECT * FROM s"
    )


def _windows(kind: str) -> str:
    feeds = " UNION ALL ".join(
        f"SELECT '{f.name}' AS feed, '{f.route}' AS route, {f.lag_days} AS lag" for f in FEEDS.values()
    )
    if kind == "monthly":
        runs = "SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS logical_date FROM orders"
        day, start, end = "logical_date", "logical_date", "last_day(logical_date)"
        path = "'%Y/%m.parquet'"
    else:
        runs = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS logical_date FROM orders"
        day, end = "logical_date - lag", "logical_date - lag"
        start = f"{day} - 7" if kind == "refresh" else day
        path = "'%Y/%m/%d.parquet'"
    return (
        f"WITH runs AS ({runs}), feeds AS ({feeds}) "
        "SELECT strftime(logical_date, '%Y-%m-%d') AS logical_date, feed, "
        f"route || '/data/' AS url, strftime({day}, '%Y-%m-%d') AS run_date, "
        f"'api/' || feed || strftime({day}, '/%Y/%m/') AS directory, "
        f"'api/' || feed || '/' || strftime({day}, {path}) AS object_path, "
        f"strftime({start}, '%Y-%m-%dT00') AS start_date, "
        f"strftime({end}, '%Y-%m-%dT23') AS end_date FROM runs CROSS JOIN feeds"
    )


def _arrived(feed: Feed) -> str:
    """Rows of the pages, all of which arrived."""
    return _landing(feed)


_PAGE = "SELECT strftime(ts, '%Y-%m-%dT%H') AS period, user_id, event_type, event_id, value FROM events"
_STG = ["recorded_date"], ["ingestion_time"], ["num_units"]
_RAW = ["partition_date"], ["ingestion_time"], ["value"]

ORACLE: dict[str, str] = {
    **{f"stg_{f.name}": _show(_staged(f), *_STG) for f in FEEDS.values()},
    **{f"int_{f.name}": _show_readings(_latest(f)) for f in FEEDS.values()},
    "int_generation_history": _show_readings(_latest(GENERATION, _staged(GENERATION, _HISTORY))),
    "fuel_lookup": _FUELS,
    "dim_generation": _show(_dim_generation(_latest(GENERATION)), ["recorded_date"], [], ["num_units"]),
    "dim_interchange": _show(_DIM_INTERCHANGE, ["recorded_date"], [], ["interchange"]),
    "marts_generation": _show(
        _mart_generation(_dim_generation(_latest(GENERATION))), measures=["total_generation"]
    ),
    "marts_generation_history": _show(_MART_HISTORY, measures=["total_generation"]),
    "marts_interchange": _show(_MART_INTERCHANGE, ["recorded_date"], [], ["interchange"]),
    "marts_forecast": _show(_mart_forecast(AS_OF), ["recorded_date"], [], ["value"]),
    "marts_forecast_trailing": _show(_mart_forecast(LATER), ["recorded_date"], [], ["value"]),
    "marts_forecast_known_respondents": _show(
        _mart_forecast(AS_OF, "respondent_id IN (SELECT upper(n_name) FROM nation)"),
        ["recorded_date"],
        [],
        ["value"],
    ),
    "filter_refresh": _show(
        f"SELECT * FROM ({_staged(GENERATION)}) WHERE recorded_date >= DATE '{AS_OF}' - 7", *_STG
    ),
    "filter_backfill": _show(
        f"SELECT * FROM ({_staged(GENERATION)}) WHERE recorded_date > "
        f"(SELECT max(recorded_date) FROM ({_first_build(GENERATION)}))",
        *_STG,
    ),
    "high_water_mark": _show(
        "SELECT max(CAST(ts AS DATE)) AS high_water_mark FROM events", ["high_water_mark"]
    ),
    **{f"upsert_{f.name}": _upsert(f, 7, 7) for f in FEEDS.values()},
    "upsert_wide_window": _upsert(GENERATION, 10, 7),
    "backfill_generation": _show_readings(_BACKFILL),
    "fuel_series_absolute": _show(
        'SELECT year AS "Year", fuel AS "Fuel", energy_type, total_generation, '
        "round(CAST(total_generation AS DOUBLE) / 1000000, 6) AS value "
        f"FROM ({_MART_HISTORY}) WHERE fuel IN ({_quoted(FUELS)})",
        measures=["total_generation"],
    ),
    "fuel_series_share": _show(
        f"WITH m AS (SELECT * FROM ({_MART_HISTORY}) WHERE fuel IN ({_quoted(FUELS)})) "
        'SELECT year AS "Year", fuel AS "Fuel", energy_type, total_generation, '
        "round(CAST(total_generation AS DOUBLE) / nullif(CAST((SELECT sum(o.total_generation) "
        "FROM m o WHERE o.year = m.year) AS DOUBLE), 0) * 100, 6) AS value FROM m",
        measures=["total_generation"],
    ),
    "energy_mix": _show(
        "SELECT year, energy_type, coalesce(sum(total_generation), 0) AS total_generation "
        f"FROM ({_MART_HISTORY}) WHERE year IS NOT NULL GROUP BY ALL",
        measures=["total_generation"],
    ),
    "demand_series": _show(
        "SELECT *, recorded_date + to_hours(recorded_hour) AS datetime "
        f"FROM ({_mart_forecast(AS_OF)})",
        ["recorded_date"],
        ["datetime"],
        ["value"],
    ),
    "flow_series": _show(
        f"SELECT * FROM ({_FLOWS}) WHERE flow IN ({_quoted(FLOWS)})",
        ["recorded_date"],
        [],
        ["interchange"],
    ),
    "distinct_fuels": f"SELECT DISTINCT fuel FROM ({_MART_HISTORY})",
    "distinct_flows": f"SELECT DISTINCT flow FROM ({_FLOWS})",
    "default_flows": f"SELECT DISTINCT flow FROM ({_FLOWS}) ORDER BY flow LIMIT 2",
    "ingest_windows_daily": _windows("daily"),
    "ingest_windows_refresh": _windows("refresh"),
    "ingest_windows_monthly": _windows("monthly"),
    "page_ingest": _show(
        f"SELECT * REPLACE (TIMESTAMP '{STAMP}' AS ingestion_time) FROM ({_arrived(GENERATION)})",
        *_RAW,
    ),
    "reconcile_counts": (
        "SELECT strftime(ts, '%Y-%m-%d') AS extract_date, count(*) AS declared_rows, "
        "count(*) FILTER (event_type <> 'error') AS actual_rows, "
        "bool_and(event_type <> 'error') AS matches FROM events GROUP BY 1"
    ),
    "union_pages": (
        "SELECT period, respondent, respondent_name, fueltype, type_name, "
        "CAST(value AS DOUBLE) AS value, value_units, NULL AS type "
        f"FROM ({_arrived(GENERATION)}) UNION ALL "
        "SELECT period, respondent, respondent_name, NULL, type_name, "
        f"CAST(value AS DOUBLE), value_units, type FROM ({_arrived(FORECAST)})"
    ),
    "normalize_feed_columns": "SELECT event_id, event_type AS type_name, value FROM events",
    "normalize_seed_columns": (
        "SELECT c_custkey AS ba_code, c_name AS ba_name, c_mktsegment AS region_or_country_name, "
        "CAST(c_nationkey AS BIGINT) AS us_ba FROM customer"
    ),
    "stamp_partition_date": _show(
        f"SELECT * REPLACE (TIMESTAMP '{STAMP}' AS ingestion_time) FROM ({_landing(GENERATION)})",
        *_RAW,
    ),
    "conform_landing": _show(
        f"SELECT * REPLACE (CAST(NULL AS VARCHAR) AS fromba_name) FROM ({_landing(INTERCHANGE)})",
        *_RAW,
    ),
    "coerce_mart": (
        "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS total_generation, "
        "CASE WHEN event_type <> 'error' THEN CAST(date_part('year', ts) AS BIGINT) END AS year, "
        "CASE event_type WHEN 'error' THEN 'Unknown' ELSE event_type END AS energy_type, "
        "event_type AS fuel, strftime(ts, '%Y-%m-%d') AS recorded_date, "
        "CASE WHEN event_type <> 'error' THEN value END AS interchange FROM events"
    ),
    "landing_table": _show(
        f"SELECT * FROM ({_landing(SUBREGION)}) UNION ALL SELECT * FROM ({_landing(SUBREGION)})",
        *_RAW,
    ),
    "streamed_landing": _show(
        f"SELECT * EXCLUDE (ingestion_time) FROM ({_arrived(GENERATION)})",
        ["partition_date"],
        [],
        ["value"],
    ),
    "whole_extracts": _show(
        f"SELECT * REPLACE (TIMESTAMP '{STAMP}' AS ingestion_time) FROM ({_arrived(GENERATION)}) "
        "WHERE period NOT IN (SELECT strftime(ts, '%Y-%m-%dT%H') FROM events WHERE event_type = 'error')",
        *_RAW,
    ),
    "page_files_ingest": _show(
        f"SELECT * REPLACE (TIMESTAMP '{STAMP}' AS ingestion_time) FROM ({_arrived(GENERATION)})",
        *_RAW,
    ),
    "mixed_extracts": _show(f"SELECT * FROM ({_landing(GENERATION)})", *_RAW),
    "landed_once": _show(
        f"SELECT * FROM ({_landing(GENERATION)}) UNION ALL "
        f"SELECT * FROM ({_landing(GENERATION)}) WHERE type_name = 'click'",
        *_RAW,
    ),
    "exported_landing": _show(
        " UNION ALL ".join(
            f"SELECT '{f.name}' AS feed, partition_date, count(*) AS n_rows, sum(value) AS total "
            f"FROM ({_landing(f)}) GROUP BY ALL"
            for f in FEEDS.values()
        ),
        ["partition_date"],
        [],
        ["total"],
    ),
    "landing_layout": (
        "SELECT strftime(CASE event_type WHEN 'view' THEN DATE '2024-01-15' ELSE CAST(ts AS DATE) END, "
        "'%Y-%m-%d') AS partition_date, count(*) AS n_rows, CAST(0 AS BIGINT) AS misplaced, "
        "CAST(0 AS BIGINT) AS overlapping FROM events GROUP BY 1"
    ),
    "file_census": "SELECT count(DISTINCT CAST(ts AS DATE)) AS n_files FROM events",
    "seed_table": (
        "SELECT CAST(c_custkey AS VARCHAR) AS energy_source_code, "
        "c_name || ', \"' || c_mktsegment || '\"' AS energy_source_name FROM customer"
    ),
    "stored_refresh": _show_readings(_stored_refresh()),
    **{
        f"stored_{kind}_run_{name}": sql
        for kind in ("full", "window")
        for name, sql in (
            ("generation", _show(
                _mart_generation(_dim_generation(_stored_refresh())), measures=["total_generation"]
            )),
            ("dim_generation", _show(
                _dim_generation(_stored_refresh()), ["recorded_date"], [], ["num_units"]
            )),
            ("interchange", _show(
                _mart_interchange(_dim_interchange(_stored_refresh(INTERCHANGE))),
                ["recorded_date"], [], ["interchange"],
            )),
            ("dim_interchange", _show(
                _dim_interchange(_stored_refresh(INTERCHANGE)), ["recorded_date"], [], ["interchange"]
            )),
            ("forecast", _show(
                _mart_forecast(REFRESHED, readings=_stored_refresh(FORECAST)),
                ["recorded_date"], [], ["value"],
            )),
        )
    },
    "stored_window_run_forecast_trailing": _show(
        _mart_forecast(LATER, readings=_stored_refresh(FORECAST, f"DATE '{LATER}' - 12")),
        ["recorded_date"],
        [],
        ["value"],
    ),
    "stored_mart_display": _show(
        "SELECT 'table' AS source, recorded_date, flow AS name, CAST(interchange AS DOUBLE) AS value "
        f"FROM ({_FLOWS}) WHERE flow IN ({_quoted(FLOWS)}) UNION ALL "
        "SELECT 'csv', make_date(CAST(year AS INT), 1, 1), fuel, "
        "round(CAST(total_generation AS DOUBLE) / 1000000, 6) "
        f"FROM ({_MART_HISTORY}) WHERE fuel IN ({_quoted(FUELS)})",
        ["recorded_date"],
    ),
    "cached_marts": _show(
        "SELECT *, (SELECT count(*) FROM "
        f"({_mart_interchange(_dim_interchange(_first_build(INTERCHANGE)))})) AS rows_before "
        f"FROM ({_mart_interchange(_dim_interchange(_stored_refresh(INTERCHANGE)))})",
        ["recorded_date"],
        [],
        ["interchange"],
    ),
    "scheduled_days": (
        f"WITH l AS (SELECT * FROM ({_landing(GENERATION)})), days AS (SELECT * FROM (VALUES "
        f"(DATE '{REFRESHED}' - 1, FALSE), (DATE '{REFRESHED}', TRUE)) d(day, today)) "
        "SELECT strftime(day, '%Y-%m-%d') AS logical_date, (SELECT count(*) FROM l WHERE "
        f"partition_date BETWEEN DATE '{REFRESHED}' - 2 AND day - 1) AS landed, today AS transformed, "
        "CASE WHEN today THEN (SELECT count(DISTINCT (period, upper(respondent), upper(fueltype))) "
        f"FROM l WHERE partition_date BETWEEN DATE '{REFRESHED}' - 2 AND day - 1) ELSE 0 END AS readings "
        "FROM days"
    ),
    "as_of_today": (
        "SELECT recorded_hour, demand_type, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value, "
        "DATE '2024-01-30' - recorded_date <= 7 AS in_window, "
        "DATE '2024-01-30' - recorded_date AS days_ago "
        f"FROM ({_mart_forecast('2024-02-09')})"
    ),
    "page_slice": f"SELECT * FROM ({_PAGE}) ORDER BY {', '.join(PAGE_KEY)} LIMIT 1000 OFFSET 1000",
    "page_index": (
        "SELECT CAST(place // 1000 AS BIGINT) AS page, count(*) AS n_rows, "
        "min(period) AS first_period, max(period) AS last_period, "
        "CAST(sum(event_id) AS BIGINT) AS event_ids FROM (SELECT *, "
        f"row_number() OVER (ORDER BY {', '.join(PAGE_KEY)}) - 1 AS place FROM ({_PAGE})) GROUP BY 1"
    ),
    "page_counts": (
        "SELECT event_type, count(*) AS total, CAST(ceil(count(*) / 5000.0) AS BIGINT) AS pages "
        "FROM events GROUP BY 1"
    ),
}
