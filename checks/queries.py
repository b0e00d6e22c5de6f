"""Registered queries: each operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import (
    FORECAST,
    GENERATION,
    INTERCHANGE,
    SUBREGION,
    balancing_authorities,
    energy_sources,
    envelopes,
    history,
    landing,
    pages,
    portable,
    read,
)
from wattframe.checkpoints import shared_folder
from wattframe.feeds import FEEDS, Feed
from wattframe.operators import series
from wattframe.operators.calendar import DAILY, MONTHLY, REFRESH, ingest_windows
from wattframe.operators.dimensions import dim_generation, dim_interchange, fuel_lookup
from wattframe.operators.increments import (
    beyond_high_water_mark,
    high_water_mark,
    incoming,
    within_window,
)
from wattframe.operators.latest import latest_readings
from wattframe.operators.marts import (
    by_fuel_and_size,
    marts_forecast,
    marts_generation,
    marts_interchange,
)
from wattframe.operators.paging import number_rows, page_count, page_slice
from wattframe.operators.staging import stage
from wattframe.operators.upsert import upsert
from wattframe.plans import jobs
from wattframe.plans.build import build_readings, run
from wattframe.plans.cache import MartCache
from wattframe.plans.warehouse import Warehouse
from wattframe.sources.landing import append_landing, conform, file_census, load_all, read_landing
from wattframe.sources.layout import layout_report
from wattframe.sources.marts import coerce_mart, load_marts
from wattframe.sources.pages import (
    normalize_feed_columns,
    page_rows,
    reconcile,
    stamp,
    union_pages,
)
from wattframe.sources.seeds import SEED_COLUMNS, normalize_seed_columns, read_seed, write_seed
from wattframe.streaming.extracts import stream_whole_extracts
from wattframe.streaming.landing import stream_landing

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-01-31"
#: A later run, whose trailing 30 days start inside the data.
LATER = "2024-02-09"
#: First build of the upsert queries ends here; their refresh runs on REFRESHED.
BUILT_TO = "2024-01-27"
REFRESHED = "2024-01-30"
STAMP = "2024-02-01 06:00:00"
FUELS = ("Wind", "Coal", "Natural gas", "Nuclear")
FLOWS = ("USA → Canada", "Canada → Mexico", "Mexico → USA")
EVENT_KINDS = ("view", "click", "purchase", "signup", "error")
PAGE_KEY = ("period", "user_id", "event_type", "event_id")


def _stg(feed: Feed) -> Query:
    return lambda spark, d: portable(stage(landing(spark, d, feed), feed))


def _readings(spark: SparkSession, d: str, feed: Feed) -> DataFrame:
    return latest_readings(stage(landing(spark, d, feed), feed), feed)


def _int(feed: Feed) -> Query:
    return lambda spark, d: portable(_readings(spark, d, feed))


def _history_readings(spark: SparkSession, d: str) -> DataFrame:
    return latest_readings(stage(history(spark, d), GENERATION), GENERATION)


def _fuels(spark: SparkSession, d: str) -> DataFrame:
    return fuel_lookup(energy_sources(spark, d))


def _dim_generation(spark: SparkSession, d: str) -> DataFrame:
    return dim_generation(
        _readings(spark, d, GENERATION), _fuels(spark, d), balancing_authorities(spark, d)
    )


def _dim_interchange(spark: SparkSession, d: str) -> DataFrame:
    return dim_interchange(_readings(spark, d, INTERCHANGE), balancing_authorities(spark, d))


def _mart_history(spark: SparkSession, d: str) -> DataFrame:
    return marts_generation(
        dim_generation(_history_readings(spark, d), _fuels(spark, d), balancing_authorities(spark, d))
    )


def _mart_interchange(spark: SparkSession, d: str) -> DataFrame:
    return marts_interchange(_dim_interchange(spark, d))


def _mart_forecast(spark: SparkSession, d: str, as_of: str = AS_OF) -> DataFrame:
    return marts_forecast(_readings(spark, d, FORECAST), as_of)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Landing rows to the ordered generation mart."""
    return portable(by_fuel_and_size(marts_generation(_dim_generation(spark, d))))


def _known_respondents(spark: SparkSession, d: str) -> DataFrame:
    known = balancing_authorities(spark, d).select(F.col("ba_code").alias("respondent_id"))
    return portable(marts_forecast(_readings(spark, d, FORECAST), AS_OF, respondents=known))


def _filter_backfill(spark: SparkSession, d: str) -> DataFrame:
    staged = stage(landing(spark, d, GENERATION), GENERATION)
    target = latest_readings(
        staged.where(F.col("recorded_date") <= F.lit(BUILT_TO).cast("date")), GENERATION
    )
    return portable(staged.where(beyond_high_water_mark(target)))


def _corrected(staged: DataFrame) -> DataFrame:
    """A later delivery of the same readings with other measures."""
    return staged.withColumns(
        {
            "num_units": (F.col("num_units") + 1).cast("decimal(38,9)"),
            "ingestion_time": F.col("ingestion_time") + F.expr("interval 1 day"),
        }
    )


def _upsert(feed: Feed, source_days: int, merge_days: int) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        staged = stage(landing(spark, d, feed), feed)
        first = staged.where(F.col("recorded_date") <= F.lit(BUILT_TO).cast("date"))
        late = incoming(
            _corrected(staged), "refresh", as_of=REFRESHED, window_days=source_days
        )
        return portable(
            upsert(
                latest_readings(first, feed),
                latest_readings(late, feed),
                feed,
                REFRESHED,
                merge_days,
            )
        )

    return query


def _backfilled(spark: SparkSession, d: str) -> DataFrame:
    """A table built to BUILT_TO, then backfilled with everything newer."""
    staged = stage(landing(spark, d, GENERATION), GENERATION)
    target = latest_readings(
        staged.where(F.col("recorded_date") <= F.lit(BUILT_TO).cast("date")), GENERATION
    )
    newer = incoming(_corrected(staged), "backfill", target=target)
    return portable(target.unionByName(latest_readings(newer, GENERATION)))


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return (
        read(spark, d, "orders")
        .select(F.col("o_orderdate").cast("date").alias("logical_date"))
        .distinct()
    )


def _windows(kind: str) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        runs = _runs(spark, d)
        if kind == MONTHLY:
            runs = runs.select(F.trunc("logical_date", "month").alias("logical_date")).distinct()
        return portable(ingest_windows(runs, kind))

    return query


def _page_ingest(spark: SparkSession, d: str) -> DataFrame:
    return portable(conform(stamp(page_rows(pages(spark, d, GENERATION)), STAMP), GENERATION))


def _union_pages(spark: SparkSession, d: str) -> DataFrame:
    return portable(
        union_pages(
            page_rows(pages(spark, d, GENERATION)).withColumn("value", F.col("value").cast("double")),
            page_rows(pages(spark, d, FORECAST)).withColumn("value", F.col("value").cast("double")),
        )
    )


def _normalize_feed(spark: SparkSession, d: str) -> DataFrame:
    raw = read(spark, d, "events").select(
        F.col("event_id").alias("Event-ID"),
        F.col("event_type").alias("type-Name"),
        F.col("value").alias("VALUE"),
    )
    return portable(normalize_feed_columns(raw))


def _normalize_seed(spark: SparkSession, d: str) -> DataFrame:
    raw = read(spark, d, "customer").select(
        F.col("c_custkey").alias("BA Code"),
        F.col("c_name").alias("BA Name"),
        F.col("c_mktsegment").alias("Region/Country  Name"),
        F.col("c_nationkey").cast("bigint").alias("U.S. BA"),
    )
    return portable(normalize_seed_columns(raw))


def _stamp(spark: SparkSession, d: str) -> DataFrame:
    rows = landing(spark, d, GENERATION).drop("ingestion_time", "partition_date")
    return portable(stamp(rows, STAMP))


def _conform(spark: SparkSession, d: str) -> DataFrame:
    """An extract whose measures came as text and whose names are missing."""
    rows = landing(spark, d, INTERCHANGE).drop("fromba_name")
    return portable(conform(rows.withColumn("value", F.col("value").cast("string")), INTERCHANGE))


def _coerce(spark: SparkSession, d: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    text = read(spark, d, "events").select(
        "event_id",
        F.when(failed, "n/a").otherwise(F.col("value").cast("string")).alias("total_generation"),
        F.when(failed, "unknown").otherwise(F.date_format("ts", "yyyy")).alias("year"),
        F.when(~failed, F.col("event_type")).alias("energy_type"),
        F.col("event_type").alias("fuel"),
        F.date_format("ts", "yyyy.MM.dd").alias("recorded_date"),
        F.when(failed, "").otherwise(F.col("value").cast("string")).alias("interchange"),
    )
    return portable(coerce_mart(text))


def _paged(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH").alias("period"),
        "user_id",
        "event_type",
        "event_id",
        "value",
    )


def _page_index(spark: SparkSession, d: str) -> DataFrame:
    """Every page of the whole table: size, first and last period."""
    numbered = number_rows(_paged(spark, d), PAGE_KEY)
    page = F.floor(F.col("position") / 1000).alias("page")
    return numbered.groupBy(page).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("period").alias("first_period"),
        F.max("period").alias("last_period"),
        F.sum("event_id").alias("event_ids"),
    )


def _page_counts(spark: SparkSession, d: str) -> DataFrame:
    per_type = _paged(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("total"))
    return per_type.withColumn("pages", page_count(F.col("total")))


def _landing_table(spark: SparkSession, d: str) -> DataFrame:
    """Two extracts of the same rows, one with measures as text, landed and read back."""
    root = shared_folder(spark)
    rows = landing(spark, d, SUBREGION)
    rows.write.parquet(f"{root}/a/exact.parquet")
    rows.withColumn("value", F.col("value").cast("string")).write.parquet(f"{root}/a/text.parquet")
    load_all(spark, [f"{root}/a"], SUBREGION, f"{root}/landing")
    return portable(read_landing(spark, f"{root}/landing", SUBREGION))


def _streamed_landing(spark: SparkSession, d: str) -> DataFrame:
    """Pages written as files of lines, picked up by the stream, read back from landing."""
    root = shared_folder(spark)
    envelopes(spark, d, GENERATION).select("body").write.text(f"{root}/pages")
    stream = stream_landing(
        spark, f"{root}/pages", GENERATION, f"{root}/landing", f"{root}/progress", lines=True
    )
    stream.awaitTermination()
    return portable(read_landing(spark, f"{root}/landing", GENERATION).drop("ingestion_time"))


def _page_files_ingest(spark: SparkSession, d: str) -> DataFrame:
    """A month's page files through the monthly job: counted and written in one pass, landed."""
    house = Warehouse(spark, shared_folder(spark))
    month = envelopes(spark, d, GENERATION, extract="trunc(partition_date, 'month')")
    month.select("body").write.text(f"{house.root}/pages")
    jobs.ingest(
        house, GENERATION, f"{house.root}/pages", date(2024, 1, 1), STAMP, monthly=True, lines=True
    )
    return portable(house.landing(GENERATION))


def _whole_extracts(spark: SparkSession, d: str) -> DataFrame:
    """Hourly extracts whose pages arrive in two deliveries; pages of errors came without their
    rows, so the extracts of their hours never are whole."""
    root = shared_folder(spark)
    hourly = envelopes(spark, d, GENERATION, lossy=True, extract="period")
    hourly = hourly.withColumn("late", F.col("kind") == "click").repartition("extract_date")
    for late in (False, True):
        some = hourly.where(F.col("late") == late).select("body", "extract_date")
        some.write.mode("append").partitionBy("extract_date").text(f"{root}/pages")
        stream_whole_extracts(
            spark, f"{root}/pages", GENERATION, f"{root}/landing", f"{root}/state", lines=True,
            ingestion_time=STAMP,
        ).awaitTermination()
    return portable(read_landing(spark, f"{root}/landing", GENERATION))


def _extract_of_kind(spark: SparkSession, d: str, path: str, kind: str, value: str) -> None:
    rows = landing(spark, d, GENERATION).where(F.col("type_name") == kind)
    rows.withColumn("value", F.col("value").cast(value)).write.mode("overwrite").parquet(path)


def _mixed_extracts(spark: SparkSession, d: str) -> DataFrame:
    """Five extracts whose measures are of four types, landed in one load."""
    root = shared_folder(spark)
    types = ("string", "double", "decimal(12,2)", "string", "float")
    for kind, value in zip(EVENT_KINDS, types):
        _extract_of_kind(spark, d, f"{root}/api/{kind}.parquet", kind, value)
    load_all(spark, [f"{root}/api"], GENERATION, f"{root}/landing")
    rows = read_landing(spark, f"{root}/landing", GENERATION)
    # a float is near to the two decimals that it was made from
    return portable(rows.withColumn("value", F.round("value", 2)))


def _landed_once(spark: SparkSession, d: str) -> DataFrame:
    """Extracts loaded twice through a ledger, then once more with one of them pulled again."""
    root = shared_folder(spark)

    def load() -> None:
        load_all(spark, [f"{root}/api"], GENERATION, f"{root}/landing", f"{root}/ledger")

    for kind in EVENT_KINDS:
        _extract_of_kind(spark, d, f"{root}/api/{kind}.parquet", kind, "string")
    load()
    load()
    _extract_of_kind(spark, d, f"{root}/api/click.parquet", "click", "double")
    load()
    return portable(read_landing(spark, f"{root}/landing", GENERATION))


def _exports(spark: SparkSession, d: str) -> DataFrame:
    """One export of each feed, landed; rows and measures by feed and day."""
    house = Warehouse(spark, shared_folder(spark))
    for name, feed in FEEDS.items():
        landing(spark, d, feed).write.parquet(f"{house.root}/batch/{name}.parquet")
    jobs.exports(house, {name: f"{house.root}/batch/{name}.parquet" for name in FEEDS})
    parts = [
        house.landing(feed)
        .groupBy(F.lit(name).alias("feed"), "partition_date")
        .agg(F.count("*").alias("n_rows"), F.sum("value").alias("total"))
        for name, feed in FEEDS.items()
    ]
    return portable(reduce(DataFrame.unionAll, parts))


def _census(spark: SparkSession, d: str) -> DataFrame:
    """Extract files of a lake: one for each day of the month, written by a job."""
    root = shared_folder(spark)
    days = landing(spark, d, GENERATION).withColumn("day", F.col("partition_date"))
    days.repartition("day").write.partitionBy("day").parquet(f"{root}/api/generation")
    return file_census(spark, root)


def _layout(spark: SparkSession, d: str) -> DataFrame:
    """A landing table of two loads, one day with a third of all rows, after its days were put in
    order; rows, misplaced rows and overlapping files of each day."""
    house = Warehouse(spark, shared_folder(spark))
    hot = F.when(F.col("type_name") == "view", F.lit("2024-01-15").cast("date"))
    rows = landing(spark, d, GENERATION)
    rows = rows.withColumn("partition_date", F.coalesce(hot, "partition_date"))
    for late in (False, True):
        some = rows.where((F.col("type_name") == "click") == late)
        append_landing(some, GENERATION, house.path(GENERATION.landing_table))
    jobs.recluster(house, GENERATION)
    report = layout_report(spark, house.path(GENERATION.landing_table), GENERATION)
    return portable(report.drop("n_files"))


def _land_early(house: Warehouse, d: str, feed: Feed = GENERATION) -> None:
    rows = landing(house.spark, d, feed)
    early = rows.where(F.col("partition_date") <= F.lit(BUILT_TO).cast("date"))
    append_landing(early, feed, house.path(feed.landing_table))


def _land_corrected(house: Warehouse, d: str, feed: Feed = GENERATION) -> None:
    corrected = landing(house.spark, d, feed).withColumns(
        {
            "value": F.col("value") + 1,
            "ingestion_time": F.col("ingestion_time") + F.expr("interval 1 day"),
        }
    )
    append_landing(corrected, feed, house.path(feed.landing_table))


def _with_seeds(spark: SparkSession, d: str) -> Warehouse:
    house = Warehouse(spark, shared_folder(spark))
    for name, seed in (
        ("energy_sources", energy_sources(spark, d)),
        ("balancing_authorities", balancing_authorities(spark, d)),
    ):
        columns = [
            (F.col(c) if c in seed.columns else F.lit(None).cast("string")).alias(c)
            for c in SEED_COLUMNS[name]
        ]
        write_seed(seed.select(*columns), house.path(name))
    return house


def _corrected_run(
    spark: SparkSession,
    d: str,
    feed: Feed,
    rebuild_all: bool,
    as_of: str = REFRESHED,
    window_days: int = 7,
) -> Warehouse:
    """A full run to BUILT_TO, a correction of one feed, and a refresh."""
    house = _with_seeds(spark, d)
    for other in FEEDS.values():
        if other is not feed:
            append_landing(landing(spark, d, other), other, house.path(other.landing_table))
    _land_early(house, d, feed)
    run(house, BUILT_TO, "full")
    _land_corrected(house, d, feed)
    run(house, as_of, "refresh", window_days, rebuild_all=rebuild_all)
    return house


def _stored_run(table: str, feed: Feed, rebuild_all: bool, **options) -> Query:
    """A table read back after a full run, a correction and a refresh."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        return portable(_corrected_run(spark, d, feed, rebuild_all, **options).table(table))

    return query


def _display(spark: SparkSession, d: str) -> DataFrame:
    """A stored mart read for display, and one that there is only a CSV of, with where each came
    from: flows from the table, fuels from the file."""
    house = _with_seeds(spark, d)
    mart = house.replace("marts_interchange", _mart_interchange(spark, d))
    csv = f"{house.root}/generation.csv"
    _mart_history(spark, d).write.csv(csv, header=True)
    spark.catalog.dropTempView("marts_generation")
    marts, sources = load_marts(spark, {"marts_interchange": "/absent.csv", "marts_generation": csv})
    flows = series.flow_series(marts["marts_interchange"], FLOWS).select(
        F.lit(sources["marts_interchange"]).alias("source"),
        "recorded_date",
        F.col("flow").alias("name"),
        F.col("interchange").cast("double").alias("value"),
    )
    fuels = series.fuel_series_absolute(marts["marts_generation"], FUELS).select(
        F.lit(sources["marts_generation"]).alias("source"),
        F.make_date("Year", F.lit(1), F.lit(1)).alias("recorded_date"),
        F.col("Fuel").alias("name"),
        F.round("value", 6).alias("value"),
    )
    assert mart.columns == marts["marts_interchange"].columns
    return portable(flows.unionAll(fuels))


def _cached(spark: SparkSession, d: str) -> DataFrame:
    """A mart kept in the cache, read before and after its table was rebuilt by a refresh."""
    house = _with_seeds(spark, d)
    for feed in FEEDS.values():
        _land_early(house, d, feed)
    run(house, BUILT_TO, "full")
    cache = MartCache(house)
    before = cache.get("marts_interchange").agg(F.count("*").alias("n")).first()["n"]
    _land_corrected(house, d, INTERCHANGE)
    run(house, REFRESHED, "refresh", rebuild_all=False)
    after = cache.get("marts_interchange")
    return portable(after.withColumn("rows_before", F.lit(before).cast("bigint")))


def _scheduled(spark: SparkSession, d: str) -> DataFrame:
    """Two daily runs over page files: one dated before today only lands its extract, one dated
    today transforms, too. Their ``landed`` rows, and whether readings existed by then."""
    house = _with_seeds(spark, d)
    for feed in FEEDS.values():
        if feed is not GENERATION:
            append_landing(landing(spark, d, feed), feed, house.path(feed.landing_table))
    today = date.fromisoformat(REFRESHED)
    parts = []
    for days_ago in (1, 0):
        logical = today - timedelta(days=days_ago)
        day = logical - timedelta(days=GENERATION.lag_days)
        one = envelopes(spark, d, GENERATION).where(F.col("extract_date") == F.lit(day))
        one.select("body").write.text(f"{house.root}/pages/{day}")
        jobs.daily(
            house, logical, today, {"generation": f"{house.root}/pages/{day}"}, STAMP, lines=True
        )
        landed = house.landing(GENERATION).count()
        readings = house.readings(GENERATION)
        parts.append((str(logical), landed, readings is not None, readings.count() if readings else 0))
    return spark.createDataFrame(
        parts, "logical_date string, landed bigint, transformed boolean, readings bigint"
    )


def _of_today(spark: SparkSession, d: str) -> DataFrame:
    """The forecast mart and the look-back as of the current date, over readings moved so that the
    last day of the data is today; days as their distance from it."""
    rows = landing(spark, d, FORECAST)
    shift = F.date_diff(F.current_date(), F.lit("2024-01-30").cast("date"))
    moved = F.date_add("partition_date", shift)
    hour = F.substring("period", 11, 3)
    rows = rows.withColumns(
        {"partition_date": moved, "period": F.concat(moved.cast("string"), hour)}
    )
    staged = stage(rows, FORECAST)
    mart = marts_forecast(latest_readings(staged, FORECAST), days=20).withColumn(
        "in_window", within_window()
    )
    ago = F.date_diff(F.current_date(), "recorded_date").cast("bigint")
    return portable(mart.withColumn("days_ago", ago).drop("recorded_date"))


def _stored_refresh(spark: SparkSession, d: str) -> DataFrame:
    """A stored table built to BUILT_TO, then refreshed from a corrected delivery."""
    house = Warehouse(spark, shared_folder(spark))
    _land_early(house, d)
    build_readings(house, GENERATION, "full", BUILT_TO)
    _land_corrected(house, d)
    build_readings(house, GENERATION, "refresh", REFRESHED)
    return portable(house.readings(GENERATION))


def _seed_table(spark: SparkSession, d: str) -> DataFrame:
    """A reference table written as CSV with published headers, and read back."""
    path = f"{shared_folder(spark)}/energy_sources"
    raw = read(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("Energy Source Code"),
        F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("Energy Source Name"),
    )
    write_seed(raw, path)
    return read_seed(spark, "energy_sources", path)


QUERIES: dict[str, Query] = {
    # staging
    "stg_generation": _stg(GENERATION),
    "stg_interchange": _stg(INTERCHANGE),
    "stg_demand_forecast": _stg(FORECAST),
    "stg_demand_by_subregion": _stg(SUBREGION),
    # latest reading per key
    "int_generation": _int(GENERATION),
    "int_interchange": _int(INTERCHANGE),
    "int_demand_forecast": _int(FORECAST),
    "int_demand_by_subregion": _int(SUBREGION),
    "int_generation_history": lambda spark, d: portable(_history_readings(spark, d)),
    # dimensions
    "fuel_lookup": lambda spark, d: portable(_fuels(spark, d)),
    "dim_generation": lambda spark, d: portable(_dim_generation(spark, d)),
    "dim_interchange": lambda spark, d: portable(_dim_interchange(spark, d)),
    # marts
    "marts_generation": flagship,
    "marts_generation_history": lambda spark, d: portable(by_fuel_and_size(_mart_history(spark, d))),
    "marts_interchange": lambda spark, d: portable(_mart_interchange(spark, d)),
    "marts_forecast": lambda spark, d: portable(_mart_forecast(spark, d)),
    "marts_forecast_trailing": lambda spark, d: portable(_mart_forecast(spark, d, LATER)),
    "marts_forecast_known_respondents": _known_respondents,
    # incremental
    "filter_refresh": lambda spark, d: portable(
        stage(landing(spark, d, GENERATION), GENERATION).where(within_window(AS_OF))
    ),
    "filter_backfill": _filter_backfill,
    "high_water_mark": lambda spark, d: portable(high_water_mark(_readings(spark, d, GENERATION))),
    "upsert_generation": _upsert(GENERATION, 7, 7),
    "upsert_interchange": _upsert(INTERCHANGE, 7, 7),
    "upsert_demand_forecast": _upsert(FORECAST, 7, 7),
    "upsert_demand_by_subregion": _upsert(SUBREGION, 7, 7),
    "upsert_wide_window": _upsert(GENERATION, 10, 7),
    "backfill_generation": _backfilled,
    # dashboard series
    "fuel_series_absolute": lambda spark, d: portable(
        series.fuel_series_absolute(_mart_history(spark, d), FUELS).withColumn(
            "value", F.round("value", 6)
        )
    ),
    "fuel_series_share": lambda spark, d: portable(
        series.fuel_series_share(_mart_history(spark, d), FUELS).withColumn(
            "value", F.round("value", 6)
        )
    ),
    "energy_mix": lambda spark, d: portable(series.energy_mix(_mart_history(spark, d))),
    "demand_series": lambda spark, d: portable(series.demand_series(_mart_forecast(spark, d))),
    "flow_series": lambda spark, d: portable(series.flow_series(_mart_interchange(spark, d), FLOWS)),
    "distinct_fuels": lambda spark, d: series.distinct_fuels(_mart_history(spark, d)),
    "distinct_flows": lambda spark, d: series.distinct_flows(_mart_interchange(spark, d)),
    "default_flows": lambda spark, d: series.default_flows(_mart_interchange(spark, d)),
    # ingest
    "ingest_windows_daily": _windows(DAILY),
    "ingest_windows_refresh": _windows(REFRESH),
    "ingest_windows_monthly": _windows(MONTHLY),
    "page_ingest": _page_ingest,
    "reconcile_counts": lambda spark, d: portable(
        reconcile(pages(spark, d, GENERATION, lossy=True), "extract_date")
    ),
    "union_pages": _union_pages,
    "normalize_feed_columns": _normalize_feed,
    "normalize_seed_columns": _normalize_seed,
    "stamp_partition_date": _stamp,
    "conform_landing": _conform,
    "coerce_mart": _coerce,
    "landing_table": _landing_table,
    "streamed_landing": _streamed_landing,
    "whole_extracts": _whole_extracts,
    "page_files_ingest": _page_files_ingest,
    "mixed_extracts": _mixed_extracts,
    "landed_once": _landed_once,
    "exported_landing": _exports,
    "file_census": _census,
    "landing_layout": _layout,
    "seed_table": _seed_table,
    "stored_refresh": _stored_refresh,
    **{
        f"stored_{kind}_run_{name}": _stored_run(table, feed, kind == "full")
        for kind in ("full", "window")
        for name, table, feed in (
            ("generation", "marts_generation", GENERATION),
            ("dim_generation", "dim_generation", GENERATION),
            ("interchange", "marts_interchange", INTERCHANGE),
            ("dim_interchange", "dim_interchange", INTERCHANGE),
            ("forecast", "marts_forecast", FORECAST),
        )
    },
    "stored_window_run_forecast_trailing": _stored_run(
        "marts_forecast", FORECAST, False, as_of=LATER, window_days=12
    ),
    "stored_mart_display": _display,
    "cached_marts": _cached,
    "scheduled_days": _scheduled,
    "as_of_today": _of_today,
    "page_slice": lambda spark, d: page_slice(_paged(spark, d), PAGE_KEY, 1, 1000),
    "page_index": _page_index,
    "page_counts": _page_counts,
}
