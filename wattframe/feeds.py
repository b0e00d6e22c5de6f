"""The four hourly feeds, described once.

Every staging, de-duplication, landing and upsert operator is driven by a
:class:`Feed`, so the feeds differ only in the data below.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

#: Exact numeric type of every measure.
MEASURE = T.DecimalType(38, 9)


@dataclass(frozen=True)
class Party:
    """One of the two entities a reading is about (a grid operator, a fuel, a subregion...)."""

    raw_id: str
    raw_name: str
    id: str
    name: str


@dataclass(frozen=True)
class Feed:
    name: str
    route: str
    parties: tuple[Party, Party]
    #: the two raw id columns in clustering order
    cluster_raw: tuple[str, str]
    #: a missing measure becomes 0 in staging, or stays missing
    zero_fill: bool
    #: days between the run date and the day a daily extract covers
    lag_days: int

    @property
    def landing_schema(self) -> T.StructType:
        text = [c for p in self.parties for c in (p.raw_id, p.raw_name)]
        return T.StructType(
            [T.StructField("period", T.StringType())]
            + [T.StructField(c, T.StringType()) for c in text]
            + [
                T.StructField("value", MEASURE),
                T.StructField("value_units", T.StringType()),
                T.StructField("ingestion_time", T.TimestampType()),
                T.StructField("partition_date", T.DateType()),
            ]
        )

    @property
    def required(self) -> tuple[str, ...]:
        """Landing columns a usable reading must have. The measure is not one of them."""
        ids = tuple(p.raw_id for p in self.parties)
        return ("partition_date", "period", *ids, "value_units", "ingestion_time")

    @property
    def key(self) -> tuple[str, ...]:
        return ("recorded_date", "recorded_hour", *(p.id for p in self.parties))

    @property
    def reading_columns(self) -> tuple[str, ...]:
        return (*self.key, "num_units", "unit", "ingestion_time")

    @property
    def cluster_by(self) -> tuple[str, ...]:
        by_raw = {p.raw_id: p.id for p in self.parties}
        return tuple(by_raw[c] for c in self.cluster_raw)

    @property
    def readings_schema(self) -> T.StructType:
        kinds = {
            "recorded_date": T.DateType(),
            "recorded_hour": T.LongType(),
            "num_units": MEASURE,
            "ingestion_time": T.TimestampType(),
        }
        return T.StructType(
            [T.StructField(c, kinds.get(c, T.StringType())) for c in self.reading_columns]
        )

    @property
    def landing_table(self) -> str:
        return f"landing_{self.name}"

    @property
    def staging_view(self) -> str:
        return f"stg_{self.name}"

    @property
    def readings_table(self) -> str:
        return f"int_{self.name}"


# Feed names, public API routes, column names.
FEEDS: dict[str, Feed] = {
    f.name: f
    for f in (
        Feed(
            name="generation",
            route="fuel-type-data",
            parties=(
                Party("respondent", "respondent_name", "respondent_id", "respondent"),
                Party("fueltype", "type_name", "fuel_id", "fuel_name"),
            ),
            cluster_raw=("respondent", "fueltype"),
            zero_fill=True,
            lag_days=1,
        ),
        Feed(
            name="demand_forecast",
            route="region-data",
            parties=(
                Party("respondent", "respondent_name", "respondent_id", "respondent"),
                Party("type", "type_name", "demand_type_id", "demand_type"),
            ),
            cluster_raw=("respondent", "type"),
            zero_fill=False,
            lag_days=0,
        ),
        Feed(
            name="demand_by_subregion",
            route="region-sub-ba-data",
            parties=(
                Party("subba", "subba_name", "sub_id", "sub_ba"),
                Party("parent", "parent_name", "parent_id", "parent_ba"),
            ),
            cluster_raw=("parent", "subba"),
            zero_fill=True,
            lag_days=1,
        ),
        Feed(
            name="interchange",
            route="interchange-data",
            parties=(
                Party("fromba", "fromba_name", "provider_id", "provider"),
                Party("toba", "toba_name", "recipient_id", "recipient"),
            ),
            cluster_raw=("fromba", "toba"),
            zero_fill=True,
            lag_days=1,
        ),
    )
}
