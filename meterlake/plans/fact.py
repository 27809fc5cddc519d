"""The trip fact (M3) and its incremental refresh (I4)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.keys import surrogate_key
from meterlake.operators.upsert import merge
from meterlake.plans.dimensions import NO_ZONE
from meterlake.schema import FACT, TRIP_KEY

EPOCH = datetime(1900, 1, 1, tzinfo=timezone.utc)


def trip_fact(staged: DataFrame, vendors: DataFrame, zones: DataFrame) -> DataFrame:
    """Staged trips with surrogate keys.

    A trip without vendor has no vendor key; a location outside the dimension gets the
    key of the no-zone row. The dimensions carry no broadcast hint: read from tables,
    their size is known and decides the join.
    """
    vendor = vendors.select("taxi_type", "vendor_id", "vendor_sk")
    no_zone = surrogate_key(F.lit(NO_ZONE))

    def zone(side: str) -> DataFrame:
        return zones.select(
            F.col("location_id").alias(f"_{side}"), F.col("zone_sk").alias(f"_{side}_sk")
        )

    def location(side: str):
        return F.coalesce(F.col(f"{side}_location_id"), F.lit(NO_ZONE)) == F.col(f"_{side}")

    return (
        staged.join(vendor, ["taxi_type", "vendor_id"], "left")
        .join(zone("pickup"), location("pickup"), "left")
        .join(zone("dropoff"), location("dropoff"), "left")
        .withColumns(
            {
                "trip_sk": surrogate_key(*TRIP_KEY),
                "pickup_zone_sk": F.coalesce("_pickup_sk", no_zone),
                "dropoff_zone_sk": F.coalesce("_dropoff_sk", no_zone),
            }
        )
        .select(*FACT.names)
    )


def high_water_mark(fact: DataFrame) -> datetime:
    """Latest ``updated_at`` of the fact, 1900-01-01 when it is empty."""
    latest = F.unix_micros(F.max("updated_at")).alias("micros")
    micros = fact.agg(latest).first()["micros"]
    return EPOCH if micros is None else datetime.fromtimestamp(micros / 1e6, timezone.utc)


def changed_since(staged: DataFrame, mark: datetime) -> DataFrame:
    """Trips updated at or after the mark. As a literal it reaches the parquet scan.

    Rows at the mark itself are taken again, which changes nothing.
    """
    return staged.where(F.col("updated_at") >= F.lit(mark))


def refreshed_fact(fact: DataFrame, delta: DataFrame) -> DataFrame:
    """The fact with ``delta`` rows in place of rows of the same key and source month."""
    return merge(fact, delta.select(*fact.columns), keep=())
