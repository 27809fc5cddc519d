"""Staging views over silver, zones and ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.schema import LEDGER, STAGED_TRIPS, ZONES


def stage_trips(silver: DataFrame) -> DataFrame:
    pickup, distance = F.col("pickup_datetime"), F.col("trip_distance")
    return silver.withColumns(
        {
            "trip_month": F.date_trunc("month", pickup).cast("date"),
            "pickup_date": pickup.cast("date"),
            "pickup_hour": F.hour(pickup),
            # Total, not fare, per mile.
            "fare_per_mile": F.when(distance > 0, F.col("total_amount") / distance),
        }
    ).select(*STAGED_TRIPS.names)


def stage_zones(zones: DataFrame) -> DataFrame:
    return zones.select(*ZONES.names)


def stage_batches(batches: DataFrame) -> DataFrame:
    return batches.select(*LEDGER.names)
