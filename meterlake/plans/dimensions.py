"""Vendor and zone dimensions (M1, M2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.keys import surrogate_key

# Vendor names by id; any other id is unknown.
VENDOR_NAMES = {1: "Creative Mobile Technologies", 2: "VeriFone", 4: "Via"}
UNKNOWN = "Unknown"
# Trips without a location belong to this zone.
NO_ZONE = 0


def vendor_name(vendor_id: Column) -> Column:
    known = [F.when(vendor_id == number, text) for number, text in VENDOR_NAMES.items()]
    return F.coalesce(*known, F.lit(UNKNOWN))


def vendor_dimension(trips: DataFrame) -> DataFrame:
    """One row per vendor seen, the missing vendor included."""
    return trips.select("taxi_type", "vendor_id").distinct().select(
        surrogate_key("taxi_type", "vendor_id").alias("vendor_sk"),
        "taxi_type",
        "vendor_id",
        vendor_name(F.col("vendor_id")).alias("vendor_name"),
    )


def observed_zones(trips: DataFrame) -> DataFrame:
    """Distinct pickup and dropoff locations, null included, in one pass."""
    both = F.explode(F.array("pickup_location_id", "dropoff_location_id"))
    return trips.select(both.alias("location_id")).distinct()


def unknown_zones(observed: DataFrame, zones: DataFrame) -> DataFrame:
    """Locations seen in trips that the zone list lacks."""
    return observed.where(F.col("location_id").isNotNull()).join(
        zones.select("location_id"), "location_id", "left_anti"
    )


def zone_dimension(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Listed zones, unlisted ones seen in trips, and the no-zone row.

    The no-zone row appears once, also when location 0 is seen in trips or listed; a
    second one would repeat every trip without a location in the fact.
    """
    no_zone = trips.sparkSession.range(1).select(F.lit(NO_ZONE).cast("int").alias("location_id"))
    seen = observed_zones(trips).where(F.col("location_id") != NO_ZONE).union(no_zone)
    unknown = unknown_zones(seen, zones)
    rows = zones.select(
        "location_id", "borough", "zone", "service_zone", F.lit(True).alias("is_known_zone")
    ).unionByName(
        unknown.select(
            "location_id",
            F.lit(UNKNOWN).alias("borough"),
            F.lit(UNKNOWN).alias("zone"),
            F.lit(UNKNOWN).alias("service_zone"),
            F.lit(False).alias("is_known_zone"),
        )
    )
    return rows.select(surrogate_key("location_id").alias("zone_sk"), "*")
