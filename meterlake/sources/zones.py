"""The zone list (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.casts import lenient_cast
from meterlake.schema import ZONES

# Header names of the zone file and the columns they become.
ZONE_HEADERS = {
    "LocationID": "location_id",
    "Borough": "borough",
    "Zone": "zone",
    "service_zone": "service_zone",
}


def normalize_zones(raw: DataFrame) -> DataFrame:
    types = {field.name: field.dataType for field in raw.schema.fields}
    missing = [header for header in ZONE_HEADERS if header not in types]
    if missing:
        raise ValueError(f"zone file lacks columns {missing}")
    return raw.select(
        *[
            lenient_cast(F.col(header), types[header], ZONES[name].dataType).alias(name)
            for header, name in ZONE_HEADERS.items()
        ]
    )


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone CSV. Text such as ``N/A`` stays text; an empty field is null."""
    return normalize_zones(spark.read.option("header", True).csv(path))
