"""Row quality flags (B10-B15) and the status derived from them."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.schema import FLAGS

# Limits beyond which a row is flagged.
MAX_TRIP_MILES = 250.0
FIRST_ZONE, LAST_ZONE = 1, 265


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def negative_fare() -> Column:
    return (_or_zero("fare_amount") < 0) | (_or_zero("total_amount") < 0)


def invalid_distance() -> Column:
    distance = _or_zero("trip_distance")
    return (distance < 0) | (distance > MAX_TRIP_MILES)


def temporal_anomaly() -> Column:
    return F.coalesce(F.col("pickup_datetime") > F.col("dropoff_datetime"), F.lit(False))


def _known_zone(name: str) -> Column:
    return F.coalesce(F.col(name).between(FIRST_ZONE, LAST_ZONE), F.lit(False))


def invalid_zone() -> Column:
    return ~(_known_zone("pickup_location_id") & _known_zone("dropoff_location_id"))


def null_key() -> Column:
    columns = ("vendor_id", "pickup_datetime", "dropoff_datetime")
    return reduce(or_, [F.col(c).isNull() for c in columns])


def row_flags(schema_drift: bool | Column) -> dict[str, Column]:
    """The six flags by name; drift is a property of the whole batch."""
    drift = schema_drift if isinstance(schema_drift, Column) else F.lit(bool(schema_drift))
    return dict(
        zip(
            FLAGS,
            (
                negative_fare(),
                invalid_distance(),
                temporal_anomaly(),
                invalid_zone(),
                null_key(),
                drift,
            ),
        )
    )


def quality_status() -> Column:
    flagged = reduce(or_, [F.col(flag) for flag in FLAGS])
    return F.when(flagged, "flagged").otherwise("valid")
