"""Canonical columns and table schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TripColumn:
    """A canonical trip column, its type, and the lower-case source names it accepts."""

    name: str
    dtype: T.DataType
    sources: tuple[str, ...]


_LONG, _DOUBLE, _TEXT, _WHEN = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()

# The canonical trip columns, in order, with their source names.
TRIP_COLUMNS = (
    TripColumn("vendor_id", _LONG, ("vendorid", "vendor_id")),
    TripColumn(
        "pickup_datetime",
        _WHEN,
        ("tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime"),
    ),
    TripColumn(
        "dropoff_datetime",
        _WHEN,
        ("tpep_dropoff_datetime", "lpep_dropoff_datetime", "dropoff_datetime"),
    ),
    TripColumn("passenger_count", _DOUBLE, ("passenger_count",)),
    TripColumn("trip_distance", _DOUBLE, ("trip_distance",)),
    TripColumn("rate_code_id", _LONG, ("ratecodeid", "rate_code_id")),
    TripColumn("store_and_fwd_flag", _TEXT, ("store_and_fwd_flag",)),
    TripColumn("pickup_location_id", _LONG, ("pulocationid", "pickup_location_id")),
    TripColumn("dropoff_location_id", _LONG, ("dolocationid", "dropoff_location_id")),
    TripColumn("payment_type", _LONG, ("payment_type",)),
    TripColumn("fare_amount", _DOUBLE, ("fare_amount",)),
    TripColumn("extra", _DOUBLE, ("extra",)),
    TripColumn("mta_tax", _DOUBLE, ("mta_tax",)),
    TripColumn("tip_amount", _DOUBLE, ("tip_amount",)),
    TripColumn("tolls_amount", _DOUBLE, ("tolls_amount",)),
    TripColumn("improvement_surcharge", _DOUBLE, ("improvement_surcharge",)),
    TripColumn("total_amount", _DOUBLE, ("total_amount",)),
    TripColumn("congestion_surcharge", _DOUBLE, ("congestion_surcharge",)),
    TripColumn("airport_fee", _DOUBLE, ("airport_fee",)),
    TripColumn("trip_type", _LONG, ("trip_type",)),
    TripColumn("ehail_fee", _DOUBLE, ("ehail_fee",)),
)

TRIP_NAMES = tuple(column.name for column in TRIP_COLUMNS)
ALIASES = {source: column.name for column in TRIP_COLUMNS for source in column.sources}

# The columns that identify a trip, and those that identify its content.
BUSINESS_KEY = (
    "taxi_type",
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "passenger_count",
)
FINGERPRINT = BUSINESS_KEY + (
    "trip_distance",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "total_amount",
)

TAXI_TYPES = ("yellow", "green")

PROVENANCE = ("batch_id", "taxi_type", "source_year_month", "source_file_name")
ROW_NUMBER = "row_number_in_file"
BASE_COLUMNS = PROVENANCE + (ROW_NUMBER,) + TRIP_NAMES

# The flags of a trip.
FLAGS = (
    "has_negative_fare",
    "has_invalid_distance",
    "has_temporal_anomaly",
    "has_invalid_zone",
    "has_null_key",
    "has_schema_drift",
)
PREPARED_COLUMNS = (
    ("business_trip_key", "row_fingerprint") + BASE_COLUMNS + FLAGS + ("quality_status",)
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


def _stored(column: TripColumn) -> tuple[str, T.DataType]:
    return (column.name, T.IntegerType() if column.dtype == _LONG else column.dtype)


TRIP_KEY = ("business_trip_key", "source_year_month")
# Hash of the trip key; travels with prepared trips and is not stored.
KEY_HASH = "trip_key_hash"
TRIP_PARTITIONS = ("source_year_month", "taxi_type")

# The columns of the trip table.
SILVER = _struct(
    ("business_trip_key", _TEXT),
    ("source_year_month", _TEXT),
    ("row_fingerprint", _TEXT),
    ("batch_id", _TEXT),
    ("taxi_type", _TEXT),
    ("source_file_name", _TEXT),
    *[_stored(column) for column in TRIP_COLUMNS],
    *[(flag, T.BooleanType()) for flag in FLAGS],
    ("quality_status", _TEXT),
    ("loaded_at", T.TimestampType()),
    ("updated_at", T.TimestampType()),
)

# Staged trips: silver with dates after the pickup and dropoff, and the fare rate.
_PICKUP_DATES = (
    ("trip_month", T.DateType()),
    ("pickup_date", T.DateType()),
    ("pickup_hour", T.IntegerType()),
)
_AFTER_TIMES = SILVER.fieldNames().index("passenger_count")
_AFTER_TRIP = SILVER.fieldNames().index(FLAGS[0])
STAGED_TRIPS = T.StructType(
    SILVER.fields[:_AFTER_TIMES]
    + _struct(*_PICKUP_DATES).fields
    + SILVER.fields[_AFTER_TIMES:_AFTER_TRIP]
    + [T.StructField("fare_per_mile", _DOUBLE)]
    + SILVER.fields[_AFTER_TRIP:]
)

# The fact: staged trips with surrogate keys in place of vendor and load details.
FACT_KEYS = ("trip_sk", "vendor_sk", "pickup_zone_sk", "dropoff_zone_sk")
FACT = T.StructType(
    [STAGED_TRIPS[name] for name in TRIP_KEY]
    + _struct(*[(name, _TEXT) for name in FACT_KEYS]).fields
    + [
        field
        for field in STAGED_TRIPS.fields
        if field.name not in (*TRIP_KEY, "vendor_id", "batch_id", "row_fingerprint")
    ]
)

# The columns of the batch ledger.
LEDGER = _struct(
    ("batch_id", _TEXT),
    ("taxi_type", _TEXT),
    ("year_month", _TEXT),
    ("source_url", _TEXT),
    ("source_file_name", _TEXT),
    ("bronze_object_key", _TEXT),
    ("source_etag", _TEXT),
    ("source_last_modified", T.TimestampType()),
    ("source_rows", _LONG),
    ("loaded_rows", _LONG),
    ("duplicate_rows", _LONG),
    ("invalid_rows", _LONG),
    ("null_key_rows", _LONG),
    ("status", _TEXT),
    ("schema_drift_columns", T.ArrayType(_TEXT)),
    ("error_message", _TEXT),
    ("started_at", T.TimestampType()),
    ("finished_at", T.TimestampType()),
    ("runtime_seconds", _DOUBLE),
)

# One row per state change of a batch; the row with the highest ``event_seq`` is current.
LEDGER_EVENTS = T.StructType(LEDGER.fields + [T.StructField("event_seq", T.IntegerType())])

ZONE_COLUMNS = ("location_id", "borough", "zone", "service_zone")
ZONES = _struct(
    ("location_id", T.IntegerType()),
    ("borough", _TEXT),
    ("zone", _TEXT),
    ("service_zone", _TEXT),
    ("updated_at", T.TimestampType()),
)
