"""Deduplication, keys, flags and metrics."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from meterlake.functions.calendar import month_before, month_range, resolve_months
from meterlake.functions.keys import business_trip_key, surrogate_key
from meterlake.operators.dedupe import keep_first
from meterlake.operators.prepare import batch_metrics, prepare_batch, to_silver
from meterlake.schema import (
    BASE_COLUMNS,
    BUSINESS_KEY,
    FLAGS,
    KEY_HASH,
    PREPARED_COLUMNS,
    SILVER,
    TRIP_COLUMNS,
)
from tests.conftest import at

SCHEMA = (
    "batch_id string, taxi_type string, source_year_month string, source_file_name string,"
    " row_number_in_file long, "
    + ", ".join(f"{c.name} {c.dtype.simpleString()}" for c in TRIP_COLUMNS)
)
NAN = float("nan")


def trip(number=1, **changes):
    values = dict.fromkeys(BASE_COLUMNS)
    values.update(
        batch_id="b",
        taxi_type="yellow",
        source_year_month="2024-01",
        source_file_name="f",
        row_number_in_file=number,
        vendor_id=1,
        pickup_datetime=at(10),
        dropoff_datetime=at(11),
        passenger_count=1.0,
        trip_distance=2.0,
        pickup_location_id=100,
        dropoff_location_id=161,
        fare_amount=10.0,
        total_amount=12.0,
    )
    values.update(changes)
    return tuple(values[c] for c in BASE_COLUMNS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.mark.parametrize(
    "changes, flags",
    [
        ({}, set()),
        ({"fare_amount": -1.0}, {"has_negative_fare"}),
        ({"total_amount": -0.01}, {"has_negative_fare"}),
        ({"fare_amount": None, "total_amount": None}, set()),
        ({"trip_distance": -0.1}, {"has_invalid_distance"}),
        ({"trip_distance": 250.0}, set()),
        ({"trip_distance": 250.1}, {"has_invalid_distance"}),
        ({"trip_distance": None}, set()),
        ({"trip_distance": NAN}, {"has_invalid_distance"}),
        ({"dropoff_datetime": at(9)}, {"has_temporal_anomaly"}),
        ({"dropoff_datetime": at(10)}, set()),
        ({"pickup_location_id": None}, {"has_invalid_zone"}),
        ({"dropoff_location_id": 0}, {"has_invalid_zone"}),
        ({"pickup_location_id": 265, "dropoff_location_id": 1}, set()),
        ({"pickup_location_id": 266}, {"has_invalid_zone"}),
        ({"vendor_id": None}, {"has_null_key"}),
        ({"pickup_datetime": None}, {"has_null_key"}),
        ({"dropoff_datetime": None}, {"has_null_key"}),
    ],
)
def test_flags(spark, changes, flags):
    row = prepare_batch(frame(spark, trip(**changes)), False).first()
    assert {flag for flag in FLAGS if row[flag]} == flags
    assert row.quality_status == ("flagged" if flags else "valid")
    assert all(row[flag] is not None for flag in FLAGS)


def test_drift_flags_the_whole_batch(spark):
    prepared = prepare_batch(frame(spark, trip(1), trip(2, vendor_id=2)), True)
    assert prepared.where("has_schema_drift and quality_status = 'flagged'").count() == 2


def test_prepared_columns_in_order(spark):
    assert prepare_batch(frame(spark, trip()), False).columns == list(PREPARED_COLUMNS)
    ahead = prepare_batch(frame(spark, trip()), False, merge_next=True)
    assert ahead.columns == [*PREPARED_COLUMNS, KEY_HASH]


def test_first_in_file_order_is_kept_and_nulls_are_equal(spark):
    rows = [
        trip(1, fare_amount=1.0),
        trip(2, fare_amount=2.0),
        trip(3, pickup_datetime=None, vendor_id=None, fare_amount=3.0),
        trip(4, pickup_datetime=None, vendor_id=None, fare_amount=4.0),
        trip(5, passenger_count=None, fare_amount=5.0),
    ]
    random.Random(7).shuffle(rows)
    for partitions, merge_next in ((1, False), (5, False), (5, True)):
        kept = keep_first(frame(spark, *rows).repartition(partitions), merge_next=merge_next)
        assert sorted(r.fare_amount for r in kept.collect()) == [1.0, 3.0, 5.0]


def test_scope_is_the_month_or_the_batch(spark):
    rows = frame(spark, trip(1), trip(1, batch_id="c"), trip(1, source_year_month="2024-02"))
    assert keep_first(rows).count() == 2
    assert keep_first(rows, scope=["batch_id"]).count() == 3


def test_minus_zero_is_zero_in_keys(spark):
    rows = frame(spark, trip(1, passenger_count=0.0), trip(2, passenger_count=-0.0))
    assert keep_first(rows).count() == 1
    assert keep_first(rows, merge_next=True).count() == 1


def test_a_hot_key_is_cut_down_before_the_shuffle(spark):
    """A third of all rows share one key: the shuffle still carries one per task at most."""
    rows = spark.range(0, 30000, 1, 6).select(
        *[F.lit(v).cast(t).alias(n) for n, t, v in zip(BASE_COLUMNS, _types(spark), trip())]
    )
    rows = rows.withColumns(
        {
            "row_number_in_file": F.monotonically_increasing_id(),
            "vendor_id": F.when(F.rand(1) < 0.34, 1).otherwise(F.monotonically_increasing_id() + 2),
        }
    )
    kept = keep_first(rows)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    limited, exchange = plan.rindex("Partial"), plan.index("Exchange")
    assert exchange < limited  # printed from the top: the partial limit is below the exchange
    assert kept.where("vendor_id = 1").count() == 1


def _types(spark):
    return [f.dataType for f in frame(spark, trip()).schema.fields]


def test_business_key_text(spark):
    key = frame(spark, trip(vendor_id=None)).select(business_trip_key().alias("k")).first().k
    assert key == "yellow||2024-01-01 10:00:00|2024-01-01 11:00:00|100|161|1.0"
    assert len(BUSINESS_KEY) == 7


def test_surrogate_key_tells_null_from_empty(spark):
    rows = spark.createDataFrame([(None, "a"), ("", "a"), ("_", "a")], "x string, y string")
    keys = {r.k for r in rows.select(surrogate_key("x", "y").alias("k")).collect()}
    assert len(keys) == 3


def test_silver_types_and_nan_cleaning(spark):
    silver = to_silver(prepare_batch(frame(spark, trip(trip_distance=NAN)), False), at(0))
    row = silver.first()
    assert [(f.name, f.dataType) for f in silver.schema] == [
        (f.name, f.dataType) for f in SILVER
    ]
    assert row.trip_distance is None and row.has_invalid_distance
    assert "NaN" in row.row_fingerprint


def test_an_integer_beyond_32_bits_fails_the_batch(spark):
    silver = to_silver(prepare_batch(frame(spark, trip(payment_type=2**40)), False), at(0))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        silver.collect()


def test_metrics(spark):
    source = frame(spark, trip(1), trip(2), trip(3, vendor_id=None), trip(4, fare_amount=-1.0, vendor_id=4))
    row = batch_metrics(source, prepare_batch(source, False)).first()
    assert row.asDict() == {
        "batch_id": "b",
        "source_rows": 4,
        "loaded_rows": 3,
        "duplicate_rows": 1,
        "invalid_rows": 2,
        "null_key_rows": 1,
    }


def test_month_range_is_inclusive():
    assert month_range("2024-01", "2024-03") == ["2024-01", "2024-02", "2024-03"]
    assert month_range("2023-11", "2024-02") == ["2023-11", "2023-12", "2024-01", "2024-02"]


@pytest.mark.parametrize("start, end", [("2024-03", "2024-01"), ("2024-13", "2024-14"), ("x", "y")])
def test_month_range_rejects(start, end):
    with pytest.raises(ValueError):
        month_range(start, end)


def test_default_month_is_the_one_before_the_run():
    assert month_before(date(2024, 2, 2)) == "2024-01"
    assert month_before(date(2024, 1, 31)) == "2023-12"


def test_resolve_months():
    assert resolve_months("2024-05") == ["2024-05"]
    assert resolve_months("2024-05", year_month="2024-01") == ["2024-01"]
    assert resolve_months("2024-05", None, "2024-01", "2024-02") == ["2024-01", "2024-02"]
    with pytest.raises(ValueError, match="not both"):
        resolve_months("2024-05", "2024-01", "2024-01", "2024-02")
    with pytest.raises(ValueError, match="first and its last"):
        resolve_months("2024-05", start_month="2024-01")
