"""Marts, monitoring, alerts and dashboards on hand-made rows."""

from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from meterlake.operators import checks, ledger
from meterlake.plans import dashboards, dimensions, marts, monitoring
from meterlake.schema import LEDGER

AS_OF = datetime(2024, 1, 10, tzinfo=timezone.utc)


def batch(spark, *rows):
    """Ledger rows from (id, month, source, loaded, duplicate, null keys, status, hours ago)."""
    base = spark.createDataFrame(
        list(rows), "b string, m string, s int, l int, d int, n int, st string, h double"
    )
    finished = F.lit(AS_OF) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("h") * 3600)
    values = {
        "batch_id": F.col("b"),
        "taxi_type": F.lit("yellow"),
        "year_month": F.col("m"),
        "source_rows": F.col("s"),
        "loaded_rows": F.col("l"),
        "duplicate_rows": F.col("d"),
        "invalid_rows": F.lit(0),
        "null_key_rows": F.col("n"),
        "status": F.col("st"),
        "started_at": finished - F.expr("interval 10 minutes"),
        "finished_at": F.when(F.col("st") != "running", finished),
        "runtime_seconds": F.lit(600.0),
        "source_etag": F.col("b"),
    }
    return base.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER.fields]
    )


OK = ("a", "2024-01", 10000, 10000, 0, 0, "success", 1.0)


def fact_rows(spark, count, month="2024-01"):
    return spark.range(count).select(
        F.lit("yellow").alias("taxi_type"), F.lit(month).alias("source_year_month")
    )


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([OK], None),
        (
            [OK, ("b", "2024-02", 10, 0, 0, 0, "failed", 1.0)],
            ("error", "ingest_success_rate_below_threshold", "ingest_success_rate=0.5000"),
        ),
        (
            [(*OK[:7], 36.5)],
            ("error", "freshness_lag_above_threshold", "freshness_lag_hours=36.50"),
        ),
        (
            [("a", "2024-01", 10000, 9000, 1000, 100, "success", 1.0)],
            ("warn", "duplicate_rate_above_threshold", "duplicate_rate=0.1000"),
        ),
        (
            [("a", "2024-01", 10000, 10000, 0, 20, "success", 1.0)],
            ("warn", "null_key_rate_above_threshold", "null_rate_key_columns=0.0020"),
        ),
        ([OK, ("b", "2024-02", 5, 0, 0, 0, "running", 0.0)], None),
    ],
)
def test_monitoring_alerts(spark, rows, expected):
    health = monitoring.pipeline_monitoring(batch(spark, *rows), AS_OF)
    alert = monitoring.monitoring_alerts(health).first()
    found = (alert.severity, alert.alert_code, alert.alert_context)
    assert found == (expected or (None, None, None))


@pytest.mark.parametrize(
    "row, stored, expected",
    [
        (OK, 10000, None),
        (("a", "2024-01", 10, 9, 1, 0, "success", 1.0), 9, ("warn", "source_reconciliation_mismatch")),
        (("a", "2024-01", 10, 9, 1, 0, "success", 1.0), 0, ("error", "loaded_reconciliation_mismatch")),
        (("a", "2024-01", 10, 10, 0, 0, "success", 1.0), 11, ("error", "loaded_reconciliation_mismatch")),
    ],
)
def test_reconciliation_alerts(spark, row, stored, expected):
    totals = monitoring.source_reconciliation(batch(spark, row), fact_rows(spark, stored))
    alert = monitoring.reconciliation_alerts(totals).first()
    assert (alert.severity, alert.alert_code) == (expected or (None, None))
    if expected:
        text = f"expected_loaded_rows={row[3]} warehouse_rows={stored} source_rows={row[2]}"
        assert alert.alert_context == text


def test_months_without_success_do_not_appear(spark):
    rows = batch(spark, ("a", "2024-01", 5, 0, 0, 0, "failed", 1.0))
    assert monitoring.source_reconciliation(rows, fact_rows(spark, 5)).count() == 0


def test_latest_success_wins(spark):
    rows = batch(spark, OK, ("z", "2024-01", 7, 7, 0, 0, "success", 0.5))
    assert monitoring.latest_successful_batches(rows).first().source_rows == 7


def test_batches_without_rows_count_as_zero_rates(spark):
    rows = batch(spark, ("a", "2024-01", 0, 0, 0, 0, "success", 1.0), ("b", "2024-02", 10, 5, 5, 0, "success", 1.0))
    health = monitoring.pipeline_monitoring(rows, AS_OF).first()
    assert health.duplicate_rate == 0.25 and health.average_pipeline_runtime_seconds == 600.0


def test_gate_names_every_error(spark):
    rows = batch(spark, ("a", "2024-01", 5, 5, 0, 0, "success", 1.0))
    totals = monitoring.source_reconciliation(rows, fact_rows(spark, 4))
    alerts = monitoring.operational_alerts(
        monitoring.pipeline_monitoring(rows, AS_OF), totals, AS_OF
    )
    with pytest.raises(monitoring.AlertThresholdBreached) as raised:
        monitoring.alert_gate(alerts)
    assert str(raised.value).endswith(
        "error:yellow:2024-01:loaded_reconciliation_mismatch:"
        "expected_loaded_rows=5 warehouse_rows=4 source_rows=5"
    )
    monitoring.alert_gate(alerts.where("severity = 'warn'"))


def test_an_earlier_success_with_the_same_etag_is_skipped(spark):
    loaded = batch(
        spark,
        ("A", "2024-01", 1, 1, 0, 0, "success", 9.0),
        ("B", "2024-01", 1, 1, 0, 0, "success", 5.0),
        ("C", "2024-01", 1, 0, 0, 0, "failed", 1.0),
    )
    candidates = spark.createDataFrame(
        [("yellow", "2024-01", e) for e in ("A", "C", "", None)]
        + [("yellow", "2024-02", "A"), ("green", "2024-01", "A")],
        "taxi_type string, year_month string, source_etag string",
    )
    pending = ledger.pending_batches(candidates, loaded).collect()
    assert len(pending) == 5 and ("yellow", "2024-01", "A") not in [tuple(r) for r in pending]


def test_accounting(spark):
    rows = batch(spark, OK, ("b", "2024-02", 10, 5, 4, 0, "success", 1.0), ("c", "2024-03", 9, 0, 0, 0, "failed", 1.0))
    assert [r.batch_id for r in checks.batch_accounting(rows).collect()] == ["b"]


def trips(spark, rows):
    """(fare per mile, negative fare, null key) per trip of one month."""
    frame = spark.createDataFrame(rows, "fare_per_mile double, has_negative_fare boolean, has_null_key boolean")
    text = ["business_trip_key", "source_year_month"]
    return frame.withColumns(
        {
            **{c: F.lit("x") for c in text},
            "taxi_type": F.lit("yellow"),
            "trip_month": F.lit(date(2024, 1, 1)),
            "pickup_datetime": F.lit(None).cast("timestamp_ntz"),
            "dropoff_datetime": F.lit(None).cast("timestamp_ntz"),
            "pickup_location_id": F.lit(1),
            "dropoff_location_id": F.lit(1),
            "trip_distance": F.lit(1.0),
            "fare_amount": F.lit(1.0),
            "total_amount": F.lit(1.0),
            "has_invalid_distance": F.lit(False),
            "has_temporal_anomaly": F.lit(False),
            "has_invalid_zone": F.lit(False),
        }
    )


def test_outliers_and_first_reason(spark):
    rows = [(1.0 + i % 2, False, False) for i in range(40)]
    rows += [(100.0, False, False), (None, True, True), (None, False, True)]
    frame = trips(spark, rows)
    found = marts.fare_anomalies(frame, marts.fare_baseline(frame)).collect()
    kinds = sorted(r.anomaly_type for r in found)
    assert kinds == ["fare_rate_outlier", "negative_fare", "null_business_key"]


@pytest.mark.parametrize("rows", [[(5.0, False, False)], [(5.0, False, False)] * 3])
def test_no_deviation_means_no_score(spark, rows):
    frame = trips(spark, rows)
    assert marts.fare_anomalies(frame, marts.fare_baseline(frame)).count() == 0


def test_zone_zero_appears_once(spark):
    def ids(observed, listed):
        seen = spark.createDataFrame(
            [(p, p) for p in observed], "pickup_location_id int, dropoff_location_id int"
        )
        zones = spark.createDataFrame(
            [(z, "b", "z", "s") for z in listed],
            "location_id int, borough string, zone string, service_zone string",
        )
        rows = dimensions.zone_dimension(seen, zones).collect()
        assert len({r.zone_sk for r in rows}) == len(rows)
        return sorted((r.location_id, r.is_known_zone) for r in rows)

    assert ids([1, 9, None], [1]) == [(0, False), (1, True), (9, False)]
    assert ids([0, 1], [1]) == [(0, False), (1, True)]
    assert ids([0], [0]) == [(0, True)]


def test_vendor_names(spark):
    rows = spark.createDataFrame(
        [("yellow", v) for v in (1, 2, 3, 4, None, 1)], "taxi_type string, vendor_id int"
    )
    names = {r.vendor_id: r.vendor_name for r in dimensions.vendor_dimension(rows).collect()}
    assert names == {
        1: "Creative Mobile Technologies",
        2: "VeriFone",
        3: "Unknown",
        4: "Via",
        None: "Unknown",
    }


def test_dashboard_orders_and_filters(spark):
    alerts = spark.createDataFrame(
        [(AS_OF, "error", "yellow", None), (AS_OF, "warn", "yellow", "2024-01"), (AS_OF, "error", "green", "2024-02")],
        "evaluated_at timestamp, severity string, taxi_type string, year_month string",
    ).withColumns({"alert_code": F.lit("c"), "alert_context": F.lit("t")})
    listed = [(r.severity, r.taxi_type) for r in dashboards.active_alerts(alerts).collect()]
    assert listed == [("warn", "yellow"), ("error", "green"), ("error", "yellow")]
    assert dashboards.active_alerts(alerts, taxi_type="yellow", severity=["error"]).count() == 1

    hours = spark.createDataFrame(
        [(date(2024, 1, 1), 8, "yellow", "B", "z", 5, 10.0), (date(2024, 1, 2), 9, "yellow", "B", "z", 1, 2.0), (None, 9, "green", "C", "z", 7, 3.0)],
        "pickup_date date, pickup_hour int, taxi_type string, pickup_borough string,"
        " pickup_zone string, trip_count long, total_revenue double",
    )
    assert [r.trip_count for r in dashboards.peak_zones(hours).collect()] == [7, 1, 5]
    assert [r.trip_count for r in dashboards.peak_zones(hours, top=1).collect()] == [7]
    assert dashboards.peak_zones(hours, pickup_date=date(2024, 1, 2), pickup_hour=9).count() == 1
    revenue = {r.pickup_borough: r.total_revenue for r in dashboards.revenue_by_borough(hours).collect()}
    assert revenue == {"B": 12.0, "C": 3.0}


def test_orders_of_months_anomalies_and_reconciliation(spark):
    months = spark.createDataFrame(
        [("2024-02-01", "yellow"), (None, "green"), ("2024-01-01", "yellow"), ("2024-01-01", "green")],
        "trip_month string, taxi_type string",
    ).selectExpr(
        "cast(trip_month as date) trip_month", "taxi_type", "1 trip_count", "1D total_revenue",
        "1D avg_total_amount", "0 flagged_trip_count",
    )
    found = dashboards.monthly_volume(months.repartition(3)).collect()
    assert [(str(r.trip_month), r.taxi_type) for r in found] == [
        ("2024-01-01", "green"), ("2024-01-01", "yellow"), ("2024-02-01", "yellow"), ("None", "green"),
    ]
    anomalies = spark.createDataFrame(
        [("2024-01-01 10:00:00",), (None,), ("2024-03-01 10:00:00",)], "t string"
    ).selectExpr(
        "cast(t as timestamp_ntz) pickup_datetime", "'yellow' taxi_type", "'x' anomaly_type",
        "1 pickup_location_id", "1 dropoff_location_id", "1D trip_distance", "1D total_amount",
        "1D fare_per_mile_zscore",
    )
    found = dashboards.anomaly_review(anomalies.repartition(3)).collect()
    assert [r.pickup_datetime and r.pickup_datetime.month for r in found] == [None, 3, 1]
    totals = spark.createDataFrame(
        [("2024-01", "yellow"), ("2024-02", "yellow"), ("2024-02", "green"), (None, "green")],
        "year_month string, taxi_type string",
    ).selectExpr(
        "*", "1 source_rows", "1 expected_loaded_rows", "0 duplicate_rows", "1 warehouse_rows",
        "0 source_variance", "0 loaded_variance",
    )
    found = dashboards.reconciliation(totals.repartition(3)).collect()
    assert [(r.year_month, r.taxi_type) for r in found] == [
        (None, "green"), ("2024-02", "green"), ("2024-02", "yellow"), ("2024-01", "yellow"),
    ]
