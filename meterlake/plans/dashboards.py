"""Dashboard queries (V1-V9) with their filters.

A filter that is not given, or None, does not filter. A filter value may be a list.
Each order states where nulls go; descending orders put them first.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.plans.marts import money_sum


def filtered(df: DataFrame, **filters: Any) -> DataFrame:
    for name, value in filters.items():
        if value is None:
            continue
        if isinstance(value, (list, tuple, set)):
            df = df.where(F.col(name).isin(list(value)))
        else:
            df = df.where(F.col(name) == F.lit(value))
    return df


def between(df: DataFrame, name: str, start: Any = None, end: Any = None) -> DataFrame:
    """Rows from ``start`` to before ``end``, either of them optional."""
    if start is not None:
        df = df.where(F.col(name) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(name) < F.lit(end))
    return df


def monthly_volume(metrics: DataFrame, taxi_type=None, trip_month=None) -> DataFrame:
    return (
        filtered(metrics, taxi_type=taxi_type, trip_month=trip_month)
        .select(
            "trip_month",
            "taxi_type",
            "trip_count",
            "total_revenue",
            "avg_total_amount",
            "flagged_trip_count",
        )
        .orderBy(F.asc_nulls_last("trip_month"), "taxi_type")
    )


def anomaly_review(
    anomalies: DataFrame, taxi_type=None, anomaly_type=None, picked_up_from=None, picked_up_to=None
) -> DataFrame:
    chosen = filtered(anomalies, taxi_type=taxi_type, anomaly_type=anomaly_type)
    return (
        between(chosen, "pickup_datetime", picked_up_from, picked_up_to)
        .select(
            "pickup_datetime",
            "taxi_type",
            "anomaly_type",
            "pickup_location_id",
            "dropoff_location_id",
            "trip_distance",
            "total_amount",
            "fare_per_mile_zscore",
        )
        .orderBy(F.desc_nulls_first("pickup_datetime"))
    )


def peak_zones(
    hourly: DataFrame,
    taxi_type=None,
    pickup_date=None,
    pickup_hour=None,
    pickup_borough=None,
    top: int | None = None,
) -> DataFrame:
    """All zone hours, or with ``top`` the first of them only."""
    ordered = (
        filtered(
            hourly,
            taxi_type=taxi_type,
            pickup_date=pickup_date,
            pickup_hour=pickup_hour,
            pickup_borough=pickup_borough,
        )
        .select(
            "pickup_date",
            "pickup_hour",
            "taxi_type",
            "pickup_borough",
            "pickup_zone",
            "trip_count",
            "total_revenue",
        )
        .orderBy(F.desc_nulls_first("pickup_date"), F.desc("trip_count"))
    )
    return ordered if top is None else ordered.limit(top)


def monitoring(pipeline: DataFrame, taxi_type=None) -> DataFrame:
    return filtered(pipeline, taxi_type=taxi_type).select(
        "taxi_type",
        "ingest_success_rate",
        "avg_rows_ingested_per_file",
        "duplicate_rate",
        "null_rate_key_columns",
        "average_pipeline_runtime_seconds",
        "freshness_lag_hours",
    )


def active_alerts(alerts: DataFrame, taxi_type=None, year_month=None, severity=None) -> DataFrame:
    """Newest first; ``severity`` descends as text, so warnings come before errors."""
    return (
        filtered(alerts, taxi_type=taxi_type, year_month=year_month, severity=severity)
        .select(
            "evaluated_at", "severity", "taxi_type", "year_month", "alert_code", "alert_context"
        )
        .orderBy(
            F.desc_nulls_first("evaluated_at"),
            F.desc_nulls_first("severity"),
            "taxi_type",
            F.asc_nulls_last("year_month"),
        )
    )


def reconciliation(totals: DataFrame, taxi_type=None, year_month=None) -> DataFrame:
    return (
        filtered(totals, taxi_type=taxi_type, year_month=year_month)
        .select(
            "year_month",
            "taxi_type",
            "source_rows",
            "expected_loaded_rows",
            "duplicate_rows",
            "warehouse_rows",
            "source_variance",
            "loaded_variance",
        )
        .orderBy(F.desc_nulls_first("year_month"), "taxi_type")
    )


def fare_and_distance(metrics: DataFrame, taxi_type=None, trip_month=None) -> DataFrame:
    """Average fare and distance, and flagged trips, per month."""
    return filtered(metrics, taxi_type=taxi_type, trip_month=trip_month).select(
        "trip_month", "taxi_type", "avg_total_amount", "avg_trip_distance", "flagged_trip_count"
    )


def freshness_lag(pipeline: DataFrame, taxi_type=None) -> DataFrame:
    return filtered(pipeline, taxi_type=taxi_type).select("taxi_type", "freshness_lag_hours")


def anomaly_counts(metrics: DataFrame, taxi_type=None, trip_month=None) -> DataFrame:
    return (
        filtered(metrics, taxi_type=taxi_type, trip_month=trip_month)
        .groupBy("taxi_type")
        .agg(
            F.sum("negative_fare_count").alias("negative_fare_count"),
            F.sum("invalid_distance_count").alias("invalid_distance_count"),
            F.sum("temporal_anomaly_count").alias("temporal_anomaly_count"),
        )
    )


def revenue_by_borough(
    hourly: DataFrame, taxi_type=None, pickup_date=None, pickup_hour=None, pickup_borough=None
) -> DataFrame:
    """Sums over the zone hours; averages would weigh quiet hours like busy ones."""
    return (
        filtered(
            hourly,
            taxi_type=taxi_type,
            pickup_date=pickup_date,
            pickup_hour=pickup_hour,
            pickup_borough=pickup_borough,
        )
        .groupBy("pickup_borough")
        .agg(
            F.sum("trip_count").alias("trip_count"),
            money_sum("total_revenue").alias("total_revenue"),
        )
    )
