"""Analytic marts over the fact (M4-M6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: standard deviations beyond which a fare rate is an outlier.
OUTLIER_ZSCORE = 3

_BASELINE_KEY = ("taxi_type", "trip_month")


def fare_baseline(trips: DataFrame) -> DataFrame:
    """Mean and sample deviation of the fare rate per type and month, flagged trips included."""
    return (
        trips.where(F.col("fare_per_mile").isNotNull())
        .groupBy(*_BASELINE_KEY)
        .agg(
            F.avg("fare_per_mile").alias("avg_fare_per_mile"),
            # A single trip has no sample deviation.
            F.stddev_samp("fare_per_mile").alias("stddev_fare_per_mile"),
        )
    )


def fare_zscore() -> Column:
    """Null when there is no deviation to measure by."""
    return (F.col("fare_per_mile") - F.col("avg_fare_per_mile")) / F.nullif(
        "stddev_fare_per_mile", F.lit(0.0)
    )


def anomaly_type() -> Column:
    """The first reason that applies, null for none; drift alone is no reason."""
    reasons = [
        (F.col("has_negative_fare"), "negative_fare"),
        (F.col("has_invalid_distance"), "invalid_distance"),
        (F.col("has_temporal_anomaly"), "pickup_after_dropoff"),
        (F.col("has_invalid_zone"), "invalid_zone"),
        (F.col("has_null_key"), "null_business_key"),
        (F.abs("fare_per_mile_zscore") >= OUTLIER_ZSCORE, "fare_rate_outlier"),
    ]
    return F.coalesce(*[F.when(applies, F.lit(reason)) for applies, reason in reasons])


def fare_anomalies(fact: DataFrame, baseline: DataFrame) -> DataFrame:
    """Trips with a reason to review them.

    The baseline is an aggregate joined back, not a window, so that trips are not
    shuffled on two columns of few values. Pass it as a table (``cut``): its size is
    then known before the join is planned.
    """
    return (
        fact.join(baseline, list(_BASELINE_KEY), "left")
        .withColumn("fare_per_mile_zscore", fare_zscore())
        .withColumn("anomaly_type", anomaly_type())
        .where("anomaly_type is not null")
        .select(
            "business_trip_key",
            "source_year_month",
            "taxi_type",
            "pickup_datetime",
            "dropoff_datetime",
            "pickup_location_id",
            "dropoff_location_id",
            "trip_distance",
            "fare_amount",
            "total_amount",
            "fare_per_mile",
            "fare_per_mile_zscore",
            "has_negative_fare",
            "has_invalid_distance",
            "has_temporal_anomaly",
            "has_invalid_zone",
            "has_null_key",
            "anomaly_type",
        )
    )


def money_sum(column: str) -> Column:
    """The sum of amounts in cents, exact in whatever order rows come."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def money_avg(column: str) -> Column:
    return money_sum(column) / F.count(column)


def monthly_metrics(trips: DataFrame) -> DataFrame:
    return trips.groupBy("taxi_type", "trip_month").agg(
        F.count("*").alias("trip_count"),
        money_sum("total_amount").alias("total_revenue"),
        money_avg("total_amount").alias("avg_total_amount"),
        F.avg("trip_distance").alias("avg_trip_distance"),
        F.avg("fare_per_mile").alias("avg_fare_per_mile"),
        F.count_if(F.col("quality_status") == "flagged").alias("flagged_trip_count"),
        F.count_if("has_negative_fare").alias("negative_fare_count"),
        F.count_if("has_invalid_distance").alias("invalid_distance_count"),
        F.count_if("has_temporal_anomaly").alias("temporal_anomaly_count"),
        F.count_if("has_invalid_zone").alias("invalid_zone_count"),
    )


def zone_hourly_metrics(fact: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips, revenue and mean distance per pickup zone and hour.

    Aggregated before the join: a location has one zone key, so the groups are the same
    and far fewer rows meet the dimension.
    """
    hourly = fact.groupBy(
        "taxi_type", "pickup_date", "pickup_hour", "pickup_location_id", "pickup_zone_sk"
    ).agg(
        F.count("*").alias("trip_count"),
        money_sum("total_amount").alias("total_revenue"),
        F.avg("trip_distance").alias("avg_trip_distance"),
    )
    names = zones.select(
        F.col("zone_sk").alias("pickup_zone_sk"),
        F.col("borough").alias("pickup_borough"),
        F.col("zone").alias("pickup_zone"),
    )
    return hourly.join(names, "pickup_zone_sk", "left").select(
        "taxi_type",
        "pickup_date",
        "pickup_hour",
        "pickup_location_id",
        "pickup_borough",
        "pickup_zone",
        "trip_count",
        "total_revenue",
        "avg_trip_distance",
    )
