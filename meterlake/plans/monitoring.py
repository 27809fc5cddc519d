"""Pipeline monitoring, source reconciliation and alerts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Thresholds beyond which an alert is raised.
MIN_SUCCESS_RATE = 0.99
MAX_FRESHNESS_LAG_HOURS = 36
MAX_DUPLICATE_RATE = 0.05
MAX_NULL_KEY_RATE = 0.001


class AlertThresholdBreached(Exception):
    """At least one alert of severity ``error`` is active."""


def _instant(as_of: datetime | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def pipeline_monitoring(batches: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Health per taxi type over finished batches, each batch weighing the same.

    ``latest_success_at`` is the latest finish, failed batches included.
    """

    def rate(rows: str) -> Column:
        share = F.col(rows).cast("double") / F.col("source_rows")
        return F.avg(F.when(F.col("source_rows") > 0, share).otherwise(0.0))

    lag = F.unix_micros(_instant(as_of)) - F.unix_micros(F.max("finished_at"))
    return (
        batches.where(F.col("status").isin("success", "failed"))
        .groupBy("taxi_type")
        .agg(
            F.count("*").alias("batch_count"),
            F.avg(F.when(F.col("status") == "success", 1.0).otherwise(0.0)).alias(
                "ingest_success_rate"
            ),
            F.avg("source_rows").alias("avg_rows_ingested_per_file"),
            rate("duplicate_rows").alias("duplicate_rate"),
            rate("null_key_rows").alias("null_rate_key_columns"),
            F.avg("runtime_seconds").alias("average_pipeline_runtime_seconds"),
            F.max("finished_at").alias("latest_success_at"),
            (lag / F.lit(3.6e9)).alias("freshness_lag_hours"),
        )
    )


def latest_successful_batches(batches: DataFrame) -> DataFrame:
    """The last successful batch of each type and month."""
    newest = Window.partitionBy("taxi_type", "year_month").orderBy(
        F.desc_nulls_first("finished_at"),
        F.desc_nulls_first("started_at"),
        F.desc_nulls_first("batch_id"),
    )
    return (
        batches.where("status = 'success'")
        .withColumn("batch_rank", F.row_number().over(newest))
        .where("batch_rank = 1")
        .select(
            "taxi_type",
            "year_month",
            "source_rows",
            F.col("loaded_rows").alias("expected_loaded_rows"),
            "duplicate_rows",
            "invalid_rows",
            "null_key_rows",
            F.col("finished_at").alias("latest_success_at"),
        )
    )


def warehouse_totals(fact: DataFrame) -> DataFrame:
    """Rows per type and source month; on the fact table a count by partition."""
    return fact.groupBy("taxi_type", F.col("source_year_month").alias("year_month")).agg(
        F.count("*").alias("warehouse_rows")
    )


def source_reconciliation(batches: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows of the last successful batch against rows in the fact, per type and month.

    Variances are warehouse minus source, so ordinary duplicates show as negative.
    """
    rows = F.coalesce("warehouse_rows", F.lit(0))
    return (
        latest_successful_batches(batches)
        .join(warehouse_totals(fact), ["taxi_type", "year_month"], "left")
        .select(
            "taxi_type",
            "year_month",
            "source_rows",
            "expected_loaded_rows",
            "duplicate_rows",
            "invalid_rows",
            "null_key_rows",
            "latest_success_at",
            rows.alias("warehouse_rows"),
            (rows - F.col("source_rows")).alias("source_variance"),
            (rows - F.col("expected_loaded_rows")).alias("loaded_variance"),
        )
    )


def _first_match(rules: list[tuple[Column, str, str, Column]]) -> list[Column]:
    """Severity, code and context of the first rule whose condition holds."""
    names = ("severity", "alert_code", "alert_context")
    columns = zip(names, zip(*[rule[1:] for rule in rules]))
    return [
        F.coalesce(*[F.when(rule[0], value) for rule, value in zip(rules, values)]).alias(name)
        for name, values in columns
    ]


def monitoring_alerts(monitoring: DataFrame) -> DataFrame:
    def measure(name: str, digits: int) -> Column:
        return F.format_string(f"{name}=%.{digits}f", F.col(name))

    success, lag = F.col("ingest_success_rate"), F.col("freshness_lag_hours")
    duplicates, null_keys = F.col("duplicate_rate"), F.col("null_rate_key_columns")
    # Severities and codes, in the order of their rank.
    rules = [
        (
            success < MIN_SUCCESS_RATE,
            "error",
            "ingest_success_rate_below_threshold",
            measure("ingest_success_rate", 4),
        ),
        (
            lag > MAX_FRESHNESS_LAG_HOURS,
            "error",
            "freshness_lag_above_threshold",
            measure("freshness_lag_hours", 2),
        ),
        (
            duplicates > MAX_DUPLICATE_RATE,
            "warn",
            "duplicate_rate_above_threshold",
            measure("duplicate_rate", 4),
        ),
        (
            null_keys > MAX_NULL_KEY_RATE,
            "warn",
            "null_key_rate_above_threshold",
            measure("null_rate_key_columns", 4),
        ),
    ]
    return monitoring.select(
        "taxi_type", F.lit(None).cast("string").alias("year_month"), *_first_match(rules)
    )


def reconciliation_alerts(reconciliation: DataFrame) -> DataFrame:
    context = F.format_string(
        "expected_loaded_rows=%s warehouse_rows=%s source_rows=%s",
        "expected_loaded_rows",
        "warehouse_rows",
        "source_rows",
    )
    # Severities and codes, in the order of their rank.
    rules = [
        (F.col("loaded_variance") != 0, "error", "loaded_reconciliation_mismatch", context),
        (F.col("source_variance") != 0, "warn", "source_reconciliation_mismatch", context),
    ]
    return reconciliation.select("taxi_type", "year_month", *_first_match(rules))


def operational_alerts(
    monitoring: DataFrame, reconciliation: DataFrame, as_of: datetime | Column
) -> DataFrame:
    """At most one alert per taxi type and one per type and month."""
    alerts = monitoring_alerts(monitoring).unionByName(reconciliation_alerts(reconciliation))
    return alerts.where("severity is not null").withColumn("evaluated_at", _instant(as_of))


def alert_gate(alerts: DataFrame) -> None:
    """Raise with the text of all ``error`` alerts, if there is any.

    Alerts number at most one per type and month, so they fit the driver.
    """
    errors = (
        alerts.where("severity = 'error'")
        .orderBy("taxi_type", F.asc_nulls_first("year_month"), "alert_code")
        .select(
            F.concat_ws(
                ":",
                "severity",
                "taxi_type",
                F.coalesce("year_month", F.lit("")),
                "alert_code",
                "alert_context",
            ).alias("text")
        )
        .collect()
    )
    if errors:
        raise AlertThresholdBreached(
            "alerts of severity error: " + "; ".join(row["text"] for row in errors)
        )
