"""Data-quality checks (Q1-Q7).

Each check returns failing rows or a count of them; ``summary`` rows all have the
columns ``check, target, column, failures, status``. A failed check is a result.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.operators.dedupe import repeated_table, split_repeated
from meterlake.schema import TRIP_KEY
from meterlake.sources.tables import cut

SUMMARY_COLUMNS = ("check", "target", "column", "failures", "status")

# What is checked on which table.
NOT_NULL = {
    "silver.taxi_trips": ("business_trip_key", "source_year_month", "pickup_datetime"),
    "raw.taxi_zone_lookup": ("location_id",),
    "ops.batch_runs": ("batch_id",),
    "stg_taxi_trips": ("business_trip_key", "quality_status"),
    "stg_taxi_zones": ("location_id",),
    "stg_batch_runs": ("batch_id", "status"),
    "dim_vendor": ("vendor_sk",),
    "dim_zone": ("zone_sk",),
    "fct_taxi_trips": ("business_trip_key", "source_year_month", "quality_status"),
    "fct_monthly_metrics": ("taxi_type", "trip_month"),
    "ops_monthly_source_reconciliation": ("source_variance", "loaded_variance"),
    "ops_alerts": ("severity", "alert_code"),
}
UNIQUE = {
    "raw.taxi_zone_lookup": "location_id",
    "ops.batch_runs": "batch_id",
    "stg_taxi_trips": "business_trip_key",
    "stg_batch_runs": "batch_id",
    "dim_vendor": "vendor_sk",
    "dim_zone": "zone_sk",
}
ACCEPTED_VALUES = {
    "stg_taxi_trips": ("quality_status", ("valid", "flagged")),
    "stg_batch_runs": ("status", ("running", "success", "failed")),
    "fct_taxi_trips": ("quality_status", ("valid", "flagged")),
    "ops_alerts": ("severity", ("warn", "error")),
}
WARN_AFTER_HOURS, ERROR_AFTER_HOURS = 36, 72


def summary(check: str, target: str, column: str, failures: DataFrame) -> DataFrame:
    """One summary row from a one-row frame with a ``failures`` column."""
    return failures.select(
        F.lit(check).alias("check"),
        F.lit(target).alias("target"),
        F.lit(column).alias("column"),
        F.col("failures").cast("bigint").alias("failures"),
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"),
    )


def not_null(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """All columns of a table in one pass."""
    return column_checks(df, [("not_null", target, c, None) for c in columns])


def column_checks(
    df: DataFrame, wanted: Sequence[tuple[str, str, str, Sequence[str] | None]]
) -> DataFrame:
    """Checks of single columns in one pass: ``not_null``, and ``accepted_values`` with the
    values; of the latter the distinct values outside the list are failures."""

    def failures(check: str, column: str, values: Sequence[str] | None) -> Column:
        if check == "not_null":
            return F.count_if(F.col(column).isNull())
        return F.count_distinct(F.when(~F.col(column).isin(*values), F.col(column)))

    counts = df.agg(*[failures(k, c, v).alias(f"_{n}") for n, (k, _, c, v) in enumerate(wanted)])
    names = ("check", "target", "column")
    rows = F.array(
        *[
            F.struct(
                *[F.lit(x).alias(name) for name, x in zip(names, rule[:3], strict=True)],
                F.col(f"_{n}").cast("bigint").alias("failures"),
            )
            for n, rule in enumerate(wanted)
        ]
    )
    passed = F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status")
    return counts.select(F.explode(rows).alias("r")).select("r.*").select("*", passed)


def repeated(df: DataFrame, columns: Sequence[str], folder: str | None = None) -> DataFrame:
    """Values of ``columns`` that occur more than once, with their ``row_count``.

    For long keys on large tables give a ``folder`` for intermediate tables: hashes are
    counted first, so eight bytes a row are shuffled in place of the keys, and only rows
    whose hash repeats are then counted by key. Equal keys have equal hashes, so none is
    missed; hashes that only collide drop out in the second count. The repeated ones, or bits
    for them, are broadcast, so that rows of other keys are not shuffled.
    """
    if folder is not None:
        df, key = df.select(*columns), F.xxhash64(*columns)
        _, df = split_repeated(df, key, repeated_table(df.select(key), folder))
    return df.groupBy(*columns).agg(F.count("*").alias("row_count")).where("row_count > 1")


def unique(df: DataFrame, target: str, column: str, folder: str | None = None) -> DataFrame:
    found = repeated(df.where(F.col(column).isNotNull()), [column], folder)
    return summary("unique", target, column, found.agg(F.count("*").alias("failures")))


def accepted_values(
    df: DataFrame, target: str, column: str, values: Sequence[str]
) -> DataFrame:
    """Counts distinct values outside the list; nulls are left to ``not_null``."""
    return column_checks(df, [("accepted_values", target, column, values)])


def batch_accounting(batches: DataFrame) -> DataFrame:
    """Successful batches whose source rows are not loaded plus duplicate rows (Q4)."""
    return batches.where(
        (F.col("status") == "success")
        & (F.col("source_rows") != F.col("loaded_rows") + F.col("duplicate_rows"))
    ).select(
        "batch_id", "taxi_type", "year_month", "source_rows", "loaded_rows", "duplicate_rows"
    )


def unique_grain(fact: DataFrame, folder: str | None = None) -> DataFrame:
    """Fact rows that share key and source month (Q5)."""
    return repeated(fact, TRIP_KEY, folder)


def loaded_reconciliation(reconciliation: DataFrame) -> DataFrame:
    """Months whose warehouse rows are not those of the last batch (Q6)."""
    return reconciliation.where("loaded_variance <> 0").select(
        "taxi_type", "year_month", "expected_loaded_rows", "warehouse_rows", "loaded_variance"
    )


def source_freshness(trips: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Hours since the last load: warn beyond 36, error beyond 72 or without any row (Q7)."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    latest = trips.agg(F.max("loaded_at").alias("max_loaded_at"))
    hours = (F.unix_micros(now) - F.unix_micros("max_loaded_at")) / F.lit(3.6e9)
    age = F.col("age_hours")
    return latest.withColumn("age_hours", hours).select(
        F.lit("silver.taxi_trips").alias("target"),
        "max_loaded_at",
        "age_hours",
        F.when(age.isNull() | (age > ERROR_AFTER_HOURS), "error")
        .when(age > WARN_AFTER_HOURS, "warn")
        .otherwise("pass")
        .alias("status"),
    )


# A staging view has the rows of its table and all checked columns: one pass serves both.
_SAME_ROWS = {
    "silver.taxi_trips": "stg_taxi_trips",
    "raw.taxi_zone_lookup": "stg_taxi_zones",
    "ops.batch_runs": "stg_batch_runs",
}
# Tables with a row per trip: their keys are counted by hash first.
_TRIP_TABLES = ("stg_taxi_trips", "fct_taxi_trips")


def run_checks(tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Summary rows of all checks on the tables given by name."""
    by_rows: dict[str, list] = {}
    for target, columns in NOT_NULL.items():
        rules = [("not_null", target, column, None) for column in columns]
        by_rows.setdefault(_SAME_ROWS.get(target, target), []).extend(rules)
    for target, (column, values) in ACCEPTED_VALUES.items():
        rule = ("accepted_values", target, column, values)
        by_rows.setdefault(_SAME_ROWS.get(target, target), []).append(rule)
    results = [column_checks(tables[t], rules) for t, rules in by_rows.items()]
    results += [
        unique(tables[t], t, column, folder if t in _TRIP_TABLES else None)
        for t, column in UNIQUE.items()
    ]

    def rows_of(df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("failures"))

    results += [
        summary(
            "batch_accounting",
            "stg_batch_runs",
            "source_rows",
            rows_of(batch_accounting(tables["stg_batch_runs"])),
        ),
        summary(
            "unique_grain",
            "fct_taxi_trips",
            "business_trip_key,source_year_month",
            rows_of(unique_grain(tables["fct_taxi_trips"], folder)),
        ),
        summary(
            "loaded_reconciliation_zero",
            "ops_monthly_source_reconciliation",
            "loaded_variance",
            rows_of(loaded_reconciliation(tables["ops_monthly_source_reconciliation"])),
        ),
    ]
    return reduce(DataFrame.unionByName, results)
