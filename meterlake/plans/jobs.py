"""The jobs of the lake (J2-J7): bootstrap, month and range loads, gold, checks, alerts.

The driver handles batches, months and file names only; trips stay in Spark.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.calendar import month_range
from meterlake.operators import checks, ledger, upsert
from meterlake.operators.prepare import loaded_metrics, prepare_batch, to_silver
from meterlake.plans import dimensions, fact, marts, monitoring, staging
from meterlake.schema import LEDGER_EVENTS, ROW_NUMBER, ZONES
from meterlake.sources import trips, zones
from meterlake.sources.tables import Lake, cut, working_dir

_PLANNED = (
    "batch_id",
    "taxi_type",
    "year_month",
    "source_url",
    "source_file_name",
    "bronze_object_key",
    "source_etag",
    "source_last_modified",
    "source_rows",
    "schema_drift_columns",
)
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


# Source bytes of the months that are loaded in one plan.
WAVE_BYTES = 1 << 40


class CheckFailed(Exception):
    """A freshness or data check failed in a run that asked for it to stop there."""


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


@contextmanager
def shuffle_sized_for(
    spark: SparkSession, source_bytes: int, growth: float = 4.0, target: int = 256 << 20
) -> Iterator[None]:
    """Enough shuffle partitions for the input, so that none has to spill much.

    Rows take several times their compressed parquet size in memory. Adaptive execution
    merges partitions that turn out small.
    """
    before = spark.conf.get(_INITIAL_PARTITIONS, None)
    floor = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(floor, math.ceil(source_bytes * growth / target))
    spark.conf.set(_INITIAL_PARTITIONS, str(wanted))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_INITIAL_PARTITIONS)
        else:
            spark.conf.set(_INITIAL_PARTITIONS, before)


def staging_path(spark: SparkSession, lake: Lake, name: str) -> str:
    return f"{working_dir(spark, lake.path('_staging')).rstrip('/')}/{name}"


# Bootstrap -------------------------------------------------------------------------


def ensure_warehouse(spark: SparkSession, lake: Lake) -> None:
    for table in (lake.ledger, lake.zones, lake.silver):
        table.create(spark)


def load_zones(spark: SparkSession, lake: Lake, now: datetime | None = None) -> int:
    """Refresh the zone list from its CSV; returns the rows of the CSV."""
    ensure_warehouse(spark, lake)
    listed = zones.read_zones(spark, lake.zone_csv)
    count = upsert.check_zone_keys(listed)
    if count:
        merged = upsert.upsert_zones(lake.zones.read(spark), listed, F.lit(now or utc_now()))
        staged = cut(merged, staging_path(spark, lake, "zones"), "taxi_zone_lookup")
        lake.zones.rewrite(staged.select(*ZONES.names).coalesce(1))
    return count


def bootstrap(spark: SparkSession, lake: Lake) -> None:
    ensure_warehouse(spark, lake)
    load_zones(spark, lake)


# Loads -----------------------------------------------------------------------------


def _planned(spark: SparkSession, rows: list[dict]) -> DataFrame:
    schema = LEDGER_EVENTS
    fields = [schema[name] for name in _PLANNED]
    return spark.createDataFrame(
        [tuple(row[name] for name in _PLANNED) for row in rows], type(schema)(fields)
    )


def _plan(lake: Lake, taxi_type: str, year_month: str, source: Row | None = None) -> dict:
    return {
        "batch_id": str(uuid4()),
        "taxi_type": taxi_type,
        "year_month": year_month,
        "source_url": trips.source_url(lake.source_base, taxi_type, year_month),
        "source_file_name": trips.source_file_name(taxi_type, year_month),
        "bronze_object_key": trips.bronze_key(taxi_type, year_month),
        "source_etag": source["source_etag"] if source else None,
        "source_last_modified": source["source_last_modified"] if source else None,
        "source_rows": 0,
        "schema_drift_columns": [],
    }


def _load(
    spark: SparkSession,
    lake: Lake,
    taxi_type: str,
    plans: list[dict],
    files: list[str],
    parts: bool,
) -> dict:
    """Load planned months of one type in one plan; returns metrics by batch id."""
    started = None
    try:
        groups = trips.read_schema_groups(spark, files)
        for raw, _ in groups:
            # Raises on colliding names before anything is written.
            trips.canonical_columns(raw.schema)
        rows = {r["year_month"]: r["source_rows"] for r in trips.count_source_rows(groups).collect()}
        drift = trips.drift_by_month(groups)
        for plan in plans:
            plan["schema_drift_columns"] = drift.get(plan["year_month"], [])
            plan["source_rows"] = rows.get(plan["year_month"], 0)
        months = [plan["year_month"] for plan in plans]
        trips.land_months(spark, groups, lake.root, taxi_type, months)
        planned = _planned(spark, plans)
        ledger.start_batches(spark, lake.ledger, planned, utc_now())
        started = planned

        only_month = months[0] if len(plans) == 1 else None
        normalized = trips.normalize_groups(groups, taxi_type, only_month, parts)
        order = (trips.SOURCE_PART, ROW_NUMBER) if parts else (ROW_NUMBER,)
        prepared = prepare_batch(
            normalized,
            F.col("has_schema_drift"),
            order,
            folder=staging_path(spark, lake, "dedupe"),
            cluster_by=() if only_month else lake.silver.partition_by,
        )
        metrics = load_prepared(
            spark,
            lake,
            to_silver(trips.with_batches(prepared, planned), utc_now()),
            planned,
            [(month, taxi_type) for month in months],
            clustered=True,
        )
        ledger.finish_batches(spark, lake.ledger, planned, metrics, utc_now())
        return {row["batch_id"]: row.asDict() for row in metrics.collect()}
    except Exception as error:
        if started is None:
            started = _planned(spark, plans)
            ledger.start_batches(spark, lake.ledger, started, utc_now())
        ledger.fail_batches(spark, lake.ledger, started, str(error), utc_now())
        raise


class LostRows(Exception):
    """A write left out rows that were prepared for it."""


def load_prepared(
    spark: SparkSession,
    lake: Lake,
    silver: DataFrame,
    planned: DataFrame,
    partitions: list[tuple[str, str]],
    clustered: bool = False,
) -> DataFrame:
    """Upsert prepared rows and count them per batch; raises when the table lacks any.

    Rows are counted on their way into the staging folder, in what was written there, and in
    the table, so rows that a write loses cannot pass for duplicates.
    """
    upsert.recover(spark, lake.silver)
    seen = Observation()
    rows = upsert.materialize(spark, lake.silver, silver, partitions, seen, clustered)
    counted = loaded_metrics(rows).collect()
    prepared, staged = seen.get["rows"], sum(row["loaded_rows"] for row in counted)
    if prepared != staged:
        raise LostRows(f"{prepared} rows prepared, {staged} written")
    upsert.upsert_table(spark, lake.silver, rows, partitions=partitions, materialized=True)
    written = lake.silver.read(spark).where(
        upsert.in_partitions(lake.silver.partition_by, partitions)
    )
    written = written.join(F.broadcast(planned.select("batch_id")), "batch_id", "left_semi")
    found = {r["batch_id"]: r["count"] for r in written.groupBy("batch_id").count().collect()}
    for row in counted:
        if found.get(row["batch_id"], 0) != row["loaded_rows"]:
            raise LostRows(
                f"batch {row['batch_id']}: {row['loaded_rows']} rows prepared, "
                f"{found.get(row['batch_id'], 0)} in the table"
            )
    # One row per batch, read twice by the caller.
    loaded = spark.createDataFrame(
        counted, "batch_id string, loaded_rows bigint, invalid_rows bigint, null_key_rows bigint"
    )
    counts = planned.select("batch_id", "source_rows").join(loaded, "batch_id", "left").fillna(0)
    return counts.select(
        "batch_id",
        "source_rows",
        "loaded_rows",
        (F.col("source_rows") - F.col("loaded_rows")).alias("duplicate_rows"),
        "invalid_rows",
        "null_key_rows",
    )


def _outcome(plan: dict, metrics: dict) -> dict:
    return {
        "status": "success",
        "batch_id": plan["batch_id"],
        "taxi_type": plan["taxi_type"],
        "year_month": plan["year_month"],
        "source_url": plan["source_url"],
        "source_rows": plan["source_rows"],
        "schema_drift_columns": plan["schema_drift_columns"],
        **{k: v for k, v in metrics[plan["batch_id"]].items() if k.endswith("_rows")},
    }


def _skipped(plan: dict) -> dict:
    return {
        "status": "skipped",
        "reason": "this source file is loaded already",
        "taxi_type": plan["taxi_type"],
        "year_month": plan["year_month"],
        "source_url": plan["source_url"],
        "source_etag": plan["source_etag"],
    }


def _record_failed(spark: SparkSession, lake: Lake, plans: list[dict], message: str) -> None:
    """Ledger rows for months whose file could not be found."""
    planned = _planned(spark, plans)
    ledger.start_batches(spark, lake.ledger, planned, utc_now())
    ledger.fail_batches(spark, lake.ledger, planned, message, utc_now())


def _waves(plans: list[dict], sources: dict[str, Row], limit: int) -> Iterator[list[dict]]:
    """Months in order, in runs of at most ``limit`` source bytes, one month at least."""
    wave, size = [], 0
    for plan in plans:
        more = sources[plan["year_month"]]["source_bytes"]
        if wave and size + more > limit:
            yield wave
            wave, size = [], 0
        wave.append(plan)
        size += more
    if wave:
        yield wave


def _load_wave(
    spark: SparkSession, lake: Lake, taxi_type: str, wave: list[dict], sources: dict[str, Row]
) -> dict:
    loading = [sources[plan["year_month"]] for plan in wave]
    with shuffle_sized_for(spark, sum(row["source_bytes"] for row in loading)):
        parts = any(row["source_parts"] > 1 for row in loading)
        files = [file for row in loading for file in row["source_files"]]
        return _load(spark, lake, taxi_type, wave, files, parts)


def _run(
    spark: SparkSession,
    lake: Lake,
    taxi_type: str,
    months: list[str],
    continue_on_error: bool = False,
    wave_bytes: int = WAVE_BYTES,
) -> tuple[list[dict], list[tuple[str, Exception]]]:
    """Load the months that are not loaded yet, in waves; results and failures in order.

    The months of a wave share one normalization, one deduplication and one upsert. When a
    wave of several months fails, its months are loaded one by one, so each is loaded or
    has failed by itself. Loading stops at the first month that fails, and what was loaded
    before stays; with ``continue_on_error`` the rest is loaded too.
    """
    ensure_warehouse(spark, lake)
    pattern = months[0] if len(months) == 1 else "*"
    try:
        listed = trips.list_sources(spark, lake.source_base, taxi_type, pattern)
        sources = {row["year_month"]: row for row in listed.collect()}
    except Exception as error:
        _record_failed(spark, lake, [_plan(lake, taxi_type, m) for m in months], str(error))
        raise
    failures: dict[str, Exception] = {}
    wanted = months
    missing = [month for month in months if month not in sources]
    if missing and not continue_on_error:
        wanted, missing = months[: months.index(missing[0])], missing[:1]
    for month in missing:
        error = FileNotFoundError(f"no source file for {taxi_type} {month}")
        failures[month] = error
    if missing:
        plans = [_plan(lake, taxi_type, m) for m in missing]
        _record_failed(spark, lake, plans, f"no source file for {taxi_type} {', '.join(missing)}")

    plans = [_plan(lake, taxi_type, m, sources[m]) for m in wanted if m in sources]
    results: dict[str, dict] = {}
    if plans:
        batches = ledger.current_batches(lake.ledger.read(spark))
        pending = ledger.pending_batches(_planned(spark, plans), batches).select("batch_id")
        pending_ids = {row["batch_id"] for row in pending.collect()}
        to_load = [plan for plan in plans if plan["batch_id"] in pending_ids]
        results = {p["year_month"]: _skipped(p) for p in plans if p["batch_id"] not in pending_ids}
        for wave in _waves(to_load, sources, wave_bytes):
            failed = _load_months(spark, lake, taxi_type, wave, sources, results)
            failures |= failed
            if failed and not continue_on_error:
                break
    return (
        [results[m] for m in months if m in results],
        [(m, failures[m]) for m in months if m in failures],
    )


def _load_months(
    spark: SparkSession,
    lake: Lake,
    taxi_type: str,
    wave: list[dict],
    sources: dict[str, Row],
    results: dict[str, dict],
) -> dict[str, Exception]:
    """Load a wave into ``results``; failures by month."""
    try:
        metrics = _load_wave(spark, lake, taxi_type, wave, sources)
        results |= {plan["year_month"]: _outcome(plan, metrics) for plan in wave}
        return {}
    except Exception as error:
        if len(wave) == 1:
            return {wave[0]["year_month"]: error}
    failures: dict[str, Exception] = {}
    for plan in wave:
        alone = _plan(lake, taxi_type, plan["year_month"], sources[plan["year_month"]])
        failures |= _load_months(spark, lake, taxi_type, [alone], sources, results)
    return failures


def run_month(spark: SparkSession, lake: Lake, taxi_type: str, year_month: str) -> dict:
    """Load one month, or skip it when the same file was loaded before."""
    results, failures = _run(spark, lake, taxi_type, month_range(year_month, year_month))
    for _, error in failures:
        raise error
    return results[0]


def run_range(
    spark: SparkSession,
    lake: Lake,
    taxi_type: str,
    start_month: str,
    end_month: str,
    continue_on_error: bool = False,
    wave_bytes: int = WAVE_BYTES,
) -> dict:
    """Load a range of months, both ends included.

    The first month that fails raises, and months loaded before it stay loaded. With
    ``continue_on_error`` all others are loaded and failures are listed.
    """
    months = month_range(start_month, end_month)
    results, failures = _run(spark, lake, taxi_type, months, continue_on_error, wave_bytes)
    if failures and not continue_on_error:
        raise failures[0][1]
    return {
        "status": "partial_success" if failures else "success",
        "taxi_type": taxi_type,
        "start_month": start_month,
        "end_month": end_month,
        "requested_months": months,
        "successful_months": [result["year_month"] for result in results],
        "failed_months": [{"year_month": m, "error": str(error)} for m, error in failures],
        "results": results,
    }


# Gold ------------------------------------------------------------------------------


def refresh_dimensions(spark: SparkSession, lake: Lake) -> None:
    trips_view = staging.stage_trips(lake.silver.read(spark))
    zones_view = staging.stage_zones(lake.zones.read(spark))
    lake.gold("dim_vendor").rewrite(dimensions.vendor_dimension(trips_view))
    lake.gold("dim_zone").rewrite(dimensions.zone_dimension(trips_view, zones_view))


def refresh_fact(spark: SparkSession, lake: Lake, full: bool = False) -> None:
    """Build the fact, or replace the trips updated since it was last built.

    The full build shuffles nothing: silver and fact have the same partitions and the
    dimensions are joined by broadcast as long as they are small. A refresh rewrites
    the partitions that hold updated trips and no others.
    """
    staged = staging.stage_trips(lake.silver.read(spark))
    vendors, zone_dim = lake.gold("dim_vendor").read(spark), lake.gold("dim_zone").read(spark)
    upsert.recover(spark, lake.fact)
    if full or not lake.fact.exists(spark):
        lake.fact.rewrite(fact.trip_fact(staged, vendors, zone_dim))
        return
    delta = fact.changed_since(staged, fact.high_water_mark(lake.fact.read(spark)))
    upsert.upsert_table(
        spark,
        lake.fact,
        fact.trip_fact(delta, vendors, zone_dim),
        keep=(),
        # Rows come by partition as they were read from silver.
        clustered=True,
    )


def refresh_marts(spark: SparkSession, lake: Lake) -> None:
    trip_fact = lake.fact.read(spark)
    zone_dim = lake.gold("dim_zone").read(spark)
    baseline = cut(
        marts.fare_baseline(trip_fact), staging_path(spark, lake, "marts"), "fare_baseline"
    )
    lake.gold("fct_fare_anomalies").rewrite(marts.fare_anomalies(trip_fact, baseline))
    lake.gold("fct_monthly_metrics").rewrite(marts.monthly_metrics(trip_fact))
    lake.gold("fct_zone_hourly_metrics").rewrite(marts.zone_hourly_metrics(trip_fact, zone_dim))


def refresh_monitoring(spark: SparkSession, lake: Lake, as_of: datetime) -> None:
    batches = staging.stage_batches(ledger.current_batches(lake.ledger.read(spark)))
    pipeline = lake.gold("ops_pipeline_monitoring")
    totals = lake.gold("ops_monthly_source_reconciliation")
    pipeline.rewrite(monitoring.pipeline_monitoring(batches, as_of))
    totals.rewrite(monitoring.source_reconciliation(batches, lake.fact.read(spark)))
    lake.gold("ops_alerts").rewrite(
        monitoring.operational_alerts(pipeline.read(spark), totals.read(spark), as_of)
    )


def build_gold(spark: SparkSession, lake: Lake, as_of: datetime | None = None) -> None:
    """Dimensions, fact, marts and monitoring, each after what it reads."""
    refresh_dimensions(spark, lake)
    refresh_fact(spark, lake)
    refresh_marts(spark, lake)
    refresh_monitoring(spark, lake, as_of or utc_now())


# Checks and the whole run ------------------------------------------------------------

_GOLD_CHECKED = (
    "dim_vendor",
    "dim_zone",
    "fct_monthly_metrics",
    "ops_monthly_source_reconciliation",
    "ops_alerts",
)


def checked_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    silver, zone_list = lake.silver.read(spark), lake.zones.read(spark)
    batches = ledger.current_batches(lake.ledger.read(spark))
    return {
        "silver.taxi_trips": silver,
        "raw.taxi_zone_lookup": zone_list,
        "ops.batch_runs": batches,
        "stg_taxi_trips": staging.stage_trips(silver),
        "stg_taxi_zones": staging.stage_zones(zone_list),
        "stg_batch_runs": staging.stage_batches(batches),
        "fct_taxi_trips": lake.fact.read(spark),
        **{name: lake.gold(name).read(spark) for name in _GOLD_CHECKED},
    }


def check_tables(spark: SparkSession, lake: Lake) -> DataFrame:
    """Summary rows of all data checks on the lake's tables."""
    return checks.run_checks(checked_tables(spark, lake), staging_path(spark, lake, "checks"))


def run_all(
    spark: SparkSession,
    lake: Lake,
    taxi_type: str,
    months: list[str],
    as_of: datetime | None = None,
    strict_checks: bool = False,
) -> dict:
    """Bootstrap, load, freshness, gold, checks, alerts; an ``error`` alert raises.

    Failed checks are returned, and raise only with ``strict_checks``.
    """
    bootstrap(spark, lake)
    loads, failures = _run(spark, lake, taxi_type, months)
    for _, error in failures:
        raise error
    freshness = checks.source_freshness(lake.silver.read(spark), as_of or utc_now()).first()
    if freshness["status"] == "error":
        raise CheckFailed(f"{freshness['target']} was last loaded at {freshness['max_loaded_at']}")
    build_gold(spark, lake, as_of)
    results = [row.asDict() for row in check_tables(spark, lake).collect()]
    failed = [row for row in results if row["status"] == "fail"]
    if failed and strict_checks:
        raise CheckFailed("; ".join(f"{r['check']}:{r['target']}:{r['column']}" for r in failed))
    monitoring.alert_gate(lake.gold("ops_alerts").read(spark))
    return {"loads": loads, "freshness": freshness.asDict(), "checks": results}
