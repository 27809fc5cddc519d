"""The batch ledger.

Each state change appends one event that carries the whole ledger row. The current row
of a batch is its latest event, which looks the same as updating rows in place. Events of
a batch are numbered through; a batch that is started again after it failed (a stream
that replays a micro-batch) goes on with the next number.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.schema import LEDGER, LEDGER_EVENTS
from meterlake.sources.tables import LakeTable

# Fixed value: longest error text kept.
MAX_ERROR_CHARS = 4000


def current_batches(events: DataFrame) -> DataFrame:
    """The latest event of each batch, in the ledger schema."""
    rest = [c for c in LEDGER.names if c != "batch_id"]
    latest = events.groupBy("batch_id").agg(
        F.max_by(F.struct(*rest), F.col("event_seq")).alias("row")
    )
    return latest.select("batch_id", *[F.col(f"row.{c}").alias(c) for c in rest])


def start_events(batches: DataFrame, started_at: Column) -> DataFrame:
    """First events, status ``running``, of planned batches (``batch_id`` to drift columns)."""
    values = {
        "loaded_rows": F.lit(0),
        "duplicate_rows": F.lit(0),
        "invalid_rows": F.lit(0),
        "null_key_rows": F.lit(0),
        "status": F.lit("running"),
        "error_message": F.lit(None),
        "started_at": started_at,
        "finished_at": F.lit(None),
        "runtime_seconds": F.lit(None),
        "event_seq": F.col("event_seq") if "event_seq" in batches.columns else F.lit(0),
    }
    return batches.select(
        *[
            values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in LEDGER_EVENTS.fields
        ]
    )


def _closed(running: DataFrame, finished_at: Column, changes: dict[str, Column]) -> DataFrame:
    seconds = (F.unix_micros(finished_at) - F.unix_micros("started_at")) / F.lit(1e6)
    changes = {
        **changes,
        "finished_at": finished_at,
        "runtime_seconds": seconds,
        "event_seq": F.col("event_seq") + 1 if "event_seq" in running.columns else F.lit(1),
    }
    return running.select(
        *[
            changes.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in LEDGER_EVENTS.fields
        ]
    )


def finish_events(running: DataFrame, metrics: DataFrame, finished_at: Column) -> DataFrame:
    """Success events from running rows and their metrics per ``batch_id``.

    A batch without metrics loaded nothing and finishes with zero counts.
    """
    names = ("loaded_rows", "duplicate_rows", "invalid_rows", "null_key_rows")
    joined = running.drop(*names).join(metrics.select("batch_id", *names), "batch_id", "left")
    counts = {name: F.coalesce(F.col(name), F.lit(0)) for name in names}
    return _closed(joined, finished_at, {**counts, "status": F.lit("success")})


def fail_events(running: DataFrame, error_message: str | Column, finished_at: Column) -> DataFrame:
    text = error_message if isinstance(error_message, Column) else F.lit(error_message)
    return _closed(
        running,
        finished_at,
        {"status": F.lit("failed"), "error_message": F.substring(text, 1, MAX_ERROR_CHARS)},
    )


def already_succeeded(candidates: DataFrame, batches: DataFrame, how: str) -> DataFrame:
    """``left_semi``: candidates loaded before from the same source; ``left_anti``: the rest.

    Any earlier success with the same etag counts, also when another version of the file
    was loaded in between. A candidate without etag never matches.
    """
    succeeded = batches.where("status = 'success'").select("taxi_type", "year_month", "source_etag")
    keyed = candidates.withColumn("_etag", F.nullif("source_etag", F.lit("")))
    on = (
        (F.col("c.taxi_type") == F.col("s.taxi_type"))
        & (F.col("c.year_month") == F.col("s.year_month"))
        & (F.col("c._etag") == F.col("s.source_etag"))
    )
    return keyed.alias("c").join(succeeded.alias("s"), on, how).drop("_etag")


def pending_batches(candidates: DataFrame, batches: DataFrame) -> DataFrame:
    return already_succeeded(candidates, batches, "left_anti")


def running_batches(spark: SparkSession, table: LakeTable, batches: DataFrame) -> DataFrame:
    """Ledger rows, with the number of their latest event, of those of ``batches
    (batch_id)`` that run."""
    events = table.read(spark).join(batches.select("batch_id"), "batch_id", "left_semi")
    last = events.groupBy("batch_id").agg(F.max("event_seq").alias("event_seq"))
    return current_batches(events).where("status = 'running'").join(last, "batch_id")


def start_batches(
    spark: SparkSession, table: LakeTable, batches: DataFrame, now: datetime
) -> None:
    """Mark ``batches`` as running, each after its earlier events if it has any."""
    before = table.read(spark).join(batches.select("batch_id"), "batch_id", "left_semi")
    before = before.groupBy("batch_id").agg((F.max("event_seq") + 1).alias("event_seq"))
    numbered = batches.join(before, "batch_id", "left").fillna(0, ["event_seq"])
    table.append(start_events(numbered, F.lit(now)))


def finish_batches(
    spark: SparkSession, table: LakeTable, batches: DataFrame, metrics: DataFrame, now: datetime
) -> None:
    running = running_batches(spark, table, batches)
    table.append(finish_events(running, metrics, F.lit(now)))


def fail_batches(
    spark: SparkSession, table: LakeTable, batches: DataFrame, message: str, now: datetime
) -> None:
    running = running_batches(spark, table, batches)
    table.append(fail_events(running, message, F.lit(now)))
