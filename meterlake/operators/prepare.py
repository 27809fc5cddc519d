"""Preparation of a batch for the merge (I2) and its metrics."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.flags import quality_status, row_flags
from meterlake.functions.keys import row_fingerprint
from meterlake.operators.dedupe import keep_first, keep_first_narrow
from meterlake.schema import KEY_HASH, PREPARED_COLUMNS, ROW_NUMBER, SILVER


def add_flags(kept: DataFrame, schema_drift: bool | Column) -> DataFrame:
    return kept.withColumns(
        {"row_fingerprint": row_fingerprint(), **row_flags(schema_drift)}
    ).withColumn("quality_status", quality_status())


def prepare_batch(
    trips: DataFrame,
    schema_drift: bool | Column,
    order_by: Sequence[str] = (ROW_NUMBER,),
    scope: Sequence[str] = (),
    merge_next: bool = False,
    carry: Sequence[str] = (),
    folder: str | None = None,
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Deduplicated trips with keys, flags and status: one scan and one shuffle.

    With ``merge_next`` the hash of the trip key comes last, for the merge to reuse; the
    columns ``carry`` stay on. With a ``folder`` for an intermediate table, hashes of the keys
    are counted first and only rows with a repeated one are shuffled; then rows equal in
    ``cluster_by`` come together (see ``keep_first_narrow``).
    """
    if folder is not None:
        kept = keep_first_narrow(trips, folder, order_by, scope, cluster_by)
    else:
        kept = keep_first(trips, order_by, scope, merge_next)
    flagged = add_flags(kept, schema_drift)
    columns = [c for c in (*PREPARED_COLUMNS, *carry, KEY_HASH) if c in flagged.columns]
    return flagged.select(*columns)


def to_silver(
    prepared: DataFrame, loaded_at: datetime | Column, first_loaded_at: Column | None = None
) -> DataFrame:
    """Prepared trips in the silver schema; ``first_loaded_at`` is that of trips loaded before,
    null for others.

    NaN is cleaned here, after keys and flags have seen it. An integer beyond 32 bits
    raises under ANSI casts and so fails the batch. The hash of the trip key stays on
    for the merge if it is there; tables do not store it.
    """
    now = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    first = now if first_loaded_at is None else F.coalesce(first_loaded_at, now)
    stamped = prepared.withColumns({"loaded_at": first, "updated_at": now})
    columns = []
    for target in SILVER.fields:
        column = F.col(target.name)
        if isinstance(target.dataType, T.DoubleType):
            column = F.when(~F.isnan(column), column)
        columns.append(column.cast(target.dataType).alias(target.name))
    carried = [KEY_HASH] if KEY_HASH in prepared.columns else []
    return stamped.select(*columns, *carried)


def loaded_metrics(prepared: DataFrame, by: Sequence[str] = ("batch_id",)) -> DataFrame:
    """Loaded, invalid and null-key rows per batch."""
    return prepared.groupBy(*by).agg(
        F.count("*").alias("loaded_rows"),
        F.count_if(F.col("quality_status") == "flagged").alias("invalid_rows"),
        F.count_if("has_null_key").alias("null_key_rows"),
    )


def batch_metrics(
    source: DataFrame, prepared: DataFrame, by: Sequence[str] = ("batch_id",)
) -> DataFrame:
    """Source, loaded, duplicate, invalid and null-key rows per batch.

    Counted from the data rather than from accumulators, which count a task again when
    its executor is lost.
    """
    counts = source.groupBy(*by).agg(F.count("*").alias("source_rows"))
    metrics = counts.join(loaded_metrics(prepared, by), list(by), "left").fillna(
        0, ["loaded_rows", "invalid_rows", "null_key_rows"]
    )
    return metrics.select(
        *by,
        "source_rows",
        "loaded_rows",
        (F.col("source_rows") - F.col("loaded_rows")).alias("duplicate_rows"),
        "invalid_rows",
        "null_key_rows",
    )
