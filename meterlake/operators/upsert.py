"""Upserts on plain parquet (I1, I3) and column sync.

A table format with MERGE INTO can replace ``upsert_table`` behind the same signature.

**Steps of an upsert.** The incoming rows are written as partitions to the table's staging
folder. Where the table holds rows of a partition, its merged content is written beside them
and the incoming folder goes; a partition that is new to the table is taken as it was written.
Where no column is kept, the incoming rows are final, and current rows that stay are written
into their folder instead. Then a marker is put there, the staged folders are moved over the
table's, and the marker is removed. A job that dies before the marker leaves the table as it was. One that dies after it is completed by ``recover``, with which every later writer of
the table begins, so a partition that is being replaced is never taken for an empty one.
A table has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators.dedupe import repeated_table, split_repeated
from meterlake.schema import KEY_HASH, TRIP_KEY, TRIP_PARTITIONS, ZONE_COLUMNS
from meterlake.sources import files
from meterlake.sources.tables import LakeTable, cut, working_dir

# Keys of so many incoming rows are broadcast in a merge: some 200 MB at most.
BROADCAST_ROWS = 1_000_000


def latest_per_key(
    rows: DataFrame, keys: Sequence[str], latest_first: Sequence[Column]
) -> DataFrame:
    """One row per key: the first under ``latest_first``."""
    versions = Window.partitionBy(*keys).orderBy(*latest_first)
    return (
        rows.withColumn("_version", F.row_number().over(versions))
        .where("_version = 1")
        .drop("_version")
    )


def merge(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str] = TRIP_KEY,
    keep: Sequence[str] = ("loaded_at",),
    folder: str | None = None,
) -> DataFrame:
    """Incoming rows replace current rows of the same key; ``keep`` columns stay as first loaded.

    Keys are unique on either side, so one full outer join does it and no key can be hot.
    The hash leads the join columns (see ``key_hash``). Incoming trips straight from
    ``prepare_batch(merge_next=True)`` are already partitioned and sorted this way, and
    then only the current rows are shuffled for the merge, or none if they come so too.

    With a ``folder`` for an intermediate table, hashes of the keys of both sides are counted
    first. Only rows whose hash is there twice can meet; the others stay where they are.
    """
    if folder is not None:
        key = F.xxhash64(*keys)
        sides = [side.drop(KEY_HASH) for side in (current, incoming)]
        repeated = repeated_table(sides[0].select(key).unionAll(sides[1].select(key)), folder)
        (stay, old), (added, new) = (split_repeated(side, key, repeated) for side in sides)
        met = merge(old, new, keys, keep)
        return stay.unionByName(added.select(*stay.columns)).unionByName(met)
    names = [name for name in current.columns if name != KEY_HASH]
    left = current if len(names) < len(current.columns) else current.withColumn(
        KEY_HASH, F.xxhash64(*keys)
    )
    left = left.alias("old")
    right = incoming.withColumn("_incoming", F.lit(True))
    if KEY_HASH not in incoming.columns:
        right = right.withColumn(KEY_HASH, F.xxhash64(*keys))
    right = right.alias("new")
    on = reduce(and_, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in (KEY_HASH, *keys)])
    is_new = F.col("new._incoming").isNotNull()
    columns = []
    for name in names:
        old, new = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name in keep:
            value = F.coalesce(old, new)
        else:
            value = F.when(is_new, new).otherwise(old)
        columns.append(value.alias(name))
    return left.join(right, on, "full").select(*columns)


def sync_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in another schema: new columns are null, columns no longer there are dropped."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def in_partitions(columns: Sequence[str], values: Sequence[Sequence[str]]) -> Column:
    """A predicate on partition columns, as literals so that it prunes directories."""
    if not values:
        return F.lit(False)
    by_rest: dict[tuple, list[str]] = {}
    for first, *rest in values:
        by_rest.setdefault(tuple(rest), []).append(first)
    groups = []
    for rest, firsts in sorted(by_rest.items()):
        terms = [F.col(columns[0]).isin(sorted(firsts))]
        terms += [F.col(c) == v for c, v in zip(columns[1:], rest)]
        groups.append(reduce(and_, terms))
    return reduce(or_, groups)


def touched_partitions(rows: DataFrame, table: LakeTable) -> list[tuple[str, ...]]:
    """The partitions that ``rows`` fall in: one small row per month and type.

    On a partitioned table this reads row counts from file footers and no column.
    """
    return [tuple(row) for row in rows.select(*table.partition_by).distinct().collect()]


def held_partitions(
    spark: SparkSession, table: LakeTable, partitions: Sequence[Sequence[str]]
) -> set[tuple[str, ...]]:
    """Those of ``partitions`` that hold rows."""
    rows = table.read(spark).where(in_partitions(table.partition_by, partitions))
    return set(touched_partitions(rows, table))


def _staging(table: LakeTable, name: str) -> LakeTable:
    return LakeTable(f"{table.path}__staging/{name}", table.schema, table.partition_by)


def _marker(table: LakeTable) -> str:
    return f"{table.path}__staging/_READY"


def materialize(
    spark: SparkSession,
    table: LakeTable,
    incoming: DataFrame,
    partitions: Sequence[Sequence[str]] | None = None,
    seen: Observation | None = None,
    clustered: bool = False,
) -> DataFrame:
    """``incoming`` as a table of its own, in files of the advisory size by partition. ``seen``
    gets the ``rows`` that go into the write, counted in its own tasks. ``clustered`` says that
    rows of one partition are together already."""
    held = _staging(table, "incoming")
    rows = incoming.select(*table.schema.names)
    one = partitions is not None and len(partitions) < 2
    rows = rows if clustered or one else _clustered(rows, table)
    held.rewrite(rows.observe(seen, F.count(F.lit(1)).alias("rows")) if seen else rows)
    return held.read(spark)


def _clustered(df: DataFrame, table: LakeTable) -> DataFrame:
    """Rows of one partition together, in files of the advisory size.

    Rebalancing splits a partition that holds much of the data over many tasks, and
    puts small ones in a single file.
    """
    return df.hint("rebalance", *table.partition_by)


def merge_narrow(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], keep: Sequence[str], small: bool
) -> DataFrame:
    """``merge`` for incoming rows that are a table. When they are ``small`` their keys are
    broadcast, and no current row is shuffled; either way the rows are the same. Incoming rows
    come by partition after their join, so they make few files."""
    names = incoming.select(*keys)
    names = F.broadcast(names) if small else names
    stay = current.join(names, list(keys), "left_anti").select(*current.columns)
    new = incoming
    if keep:
        old = current.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in keep])
        old = old.join(names, list(keys), "left_semi")
        new = incoming.join(old, list(keys), "left").withColumns(
            {c: F.coalesce(f"_old_{c}", c) for c in keep}
        )
        by = [c for c in TRIP_PARTITIONS if c in new.columns]
        new = new.hint("rebalance", *by) if by else new
    return stay.unionByName(new.select(*current.columns))


def upsert_table(
    spark: SparkSession,
    table: LakeTable,
    incoming: DataFrame,
    keys: Sequence[str] = TRIP_KEY,
    keep: Sequence[str] = ("loaded_at",),
    partitions: Sequence[Sequence[str]] | None = None,
    materialized: bool = False,
    clustered: bool = False,
) -> None:
    """Upsert ``incoming`` into a partitioned table: ``stage_upsert``, then ``publish``."""
    if stage_upsert(spark, table, incoming, keys, keep, partitions, materialized, clustered):
        publish(spark, table)


def stage_upsert(
    spark: SparkSession,
    table: LakeTable,
    incoming: DataFrame,
    keys: Sequence[str] = TRIP_KEY,
    keep: Sequence[str] = ("loaded_at",),
    partitions: Sequence[Sequence[str]] | None = None,
    materialized: bool = False,
    clustered: bool = False,
) -> list[str]:
    """Upsert ``incoming`` (unique on ``keys``) into a partitioned table.

    ``partitions`` names those that ``incoming`` falls in; without it, they are looked up.
    ``materialized`` says that ``incoming`` is what ``materialize`` returned, ``clustered`` is
    as there. Only partitions that hold rows are read and rewritten; those that hold none yet
    take the files that ``materialize`` wrote, so their rows are encoded once. Partitions are
    merged in groups whose incoming keys can be broadcast, so that current rows are shuffled
    only where one partition alone has more. Without ``keep`` only the current rows that stay
    are written (see ``_add_staying``). Returns the staged folders.
    """
    recover(spark, table)
    # What a job left that died before its marker.
    files.delete(spark, _staging(table, "rows").path)
    if not materialized:
        incoming = materialize(spark, table, incoming, partitions, clustered=clustered)
    columns = table.partition_by

    def counted() -> dict[tuple, int]:
        # From file footers; no column is read.
        found = incoming.groupBy(*columns).count().collect()
        return {tuple(row)[:-1]: row["count"] for row in found}

    rows = counted() if partitions is None else None
    touched = list(rows) if partitions is None else partitions
    if not touched:
        return []
    held = held_partitions(spark, table, touched)
    stale = [value for value in touched if tuple(value) in held]
    if stale:
        rows = counted() if rows is None else rows
        if keep:
            _merge_groups(spark, table, incoming, keys, keep, stale, rows)
        else:
            _add_staying(spark, table, incoming, keys, stale, sum(rows.values()))
    files.touch(spark, _marker(table))
    return staged_folders(spark, table)


def _merge_groups(
    spark: SparkSession,
    table: LakeTable,
    incoming: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str],
    stale: Sequence[Sequence[str]],
    rows: dict[tuple, int],
) -> None:
    """Write the merged content of the ``stale`` partitions, whose incoming ``rows`` are counted."""
    place = _staging(table, "rows")
    write = place.rewrite
    for group in _groups(stale, rows, BROADCAST_ROWS):
        inside = in_partitions(table.partition_by, group)
        small = sum(rows.get(tuple(value), 0) for value in group) <= BROADCAST_ROWS
        current, corrections = table.read(spark).where(inside), incoming.where(inside)
        # Without a shuffle, rows come by partition as they were read.
        write(merge_narrow(current, corrections, keys, keep, small))
        write = place.append
    for folder in _folders(spark, table, "rows"):
        files.delete(spark, f"{_staging(table, 'incoming').path}/{folder}")


def _add_staying(
    spark: SparkSession,
    table: LakeTable,
    incoming: DataFrame,
    keys: Sequence[str],
    stale: Sequence[Sequence[str]],
    count: int,
) -> None:
    """Write current rows of the ``stale`` partitions whose key is not among the ``count``
    incoming ones into the folders of those, which need not be encoded again then.

    Beyond ``BROADCAST_ROWS`` the keys alone are shuffled to find those that stay. They are
    few where the incoming rows replace most, and are broadcast in groups of partitions.
    """
    by, place = table.partition_by, _staging(table, "incoming")
    inside = in_partitions(by, stale)
    current, corrections = table.read(spark).where(inside), incoming.where(inside)
    if count <= BROADCAST_ROWS:
        names = F.broadcast(corrections.select(*keys))
        place.append(current.join(names, list(keys), "left_anti").select(*table.schema.names))
        return
    # A sort that begins with the hash decides on it (see ``key_hash``).
    key_hash = F.xxhash64(*keys).alias(KEY_HASH)
    named = current.select(key_hash, *dict.fromkeys((*keys, *by)))
    replaced = corrections.select(key_hash, *keys)
    folder = f"{working_dir(spark, f'{table.path}__staging').rstrip('/')}/merge"
    found = named.join(replaced, [KEY_HASH, *keys], "left_anti").drop(KEY_HASH)
    staying = cut(found, folder, "staying_keys")
    rows = {tuple(row)[:-1]: row["count"] for row in staying.groupBy(*by).count().collect()}
    for group in _groups(sorted(rows), rows, BROADCAST_ROWS):
        inside = in_partitions(by, group)
        names = staying.where(inside).select(*[F.col(k).alias(f"_{k}") for k in keys])
        if sum(rows[value] for value in group) <= BROADCAST_ROWS:
            names = F.broadcast(names)
        # A missing key equals none, so its row stays.
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        stay = table.read(spark).where(inside).join(names, same, "left_semi")
        place.append(stay.select(*table.schema.names))


def _groups(
    partitions: Sequence[Sequence[str]], rows: dict[tuple, int], limit: int
) -> Iterator[list[Sequence[str]]]:
    """Partitions in runs of at most ``limit`` of their ``rows``, one partition at least."""
    group, size = [], 0
    for value in partitions:
        more = rows.get(tuple(value), 0)
        if group and size + more > limit:
            yield group
            group, size = [], 0
        group.append(value)
        size += more
    if group:
        yield group


def _folders(spark: SparkSession, table: LakeTable, name: str) -> list[str]:
    pattern = "/".join(f"{column}=*" for column in table.partition_by)
    return files.folders(spark, _staging(table, name).path, pattern)


def staged_folders(spark: SparkSession, table: LakeTable) -> list[str]:
    """Partitions to be published: merged ones, and incoming ones that are new to the table."""
    return sorted({*_folders(spark, table, "rows"), *_folders(spark, table, "incoming")})


def publish_folder(spark: SparkSession, table: LakeTable, folder: str) -> None:
    """Move one staged partition over the table's; it is in one of the two places."""
    merged = f"{_staging(table, 'rows').path}/{folder}"
    staged = merged if files.exists(spark, merged) else f"{_staging(table, 'incoming').path}/{folder}"
    files.delete(spark, f"{table.path}/{folder}")
    files.move(spark, staged, f"{table.path}/{folder}")


def publish(spark: SparkSession, table: LakeTable) -> None:
    """Move the staged partitions over the table's; may be run again at any point."""
    for folder in staged_folders(spark, table):
        publish_folder(spark, table, folder)
    files.delete(spark, _marker(table))
    files.delete(spark, _staging(table, "rows").path)
    files.delete(spark, _staging(table, "incoming").path)


def recover(spark: SparkSession, table: LakeTable) -> bool:
    """Complete the upsert of a job that died while it published; whether there was one."""
    if not files.exists(spark, _marker(table)):
        return False
    publish(spark, table)
    return True


def upsert_zones(current: DataFrame, incoming: DataFrame, updated_at: Column) -> DataFrame:
    """The zone list after a refresh: listed zones take the new values, others stay."""
    fresh = incoming.select(*ZONE_COLUMNS).withColumn("updated_at", updated_at)
    kept = current.join(fresh, "location_id", "left_anti")
    return kept.unionByName(fresh)


def check_zone_keys(incoming: DataFrame) -> int:
    """Rows of a zone list; raises on a missing or repeated ``location_id``."""
    counts = incoming.agg(
        F.count("*").alias("rows"),
        F.count("location_id").alias("keyed"),
        F.count_distinct("location_id").alias("distinct"),
    ).first()
    if counts["keyed"] < counts["rows"]:
        raise ValueError("zone list has rows without a location_id")
    if counts["distinct"] < counts["keyed"]:
        raise ValueError("zone list repeats a location_id")
    return counts["rows"]
