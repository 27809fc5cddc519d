"""Lakes built from the test tables, once per session and data folder.

Marts read a fact that was written once, as they do in production, so queries over
the built tables do not repeat the load. ``bench.py`` times the load by itself.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators.upsert import publish_folder, stage_upsert, upsert_table
from meterlake.plans import jobs
from meterlake.schema import LEDGER, TAXI_TYPES
from meterlake.sources import files
from meterlake.sources.tables import Lake, working_dir
from meterlake.sources.trips import list_sources, source_url
from meterlake.streaming.landing import land_stream
from workload import derive

_BUILT: dict[tuple[str, str, str], Lake] = {}


def new_root(spark: SparkSession) -> str:
    """A fresh folder on the shared storage the session names: ``spark.checkpoint.dir``, or
    the warehouse where that is unset."""
    shared = working_dir(spark, "") or f"{spark.conf.get('spark.sql.warehouse.dir')}/lakes"
    return f"{shared.rstrip('/')}/lake-{uuid4().hex}"


def _memo(spark: SparkSession, sf_dir: str, kind: str, build) -> Lake:
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _BUILT:
        _BUILT[key] = build(spark, sf_dir, Lake(new_root(spark)))
    return _BUILT[key]


def months_of(trips: DataFrame) -> list[tuple[str, str]]:
    rows = trips.select("source_year_month", "taxi_type").distinct().collect()
    return [tuple(row) for row in rows]


def write_ledger(lake: Lake, batches: DataFrame) -> None:
    seq = F.when(F.col("status") == "running", 0).otherwise(1)
    lake.ledger.append(batches.select(*LEDGER.names, seq.alias("event_seq")))


def _silver(spark: SparkSession, sf_dir: str, lake: Lake) -> Lake:
    jobs.ensure_warehouse(spark, lake)
    lake.zones.append(derive.zones(spark, sf_dir))
    trips = derive.silver_trips(spark, sf_dir, lake.silver.partition_by)
    partitions = months_of(derive.trips(spark, sf_dir))
    upsert_table(spark, lake.silver, trips, partitions=partitions, clustered=True)
    return lake


def _gold(spark: SparkSession, sf_dir: str, lake: Lake) -> Lake:
    lake = silver_lake(spark, sf_dir)
    write_ledger(lake, derive.ledger(spark, sf_dir))
    jobs.build_gold(spark, lake, derive.AS_OF)
    return lake


def _corrected(spark: SparkSession, sf_dir: str, lake: Lake) -> Lake:
    """A first load and its fact, then a correction and the refreshed fact."""
    jobs.ensure_warehouse(spark, lake)
    lake.zones.append(derive.zones(spark, sf_dir))
    partitions = months_of(derive.trips(spark, sf_dir))
    for batch in derive.correction_batches(spark, sf_dir, lake.silver.partition_by):
        upsert_table(spark, lake.silver, batch, partitions=partitions, clustered=True)
        jobs.refresh_dimensions(spark, lake)
        jobs.refresh_fact(spark, lake)
    return lake


def silver_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Silver and zones."""
    return _memo(spark, sf_dir, "silver", _silver)


def gold_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Silver, zones, ledger and all of gold."""
    return _memo(spark, sf_dir, "gold", _gold)


def corrected_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Silver and fact after a correction."""
    return _memo(spark, sf_dir, "corrected", _corrected)


def _interrupted(spark: SparkSession, sf_dir: str, lake: Lake) -> Lake:
    """As ``corrected``, but the correction dies while it publishes, and is run again."""
    jobs.ensure_warehouse(spark, lake)
    partitions = months_of(derive.trips(spark, sf_dir))
    first, second = derive.correction_batches(spark, sf_dir, lake.silver.partition_by)
    upsert_table(spark, lake.silver, first, partitions=partitions, clustered=True)
    staged = stage_upsert(spark, lake.silver, second, partitions=partitions, clustered=True)
    for folder in staged[: len(staged) // 2]:
        publish_folder(spark, lake.silver, folder)
    # One more has lost its old rows and not yet got the new ones.
    files.delete(spark, f"{lake.silver.path}/{staged[-1]}")
    upsert_table(spark, lake.silver, second, partitions=partitions, clustered=True)
    return lake


def interrupted_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Silver after a correction that was interrupted and repeated."""
    return _memo(spark, sf_dir, "interrupted", _interrupted)


def write_raw(spark: SparkSession, sf_dir: str, lake: Lake) -> None:
    """All line items as raw files: for each type a folder of part files for each month."""
    for taxi_type, rows in (
        ("yellow", derive.raw_yellow(spark, sf_dir, by_month=True)),
        ("green", derive.raw_green(spark, sf_dir, by_month=True)),
    ):
        written = f"{lake.root}/raw_{taxi_type}"
        rows.write.partitionBy("file_month").parquet(written)
        for folder in files.folders(spark, written, "file_month=*"):
            month = folder.split("=", 1)[1]
            url = source_url(lake.source_base, taxi_type, month)
            files.move(spark, f"{written}/{folder}", url)


def _raw(spark: SparkSession, sf_dir: str, lake: Lake) -> Lake:
    lake = Lake(lake.root, f"{lake.root}/source", f"{lake.root}/zones.csv")
    write_raw(spark, sf_dir, lake)
    listed = derive.zone_lookup(spark, sf_dir).selectExpr(
        "location_id as LocationID", "borough as Borough", "zone as Zone", "service_zone"
    )
    listed.coalesce(1).write.option("header", True).csv(lake.zone_csv)
    return lake


def raw_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Raw files of all types and months, and the zone list as CSV; nothing loaded yet."""
    return _memo(spark, sf_dir, "raw", _raw)


def beside(spark: SparkSession, lake: Lake) -> Lake:
    """An empty lake over the same sources."""
    return Lake(new_root(spark), lake.source_base, lake.zone_csv)


def months_listed(spark: SparkSession, lake: Lake, taxi_type: str) -> list[str]:
    listed = list_sources(spark, lake.source_base, taxi_type).select("year_month").collect()
    return sorted(row["year_month"] for row in listed)


def _parts(spark: SparkSession, sf_dir: str, lake: Lake) -> Lake:
    """Months of three parts with schemas of their own: columns in another order or case, and
    one too many. Second passes, with other money, are in the third part, which is written
    first."""
    lake = Lake(lake.root, f"{lake.root}/source", raw_lake(spark, sf_dir).zone_csv)
    more = F.lit("more").alias("one_more")
    for taxi_type, rows in (
        ("yellow", derive.raw_yellow(spark, sf_dir, passes=True)),
        ("green", derive.raw_green(spark, sf_dir, passes=True)),
    ):
        names = [c for c in rows.columns if c not in ("file_month", "file_part")]
        for part, columns in (
            (2, [more, *names]),
            (1, [more, *(F.col(c).alias(c.lower()) for c in reversed(names))]),
            (0, [*names, more]),
        ):
            written = f"{lake.root}/raw_{taxi_type}_{part}"
            some = rows.where(F.col("file_part") == part).select(*columns, "file_month")
            some.repartition("file_month").write.partitionBy("file_month").parquet(written)
            for folder in files.folders(spark, written, "file_month=*"):
                url = source_url(lake.source_base, taxi_type, folder.split("=", 1)[1])
                for k, name in enumerate(files.folders(spark, f"{written}/{folder}", "*.parquet")):
                    files.move(spark, f"{written}/{folder}/{name}", f"{url}/part-{part}-{k}.parquet")
    return lake


def parts_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Raw files of all types and months in parts; nothing loaded yet."""
    return _memo(spark, sf_dir, "parts", _parts)


def _landed_parts(spark: SparkSession, sf_dir: str, lake: Lake) -> Lake:
    raw = parts_lake(spark, sf_dir)
    return _load_all(spark, Lake(lake.root, raw.source_base, raw.zone_csv))


def landed_parts_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Bronze, silver, zones and ledger from the raw files in parts."""
    return _memo(spark, sf_dir, "landed_parts", _landed_parts)


def _streamed_parts(spark: SparkSession, sf_dir: str, lake: Lake) -> Lake:
    """The raw files in parts through the stream, in two micro-batches of each type, so months
    are split over both."""
    raw = parts_lake(spark, sf_dir)
    lake = Lake(lake.root, raw.source_base, raw.zone_csv)
    for taxi_type in TAXI_TYPES:
        listed = list_sources(spark, lake.source_base, taxi_type).agg(F.sum("source_parts").alias("n"))
        url = source_url(lake.source_base, taxi_type, "*")
        schema = spark.read.option("mergeSchema", True).parquet(url).schema
        checkpoint = lake.path(f"stream_checkpoint_{taxi_type}")
        half = -(-listed.first()["n"] // 2)
        land_stream(spark, lake, taxi_type, schema, checkpoint, half).awaitTermination()
    return lake


def streamed_parts_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Silver and ledger from the stream over the raw files in parts."""
    return _memo(spark, sf_dir, "streamed_parts", _streamed_parts)


def _landed(spark: SparkSession, sf_dir: str, lake: Lake) -> Lake:
    """Every raw file through the range load."""
    raw = raw_lake(spark, sf_dir)
    return _load_all(spark, Lake(lake.root, raw.source_base, raw.zone_csv))


def _load_all(spark: SparkSession, lake: Lake) -> Lake:
    jobs.bootstrap(spark, lake)
    for taxi_type in TAXI_TYPES:
        months = months_listed(spark, lake, taxi_type)
        jobs.run_range(spark, lake, taxi_type, months[0], months[-1], continue_on_error=True)
    return lake


def landed_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Bronze, silver, zones and ledger from the raw files."""
    return _memo(spark, sf_dir, "landed", _landed)


def build_fresh(spark: SparkSession, sf_dir: str, stage: str) -> Lake:
    """Build without the memo, for timing."""
    lake = Lake(new_root(spark))
    if stage == "silver":
        return _silver(spark, sf_dir, lake)
    return _corrected(spark, sf_dir, lake)

