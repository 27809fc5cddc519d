"""Trips, zones and ledger derived from the test tables with Spark.

The SQL in ``oracle.py`` states the same expressions for DuckDB. See FIXTURES.md.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators.prepare import batch_metrics, prepare_batch, to_silver
from meterlake.schema import LEDGER
from meterlake.sources.tables import working_dir

AS_OF = datetime(2001, 11, 3, tzinfo=timezone.utc)
FIRST_LOAD = datetime(2002, 1, 1, tzinfo=timezone.utc)
CORRECTION = datetime(2002, 2, 1, tzinfo=timezone.utc)

# Stands in for the row number in the file, which SQL over the same table cannot see.
FILE_ORDER = (
    "copy_no",
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_extendedprice",
)
BATCH = ("taxi_type", "source_year_month")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lineitem_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items, and those of every twentieth order once more as a second pass."""
    copies = F.when(F.col("l_orderkey") % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return table(spark, sf_dir, "lineitem").select("*", F.explode(copies).alias("copy_no"))


def trips_from(lines: DataFrame) -> DataFrame:
    """Trip columns from line items; ``copy_no`` adds to the money columns."""
    values = {
        "vendor_id": "case when l_suppkey % 40 = 0 then null else cast(l_suppkey % 5 as bigint) end",
        "pickup_datetime": """case when l_partkey % 97 = 0 then null else l_shipdate
            + make_interval(0, 0, 0, 0, cast(l_orderkey % 24 as int), l_linenumber * 7, 0) end""",
        "dropoff_datetime": """l_shipdate + make_interval(0, 0, 0, 0,
            cast(l_orderkey % 24 as int), cast(l_linenumber * 7 + l_quantity - 2 as int), 0)""",
        "passenger_count": "cast(l_linenumber as double)",
        "trip_distance": """case when l_partkey % 50 = 3 then null
            else (l_quantity * (l_suppkey % 13) - 4) / 2D end""",
        "rate_code_id": "cast(l_linenumber % 6 + 1 as bigint)",
        "store_and_fwd_flag": "case when l_orderkey % 10 = 0 then 'Y' else 'N' end",
        "pickup_location_id": """case when l_partkey % 89 = 0 then null
            else cast(l_partkey % 268 as bigint) end""",
        "dropoff_location_id": "cast((l_suppkey * 7 + l_linenumber) % 267 as bigint)",
        "payment_type": "cast(l_orderkey % 6 as bigint)",
        "fare_amount": """case when l_returnflag = 'R' and l_linenumber = 7
            then -l_extendedprice else l_extendedprice end + copy_no""",
        "extra": "l_discount",
        "mta_tax": "l_tax",
        "tip_amount": "l_quantity / 4D",
        "tolls_amount": "cast(null as double)",
        "improvement_surcharge": "l_tax",
        "total_amount": """case when l_returnflag = 'R' and l_linenumber = 7
            then -l_extendedprice else l_extendedprice + l_quantity end + copy_no""",
        "congestion_surcharge": "l_discount",
        "airport_fee": "cast(null as double)",
        "trip_type": "case when taxi_type = 'green' then cast(l_linenumber % 2 + 1 as bigint) end",
        "ehail_fee": "cast(null as double)",
    }
    keyed = lines.selectExpr(
        "*",
        "case when l_linestatus = 'F' then 'yellow' else 'green' end as taxi_type",
        "date_format(l_shipdate, 'yyyy-MM') as source_year_month",
    )
    return keyed.selectExpr(
        *FILE_ORDER, *BATCH, *[f"{sql} as {name}" for name, sql in values.items()]
    )


def with_batch(trips: DataFrame) -> DataFrame:
    """Batch and file name, which follow from type and month and need not be shuffled."""
    return trips.withColumns(
        {
            "batch_id": F.expr("md5(concat(taxi_type, '|', source_year_month, '|1'))"),
            "source_file_name": F.expr(
                "concat(taxi_type, '_tripdata_', source_year_month, '.parquet')"
            ),
        }
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from(lineitem_passes(spark, sf_dir))


def dedupe_folder(spark: SparkSession) -> str:
    """Where intermediate tables of deduplications and checks go."""
    shared = working_dir(spark, "") or f"{spark.conf.get('spark.sql.warehouse.dir')}/lakes"
    return f"{shared.rstrip('/')}/dedupe"


def prepared_trips(
    spark: SparkSession, sf_dir: str, cluster_by: tuple[str, ...] = ()
) -> DataFrame:
    prepared = prepare_batch(
        trips(spark, sf_dir),
        schema_drift=False,
        order_by=FILE_ORDER,
        folder=dedupe_folder(spark),
        cluster_by=cluster_by,
    )
    return with_batch(prepared)


def silver_trips(
    spark: SparkSession, sf_dir: str, cluster_by: tuple[str, ...] = ()
) -> DataFrame:
    return to_silver(prepared_trips(spark, sf_dir, cluster_by), FIRST_LOAD)


def correction_batches(
    spark: SparkSession, sf_dir: str, cluster_by: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """A first load and a later one that corrects some of its trips and adds others. With
    ``cluster_by`` their rows come by partition, for a table."""
    lines = table(spark, sf_dir, "lineitem").withColumn("copy_no", F.lit(0))
    first = lines.where("l_orderkey % 50 <> 1")
    second = lines.where("l_orderkey % 15 = 0 or l_orderkey % 50 = 1")

    def silver(part: DataFrame, add: int, at: datetime) -> DataFrame:
        moved = trips_from(part).withColumns(
            {c: F.col(c) + add for c in ("fare_amount", "total_amount")}
        )
        folder = dedupe_folder(spark)
        prepared = prepare_batch(moved, False, FILE_ORDER, folder=folder, cluster_by=cluster_by)
        return to_silver(with_batch(prepared), at)

    return silver(first, 0, FIRST_LOAD), silver(second, 2, CORRECTION)


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones from all parts: 265 locations at most, those divisible by 17 left out."""
    part, nation, region = (table(spark, sf_dir, n) for n in ("part", "nation", "region"))
    location = "cast(p_partkey % 265 + 1 as int)"
    named = part.join(nation, F.expr(f"{location} % 25 = n_nationkey")).join(
        region, F.expr("n_regionkey = r_regionkey")
    )
    return (
        named.groupBy(F.expr(location).alias("location_id"))
        .agg(
            F.min("r_name").alias("borough"),
            F.min(F.expr(f"concat(n_name, '-', {location})")).alias("zone"),
            F.min("p_type").alias("service_zone"),
        )
        .where("location_id % 17 <> 0")
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_lookup(spark, sf_dir).withColumn("updated_at", F.lit(FIRST_LOAD))


def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per type and month: rows, kept rows, flagged rows and kept rows with a null key."""
    return batch_metrics(trips(spark, sf_dir), prepared_trips(spark, sf_dir), BATCH)


def ledger_from(counts: DataFrame) -> DataFrame:
    """Current, superseded, failed and running batches of each type and month."""
    minutes = "t0 {sign} make_interval(0, 0, 0, 0, 0, {n}, 0)"
    kinds = [
        # tag, condition, source, loaded, duplicate, status, start and end in minutes from t0
        (
            "1",
            "true",
            "src",
            "ld + case when taxi_type = 'green' and mi % 13 = 0 then 1 else 0 end",
            "src - ld",
            "success",
            "0",
            "src % 50 + 1",
        ),
        ("0", "mi % 5 = 0", "src - 5", "ld - 5", "src - ld", "success", "-600", "-590"),
        ("f", "mi % 7 = 0", "src", "0", "0", "failed", "-60", "-55"),
        ("r", "mi % 11 = 0", "src", "0", "0", "running", "90", None),
    ]

    def at(n: str | None) -> str:
        return "cast(null as timestamp)" if n is None else minutes.format(sign="+", n=n)

    rows = ", ".join(
        f"""if({condition}, named_struct('tag', '{tag}', 'source_rows', cast({source} as bigint),
        'loaded_rows', cast({loaded} as bigint), 'duplicate_rows', cast({duplicate} as bigint),
        'status', '{status}', 'started_at', {at(start)}, 'finished_at', {at(end)}), null)"""
        for tag, condition, source, loaded, duplicate, status, start, end in kinds
    )
    base = counts.selectExpr(
        "taxi_type",
        "source_year_month as year_month",
        "source_rows as src",
        "loaded_rows as ld",
        "invalid_rows as inv",
        "null_key_rows as nk",
        "cast(substr(source_year_month, 1, 4) as int) * 12"
        " + cast(substr(source_year_month, 6, 2) as int) as mi",
        "to_timestamp(concat(source_year_month, '-02 06:00:00')) as t0",
    )
    batches = base.selectExpr("*", f"explode(filter(array({rows}), x -> x is not null)) as b")
    loaded = "b.status = 'success'"
    ledger = batches.selectExpr(
        "md5(concat(taxi_type, '|', year_month, '|', b.tag)) as batch_id",
        "taxi_type",
        "year_month",
        "concat('/source/', taxi_type, '_tripdata_', year_month, '.parquet') as source_url",
        "concat(taxi_type, '_tripdata_', year_month, '.parquet') as source_file_name",
        "concat('bronze/', taxi_type, '/year_month=', year_month, '/',"
        " taxi_type, '_tripdata_', year_month, '.parquet') as bronze_object_key",
        "if(mi % 9 = 0, null, concat('etag-', year_month, '-', b.tag)) as source_etag",
        "b.started_at as source_last_modified",
        "b.source_rows",
        "b.loaded_rows",
        "b.duplicate_rows",
        f"if({loaded}, inv, 0) as invalid_rows",
        f"if({loaded}, nk, 0) as null_key_rows",
        "b.status",
        "if(b.tag = '0', array('bonus_field', 'other_field'), cast(array() as array<string>))"
        " as schema_drift_columns",
        "if(b.status = 'failed', 'source file could not be read', null) as error_message",
        "b.started_at",
        "b.finished_at",
        "(unix_micros(b.finished_at) - unix_micros(b.started_at)) / 1e6D as runtime_seconds",
    )
    return ledger.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER.fields])


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_from(source_counts(spark, sf_dir))


# In which of a month's three parts a line item goes: second passes in the last.
_PART = "case when copy_no = 1 then 2 else cast(l_orderkey % 2 as int) end as file_part"


def _lines(spark: SparkSession, sf_dir: str, passes: bool) -> DataFrame:
    if passes:
        return lineitem_passes(spark, sf_dir)
    return table(spark, sf_dir, "lineitem").withColumn("copy_no", F.lit(0))


def _by_month(lines: DataFrame) -> DataFrame:
    """Line items of a month together, before they get the wider columns of trips."""
    return lines.repartition(F.date_format("l_shipdate", "yyyy-MM"))


def raw_yellow(
    spark: SparkSession, sf_dir: str, passes: bool = False, by_month: bool = False
) -> DataFrame:
    """Yellow trips as their files have them: other names, text datetimes, an extra column.
    With ``passes`` second passes are among them, in a part of their own; with ``by_month``
    those of a month come together."""
    lines = _lines(spark, sf_dir, passes).where("l_linestatus = 'F'")
    source = trips_from(_by_month(lines) if by_month else lines)
    return source.selectExpr(
        "vendor_id as VendorID",
        "cast(pickup_datetime as string) as tpep_pickup_datetime",
        "cast(dropoff_datetime as string) as tpep_dropoff_datetime",
        "cast(passenger_count as bigint) as passenger_count",
        "trip_distance",
        "rate_code_id as RatecodeID",
        "store_and_fwd_flag",
        "pickup_location_id as PULocationID",
        "dropoff_location_id as DOLocationID",
        "payment_type",
        "fare_amount",
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "improvement_surcharge",
        "total_amount",
        "congestion_surcharge",
        "airport_fee as Airport_fee",
        "'drift' as bonus_field",
        "source_year_month as file_month",
        *([_PART] if passes else []),
    )


def raw_green(
    spark: SparkSession, sf_dir: str, passes: bool = False, by_month: bool = False
) -> DataFrame:
    """Green trips: other names again, narrower and wider types, no airport fee."""
    lines = _lines(spark, sf_dir, passes).where("l_linestatus <> 'F'")
    source = trips_from(_by_month(lines) if by_month else lines)
    return source.selectExpr(
        "cast(vendor_id as int) as VendorID",
        "pickup_datetime as lpep_pickup_datetime",
        "dropoff_datetime as lpep_dropoff_datetime",
        "passenger_count",
        "trip_distance",
        "cast(rate_code_id as double) as RatecodeID",
        "store_and_fwd_flag",
        "cast(pickup_location_id as int) as PULocationID",
        "cast(dropoff_location_id as string) as DOLocationID",
        "cast(payment_type as double) as payment_type",
        "fare_amount",
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "improvement_surcharge",
        "total_amount",
        "congestion_surcharge",
        "cast(trip_type as double) as trip_type",
        "ehail_fee",
        "source_year_month as file_month",
        *([_PART] if passes else []),
    )
