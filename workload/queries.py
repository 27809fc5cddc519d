"""The registered queries, each with equivalent SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions import keys
from meterlake.functions.calendar import months_between
from meterlake.functions.casts import clean_scalars, lenient_cast
from meterlake.functions.flags import quality_status, row_flags
from meterlake.operators import checks, ledger, prepare, upsert
from meterlake.operators.dedupe import keep_first
from meterlake.plans import dashboards, dimensions, fact, jobs, marts, monitoring, staging
from meterlake.schema import FLAGS, LEDGER, TAXI_TYPES, TRIP_NAMES
from meterlake.sources import trips as raw_trips
from meterlake.sources.tables import cut
from meterlake.streaming.landing import land_stream
from workload import derive, oracle
from workload.lakes import (
    beside,
    corrected_lake,
    gold_lake,
    interrupted_lake,
    landed_lake,
    landed_parts_lake,
    raw_lake,
    silver_lake,
    streamed_parts_lake,
)
from workload.oracle import statement

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """A query; ``rounded`` columns hold floating results that depend on summation order."""

    build: Build
    sql: str | None = None
    rounded: tuple[str, ...] = ()
    digits: int = 6

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            # The lake's times are UTC.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _comparable(self.build(spark, sf_dir), self.rounded, self.digits)

    def oracle(self) -> str | None:
        return self.sql and oracle.rounded(self.sql, self.rounded, self.digits)


def _comparable(df: DataFrame, rounded: tuple[str, ...], digits: int) -> DataFrame:
    """Types both engines share: timestamps without zone, arrays as text, rounded doubles."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast(T.TimestampNTZType())
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        elif field.name in rounded:
            column = F.round(column, digits)
        columns.append(column.alias(field.name))
    return df.select(*columns)


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, rounded: tuple[str, ...] = (), digits: int = 6):
    def register(build: Build) -> Build:
        QUERIES[build.__name__] = Query(build, sql, rounded, digits)
        return build

    return register


def _select(columns: str, name: str) -> str:
    return statement(f"select {columns} from {name}", name)


# Scan and normalization --------------------------------------------------------------

_NAMES = ", ".join(TRIP_NAMES)


def _normalized(raw: DataFrame, taxi_type: str) -> DataFrame:
    month = F.col("file_month")
    return raw_trips.normalize_frame(
        raw,
        batch_id=F.md5(F.concat_ws("|", F.lit(taxi_type), month, F.lit("1"))),
        taxi_type=taxi_type,
        year_month=month,
        file_name=F.concat(F.lit(f"{taxi_type}_tripdata_"), month, F.lit(".parquet")),
        row_number=F.lit(None).cast("long"),
    ).drop("row_number_in_file")


_ALL_TRIPS_ONCE = f"""
select batch_id, taxi_type, source_year_month, source_file_name, {_NAMES}
from ({oracle.trips_of('select *, 0 as copy_no from lineitem')}) as t"""


@query(_ALL_TRIPS_ONCE)
def normalize_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw yellow and green frames in canonical form."""
    yellow = _normalized(derive.raw_yellow(spark, sf_dir), "yellow")
    green = _normalized(derive.raw_green(spark, sf_dir), "green")
    return yellow.unionByName(green)


@query(
    """select row_number() over () as row_number_in_file, l_orderkey, l_linenumber
       from lineitem"""
)
def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Physical row number in the file."""
    raw = raw_trips.read_raw(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return raw.select(raw_trips.file_row_number().alias("row_number_in_file"), "l_orderkey", "l_linenumber")


@query(
    """select case when l_linestatus = 'F' then 'yellow' else 'green' end as taxi_type,
         case when l_linestatus = 'F' then 'bonus_field,file_month' else 'file_month' end
           as schema_drift_columns,
         count(*) as source_rows
       from lineitem group by 1, 2"""
)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: columns of the raw frames outside the alias table."""

    def drift(raw: DataFrame, taxi_type: str) -> DataFrame:
        return raw.agg(
            F.lit(taxi_type).alias("taxi_type"),
            F.lit(raw_trips.schema_drift(raw.columns)).alias("schema_drift_columns"),
            F.count("*").alias("source_rows"),
        )

    yellow, green = derive.raw_yellow(spark, sf_dir), derive.raw_green(spark, sf_dir)
    return drift(yellow, "yellow").unionByName(drift(green, "green"))


_JUNK = {
    "number_text": (
        "case l_linenumber when 1 then 'x' when 2 then '2.7' when 3 then '' "
        "else cast(l_suppkey as {text}) end"
    ),
    "amount_text": (
        "case l_linenumber when 1 then 'x' when 2 then 'NaN' else cast(l_quantity as {text}) end"
    ),
    "when_text": (
        "case l_linenumber when 1 then 'junk' when 2 then '1998-02-31 10:00:00' "
        "when 3 then '1998-03-05 10:00:00 trailing' when 4 then '1998/03/05 10:00:00' "
        "when 5 then '1998-03-05' else '1998-03-05T10:30:00' end"
    ),
}


@query(
    f"""select l_orderkey, l_linenumber,
         try_cast(case when number_text like '%.%' then null else number_text end as bigint)
           as from_text,
         case when l_linenumber = 2 then null else cast(trunc(l_quantity / 4) as bigint) end
           as from_double,
         case when amount_text = 'NaN' then 'NaN' else
           cast(try_cast(amount_text as double) as varchar) end as amount,
         case l_linenumber when 1 then null when 2 then null
           when 3 then timestamp '1998-03-05 10:00:00' when 4 then timestamp '1998-03-05 10:00:00'
           when 5 then timestamp '1998-03-05 00:00:00'
           else timestamp '1998-03-05 10:30:00' end as from_when
       from (select l_orderkey, l_linenumber, l_quantity,
           {_JUNK['number_text'].format(text='varchar')} as number_text,
           {_JUNK['amount_text'].format(text='varchar')} as amount_text
         from lineitem) as junk"""
)
def lenient_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text and numbers that do not fit become null, the rest is kept."""
    lines = derive.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "if(l_linenumber = 2, double('NaN'), l_quantity / 4D) as share",
        *[f"{sql.format(text='string')} as {name}" for name, sql in _JUNK.items()],
    )
    text, double = T.StringType(), T.DoubleType()
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        lenient_cast(F.col("number_text"), text, T.LongType()).alias("from_text"),
        lenient_cast(F.col("share"), double, T.LongType()).alias("from_double"),
        lenient_cast(F.col("amount_text"), text, double).cast("string").alias("amount"),
        lenient_cast(F.col("when_text"), text, T.TimestampNTZType()).alias("from_when"),
    )


@query(
    """select l_orderkey, l_linenumber,
         case when l_linenumber = 1 then null else l_quantity end as distance,
         l_shipdate as shipped
       from lineitem"""
)
def normalize_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN to null, zoned timestamps to UTC without zone."""
    lines = derive.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "if(l_linenumber = 1, double('NaN'), l_quantity) as distance",
        "cast(l_shipdate as timestamp) as shipped",
    )
    return clean_scalars(lines)


# Preparation -------------------------------------------------------------------------


@query(
    statement(
        f"select {oracle.FILE_ORDER}, {oracle.KEY_TEXT} as business_trip_key from trips", "trips"
    )
)
def business_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8."""
    return derive.trips(spark, sf_dir).select(
        *derive.FILE_ORDER, keys.business_trip_key().alias("business_trip_key")
    )


@query(
    statement(
        f"select {oracle.FILE_ORDER}, {oracle.FINGERPRINT_TEXT} as row_fingerprint from trips",
        "trips",
    )
)
def row_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B9."""
    return derive.trips(spark, sf_dir).select(
        *derive.FILE_ORDER, keys.row_fingerprint().alias("row_fingerprint")
    )


@query(
    statement(
        f"select {oracle.FILE_ORDER}, {', '.join(FLAGS)}, quality_status from flagged_trips",
        "flagged_trips",
    )
)
def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B10-B16 on all trips, duplicates included."""
    flagged = derive.trips(spark, sf_dir).withColumns(row_flags(False))
    return flagged.select(*derive.FILE_ORDER, *FLAGS, quality_status().alias("quality_status"))


@query(_select(f"batch_id, taxi_type, source_year_month, source_file_name, {_NAMES}", "kept"))
def dedupe_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2."""
    kept = keep_first(derive.trips(spark, sf_dir), derive.FILE_ORDER)
    return derive.with_batch(kept).select(
        "batch_id", "taxi_type", "source_year_month", "source_file_name", *TRIP_NAMES
    )


@query(_select("*", "prepared"))
def prepared_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I2."""
    return derive.prepared_trips(spark, sf_dir)


@query(
    statement(
        """select batch_id, source_rows, loaded_rows, duplicate_rows, invalid_rows,
             null_key_rows
           from (select *, md5(taxi_type || '|' || source_year_month || '|1') as batch_id
                 from counts) as c""",
        "counts",
    )
)
def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6."""
    source = derive.with_batch(derive.trips(spark, sf_dir))
    return prepare.batch_metrics(source, derive.prepared_trips(spark, sf_dir))


# Loads of raw files ------------------------------------------------------------------

# Columns of a raw file whose names or types differ from the canonical ones.
_RAW_YELLOW = """
  vendor_id as "VendorID", cast(pickup_datetime as varchar) as tpep_pickup_datetime,
  cast(dropoff_datetime as varchar) as tpep_dropoff_datetime,
  cast(passenger_count as bigint) as passenger_count, trip_distance, rate_code_id as "RatecodeID",
  store_and_fwd_flag, pickup_location_id as "PULocationID", dropoff_location_id as "DOLocationID",
  payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
  total_amount, congestion_surcharge, airport_fee as "Airport_fee", 'drift' as bonus_field"""
_RAW_GREEN = """
  cast(vendor_id as int) as "VendorID", pickup_datetime as lpep_pickup_datetime,
  dropoff_datetime as lpep_dropoff_datetime, passenger_count, trip_distance,
  cast(rate_code_id as double) as "RatecodeID", store_and_fwd_flag,
  cast(pickup_location_id as int) as "PULocationID",
  cast(dropoff_location_id as varchar) as "DOLocationID",
  cast(payment_type as double) as payment_type, fare_amount, extra, mta_tax, tip_amount,
  tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
  cast(trip_type as double) as trip_type, ehail_fee"""


def _landed_files(spark: SparkSession, sf_dir: str, taxi_type: str) -> DataFrame:
    lake = landed_lake(spark, sf_dir)
    return spark.read.parquet(f"{lake.root}/bronze/{taxi_type}/*/*.parquet")


@query(statement(f"select {_RAW_YELLOW} from raw_trips where taxi_type = 'yellow'", "raw_trips"))
def bronze_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: all yellow files under their bronze keys, with their own columns."""
    return _landed_files(spark, sf_dir, "yellow")


@query(statement(f"select {_RAW_GREEN} from raw_trips where taxi_type = 'green'", "raw_trips"))
def bronze_landing_green(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: all green files under their bronze keys."""
    return _landed_files(spark, sf_dir, "green")


_BATCH_COUNTS = """
    select taxi_type, source_year_month as year_month, 'success' as status,
      count(*) as source_rows, count(*) as loaded_rows, cast(0 as bigint) as duplicate_rows,
      cast(sum(case when quality_status = 'flagged' then 1 else 0 end) as bigint)
        as invalid_rows,
      cast(sum(case when has_null_key then 1 else 0 end) as bigint) as null_key_rows,
      case when taxi_type = 'yellow' then 'bonus_field' else '' end as schema_drift_columns
    from raw_prepared group by 1, 2"""


def _batch_counts(batches: DataFrame) -> DataFrame:
    return batches.select(
        "taxi_type",
        "year_month",
        "status",
        "source_rows",
        "loaded_rows",
        "duplicate_rows",
        "invalid_rows",
        "null_key_rows",
        "schema_drift_columns",
    )


@query(statement(_BATCH_COUNTS, "raw_prepared"))
def run_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger rows after every raw file went through the whole load."""
    lake = landed_lake(spark, sf_dir)
    return _batch_counts(ledger.current_batches(lake.ledger.read(spark)))


# Load details that differ from run to run.
_RUN_COLUMNS = ("batch_id", "loaded_at", "updated_at")
_LOADED_TRIPS = statement(
    f"select * exclude ({', '.join(_RUN_COLUMNS)}) from raw_silver",
    "raw_silver",
    raw_silver=(("raw_prepared",), oracle.silver_of("raw_prepared", oracle.FIRST_LOAD)),
)


@query(_LOADED_TRIPS)
def run_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after a range load of all months of both types, in their own schemas."""
    return landed_lake(spark, sf_dir).silver.read(spark).drop(*_RUN_COLUMNS)


@query(_LOADED_TRIPS)
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after the stream has taken up all raw files: what the range load gives."""
    lake = beside(spark, raw_lake(spark, sf_dir))
    for taxi_type in TAXI_TYPES:
        source = raw_trips.source_url(lake.source_base, taxi_type, "*")
        schema = spark.read.parquet(source).schema
        checkpoint = lake.path(f"stream_checkpoint_{taxi_type}")
        land_stream(spark, lake, taxi_type, schema, checkpoint).awaitTermination()
    return lake.silver.read(spark).drop(*_RUN_COLUMNS)


# The files in parts hold the second passes too; the first pass comes first and stays. They
# have a column too many.
_DRIFT_IN_PARTS = "true as has_schema_drift"
_PARTS = {
    "parts_prepared": (
        ("raw_trips",),
        oracle._prepared_of("raw_trips").replace("false as has_schema_drift", _DRIFT_IN_PARTS),
    )
}
_PARTS_SILVER = statement(
    f"select * exclude ({', '.join(_RUN_COLUMNS)}) from parts_silver",
    "parts_silver",
    parts_silver=(("parts_prepared",), oracle.silver_of("parts_prepared", oracle.FIRST_LOAD)),
    **_PARTS,
)
_PARTS_COUNTS = statement(
    """
    select taxi_type, source_year_month as year_month, 'success' as status,
      count(*) + count(*) filter (where l_orderkey % 20 = 0) as source_rows,
      count(*) as loaded_rows, count(*) filter (where l_orderkey % 20 = 0) as duplicate_rows,
      cast(sum(case when quality_status = 'flagged' then 1 else 0 end) as bigint)
        as invalid_rows,
      cast(sum(case when has_null_key then 1 else 0 end) as bigint) as null_key_rows
    from parts_keyed group by 1, 2""",
    "parts_keyed",
    parts_keyed=(
        ("raw_trips",),
        oracle._prepared_of("raw_trips")
        .replace("false as has_schema_drift", _DRIFT_IN_PARTS)
        .replace("row_fingerprint, batch_id,", f"row_fingerprint, {oracle.FILE_ORDER}, batch_id,"),
    ),
)


@query(_PARTS_SILVER)
def run_range_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver from months in three parts of different schemas with duplicates."""
    return landed_parts_lake(spark, sf_dir).silver.read(spark).drop(*_RUN_COLUMNS)


@query(_PARTS_COUNTS)
def run_range_parts_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger rows of that load."""
    lake = landed_parts_lake(spark, sf_dir)
    return _batch_counts(ledger.current_batches(lake.ledger.read(spark))).drop("schema_drift_columns")


@query(_PARTS_SILVER)
def stream_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the stream, the last parts first and months split over micro-batches."""
    return streamed_parts_lake(spark, sf_dir).silver.read(spark).drop(*_RUN_COLUMNS)


@query(_PARTS_COUNTS)
def stream_parts_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ledger batch of the stream for each month, with the counts of all its parts."""
    lake = streamed_parts_lake(spark, sf_dir)
    return _batch_counts(ledger.current_batches(lake.ledger.read(spark))).drop("schema_drift_columns")


@query(_select("location_id, borough, zone, service_zone", "zone_list"))
def bootstrap_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone list written as CSV and loaded by the bootstrap."""
    lake = beside(spark, raw_lake(spark, sf_dir))
    jobs.bootstrap(spark, lake)
    return lake.zones.read(spark).drop("updated_at")


# Tables and staging ------------------------------------------------------------------


@query(_select("*", "silver"))
def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitioned table as written by the upsert."""
    return silver_lake(spark, sf_dir).silver.read(spark)


@query(_select("location_id, borough, zone, service_zone", "zone_list"))
def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, A7."""
    return derive.zone_lookup(spark, sf_dir)


@query(_select("*", "ledger"))
def batch_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows of the ledger table."""
    lake = gold_lake(spark, sf_dir)
    return ledger.current_batches(lake.ledger.read(spark))


@query(_select("*", "stg_trips"))
def stg_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8, B17, B18."""
    return staging.stage_trips(silver_lake(spark, sf_dir).silver.read(spark))


@query(_select("*", "zones"))
def stg_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9."""
    return staging.stage_zones(derive.zones(spark, sf_dir))


@query(_select("*", "ledger"))
def stg_batch_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10."""
    return staging.stage_batches(derive.ledger(spark, sf_dir))


@query(
    statement(
        f"""select {oracle.FILE_ORDER},
             {oracle.surrogate('taxi_type, vendor_id')} as vendor_sk,
             {oracle.surrogate('pickup_location_id')} as zone_sk
           from trips""",
        "trips",
    )
)
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B19."""
    return derive.trips(spark, sf_dir).select(
        *derive.FILE_ORDER,
        keys.surrogate_key("taxi_type", "vendor_id").alias("vendor_sk"),
        keys.surrogate_key("pickup_location_id").alias("zone_sk"),
    )


# Dimensions and fact -----------------------------------------------------------------


@query(_select("*", "observed"))
def observed_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1, D8."""
    return dimensions.observed_zones(silver_lake(spark, sf_dir).silver.read(spark))


@query(_select("*", "unknown"))
def unknown_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1."""
    lake = silver_lake(spark, sf_dir)
    seen = dimensions.observed_zones(lake.silver.read(spark))
    return dimensions.unknown_zones(seen, lake.zones.read(spark))


@query(_select("vendor_sk, taxi_type, cast(vendor_id as int) as vendor_id, vendor_name", "dim_vendor"))
def dim_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, D7, B20."""
    return dimensions.vendor_dimension(silver_lake(spark, sf_dir).silver.read(spark))


@query(_select("*", "dim_zone"))
def dim_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2, G2."""
    lake = silver_lake(spark, sf_dir)
    return dimensions.zone_dimension(lake.silver.read(spark), lake.zones.read(spark))


@query(_select("*", "fact"))
def fct_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3, B21, C2-C4."""
    lake = gold_lake(spark, sf_dir)
    return fact.trip_fact(
        staging.stage_trips(lake.silver.read(spark)),
        lake.gold("dim_vendor").read(spark),
        lake.gold("dim_zone").read(spark),
    )


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_lake(spark, sf_dir).fact.read(spark)


def _mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return gold_lake(spark, sf_dir).gold(name).read(spark)


# Marts -------------------------------------------------------------------------------

_RATES = ("avg_fare_per_mile", "stddev_fare_per_mile")
_MONTHLY = ("avg_fare_per_mile",)
_SCORES = ("fare_per_mile_zscore",)


@query(_select("*", "baseline"), rounded=_RATES)
def fare_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1."""
    return marts.fare_baseline(_fact(spark, sf_dir))


@query(_select("*", "anomalies"), rounded=_SCORES)
def fare_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4, C5, E3."""
    lake = gold_lake(spark, sf_dir)
    trips = lake.fact.read(spark)
    baseline = cut(marts.fare_baseline(trips), jobs.staging_path(spark, lake, "marts"), "baseline")
    return marts.fare_anomalies(trips, baseline)


@query(_select("*", "monthly"), rounded=_MONTHLY)
def monthly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Straight from the source rows, through deduplication and flags."""
    return marts.monthly_metrics(staging.stage_trips(derive.silver_trips(spark, sf_dir)))


@query(_select("*", "hourly"))
def zone_hourly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6, D3, C6."""
    zones = _mart(spark, sf_dir, "dim_zone")
    return marts.zone_hourly_metrics(_fact(spark, sf_dir), zones)


# Monitoring --------------------------------------------------------------------------

_HEALTH = (
    "ingest_success_rate",
    "avg_rows_ingested_per_file",
    "duplicate_rate",
    "null_rate_key_columns",
    "average_pipeline_runtime_seconds",
    "freshness_lag_hours",
)


@query(_select("*", "monitoring"), rounded=_HEALTH)
def pipeline_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7, D5."""
    return monitoring.pipeline_monitoring(derive.ledger(spark, sf_dir), derive.AS_OF)


@query(_select("*", "latest_batch"))
def latest_successful_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1."""
    return monitoring.latest_successful_batches(derive.ledger(spark, sf_dir))


@query(_select("*", "reconciliation"))
def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8, C7, D4."""
    lake = gold_lake(spark, sf_dir)
    batches = ledger.current_batches(lake.ledger.read(spark))
    return monitoring.source_reconciliation(batches, _fact(spark, sf_dir))


@query(_select("*", "alerts"))
def ops_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9, G3."""
    lake = gold_lake(spark, sf_dir)
    batches = ledger.current_batches(lake.ledger.read(spark))
    return monitoring.operational_alerts(
        monitoring.pipeline_monitoring(batches, derive.AS_OF),
        monitoring.source_reconciliation(batches, _fact(spark, sf_dir)),
        derive.AS_OF,
    )


@query(
    statement(
        """select severity, taxi_type, coalesce(year_month, '') as year_month, alert_code,
             alert_context from alerts where severity = 'error'""",
        "alerts",
    )
)
def gate_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts that fail a run."""
    alerts = _mart(spark, sf_dir, "ops_alerts").where("severity = 'error'")
    year_month = F.coalesce("year_month", F.lit("")).alias("year_month")
    return alerts.select("severity", "taxi_type", year_month, "alert_code", "alert_context")


# Ledger and upserts ------------------------------------------------------------------


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source file per type and month: loaded before, changed since, or without etag."""
    months = derive.source_counts(spark, sf_dir)
    return months.selectExpr(
        "taxi_type",
        "source_year_month as year_month",
        """case when source_rows % 3 = 0 then concat('etag-', source_year_month, '-1')
             when source_rows % 3 = 1 then concat('etag-', source_year_month, '-2') end
             as source_etag""",
    )


@query(
    statement(
        """select c.* from (
             select taxi_type, source_year_month as year_month,
               case when source_rows % 3 = 0 then 'etag-' || source_year_month || '-1'
                 when source_rows % 3 = 1 then 'etag-' || source_year_month || '-2' end
                 as source_etag
             from counts) as c
           where not exists (select 1 from ledger as l where l.taxi_type = c.taxi_type
             and l.year_month = c.year_month and l.source_etag = c.source_etag
             and l.status = 'success')""",
        "counts",
        "ledger",
    )
)
def pending_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files still to load."""
    return ledger.pending_batches(_candidates(spark, sf_dir), derive.ledger(spark, sf_dir))


@query(
    statement(
        """select * replace (
             case when status = 'running' then 0 else loaded_rows end as loaded_rows)
           from ledger""",
        "ledger",
    )
)
def batch_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start all batches, then finish or fail those that ended; current rows."""
    batches = derive.ledger(spark, sf_dir)
    started = ledger.start_events(batches, F.col("started_at"))
    ended = batches.where("finished_at is not null").select(
        "batch_id", F.col("status").alias("outcome"), F.col("finished_at").alias("ended_at")
    )
    closing = started.join(ended, "batch_id")
    columns = [*LEDGER.names, "event_seq", "ended_at"]
    finished = ledger.finish_events(
        closing.where("outcome = 'success'").select(*columns), batches, F.col("ended_at")
    )
    failed = ledger.fail_events(
        closing.where("outcome = 'failed'").select(*columns),
        "source file could not be read",
        F.col("ended_at"),
    )
    events = started.unionByName(finished).unionByName(failed)
    return ledger.current_batches(events)


@query(_select("*", "upserted"))
def upsert_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after a first load and a correction."""
    return corrected_lake(spark, sf_dir).silver.read(spark)


@query(_select("*", "upserted"))
def upsert_after_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The correction died with part of its partitions published, and ran again."""
    return interrupted_lake(spark, sf_dir).silver.read(spark)


@query(_select("*", "upserted"))
def upsert_trips_in_one_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge as one lazy plan, with no table but those of key hashes."""
    first, second = derive.correction_batches(spark, sf_dir)
    return upsert.merge(first, second, folder=derive.dedupe_folder(spark))


@query(
    statement(
        f"""select location_id, borough, zone, service_zone, {oracle.FIRST_LOAD} as updated_at
            from zone_list where location_id % 10 <> 3
            union all
            select location_id, borough, upper(zone), service_zone, {oracle.CORRECTION}
            from zone_list where location_id % 10 = 3""",
        "zone_list",
    )
)
def upsert_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh renames some zones and adds some; the others stay."""
    zones = derive.zones(spark, sf_dir)
    current = zones.where("location_id % 20 <> 3")
    incoming = zones.where("location_id % 10 = 3").withColumn("zone", F.upper("zone"))
    return upsert.upsert_zones(current, incoming, F.lit(derive.CORRECTION))


def _after_correction(select: str, *needs: str) -> str:
    """The statement over silver as it is after the correction."""
    return statement(select, *needs, silver=(("upserted",), "select * from upserted"))


@query(_after_correction("select * from fact", "fact"))
def fct_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: the fact refreshed after a correction equals a full build."""
    return corrected_lake(spark, sf_dir).fact.read(spark)


@query(
    _after_correction(
        """select business_trip_key, source_year_month, updated_at from stg_trips
           where updated_at >= (
             select coalesce(max(updated_at), timestamp '1900-01-01') from stg_trips)""",
        "stg_trips",
    )
)
def incremental_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips at or after the fact's high-water mark."""
    lake = corrected_lake(spark, sf_dir)
    mark = fact.high_water_mark(lake.fact.read(spark))
    staged = staging.stage_trips(lake.silver.read(spark))
    return fact.changed_since(staged, mark).select(
        "business_trip_key", "source_year_month", "updated_at"
    )


@query(
    statement(
        """select business_trip_key, source_year_month, cast(null as varchar) as promo_code,
             total_amount from silver""",
        "silver",
    )
)
def sync_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older table in a schema with one column more and others gone."""
    target = T.StructType(
        [
            T.StructField("business_trip_key", T.StringType()),
            T.StructField("source_year_month", T.StringType()),
            T.StructField("promo_code", T.StringType()),
            T.StructField("total_amount", T.DoubleType()),
        ]
    )
    return upsert.sync_columns(silver_lake(spark, sf_dir).silver.read(spark), target)


@query(
    """with bounds as (
         select case when l_linestatus = 'F' then 'yellow' else 'green' end as taxi_type,
           min(l_shipdate) as a, max(l_shipdate) as b from lineitem group by 1),
       found as (
         select case when l_linestatus = 'F' then 'yellow' else 'green' end as taxi_type,
           strftime(l_shipdate, '%Y-%m') as year_month, count(*) as n from lineitem group by 1, 2)
       select m.taxi_type, m.year_month, coalesce(f.n, 0) as source_rows
       from (select taxi_type, strftime(unnest(generate_series(date_trunc('month', a),
               date_trunc('month', b), interval 1 month)), '%Y-%m') as year_month from bounds) as m
       left join found as f using (taxi_type, year_month)"""
)
def month_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month from the first to the last, with the rows available for it."""
    lines = derive.table(spark, sf_dir, "lineitem").selectExpr(
        "if(l_linestatus = 'F', 'yellow', 'green') as taxi_type", "l_shipdate"
    )
    months = lines.groupBy("taxi_type").agg(
        months_between(F.min("l_shipdate"), F.max("l_shipdate")).alias("months")
    )
    found = lines.groupBy(
        "taxi_type", F.date_format("l_shipdate", "yyyy-MM").alias("year_month")
    ).agg(F.count("*").alias("source_rows"))
    wanted = months.select("taxi_type", F.explode("months").alias("year_month"))
    return wanted.join(found, ["taxi_type", "year_month"], "left").fillna(0, ["source_rows"])


# Checks ------------------------------------------------------------------------------


def _checked(target: str, check: str, column: str, failures: str) -> str:
    """SQL of one summary row; ``failures`` is a scalar select."""
    return f"""select '{check}' as "check", '{target}' as target, '{column}' as "column",
      cast(({failures}) as bigint) as failures,
      case when ({failures}) = 0 then 'pass' else 'fail' end as status"""


_CHECK_SOURCES = {
    "silver.taxi_trips": "silver",
    "raw.taxi_zone_lookup": "zones",
    "ops.batch_runs": "ledger",
    "stg_taxi_trips": "stg_trips",
    "stg_taxi_zones": "zones",
    "stg_batch_runs": "ledger",
    "dim_vendor": "dim_vendor",
    "dim_zone": "dim_zone",
    "fct_taxi_trips": "fact",
    "fct_monthly_metrics": "monthly",
    "ops_monthly_source_reconciliation": "reconciliation",
    "ops_alerts": "alerts",
}


def _all_rows(parts: list[str]) -> str:
    return statement(" union all ".join(parts), *dict.fromkeys(_CHECK_SOURCES.values()))


_NOT_NULL_SQL = _all_rows(
    [
        _checked(
            t,
            "not_null",
            c,
            f"select count(*) from {_CHECK_SOURCES[t]} where {c} is null",
        )
        for t, columns in checks.NOT_NULL.items()
        for c in columns
    ]
)
_UNIQUE_SQL = _all_rows(
    [
        _checked(
            t,
            "unique",
            c,
            f"select count(*) from (select {c} from {_CHECK_SOURCES[t]} where {c} is not null"
            f" group by 1 having count(*) > 1) as d",
        )
        for t, c in checks.UNIQUE.items()
    ]
)
_ACCEPTED_SQL = _all_rows(
    [
        _checked(
            t,
            "accepted_values",
            c,
            f"select count(distinct {c}) from {_CHECK_SOURCES[t]} where {c} not in {values}",
        )
        for t, (c, values) in checks.ACCEPTED_VALUES.items()
    ]
)


def _work(spark: SparkSession, sf_dir: str) -> str:
    return jobs.staging_path(spark, silver_lake(spark, sf_dir), "checks")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return jobs.checked_tables(spark, gold_lake(spark, sf_dir))


@query(_NOT_NULL_SQL)
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1."""
    tables = _tables(spark, sf_dir)
    return _union([checks.not_null(tables[t], t, c) for t, c in checks.NOT_NULL.items()])


@query(_UNIQUE_SQL)
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2."""
    tables = _tables(spark, sf_dir)
    folder = _work(spark, sf_dir)
    return _union([checks.unique(tables[t], t, c, folder) for t, c in checks.UNIQUE.items()])


@query(_ACCEPTED_SQL)
def check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3."""
    tables = _tables(spark, sf_dir)
    return _union(
        [checks.accepted_values(tables[t], t, *r) for t, r in checks.ACCEPTED_VALUES.items()]
    )


@query(
    statement(
        """select batch_id, taxi_type, year_month, source_rows, loaded_rows, duplicate_rows
           from ledger where status = 'success' and source_rows <> loaded_rows + duplicate_rows""",
        "ledger",
    )
)
def check_batch_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4."""
    return checks.batch_accounting(derive.ledger(spark, sf_dir))


@query(
    statement(
        """select business_trip_key, source_year_month, count(*) as row_count
           from fact group by 1, 2 having count(*) > 1""",
        "fact",
    )
)
def check_unique_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5, D10."""
    return checks.unique_grain(_fact(spark, sf_dir))


@query(
    statement(
        f"""select {oracle.KEY_TEXT} as business_trip_key, source_year_month,
              count(*) as row_count
            from trips group by 1, 2 having count(*) > 1""",
        "trips",
    )
)
def repeated_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 where it fails: trips before deduplication."""
    trips = derive.trips(spark, sf_dir).withColumn("business_trip_key", keys.business_trip_key())
    return checks.unique_grain(trips, derive.dedupe_folder(spark))


@query(
    statement(
        """select taxi_type, year_month, expected_loaded_rows, warehouse_rows, loaded_variance
           from reconciliation where loaded_variance <> 0""",
        "reconciliation",
    )
)
def check_loaded_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6."""
    return checks.loaded_reconciliation(
        _mart(spark, sf_dir, "ops_monthly_source_reconciliation")
    )


@query(
    statement(
        """select 'silver.taxi_trips' as target, max(loaded_at) as max_loaded_at,
             (epoch_us(timestamp '2002-01-03 00:00:00') - epoch_us(max(loaded_at))) / 3.6e9
               as age_hours,
             'warn' as status
           from silver""",
        "silver",
    )
)
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days after the load."""
    as_of = derive.FIRST_LOAD + timedelta(days=2)
    return checks.source_freshness(silver_lake(spark, sf_dir).silver.read(spark), as_of)


# Dashboards --------------------------------------------------------------------------

_METRICS, _ZONE_HOURS = "fct_monthly_metrics", "fct_zone_hourly_metrics"
_PIPELINE, _TOTALS = "ops_pipeline_monitoring", "ops_monthly_source_reconciliation"


@query(
    _select(
        "trip_month, taxi_type, trip_count, total_revenue, avg_total_amount, flagged_trip_count",
        "monthly",
    ),
)
def dash_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1, F1."""
    return dashboards.monthly_volume(_mart(spark, sf_dir, _METRICS))


@query(
    statement(
        """select trip_month, taxi_type, trip_count, total_revenue, avg_total_amount,
             flagged_trip_count
           from monthly where taxi_type = 'green' and trip_month in
             (date '1996-01-01', date '1997-05-01')""",
        "monthly",
    )
)
def dash_monthly_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 with the filters of V10."""
    months = [date(1996, 1, 1), date(1997, 5, 1)]
    return dashboards.monthly_volume(
        _mart(spark, sf_dir, _METRICS), taxi_type="green", trip_month=months
    )


_REVIEW = (
    "pickup_datetime, taxi_type, anomaly_type, pickup_location_id, dropoff_location_id, "
    "trip_distance, total_amount, fare_per_mile_zscore"
)


@query(_select(_REVIEW, "anomalies"), rounded=("fare_per_mile_zscore",))
def dash_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2, F2."""
    return dashboards.anomaly_review(_mart(spark, sf_dir, "fct_fare_anomalies"))


@query(
    statement(
        f"""select {_REVIEW} from anomalies where taxi_type = 'yellow'
            and anomaly_type in ('negative_fare', 'fare_rate_outlier')
            and pickup_datetime >= timestamp '1997-01-01 00:00:00'
            and pickup_datetime < timestamp '1999-01-01 00:00:00'""",
        "anomalies",
    ),
    rounded=("fare_per_mile_zscore",),
)
def dash_anomalies_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 with the filters of V10."""
    ntz = T.TimestampNTZType()
    return dashboards.anomaly_review(
        _mart(spark, sf_dir, "fct_fare_anomalies"),
        taxi_type="yellow",
        anomaly_type=["negative_fare", "fare_rate_outlier"],
        picked_up_from=F.lit("1997-01-01 00:00:00").cast(ntz),
        picked_up_to=F.lit("1999-01-01 00:00:00").cast(ntz),
    )


_PEAK = (
    "pickup_date, pickup_hour, taxi_type, pickup_borough, pickup_zone, trip_count, total_revenue"
)


@query(_select(_PEAK, "hourly"))
def dash_peak_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3, F3."""
    return dashboards.peak_zones(_mart(spark, sf_dir, _ZONE_HOURS))


@query(
    statement(
        f"""select {_PEAK} from hourly where taxi_type = 'green' and pickup_hour in (8, 9)
            and pickup_borough = 'ASIA'""",
        "hourly",
    ),
)
def dash_peak_zones_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3 with the filters of V10."""
    return dashboards.peak_zones(
        _mart(spark, sf_dir, _ZONE_HOURS),
        taxi_type="green",
        pickup_hour=[8, 9],
        pickup_borough="ASIA",
    )


@query(
    statement(
        f"""select {_PEAK} from hourly where pickup_date between date '1995-06-01'
            and date '1995-06-03'""",
        "hourly",
    )
)
def dash_peak_zones_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3 with the filters ``pickup_date`` and ``top`` of V10; more than there is."""
    days = [date(1995, 6, day) for day in (1, 2, 3)]
    hours = _mart(spark, sf_dir, _ZONE_HOURS)
    return dashboards.peak_zones(hours, pickup_date=days, top=10**7)


_HEALTH_COLUMNS = "taxi_type, " + ", ".join(_HEALTH)


@query(_select(_HEALTH_COLUMNS, "monitoring"), rounded=_HEALTH)
def dash_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4."""
    return dashboards.monitoring(_mart(spark, sf_dir, _PIPELINE))


_ALERT = "evaluated_at, severity, taxi_type, year_month, alert_code, alert_context"


@query(_select(_ALERT, "alerts"))
def dash_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5, F4."""
    return dashboards.active_alerts(_mart(spark, sf_dir, "ops_alerts"))


@query(statement(f"select {_ALERT} from alerts where severity = 'error'", "alerts"))
def dash_alerts_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 with the filters of V10."""
    return dashboards.active_alerts(_mart(spark, sf_dir, "ops_alerts"), severity="error")


_TOTAL = (
    "year_month, taxi_type, source_rows, expected_loaded_rows, duplicate_rows, warehouse_rows, "
    "source_variance, loaded_variance"
)


@query(_select(_TOTAL, "reconciliation"))
def dash_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6, F5."""
    return dashboards.reconciliation(_mart(spark, sf_dir, _TOTALS))


@query(
    statement(f"select {_TOTAL} from reconciliation where year_month = '1996-03'", "reconciliation")
)
def dash_reconciliation_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6 with the filters of V10."""
    return dashboards.reconciliation(_mart(spark, sf_dir, _TOTALS), year_month="1996-03")


@query(
    _select(
        "trip_month, taxi_type, avg_total_amount, avg_trip_distance, flagged_trip_count", "monthly"
    ),
)
def card_fare_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7."""
    return dashboards.fare_and_distance(_mart(spark, sf_dir, _METRICS))


@query(_select("taxi_type, freshness_lag_hours", "monitoring"))
def card_freshness_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7."""
    return dashboards.freshness_lag(_mart(spark, sf_dir, _PIPELINE))


@query(
    statement(
        """select taxi_type, cast(sum(negative_fare_count) as bigint) as negative_fare_count,
             cast(sum(invalid_distance_count) as bigint) as invalid_distance_count,
             cast(sum(temporal_anomaly_count) as bigint) as temporal_anomaly_count
           from monthly group by 1""",
        "monthly",
    )
)
def card_anomaly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8."""
    return dashboards.anomaly_counts(_mart(spark, sf_dir, _METRICS))


@query(
    statement(
        """select pickup_borough, cast(sum(trip_count) as bigint) as trip_count,
             cast(sum(cast(total_revenue as decimal(18, 2))) as double) as total_revenue
           from hourly group by 1""",
        "hourly",
    ),
)
def card_revenue_by_borough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9."""
    return dashboards.revenue_by_borough(_mart(spark, sf_dir, _ZONE_HOURS))
