"""Physical plans: shuffles, pruning, pushdown and broadcast (what the lake relies on at scale)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterlake.operators import checks, upsert
from meterlake.operators.prepare import prepare_batch, to_silver
from meterlake.plans import fact, jobs, marts, staging
from meterlake.schema import KEY_HASH, TRIP_KEY
from meterlake.sources import trips
from tests.conftest import at, new_lake, write_parquet, yellow_columns


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lines(df, word):
    return [line for line in plan_of(df).splitlines() if word in line]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Two loaded months and their gold tables; these tests only read them."""
    lake = new_lake(tmp_path_factory.mktemp("plans"))
    for month, rows in (("2024-01", 4), ("2024-02", 3)):
        write_parquet(trips.source_url(lake.source_base, "yellow", month), yellow_columns(rows))
    jobs.bootstrap(spark, lake)
    jobs.run_range(spark, lake, "yellow", "2024-01", "2024-02")
    jobs.build_gold(spark, lake)
    return lake


def normalized(spark, lake, month):
    url = trips.source_url(lake.source_base, "yellow", month)
    return trips.normalize_groups(trips.read_schema_groups(spark, [url]), "yellow", month)


def test_a_fresh_load_shuffles_once(spark, loaded):
    frame = to_silver(prepare_batch(normalized(spark, loaded, "2024-01"), False), at(0))
    assert len(lines(frame, "Exchange")) == 1
    # Constants of the batch are added above the shuffle, not carried through it.
    assert not any("AS batch_id" in line for line in plan_of(frame).split("Exchange")[1:])


def test_a_merge_right_after_deduplication_shuffles_incoming_rows_once(spark, loaded):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = normalized(spark, loaded, "2024-01")
        incoming = to_silver(prepare_batch(source, False, merge_next=True), at(0))
        assert KEY_HASH in incoming.columns
        merged = upsert.merge(loaded.silver.read(spark), incoming)
        assert len(lines(merged, "Exchange")) == 2
        assert KEY_HASH not in merged.columns
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_small_correction_shuffles_no_current_row(spark, loaded):
    current = loaded.silver.read(spark)
    incoming = current.where("source_year_month = '2024-01'").limit(1)
    narrow = upsert.merge_narrow(current, incoming, TRIP_KEY, ("loaded_at",), small=True)
    above_scans = [
        part.split("Exchange")[0] for part in plan_of(narrow).split("BroadcastHashJoin")[1:]
    ]
    assert above_scans and not lines(narrow, "SortMergeJoin")
    whole = upsert.merge(current, incoming)
    assert sorted(map(str, narrow.collect())) == sorted(map(str, whole.collect()))
    wide = upsert.merge_narrow(current, incoming, TRIP_KEY, ("loaded_at",), small=False)
    assert sorted(map(str, wide.collect())) == sorted(map(str, whole.collect()))


def test_months_prune_partitions(spark, loaded):
    wanted = upsert.in_partitions(loaded.silver.partition_by, [("2024-01", "yellow")])
    scan = lines(loaded.silver.read(spark).where(wanted), "FileScan")[0]
    assert "PartitionFilters: [" in scan and "2024-01" in scan


def test_partition_predicate_keeps_pairs_apart(spark):
    rows = [("2024-01", "yellow"), ("2024-01", "green"), ("2024-02", "yellow"), ("2024-02", "green")]
    frame = spark.createDataFrame(rows, "source_year_month string, taxi_type string")
    wanted = [rows[0], rows[3]]
    found = frame.where(upsert.in_partitions(frame.columns, wanted)).collect()
    assert sorted(map(tuple, found)) == sorted(wanted)
    assert frame.where(upsert.in_partitions(frame.columns, [])).count() == 0


def test_high_water_mark_reaches_the_scan(spark, loaded):
    mark = fact.high_water_mark(loaded.fact.read(spark))
    delta = fact.changed_since(staging.stage_trips(loaded.silver.read(spark)), mark)
    assert "GreaterThanOrEqual(updated_at" in lines(delta, "FileScan")[0]
    assert fact.high_water_mark(loaded.fact.read(spark).limit(0)) == fact.EPOCH


def test_fact_build_has_no_shuffle_and_small_dimensions_are_broadcast(spark, loaded):
    vendors, zones = loaded.gold("dim_vendor").read(spark), loaded.gold("dim_zone").read(spark)
    built = fact.trip_fact(staging.stage_trips(loaded.silver.read(spark)), vendors, zones)
    assert len(lines(built, "BroadcastHashJoin")) == 3
    assert not lines(built, "Exchange hashpartitioning")


def test_large_dimensions_are_not_broadcast(spark, loaded):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        vendors, zones = loaded.gold("dim_vendor").read(spark), loaded.gold("dim_zone").read(spark)
        built = fact.trip_fact(staging.stage_trips(loaded.silver.read(spark)), vendors, zones)
        assert not lines(built, "BroadcastHashJoin") and built.count() == 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_monthly_metrics_scan_only_their_columns(spark, loaded):
    scan = lines(marts.monthly_metrics(loaded.fact.read(spark)), "FileScan")[0]
    assert "business_trip_key" not in scan and "store_and_fwd_flag" not in scan


def test_refreshed_fact_equals_merge_by_hand(spark, loaded):
    whole = loaded.fact.read(spark)
    delta = whole.where("source_year_month = '2024-02'").withColumn("total_amount", F.lit(1.0))
    merged = fact.refreshed_fact(whole, delta)
    assert merged.count() == 7 and merged.where("total_amount = 1").count() == 3


def test_repeated_keys_are_the_same_with_and_without_hashes(spark, tmp_path):
    rows = spark.range(1000).select(
        (F.col("id") % 990).cast("string").alias("business_trip_key"),
        F.lit("2024-01").alias("source_year_month"),
    )
    plain = sorted(map(tuple, checks.unique_grain(rows).collect()))
    assert sorted(map(tuple, checks.unique_grain(rows, str(tmp_path)).collect())) == plain
    assert len(plain) == 10


def test_several_batches_of_one_month_last_wins(spark):
    rows = spark.createDataFrame(
        [("k", "m", 1, "old"), ("k", "m", 2, "new"), ("l", "m", 1, "only")],
        "business_trip_key string, source_year_month string, n int, v string",
    )
    keys = ["business_trip_key", "source_year_month"]
    latest = upsert.latest_per_key(rows, keys, [F.desc("n")])
    assert sorted(r.v for r in latest.collect()) == ["new", "only"]


def test_shuffle_size_follows_the_input(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with jobs.shuffle_sized_for(spark, 1 << 40):
        assert int(spark.conf.get(name)) == (4 << 40) // (256 << 20)
    assert spark.conf.get(name, None) is None
