"""Deduplication by hashes first, and merges in groups of partitions."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from meterlake.operators import checks, dedupe, upsert
from meterlake.operators.dedupe import keep_first, keep_first_narrow
from meterlake.operators.prepare import prepare_batch, to_silver
from meterlake.schema import SILVER, TRIP_PARTITIONS
from meterlake.sources import tables
from meterlake.sources.tables import LakeTable
from tests.conftest import at
from tests.test_prepare import frame, trip


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_with_repeats(spark):
    return frame(
        spark,
        trip(1, fare_amount=1.0),
        trip(2, fare_amount=2.0),
        trip(3, pickup_datetime=None, vendor_id=None, fare_amount=3.0),
        trip(4, pickup_datetime=None, vendor_id=None, fare_amount=4.0),
        trip(5, passenger_count=0.0, fare_amount=5.0),
        trip(6, passenger_count=-0.0, fare_amount=6.0),
        trip(7, passenger_count=float("nan"), fare_amount=7.0),
        trip(8, passenger_count=float("nan"), fare_amount=8.0),
        trip(9, vendor_id=9, fare_amount=9.0),
        trip(10, vendor_id=9, source_year_month="2024-02", fare_amount=10.0),
    ).repartition(3)


@pytest.mark.parametrize("limit", [0, 100])
@pytest.mark.parametrize("cluster_by", [(), TRIP_PARTITIONS])
def test_narrow_deduplication_keeps_the_same_rows(spark, tmp_path, monkeypatch, limit, cluster_by):
    monkeypatch.setattr(dedupe, "BROADCAST_HASHES", limit)
    rows = rows_with_repeats(spark)
    narrow = keep_first_narrow(rows, str(tmp_path), cluster_by=cluster_by)
    assert narrow.columns == keep_first(rows).columns
    kept = sorted(r.fare_amount for r in narrow.collect())
    assert kept == sorted(r.fare_amount for r in keep_first(rows).collect())
    assert kept == [1.0, 3.0, 5.0, 7.0, 9.0, 10.0]


def test_rows_without_a_repeated_hash_are_not_shuffled(spark, tmp_path):
    rows = rows_with_repeats(spark).localCheckpoint()
    prepared = prepare_batch(rows, False, folder=str(tmp_path))
    # One shuffle, below the window of the rows whose hash is repeated.
    plan = plan_of(prepared)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "LeftAnti" in plan.split("Exchange hashpartitioning")[0]


def test_repeated_hashes_are_broadcast_whatever_size_their_file_has(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").cast("string").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = checks.repeated(rows.union(rows.limit(7)), ["k"], str(tmp_path))
        assert "SortMergeJoin" not in plan_of(found)
        assert found.count() == 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_merge_of_two_prepared_batches_shuffles_each_once(spark):
    old = frame(spark, *[trip(i, vendor_id=i) for i in range(5)])
    new = frame(spark, *[trip(i, vendor_id=i, fare_amount=0.5) for i in range(3, 8)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = upsert.merge(
            to_silver(prepare_batch(old, False, merge_next=True), at(0)),
            to_silver(prepare_batch(new, False, merge_next=True), at(1)),
        )
        assert merged.columns == SILVER.names
        assert plan_of(merged).count("Exchange hashpartitioning") == 2
        found = merged.select("vendor_id", "fare_amount", F.hour("loaded_at"), F.hour("updated_at"))
        assert sorted(tuple(r)[0] for r in found.collect()) == list(range(8))
        assert merged.where("fare_amount = 0.5").count() == 5
        assert merged.where("loaded_at < updated_at").count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitions_are_merged_in_groups_that_can_be_broadcast(spark, tmp_path, monkeypatch):
    table = LakeTable(str(tmp_path / "silver"), SILVER, TRIP_PARTITIONS)
    table.create(spark)
    months = [f"2024-{m:02d}" for m in range(1, 6)]

    def batch(fare, vendors, hour):
        trips = [
            trip(n, vendor_id=n, source_year_month=m, fare_amount=fare)
            for m in months
            for n in (vendors if m != "2024-05" else range(8))
        ]
        return to_silver(prepare_batch(frame(spark, *trips), False), at(hour))

    upsert.upsert_table(spark, table, batch(1.0, range(4), 0))
    merges = []
    monkeypatch.setattr(upsert, "BROADCAST_ROWS", 4)
    narrow = upsert.merge_narrow

    def seen(current, incoming, keys, keep, small):
        merges.append((incoming.count(), small))
        return narrow(current, incoming, keys, keep, small)

    monkeypatch.setattr(upsert, "merge_narrow", seen)
    upsert.upsert_table(spark, table, batch(2.0, (3, 4), 1))
    # 16 incoming rows: two months at a time, and the one with more than the limit by itself.
    assert sorted(merges) == [(4, True), (4, True), (8, False)]
    rows = table.read(spark)
    assert rows.count() == 4 * 5 + 8 and rows.where("fare_amount = 2").count() == 4 * 2 + 8
    assert rows.where("loaded_at < updated_at").count() == 4 * 1 + 8


def test_beyond_the_broadcast_limit_rows_of_other_keys_are_not_shuffled(
    spark, tmp_path, monkeypatch
):
    monkeypatch.setattr(dedupe, "BROADCAST_HASHES", 1)
    monkeypatch.setattr(dedupe, "FILTER_WORDS", 64)
    once = [trip(n, vendor_id=n, fare_amount=float(n)) for n in range(300)]
    twice = [trip(n + 300, vendor_id=n, fare_amount=-1.0) for n in range(20)]
    rows = frame(spark, *once, *twice).repartition(3).localCheckpoint()
    kept = keep_first_narrow(rows, str(tmp_path))
    plan = plan_of(kept)
    # Only below the window, where rows whose bit is set come.
    assert plan.count("Exchange hashpartitioning") == 1
    assert "LeftAnti" in plan.split("Exchange hashpartitioning")[0]
    assert sorted(r.fare_amount for r in kept.collect()) == [float(n) for n in range(300)]
    again = dedupe.repeated_table(rows.select(F.xxhash64("vendor_id")), str(tmp_path))
    _, compared = dedupe.split_repeated(rows, F.xxhash64("vendor_id"), again)
    assert 40 <= compared.count() < 80


@pytest.mark.parametrize("limit", [0, 100])
def test_a_merge_by_hashes_first_shuffles_only_rows_that_meet(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(dedupe, "BROADCAST_HASHES", limit)

    def batch(fare, vendors, hour):
        trips = [trip(n, vendor_id=n, fare_amount=fare) for n in vendors]
        return to_silver(prepare_batch(frame(spark, *trips), False), at(hour)).localCheckpoint()

    old, new = batch(1.0, range(6), 0), batch(2.0, range(4, 9), 1)
    merged = upsert.merge(old, new, folder=str(tmp_path))
    before_join = plan_of(merged).split("FullOuter")[0]
    assert before_join.count("LeftAnti") == 2 and "Exchange hashpartitioning" not in before_join
    assert merged.columns == SILVER.names
    columns = ("business_trip_key", "fare_amount", "loaded_at", "updated_at")
    expected, found = (
        sorted(tuple(r) for r in df.select(*columns).collect())
        for df in (upsert.merge(old, new), merged)
    )
    assert found == expected and len(found) == 9


def test_partitions_are_written_without_a_sort_of_whole_rows(spark, tmp_path, monkeypatch):
    table = LakeTable(str(tmp_path / "silver"), SILVER, TRIP_PARTITIONS)
    months = [f"20{y}-{m:02d}" for y in (22, 23, 24, 25) for m in range(1, 13)]
    trips = [trip(n, source_year_month=m) for m in months for n in range(3)]
    rows = to_silver(prepare_batch(frame(spark, *trips), False), at(0)).coalesce(1)
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    open_files, parquet = [], DataFrameWriter.parquet

    def seen(self, path):
        open_files.append(int(spark.conf.get(name)))
        parquet(self, path)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    table.rewrite(rows)
    assert open_files == [tables.OPEN_FILES] and tables.OPEN_FILES > 0
    assert spark.conf.get(name) == before
    table.append(rows.where("source_year_month < '2022-03'"))
    written = table.read(spark)
    assert written.count() == 48 + 2 and written.select("source_year_month").distinct().count() == 48


@pytest.mark.parametrize("limit", [0, 3, 1000])
def test_a_merge_without_kept_columns_writes_only_rows_that_stay(
    spark, tmp_path, monkeypatch, limit
):
    """Incoming rows are final as they were staged; where they replace all, nothing is read twice."""
    monkeypatch.setattr(upsert, "BROADCAST_ROWS", limit)
    table = LakeTable(str(tmp_path / "fact"), SILVER, TRIP_PARTITIONS)
    table.create(spark)

    def batch(fare, vendors_of, hour):
        trips = [
            trip(n, vendor_id=n, source_year_month=m, fare_amount=fare)
            for m, vendors in vendors_of.items()
            for n in vendors
        ]
        return to_silver(prepare_batch(frame(spark, *trips), False), at(hour))

    first = {"2024-01": range(4), "2024-02": range(4), "2024-03": range(4)}
    second = {"2024-01": range(6), "2024-02": (2, 3, 4), "2024-04": (1,)}
    upsert.upsert_table(spark, table, batch(1.0, first, 0), keep=())
    monkeypatch.setattr(upsert, "merge_narrow", None)
    written, write = {}, LakeTable._write

    def seen(self, df, mode, **options):
        write(self, df, mode, **options)
        if "__staging" in self.path:
            written[self.path.rsplit("/", 1)[1]] = self.read(spark).count()

    monkeypatch.setattr(LakeTable, "_write", seen)
    upsert.upsert_table(spark, table, batch(2.0, second, 1), keep=())
    # Ten incoming rows and the two of February that stay, beside them.
    assert {k: n for k, n in written.items() if k in ("incoming", "rows")} == {"incoming": 12}
    found = {
        (r.source_year_month, r.vendor_id): (r.fare_amount, r.loaded_at.hour)
        for r in table.read(spark).collect()
    }
    assert table.read(spark).count() == len(found) == 6 + 5 + 4 + 1
    for (month, vendor), (fare, _) in found.items():
        assert fare == (2.0 if vendor in second.get(month, ()) else 1.0)


def test_shuffle_files_of_a_write_are_cleaned_up(spark, tmp_path, monkeypatch):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, states, parquet = spark.conf.get(name), [], DataFrameWriter.parquet

    def seen(self, path):
        states.append(spark.conf.get(name))
        parquet(self, path)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    rows = spark.range(100).repartition(3, "id")
    table = LakeTable(str(tmp_path / "t"), rows.schema)
    table.rewrite(rows)
    table.append(rows)
    assert states == ["true", "true"] and spark.conf.get(name) == before
    assert table.read(spark).count() == 200
