"""Loads, ledger, gold, checks and alerts on a small lake."""

from __future__ import annotations

import json
import os
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterlake import __main__ as cli
from meterlake.operators import checks, ledger
from meterlake.plans import jobs, monitoring, staging
from meterlake.sources import files, trips
from meterlake.sources.tables import Lake, LakeTable
from meterlake.streaming.landing import close_months, land_stream
from tests.conftest import at, write_parquet, yellow_columns


def put(lake, month, columns, taxi_type="yellow", **types):
    write_parquet(trips.source_url(lake.source_base, taxi_type, month), columns, **types)


def silver(spark, lake):
    return lake.silver.read(spark)


def files_of(rows):
    return {r.f for r in rows.select(F.input_file_name().alias("f")).distinct().collect()}


def batches(spark, lake):
    return ledger.current_batches(lake.ledger.read(spark))


def test_month_load_then_skip_then_correction(spark, lake):
    put(lake, "2024-01", yellow_columns(3, tpep_dropoff_datetime=["2024-01-01 10:15:00"] * 2 + ["x"]))
    jobs.bootstrap(spark, lake)
    result = jobs.run_month(spark, lake, "yellow", "2024-01")
    counts = {k: v for k, v in result.items() if k.endswith("_rows")}
    assert counts == {
        "source_rows": 3,
        "loaded_rows": 2,
        "duplicate_rows": 1,
        "invalid_rows": 1,
        "null_key_rows": 1,
    }
    row = batches(spark, lake).first()
    assert row.status == "success" and row.source_rows == 3 and row.runtime_seconds > 0
    assert row.bronze_object_key.startswith("bronze/yellow/year_month=2024-01/")
    assert spark.read.parquet(lake.path(row.bronze_object_key)).count() == 3
    before = {r.business_trip_key: r for r in silver(spark, lake).collect()}

    assert jobs.run_month(spark, lake, "yellow", "2024-01")["status"] == "skipped"
    assert batches(spark, lake).count() == 1

    # One trip corrected, one re-keyed, one new: nothing is deleted.
    put(
        lake,
        "2024-01",
        yellow_columns(
            2,
            tpep_dropoff_datetime=["2024-01-01 10:15:00", "2024-01-01 12:00:00"],
            total_amount=[99.0, 50.0],
        ),
    )
    assert jobs.run_month(spark, lake, "yellow", "2024-01")["loaded_rows"] == 2
    after = {r.business_trip_key: r for r in silver(spark, lake).collect()}
    assert len(after) == 3 and set(before) < set(after)
    corrected = [k for k in before if "10:15:00" in k][0]
    stale = [k for k in before if k != corrected][0]
    assert after[corrected].total_amount == 99.0
    assert after[corrected].loaded_at == before[corrected].loaded_at
    assert after[corrected].updated_at > before[corrected].updated_at
    assert after[stale] == before[stale]


def test_loading_twice_changes_only_updated_at(spark, lake):
    put(lake, "2024-01", yellow_columns(4))
    jobs.run_month(spark, lake, "yellow", "2024-01")
    first = silver(spark, lake).drop("updated_at", "batch_id").collect()
    put(lake, "2024-01", yellow_columns(4, ehail_fee=[None] * 4))
    jobs.run_month(spark, lake, "yellow", "2024-01")
    second = silver(spark, lake).drop("updated_at", "batch_id").collect()
    assert sorted(first) == sorted(second)


def test_drift_flags_the_batch_and_is_recorded(spark, lake):
    put(lake, "2024-01", yellow_columns(2, bonus_field=["a", "b"]))
    result = jobs.run_month(spark, lake, "yellow", "2024-01")
    assert result["schema_drift_columns"] == ["bonus_field"] and result["invalid_rows"] == 2
    assert batches(spark, lake).first().schema_drift_columns == ["bonus_field"]
    assert silver(spark, lake).where("has_schema_drift").count() == 2


def test_types_share_a_month_without_touching_each_other(spark, lake):
    put(lake, "2024-01", yellow_columns(2))
    green = yellow_columns(2, trip_type=[1, 2])
    green = {k.replace("tpep_", "lpep_"): v for k, v in green.items()}
    put(lake, "2024-01", green, "green")
    jobs.run_month(spark, lake, "yellow", "2024-01")
    yellow_files = files_of(silver(spark, lake).where("taxi_type = 'yellow'"))
    jobs.run_month(spark, lake, "green", "2024-01")
    assert files_of(silver(spark, lake).where("taxi_type = 'yellow'")) == yellow_files
    assert silver(spark, lake).count() == 4


def test_empty_file_is_a_success_without_rows(spark, lake):
    columns = {name: [] for name in yellow_columns()}
    put(lake, "2024-01", columns, VendorID=pa.int64(), fare_amount=pa.float64())
    result = jobs.run_month(spark, lake, "yellow", "2024-01")
    assert result["status"] == "success" and result["source_rows"] == result["loaded_rows"] == 0
    assert batches(spark, lake).first().status == "success"


def test_failures_are_recorded(spark, lake):
    with pytest.raises(Exception):
        jobs.run_month(spark, lake, "yellow", "2024-01")
    put(lake, "2024-02", {"VendorID": [1], "vendor_id": [2]})
    with pytest.raises(ValueError, match="both map"):
        jobs.run_month(spark, lake, "yellow", "2024-02")
    put(lake, "2024-03", yellow_columns(payment_type=[2**40]))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        jobs.run_month(spark, lake, "yellow", "2024-03")
    rows = {r.year_month: r for r in batches(spark, lake).collect()}
    assert {r.status for r in rows.values()} == {"failed"} and len(rows) == 3
    assert "both map" in rows["2024-02"].error_message
    assert all(len(r.error_message) <= 4000 for r in rows.values())
    assert rows["2024-03"].finished_at is not None and silver(spark, lake).count() == 0


def test_month_stored_as_a_folder_keeps_part_order(spark, lake, tmp_path):
    folder = tmp_path / "source" / "yellow_tripdata_2024-01.parquet"
    folder.mkdir()
    write_parquet(folder / "part-1.parquet", yellow_columns(total_amount=[2.0]))
    write_parquet(folder / "part-0.parquet", yellow_columns(total_amount=[1.0]))
    result = jobs.run_month(spark, lake, "yellow", "2024-01")
    assert (result["source_rows"], result["loaded_rows"]) == (2, 1)
    assert silver(spark, lake).first().total_amount == 1.0


def test_range_loads_pending_months_in_one_plan(spark, lake):
    put(lake, "2024-01", yellow_columns(2))
    put(lake, "2024-02", yellow_columns(3, passenger_count=[2.0] * 3, bonus=[1] * 3))
    put(lake, "2024-03", yellow_columns(1))
    put(lake, "2024-04", yellow_columns(9))
    jobs.run_month(spark, lake, "yellow", "2024-03")
    result = jobs.run_range(spark, lake, "yellow", "2024-01", "2024-03")
    assert result["status"] == "success" and result["failed_months"] == []
    assert [r["status"] for r in result["results"]] == ["success", "success", "skipped"]
    assert result["successful_months"] == ["2024-01", "2024-02", "2024-03"]
    # Dedupe is per batch: the same trip in two months stays in both.
    counts = {r.m: r.n for r in silver(spark, lake).groupBy(F.col("source_year_month").alias("m"))
              .agg(F.count("*").alias("n")).collect()}
    assert counts == {"2024-01": 2, "2024-02": 3, "2024-03": 1}
    assert silver(spark, lake).where("has_schema_drift").count() == 3
    by_month = {r.year_month: r for r in batches(spark, lake).collect()}
    assert by_month["2024-02"].invalid_rows == 3 and by_month["2024-01"].invalid_rows == 0


def test_range_with_a_reloaded_and_a_new_month(spark, lake):
    put(lake, "2024-01", yellow_columns(3))
    jobs.run_month(spark, lake, "yellow", "2024-01")
    first = silver(spark, lake).first().loaded_at
    put(lake, "2024-01", yellow_columns(2, total_amount=[5.0] * 2))
    put(lake, "2024-02", yellow_columns(4, total_amount=[6.0] * 4))
    result = jobs.run_range(spark, lake, "yellow", "2024-01", "2024-02")
    assert [r["loaded_rows"] for r in result["results"]] == [2, 4]
    rows = silver(spark, lake).collect()
    assert sorted((r.source_year_month, r.total_amount) for r in rows) == [
        ("2024-01", 5.0),
        ("2024-01", 5.0),
        ("2024-01", 24.0),
    ] + [("2024-02", 6.0)] * 4
    assert {r.loaded_at == first for r in rows if r.source_year_month == "2024-01"} == {True}
    assert len({r.batch_id for r in rows}) == 3


def test_range_stops_or_continues_on_error(spark, lake):
    put(lake, "2024-01", yellow_columns(1))
    with pytest.raises(FileNotFoundError):
        jobs.run_range(spark, lake, "yellow", "2024-01", "2024-02")
    result = jobs.run_range(spark, lake, "yellow", "2024-01", "2024-02", continue_on_error=True)
    assert result["status"] == "partial_success"
    assert result["successful_months"] == ["2024-01"]
    assert [f["year_month"] for f in result["failed_months"]] == ["2024-02"]


def test_zone_refresh_upserts_and_never_deletes(spark, lake, tmp_path):
    assert jobs.load_zones(spark, lake) == 4
    (tmp_path / "zones.csv").write_text(
        "LocationID,Borough,Zone,service_zone\n1,EWR,Renamed,EWR\n7,Queens,Astoria,Boro Zone\n"
    )
    assert jobs.load_zones(spark, lake) == 2
    rows = {r.location_id: r.zone for r in lake.zones.read(spark).collect()}
    assert rows[1] == "Renamed" and rows[7] == "Astoria" and len(rows) == 5
    (tmp_path / "zones.csv").write_text("LocationID,Borough,Zone,service_zone\n")
    assert jobs.load_zones(spark, lake) == 0
    (tmp_path / "zones.csv").write_text(
        "LocationID,Borough,Zone,service_zone\n1,a,b,c\n1,d,e,f\n"
    )
    with pytest.raises(ValueError, match="repeats"):
        jobs.load_zones(spark, lake)
    assert lake.zones.read(spark).count() == 5


def test_fact_refresh_equals_full_build_and_rewrites_touched_months_only(spark, lake):
    jobs.bootstrap(spark, lake)
    for month, rows in (("2024-01", 2), ("2024-02", 3)):
        put(lake, month, yellow_columns(rows))
        jobs.run_month(spark, lake, "yellow", month)
    jobs.refresh_dimensions(spark, lake)
    jobs.refresh_fact(spark, lake)
    january = files_of(lake.fact.read(spark).where("source_year_month = '2024-01'"))
    # The unlisted zone 77 appears and one trip is corrected.
    put(lake, "2024-02", yellow_columns(4, PULocationID=[77] + [100] * 3, total_amount=[30.0] * 4))
    jobs.run_month(spark, lake, "yellow", "2024-02")
    jobs.refresh_dimensions(spark, lake)
    jobs.refresh_fact(spark, lake)
    fact = lake.fact.read(spark)
    assert files_of(fact.where("source_year_month = '2024-01'")) == january
    refreshed = sorted(map(str, fact.collect()))
    jobs.refresh_fact(spark, lake, full=True)
    assert sorted(map(str, lake.fact.read(spark).collect())) == refreshed
    assert len(refreshed) == 2 + 5
    assert lake.fact.read(spark).where("pickup_zone_sk is null").count() == 0


class Died(Exception):
    """The job was killed."""


def die_in_publish(monkeypatch, after):
    """The next publishing moves ``after`` folders and dies with the next one's target gone."""
    real, moved = files.move, []

    def move(spark, source, target):
        if len(moved) == after:
            raise Died()
        moved.append(target)
        real(spark, source, target)

    monkeypatch.setattr(files, "move", move)


def load_and_correct(spark, lake):
    for month in ("2024-01", "2024-02"):
        put(lake, month, yellow_columns(4))
    jobs.run_range(spark, lake, "yellow", "2024-01", "2024-02")
    for month in ("2024-01", "2024-02"):
        put(lake, month, yellow_columns(2, total_amount=[77.0] * 2))


def content(table):
    return sorted(map(str, table.drop("batch_id", "updated_at").collect()))


@pytest.mark.parametrize("after", [0, 1])
def test_a_job_that_died_while_publishing_loses_nothing(spark, lake, monkeypatch, after):
    load_and_correct(spark, lake)
    loaded_at = {r.loaded_at for r in silver(spark, lake).collect()}
    with monkeypatch.context() as patch:
        die_in_publish(patch, after)
        with pytest.raises(Died):
            jobs.run_range(spark, lake, "yellow", "2024-01", "2024-02")
    assert silver(spark, lake).count() < 8
    jobs.run_range(spark, lake, "yellow", "2024-01", "2024-02")
    rows = silver(spark, lake).collect()
    assert sorted((r.source_year_month, r.total_amount) for r in rows) == sorted(
        [(m, a) for m in ("2024-01", "2024-02") for a in (24.0, 24.0, 77.0, 77.0)]
    )
    assert {r.loaded_at for r in rows} == loaded_at
    current = {r.year_month: r.status for r in batches(spark, lake).orderBy("started_at").collect()}
    assert current == {"2024-01": "success", "2024-02": "success"}


def test_a_job_that_died_before_publishing_changes_nothing(spark, lake, monkeypatch):
    load_and_correct(spark, lake)
    before = content(silver(spark, lake))
    with monkeypatch.context() as patch:
        patch.setattr(files, "touch", lambda *_: (_ for _ in ()).throw(Died()))
        with pytest.raises(Died):
            jobs.run_month(spark, lake, "yellow", "2024-01")
    assert content(silver(spark, lake)) == before
    assert jobs.run_month(spark, lake, "yellow", "2024-01")["loaded_rows"] == 2
    assert silver(spark, lake).count() == 8


def test_a_fact_refresh_that_died_is_completed(spark, lake, monkeypatch):
    load_and_correct(spark, lake)
    jobs.refresh_dimensions(spark, lake)
    jobs.refresh_fact(spark, lake)
    jobs.run_range(spark, lake, "yellow", "2024-01", "2024-02")
    with monkeypatch.context() as patch:
        die_in_publish(patch, 1)
        with pytest.raises(Died):
            jobs.refresh_fact(spark, lake)
    jobs.refresh_fact(spark, lake)
    refreshed = sorted(map(str, lake.fact.read(spark).collect()))
    jobs.refresh_fact(spark, lake, full=True)
    assert sorted(map(str, lake.fact.read(spark).collect())) == refreshed and len(refreshed) == 8


def test_rows_lost_in_a_write_fail_the_batch(spark, lake, monkeypatch):
    """The first load is written once, its correction is merged in a second write."""
    real = type(lake.silver).rewrite
    totals = [24.0] * 6
    for place, message in (("incoming", "6 rows prepared, 3 written"), ("rows", "6 rows prepared, 3 in the table")):
        put(lake, "2024-01", yellow_columns(6, total_amount=totals))

        def lossy(table, df):
            real(table, df)
            if table.path.endswith(f"__staging/{place}"):  # noqa: B023
                real(table, spark.createDataFrame(table.read(spark).limit(3).collect(), table.schema))

        with monkeypatch.context() as patch:
            patch.setattr(type(lake.silver), "rewrite", lossy)
            with pytest.raises(jobs.LostRows, match=message):
                jobs.run_month(spark, lake, "yellow", "2024-01")
        assert "failed" in {r.status for r in batches(spark, lake).collect()}
        assert jobs.run_month(spark, lake, "yellow", "2024-01")["loaded_rows"] == 6
        assert silver(spark, lake).count() == 6
        totals = [25.0] * 6


def test_counts_beyond_32_bits_go_through_the_ledger(spark, lake):
    jobs.ensure_warehouse(spark, lake)
    many = 3 * 10**9
    plan = jobs._plan(lake, "yellow", "2024-01") | {"source_rows": many}
    planned = jobs._planned(spark, [plan])
    now = datetime.now(timezone.utc)
    ledger.start_batches(spark, lake.ledger, planned, now)
    metrics = spark.createDataFrame(
        [(plan["batch_id"], many - 1, 1, many - 2, 0)],
        "batch_id string, loaded_rows long, duplicate_rows long, invalid_rows long, null_key_rows long",
    )
    ledger.finish_batches(spark, lake.ledger, planned, metrics, now)
    row = batches(spark, lake).first()
    assert (row.status, row.source_rows, row.loaded_rows) == ("success", many, many - 1)


def test_parts_of_a_month_with_schemas_of_their_own(spark, lake, tmp_path):
    folder = tmp_path / "source" / "yellow_tripdata_2024-01.parquet"
    folder.mkdir()
    plain = yellow_columns(1, trip_distance=[1.0])
    write_parquet(folder / "part-0.parquet", plain)
    # An extra column, an alias of its own, and integers where the first has doubles.
    extra = yellow_columns(1, trip_distance=[2], Airport_fee=[1.25], new_field=["n"])
    extra["tpep_dropoff_datetime"] = ["2024-01-01 11:00:00"]
    write_parquet(folder / "part-1.parquet", extra)
    # A column missing.
    less = {k: v for k, v in yellow_columns(1).items() if k != "tip_amount"}
    less["tpep_dropoff_datetime"] = ["2024-01-01 12:00:00"]
    write_parquet(folder / "part-2.parquet", less)
    result = jobs.run_month(spark, lake, "yellow", "2024-01")
    assert (result["source_rows"], result["loaded_rows"]) == (3, 3)
    assert result["schema_drift_columns"] == ["new_field"]
    rows = silver(spark, lake).orderBy("dropoff_datetime").collect()
    assert [(r.trip_distance, r.airport_fee, r.tip_amount) for r in rows] == [
        (1.0, None, 2.0),
        (2.0, 1.25, 2.0),
        (4.0, None, None),
    ]
    # Drift is a matter of the whole month.
    assert all(r.has_schema_drift for r in rows)
    landed = lake.path(trips.bronze_key("yellow", "2024-01"))
    names = {f.name for part in spark.read.format("binaryFile").load(landed).collect()
             if part.path.endswith(".parquet") for f in spark.read.parquet(part.path).schema}
    assert {"new_field", "Airport_fee", "tip_amount"} <= names


def test_range_keeps_months_before_the_first_failure(spark, lake):
    for month in ("2024-01", "2024-02", "2024-04"):
        put(lake, month, yellow_columns(2))
    put(lake, "2024-03", yellow_columns(1, payment_type=[2**40]))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        jobs.run_range(spark, lake, "yellow", "2024-01", "2024-04", wave_bytes=1)
    months = {r.source_year_month for r in silver(spark, lake).collect()}
    assert months == {"2024-01", "2024-02"}
    result = jobs.run_range(spark, lake, "yellow", "2024-01", "2024-05", continue_on_error=True)
    assert [r["status"] for r in result["results"]] == ["skipped", "skipped", "success"]
    assert [f["year_month"] for f in result["failed_months"]] == ["2024-03", "2024-05"]
    assert silver(spark, lake).count() == 6


def test_run_all_passes_checks_and_gate(spark, lake):
    put(lake, "2024-01", yellow_columns(5))
    result = jobs.run_all(spark, lake, "yellow", ["2024-01"])
    assert result["freshness"]["status"] == "pass"
    assert len(result["checks"]) == 21 + 6 + 4 + 3
    assert {c["status"] for c in result["checks"]} == {"pass"}
    assert result["loads"][0]["loaded_rows"] == 5
    assert lake.gold("fct_zone_hourly_metrics").read(spark).first().pickup_borough == "Manhattan"


def test_run_all_fails_on_error_alerts_and_stale_sources(spark, lake):
    put(lake, "2024-01", yellow_columns(5))
    with pytest.raises(Exception):
        jobs.run_month(spark, lake, "yellow", "2023-12")
    with pytest.raises(monitoring.AlertThresholdBreached, match="ingest_success_rate=0.5000"):
        jobs.run_all(spark, lake, "yellow", ["2024-01"])
    later = datetime.now(timezone.utc) + timedelta(hours=73)
    with pytest.raises(jobs.CheckFailed, match="last loaded"):
        jobs.run_all(spark, lake, "yellow", ["2024-01"], as_of=later)


def test_stale_rows_show_as_loaded_variance(spark, lake):
    put(lake, "2024-01", yellow_columns(5))
    jobs.run_month(spark, lake, "yellow", "2024-01")
    put(lake, "2024-01", yellow_columns(4))
    with pytest.raises(monitoring.AlertThresholdBreached, match="loaded_reconciliation_mismatch"):
        jobs.run_all(spark, lake, "yellow", ["2024-01"])
    failed = [r for r in jobs.check_tables(spark, lake).collect() if r.status == "fail"]
    assert [r.check for r in failed] == ["loaded_reconciliation_zero"]


def test_command_line(spark, lake, capsys):
    put(lake, "2024-01", yellow_columns(2))
    places = ["--root", lake.root, "--source-base", lake.source_base, "--zone-csv", lake.zone_csv]
    assert cli.main([*places, "ensure-warehouse"])["status"] == "success"
    assert cli.main([*places, "load-zones"])["rows"] == 4
    assert cli.main([*places, "bootstrap"])["action"] == "bootstrap"
    cli.main([*places, "run-month", "--year-month", "2024-01"])
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["loaded_rows"] == 2
    command = ["run-range", "--start-month", "2024-01", "--end-month", "2024-01"]
    assert cli.main([*places, *command])["results"][0]["status"] == "skipped"
    cli.main([*places, "build-gold"])
    assert {c["status"] for c in cli.main([*places, "check"])["checks"]} == {"pass"}
    with pytest.raises(SystemExit):
        cli.main([*places, "run-month", "--taxi-type", "red", "--year-month", "2024-01"])


def test_stream_loads_each_file_once(spark, lake, tmp_path):
    put(lake, "2024-01", yellow_columns(3))
    schema = spark.read.parquet(lake.source_base).schema
    checkpoint = str(tmp_path / "stream")
    land_stream(spark, lake, "yellow", schema, checkpoint).awaitTermination()
    assert silver(spark, lake).count() == 3
    put(lake, "2024-02", yellow_columns(2))
    put(lake, "2024-03", yellow_columns(2, tpep_dropoff_datetime=["2024-01-01 10:15:00"] * 2))
    for _ in range(2):
        land_stream(spark, lake, "yellow", schema, checkpoint).awaitTermination()
    assert silver(spark, lake).count() == 6
    rows = {r.year_month: r for r in batches(spark, lake).collect()}
    assert {m: (r.source_rows, r.loaded_rows, r.duplicate_rows) for m, r in rows.items()} == {
        "2024-01": (3, 3, 0),
        "2024-02": (2, 2, 0),
        "2024-03": (2, 1, 1),
    }
    assert {r.status for r in rows.values()} == {"success"}


def test_stream_batch_that_failed_once_ends_in_success(spark, lake, tmp_path, monkeypatch):
    put(lake, "2024-01", yellow_columns(3))
    schema = spark.read.parquet(lake.source_base).schema
    checkpoint = str(tmp_path / "stream")
    with monkeypatch.context() as patch:
        die_in_publish(patch, 0)
        with pytest.raises(Exception):
            land_stream(spark, lake, "yellow", schema, checkpoint).awaitTermination()
    assert batches(spark, lake).first().status == "failed"
    land_stream(spark, lake, "yellow", schema, checkpoint).awaitTermination()
    row = batches(spark, lake).first()
    assert batches(spark, lake).count() == 1
    assert (row.status, row.loaded_rows, row.error_message) == ("success", 3, None)
    assert silver(spark, lake).count() == 3


def test_stream_takes_a_folder_as_the_month_load_does(spark, lake, tmp_path):
    folder = tmp_path / "source" / "yellow_tripdata_2024-01.parquet"
    folder.mkdir()
    write_parquet(folder / "part-1.parquet", yellow_columns(total_amount=[2.0]))
    write_parquet(folder / "part-0.parquet", yellow_columns(total_amount=[1.0]))
    schema = spark.read.parquet(str(folder)).schema
    land_stream(spark, lake, "yellow", schema, str(tmp_path / "s")).awaitTermination()
    row = batches(spark, lake).first()
    assert batches(spark, lake).count() == 1
    assert (row.source_rows, row.loaded_rows, row.duplicate_rows) == (2, 1, 1)
    assert silver(spark, lake).first().total_amount == 1.0


def _months_in_parts(folder, months=("2024-01", "2024-02")):
    """Parts of months with equal trips; greater names are written first, so they arrive first."""
    for month in months:
        (folder / f"yellow_tripdata_{month}.parquet").mkdir(parents=True)
    for k in (2, 1, 0):
        for month in months:
            path = folder / f"yellow_tripdata_{month}.parquet" / f"part-{k}.parquet"
            # Three trips, one more in each part; the first is there twice with two totals.
            totals = [100.0 * k + n for n in range(3 + k)]
            columns = yellow_columns(3 + k, total_amount=totals, passenger_count=[2] * (2 + k) + [None])
            write_parquet(path, {c: [*v, v[0]] if c != "total_amount" else [*v, -1.0] for c, v in columns.items()})
            stamp = 1_700_000_000 + 100 * (2 - k)
            os.utime(path, (stamp, stamp))


def _plain_counts(spark, lake):
    names = ("taxi_type", "year_month", "status", "source_rows", "loaded_rows", "duplicate_rows", "invalid_rows", "null_key_rows")
    return sorted(tuple(r) for r in batches(spark, lake).select(*names).collect())


@pytest.mark.parametrize("files_per_trigger", [1, 4])
def test_stream_equals_the_range_load_however_parts_arrive(spark, lake, tmp_path, files_per_trigger):
    _months_in_parts(tmp_path / "source")
    jobs.run_range(spark, lake, "yellow", "2024-01", "2024-02")
    streamed = Lake(str(tmp_path / "streamed"), lake.source_base, lake.zone_csv)
    schema = spark.read.parquet(f"{lake.source_base}/yellow_tripdata_2024-01.parquet").schema
    land_stream(spark, streamed, "yellow", schema, str(tmp_path / "s"), files_per_trigger).awaitTermination()
    run_columns = ("batch_id", "loaded_at", "updated_at")
    trips_of = lambda of: sorted(map(str, silver(spark, of).drop(*run_columns).collect()))
    assert trips_of(streamed) == trips_of(lake)
    assert {r.total_amount for r in silver(spark, streamed).collect()} >= {0.0, 1.0}
    assert _plain_counts(spark, streamed) == _plain_counts(spark, lake)
    # Each month is one batch whose counts are the table's, so nothing is amiss.
    assert batches(spark, streamed).count() == 2
    rows = monitoring.source_reconciliation(
        staging.stage_batches(batches(spark, streamed)), silver(spark, streamed)
    )
    assert {r.loaded_rows for r in batches(spark, streamed).collect()} == {
        r["count"] for r in silver(spark, streamed).groupBy("source_year_month").count().collect()
    }
    assert rows.count() == 2


def test_stream_part_that_comes_in_a_later_run(spark, lake, tmp_path):
    folder = tmp_path / "source" / "yellow_tripdata_2024-01.parquet"
    folder.mkdir()
    checkpoint = str(tmp_path / "s")
    for name, total in (("part-5", 5.0), ("part-7", 7.0), ("part-3", 3.0)):
        write_parquet(folder / f"{name}.parquet", yellow_columns(total_amount=[total]))
        schema = spark.read.parquet(str(folder)).schema
        land_stream(spark, lake, "yellow", schema, checkpoint).awaitTermination()
        expected = min(5.0, total)
        assert [r.total_amount for r in silver(spark, lake).collect()] == [expected]
    row = batches(spark, lake).first()
    assert batches(spark, lake).count() == 1
    assert (row.status, row.source_rows, row.loaded_rows, row.duplicate_rows) == ("success", 3, 1, 2)
    # Once a month is closed, a further part corrects it.
    close_months(spark, lake, "yellow", ["2024-01"])
    write_parquet(folder / "part-9.parquet", yellow_columns(total_amount=[9.0]))
    land_stream(spark, lake, "yellow", schema, checkpoint).awaitTermination()
    assert [r.total_amount for r in silver(spark, lake).collect()] == [9.0]


@pytest.mark.parametrize("dies_at", [0, 1])
def test_stream_replay_between_parts(spark, lake, tmp_path, monkeypatch, dies_at):
    """A micro-batch that dies while trips or versions are published is repeated."""
    _months_in_parts(tmp_path / "source", ("2024-01",))
    jobs.run_range(spark, lake, "yellow", "2024-01", "2024-01")
    streamed = Lake(str(tmp_path / "streamed"), lake.source_base, lake.zone_csv)
    schema = spark.read.parquet(f"{lake.source_base}/yellow_tripdata_2024-01.parquet").schema
    checkpoint = str(tmp_path / "s")
    with monkeypatch.context() as patch:
        die_in_publish(patch, dies_at)
        with pytest.raises(Exception):
            land_stream(spark, streamed, "yellow", schema, checkpoint, 1).awaitTermination()
    land_stream(spark, streamed, "yellow", schema, checkpoint, 1).awaitTermination()
    assert _plain_counts(spark, streamed) == _plain_counts(spark, lake)
    totals = lambda of: sorted(r.total_amount for r in silver(spark, of).collect())
    assert totals(streamed) == totals(lake)


def test_first_load_writes_each_row_once(spark, lake, monkeypatch):
    """Partitions that are new to the table are moved, not written again."""
    put(lake, "2024-01", yellow_columns(3))
    written = []
    rewrite = LakeTable.rewrite

    def watched(self, df):
        written.append(self.path)
        rewrite(self, df)

    monkeypatch.setattr(LakeTable, "rewrite", watched)
    jobs.run_month(spark, lake, "yellow", "2024-01")
    assert [p.rsplit("/", 1)[1] for p in written if "silver" in p] == ["incoming"]
    put(lake, "2024-02", yellow_columns(2))
    put(lake, "2024-01", yellow_columns(4, total_amount=[9.0] * 4))
    written.clear()
    jobs.run_range(spark, lake, "yellow", "2024-01", "2024-02")
    assert [p.rsplit("/", 1)[1] for p in written if "silver" in p] == ["incoming", "rows"]
    months = {r.source_year_month: r["count"] for r in silver(spark, lake).groupBy("source_year_month").count().collect()}
    assert months == {"2024-01": 4, "2024-02": 2}


def test_stream_takes_all_files_of_a_backlog(spark, lake, tmp_path):
    for month in range(1, 6):
        put(lake, f"2024-{month:02d}", yellow_columns(2))
    schema = spark.read.parquet(lake.source_base).schema
    checkpoint = str(tmp_path / "s")
    land_stream(spark, lake, "yellow", schema, checkpoint, files_per_trigger=2).awaitTermination()
    assert silver(spark, lake).count() == 10 and batches(spark, lake).count() == 5


def test_stream_writes_each_trip_once_and_keeps_the_first_load(spark, lake, tmp_path, monkeypatch):
    """Trips that win are final as they are staged; of the table only trips that stay are written."""
    folder = tmp_path / "source" / "yellow_tripdata_2024-01.parquet"
    folder.mkdir()
    checkpoint = str(tmp_path / "s")
    write_parquet(folder / "part 5[%41].parquet", yellow_columns(5, total_amount=[5.0] * 5))
    schema = spark.read.parquet(str(folder)).schema
    land_stream(spark, lake, "yellow", schema, checkpoint).awaitTermination()
    first = silver(spark, lake).first().loaded_at
    written, write = [], LakeTable._write

    def seen(self, df, mode, **options):
        write(self, df, mode, **options)
        if self.path.startswith(lake.silver.path):
            written.append((self.path.rsplit("/", 1)[1], mode, self.read(spark).count()))

    monkeypatch.setattr(LakeTable, "_write", seen)
    # Two trips of five are replaced, a new one is added; one in another part does not win.
    columns = yellow_columns(7, total_amount=[3.0] * 7)
    write_parquet(folder / "part 3.parquet", {c: [v[0], v[1], v[6]] for c, v in columns.items()})
    write_parquet(folder / "part 8.parquet", {c: [v[2]] for c, v in columns.items()})
    land_stream(spark, lake, "yellow", schema, checkpoint).awaitTermination()
    assert written == [("incoming", "overwrite", 3), ("incoming", "append", 6)]
    rows = silver(spark, lake).collect()
    assert sorted(r.total_amount for r in rows) == [3.0, 3.0, 3.0, 5.0, 5.0, 5.0]
    assert sorted((r.total_amount, r.loaded_at == first, r.updated_at == first) for r in rows) == [
        (3.0, False, False), (3.0, True, False), (3.0, True, False), *[(5.0, True, True)] * 3
    ]
    # Places of a closed month are gone, the times of its trips are not.
    close_months(spark, lake, "yellow", ["2024-01"])
    write_parquet(folder / "part 9.parquet", yellow_columns(1, total_amount=[9.0]))
    land_stream(spark, lake, "yellow", schema, checkpoint).awaitTermination()
    assert [r.loaded_at for r in silver(spark, lake).collect() if r.total_amount == 9.0] == [first]


def test_freshness_levels(spark, lake):
    put(lake, "2024-01", yellow_columns(1))
    jobs.run_month(spark, lake, "yellow", "2024-01")
    loaded = silver(spark, lake).first().loaded_at
    zone = timezone.utc

    def status(hours):
        as_of = F.lit(loaded.astimezone(zone) + timedelta(hours=hours))
        return checks.source_freshness(silver(spark, lake), as_of).first().status

    assert [status(h) for h in (1, 36, 37, 72, 73)] == ["pass", "pass", "warn", "warn", "error"]
    assert checks.source_freshness(silver(spark, lake).limit(0), at(0)).first().status == "error"
