from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from meterlake.session import SETTINGS  # noqa: E402
from meterlake.sources.tables import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Plans are printed in full for the tests that read them.
        .config("spark.sql.maxMetadataStringLength", "100000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def new_lake(tmp_path: Path) -> Lake:
    source = tmp_path / "source"
    source.mkdir()
    zones = tmp_path / "zones.csv"
    zones.write_text(
        "LocationID,Borough,Zone,service_zone\n"
        "1,EWR,Newark Airport,EWR\n"
        "100,Manhattan,Garment District,Yellow Zone\n"
        '161,Manhattan,"Midtown, Center",Yellow Zone\n'
        "264,Unknown,N/A,\n"
    )
    return Lake(str(tmp_path / "lake"), str(source), str(zones))


@pytest.fixture
def lake(tmp_path) -> Lake:
    return new_lake(tmp_path)


def write_parquet(path: Path | str, columns: dict, **types) -> None:
    """A parquet file from lists; ``types`` gives arrow types where they matter."""
    arrays = {
        name: pa.array(values, types[name]) if name in types else pa.array(values)
        for name, values in columns.items()
    }
    pq.write_table(pa.table(arrays), str(path))


def yellow_columns(rows: int = 1, **changes) -> dict:
    """Raw yellow columns, all rows alike but for the dropoff minute."""
    columns = {
        "VendorID": [1] * rows,
        "tpep_pickup_datetime": ["2024-01-01 10:00:00"] * rows,
        "tpep_dropoff_datetime": [f"2024-01-01 10:{15 + i:02d}:00" for i in range(rows)],
        "passenger_count": [2] * rows,
        "trip_distance": [4.0] * rows,
        "PULocationID": [100] * rows,
        "DOLocationID": [161] * rows,
        "payment_type": [1] * rows,
        "fare_amount": [18.5] * rows,
        "tip_amount": [2.0] * rows,
        "total_amount": [24.0] * rows,
    }
    columns.update(changes)
    return columns


def at(hour: int, minute: int = 0, day: int = 1, month: int = 1) -> datetime:
    return datetime(2024, month, day, hour, minute)
