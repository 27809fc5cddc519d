"""Compare all or named queries with DuckDB: python tests/run_oracle.py <sf_dir> [name ...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

from tests.compare import connect, differences  # noqa: E402


def main() -> None:
    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles = connect(sf_dir), entry.oracle_sql()
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            if name in oracles:
                verdict = differences(df, connection, oracles[name]) or "ok"
            else:
                verdict = f"{df.count()} rows, no SQL"
        except Exception as error:
            traceback.print_exc(limit=3)
            verdict = f"error {str(error)[:600]}"
        print(f"{name:32s} {time.time() - start:6.1f}s {verdict}", flush=True)


if __name__ == "__main__":
    main()
