"""Tables of the lake (A5-A7, A11) and small tables cut out of a plan."""

from __future__ import annotations

from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meterlake import schema as S

# Partitions that a task writes side by side; it sorts the rows of further ones.
OPEN_FILES = 32
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
# Shuffle files of a write go when it ends, not with a later garbage collection of the driver.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class LakeTable:
    """A parquet table at a path, optionally partitioned.

    A known schema is always applied on read: columns added to it later read as null
    from older files and dropped ones are not read (I5).
    """

    path: str
    schema: T.StructType | None = None
    partition_by: tuple[str, ...] = ()

    def read(self, spark: SparkSession) -> DataFrame:
        reader = spark.read if self.schema is None else spark.read.schema(self.schema)
        df = reader.parquet(self.path)
        return df if self.schema is None else df.select(*self.schema.names)

    def exists(self, spark: SparkSession) -> bool:
        try:
            spark.read.schema(self.schema or T.StructType()).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    def create(self, spark: SparkSession) -> None:
        """Write an empty table unless there already is one."""
        spark.createDataFrame([], self.schema).write.mode("ignore").partitionBy(
            *self.partition_by
        ).parquet(self.path)

    def append(self, df: DataFrame) -> None:
        self._write(df, "append")

    def rewrite(self, df: DataFrame) -> None:
        self._write(df, "overwrite")

    def overwrite_partitions(self, df: DataFrame) -> None:
        """Replace only the partitions present in ``df``."""
        self._write(df, "overwrite", partitionOverwriteMode="dynamic")

    def _write(self, df: DataFrame, mode: str, **options: str) -> None:
        """Trips have keys of long text, so tables are compressed well. A task keeps a file
        open for each of up to ``OPEN_FILES`` partitions, so its rows, in full width, are not
        sorted by partition first, which spills."""
        conf = df.sparkSession.conf
        wanted = {_CLEAN_UP: "true"}
        if self.partition_by:
            wanted[_OPEN_FILES] = str(OPEN_FILES)
        before = {name: conf.get(name, None) for name in wanted}
        for name, value in wanted.items():
            conf.set(name, value)
        try:
            writer = df.write.mode(mode).options(compression="zstd", **options)
            writer.partitionBy(*self.partition_by).parquet(self.path)
        finally:
            for name, value in before.items():
                if value is None:
                    conf.unset(name)
                else:
                    conf.set(name, value)


@dataclass(frozen=True)
class Lake:
    """Where everything lives, under one root on shared storage."""

    root: str
    source_base: str = ""
    zone_csv: str = ""
    ledger: LakeTable = field(init=False)
    zones: LakeTable = field(init=False)
    silver: LakeTable = field(init=False)
    fact: LakeTable = field(init=False)

    def __post_init__(self) -> None:
        put = object.__setattr__
        put(self, "ledger", LakeTable(self.path("ops/batch_runs"), S.LEDGER_EVENTS))
        put(self, "zones", LakeTable(self.path("raw/taxi_zone_lookup"), S.ZONES))
        put(self, "silver", LakeTable(self.path("silver/taxi_trips"), S.SILVER, S.TRIP_PARTITIONS))
        put(self, "fact", LakeTable(self.path("gold/fct_taxi_trips"), S.FACT, S.TRIP_PARTITIONS))

    def path(self, relative: str) -> str:
        return f"{self.root.rstrip('/')}/{relative}"

    def gold(self, name: str) -> LakeTable:
        """A dimension, mart or monitoring table; these are rebuilt whole."""
        return LakeTable(self.path(f"gold/{name}"))


def working_dir(spark: SparkSession, default: str) -> str:
    """The shared folder for intermediate tables: the one the cluster names, else ``default``."""
    return spark.conf.get("spark.checkpoint.dir", None) or default


def cut(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` to its own table in ``folder`` and read it back.

    The plan above it then starts from files, so lost executors do not replay the plan
    below, and Spark knows the real size: a side under the broadcast threshold is
    broadcast and a larger one is joined by sort-merge with skew handling.
    """
    table = LakeTable(f"{folder.rstrip('/')}/{name}-{uuid4().hex}", df.schema)
    table.rewrite(df)
    return table.read(df.sparkSession)
