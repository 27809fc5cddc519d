"""Helpers the operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path
from uuid import uuid4

import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a local session that
    has none gets a temporary one, a cluster must name it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        found = context._jsc.sc().getCheckpointDir()
        if found.isDefined():
            return found.get().rstrip("/")
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", folder)
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so a lost executor costs nothing."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    with short_batches(df.sparkSession):
        return df.checkpoint(eager=True)


def written(df: DataFrame, stem: str) -> DataFrame:
    """``df`` as a table of its own in the shared folder: encoded by column, so smaller than a
    checkpoint, and of a size that Spark knows."""
    place = f"{shared_dir(df.sparkSession)}/{stem}-{uuid4().hex}"
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


@contextmanager
def short_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Fewer rows of text at a time between executors and their workers, for what runs now."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_enough(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which is cheap to count, with the hint to broadcast it if it has at most ``rows``."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, as ``--py-files`` does, once an application."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(application)


def _trim() -> None:
    """Give freed memory back to the system, where the C library can."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass


def arrow_map(
    df: DataFrame,
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: object,
) -> DataFrame:
    """``mapInArrow`` by workers that have this package and, at a task's end, give back the
    memory of its batches: they go on to other work."""
    ship(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            _trim()

    return df.mapInArrow(task, schema)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name, n = stem, 0
    while name in taken:
        n += 1
        name = f"{stem}{n}"
    return name


def row_key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """A key of a row: its id, null last, and its text; rows that share both are one."""
    ident, text = F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return F.struct(
        ident.isNull().alias("no_id"),
        ident.alias("id"),
        F.unhex(F.md5(text.cast("binary"))).alias("text"),
    )


def without_rows(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` but the rows whose ``row_key`` is in the one column of ``keys``. While these
    are few they are broadcast, and no text moves."""
    name = fresh(docs, "row_key")
    gone = keys.select(F.col(keys.columns[0]).alias(name)).distinct()
    gone = small_enough(checkpointed(gone), 500_000)
    rows = docs.withColumn(name, row_key(docs, id_col, text_col))
    return rows.join(gone, name, "left_anti").drop(name)


_SENT: dict[tuple, Broadcast] = {}


def sent(spark: SparkSession, key: tuple, make: Callable[[], object]) -> Broadcast:
    """A broadcast that an application makes once for a key: workers keep what they load of
    it, so making it anew for each query would add to their memory."""
    key = (spark.sparkContext.applicationId, *key)
    if key not in _SENT:
        _SENT[key] = spark.sparkContext.broadcast(make())
    return _SENT[key]


@contextmanager
def no_cycles() -> Iterator[None]:
    """No search for unreachable cycles meanwhile: work on many small objects makes none."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose ``column`` holds about ``most`` bytes, so long rows go few at a time."""
    if not batch.num_rows:
        return
    rows = max(1, int(batch.num_rows * most // max(1, batch.column(column).nbytes)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, name])
