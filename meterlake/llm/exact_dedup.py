"""Exact deduplication: group by a 128-bit content hash, compare bytes inside the groups.

Texts are read three times and move only where their hash repeats. Hashes that repeat are
kept as a table; rows with one of them are collapsed map-side to one row per task and text,
so that a class is a hash together with its bytes: a hash shared by different texts splits
into one class per text. The classes are a table of one row per repeated text, joined to the
documents by hash and SHA-256; while small it is broadcast, beyond that a hot hash is one
that adaptive execution can split, since nothing is grouped after the join.

Rows that repeat both the id and the text of the row that stays are told apart by their
number alone: they are counted, and that many rows are made of the count.

Defined cases: a null text equals the empty text; a null id loses against any other id;
rows that repeat both id and text count in the group size, and one of them stays; an
empty table gives no rows; columns other than id and text are never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import checkpointed, fresh, small_enough

# Repeated hashes that are broadcast, some 40 bytes each; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
# Rows that are made of a count at a time.
RUN = 100_000


def content_hash(text: Column) -> Column:
    """128 bits of the text."""
    return F.unhex(F.md5(text.cast("binary")))


def classify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    hash_of: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep`` says which id of a class stays: ``smallest`` or ``largest``.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    hashed = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn(
        "h", hash_of(F.col("text"))
    )
    sha = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha")
    repeated = checkpointed(hashed.groupBy("h").count().filter("count > 1").select("h"))
    repeated = small_enough(repeated, BROADCAST_ROWS)
    # The comparison of bytes: a class is a hash together with its text.
    classes = (
        hashed.join(repeated, "h", "left_semi")
        .groupBy("h", "text")
        .agg(F.count("*").alias("group_size"), best("doc_id").alias("keep_id"))
        .filter("group_size > 1")
    )
    classes = checkpointed(classes.select("h", sha, "group_size", "keep_id"))
    thin = hashed.select("doc_id", "h", sha)
    found = thin.join(small_enough(classes, BROADCAST_ROWS), ["h", "sha"], "left")
    first = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # Classes with several rows that have the id of the one that stays.
    several = (
        found.filter(first & F.col("group_size").isNotNull())
        .groupBy("h", "sha", "keep_id", "group_size")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
    )
    several = checkpointed(several)
    marks = several.select("h", "sha", F.lit(True).alias("several"))
    found = found.join(small_enough(marks, BROADCAST_ROWS), ["h", "sha"], "left")
    single = found.filter(~(first & F.col("group_size").isNotNull() & F.col("several").isNotNull()))
    alone = F.col("group_size").isNull()
    single = single.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | first).alias("kept"),
        "sha",
    )
    # Their rows, made of the count in runs that are dealt out.
    runs = several.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN))))
    runs = runs.repartition("h", "at").withColumn(
        "copy", F.explode(F.sequence(F.col("at"), F.least(F.col("n"), F.col("at") + RUN) - 1))
    )
    again = runs.select(
        F.col("keep_id").alias("doc_id"), "keep_id", "group_size", (F.col("copy") == 0).alias("kept"), "sha"
    )
    return single.unionByName(again).withColumn("sha", F.lower(F.hex("sha"))).withColumnRenamed(
        "sha", "text_sha256"
    )


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    row = fresh(docs, "row_key")
    key = F.struct(
        F.col(id_col).alias("id"),
        F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256).alias("sha"),
    )
    seen = classify(docs, id_col, text_col, keep)
    seen = seen.select(
        F.struct(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha")).alias(row),
        "kept",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("first"),
    )
    seen = checkpointed(seen.filter("not kept"))
    dropped = small_enough(seen.filter("not first").select(row), BROADCAST_ROWS // 4)
    repeated = seen.filter("first").select(row).distinct()
    repeated = small_enough(repeated, BROADCAST_ROWS // 4)
    rows = docs.withColumn(row, key).join(dropped, row, "left_anti")
    once = rows.join(repeated, row, "left_anti")
    again = rows.join(repeated, row, "left_semi").dropDuplicates([row])
    return once.unionByName(again).drop(row)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep="largest")


OP1_SQL = """
select doc_id,
       max(doc_id) over (partition by coalesce(text, '')) as keep_id,
       count(*) over (partition by coalesce(text, '')) as group_size,
       doc_id = max(doc_id) over (partition by coalesce(text, '')) as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents
"""
