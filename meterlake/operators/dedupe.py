"""Keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.keys import business_trip_key, key_hash, unsigned_zero
from meterlake.schema import BUSINESS_KEY, KEY_HASH, ROW_NUMBER, TRIP_KEY
from meterlake.sources.tables import cut

# Hashes of eight bytes that are broadcast: some 200 MB at most.
BROADCAST_HASHES = 2_000_000
# Words of 64 bits that stand for more hashes than that, and are broadcast in their place.
FILTER_WORDS = 2_000_000

# The business key with its most selective columns first: sorting compares the first
# column by prefix and looks further only on ties.
_SORT_KEY = ("pickup_datetime", "dropoff_datetime") + tuple(
    c for c in reversed(BUSINESS_KEY) if not c.endswith("datetime")
)


def keep_first(
    trips: DataFrame,
    order_by: Sequence[str] = (ROW_NUMBER,),
    scope: Sequence[str] = (),
    merge_next: bool = False,
) -> DataFrame:
    """The first row in file order of each business key of a source month; nulls are equal.

    A month is loaded by one batch. Where a frame holds several batches of one month,
    ``scope`` names the column that tells them apart.

    ``merge_next`` shuffles by the text key and its hash, which makes the shuffle wider
    but leaves the rows partitioned and sorted as ``upsert.merge`` wants them: a merge
    right after it does not shuffle them again.

    Spark applies the rank limit before the shuffle as well as after it, so however many
    copies a key has, each task sends on at most one of them.
    """
    keys: tuple[str, ...] = (*_SORT_KEY, "source_year_month")
    if merge_next:
        trips = trips.withColumn("business_trip_key", business_trip_key())
        trips = trips.withColumn(KEY_HASH, key_hash())
        keys = (KEY_HASH, *TRIP_KEY)
    copies = Window.partitionBy(*keys, *scope).orderBy(*order_by)
    first = trips.withColumn("_copy", F.row_number().over(copies)).where("_copy = 1").drop("_copy")
    return first if merge_next else first.withColumn("business_trip_key", business_trip_key())


def repeated_hashes(hashes: DataFrame) -> DataFrame:
    """Values of the one column of ``hashes`` that occur more than once.

    They are shuffled before they are counted: eight bytes a row, and no task holds more than
    its share of the different ones, however much it reads.
    """
    name = hashes.columns[0]
    return hashes.repartition(name).groupBy(name).count().where("count > 1").select(name)


def repeated_table(hashes: DataFrame, folder: str) -> DataFrame:
    """The repeated ones of ``hashes`` as a table in ``folder`` that can be broadcast.

    Beyond ``BROADCAST_HASHES`` of them it has up to ``FILTER_WORDS`` words of 64 bits, with a
    bit set for each: some rows that stand alone then count as repeated, but no repeated one is
    missed, and the broadcast does not grow with the rows.
    """
    repeated = cut(repeated_hashes(hashes.toDF("_repeated")), folder, "repeated_keys")
    if repeated.count() <= BROADCAST_HASHES:
        return repeated
    word, bit = _place(F.col("_repeated"))
    bits = repeated.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    return cut(bits, folder, "repeated_bits")


def _place(value: Column) -> tuple[Column, Column]:
    """Word and bit of a hash among ``FILTER_WORDS`` words of 64 bits."""
    place = F.pmod(value, F.lit(FILTER_WORDS * 64))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    return F.shiftright(place, 6), bit


def split_repeated(
    rows: DataFrame, hash_of: Column, repeated: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose hash is not in ``repeated`` (see ``repeated_table``), and the others;
    no row is moved."""
    hashed = rows.withColumn("_hash", hash_of)
    if "_bits" in repeated.columns:
        word, bit = _place(F.col("_hash"))
        found = (word == F.col("_word")) & (F.col("_bits").bitwiseAND(bit) != 0)
    else:
        found = F.col("_hash") == F.col("_repeated")
    repeated = F.broadcast(repeated)
    alone = hashed.join(repeated, found, "left_anti").drop("_hash")
    return alone, hashed.join(repeated, found, "left_semi").drop("_hash")


def keep_first_narrow(
    trips: DataFrame,
    folder: str,
    order_by: Sequence[str] = (ROW_NUMBER,),
    scope: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """``keep_first`` that shuffles and sorts only rows whose key may be repeated.

    Hashes of the keys are counted first and those that repeat are kept in ``folder``. Equal
    keys have equal hashes, so a row whose hash stands alone is the only one of its key and
    stays where it is; the others are compared by key. With ``cluster_by``, rows equal in it
    come together, before texts make them wider.
    """
    keys = (*_SORT_KEY, "source_year_month", *scope)
    key = F.xxhash64(*[unsigned_zero(c) for c in keys])
    alone, again = split_repeated(trips, key, repeated_table(trips.select(key), folder))
    first = alone.unionByName(keep_first(again, order_by, scope).drop("business_trip_key"))
    if cluster_by:
        first = first.hint("rebalance", *cluster_by)
    return first.withColumn("business_trip_key", business_trip_key())
