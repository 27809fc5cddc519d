"""Text keys: business key (B8), row fingerprint (B9), surrogate key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.schema import BUSINESS_KEY, FINGERPRINT, TRIP_KEY


def joined_text(columns: Iterable[str | Column], null_text: str) -> Column:
    """Columns as text joined by ``|``, with ``null_text`` in place of nulls."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit(null_text)) for c in parts])


def unsigned_zero(name: str) -> Column:
    """Minus zero counts as zero in a key, as it does in a comparison."""
    return F.col(name) + F.lit(0.0) if name == "passenger_count" else F.col(name)


def business_trip_key() -> Column:
    """Equal texts if and only if all key columns are equal, nulls being equal."""
    return joined_text([unsigned_zero(c) for c in BUSINESS_KEY], "")


def row_fingerprint() -> Column:
    return joined_text([unsigned_zero(c) for c in FINGERPRINT], "")


def key_hash() -> Column:
    """Leads the columns that trips are shuffled and sorted on.

    Business keys begin with long common texts; a sort that compares the hash first
    decides on its eight-byte prefix and reads the text only for equal hashes.
    """
    return F.xxhash64(*TRIP_KEY)


def surrogate_key(*columns: str | Column) -> Column:
    """md5 of the joined text; the null marker keeps null apart from empty text."""
    return F.md5(joined_text(columns, "_dbt_null_"))
