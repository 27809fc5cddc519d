"""Small tables that every operator must take, and the rows of test tables."""

from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.001"

LONG = "Long words of a very long text that has no end. " * 4000

DOCS = [
    (1, "The same text, twice over and over again.", "en", "src0", 1),
    (2, "The same text, twice over and over again.", "en", "src0", 1),
    (2, "The same text, twice over and over again.", "en", "src0", 1),
    (3, None, None, None, None),
    (4, "", "en", "src0", 0),
    (None, "no id here", "en", None, 3),
    (None, None, None, None, None),
    (5, LONG, "en", "src1", len(LONG)),
    (6, "12345 !!!", "en", "src1", 9),
    (7, "Über allen Gipfeln ist Ruh, in allen Wipfeln", "de", "src1", 40),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Columns whose names operators use inside or return.
CLASHES = [
    "h", "sha", "keep_id", "group_size", "kept", "lanes", "node", "bucket", "component_id",
    "segment", "term", "positions", "words", "score", "lang_pred", "label", "ids", "decoded",
    "n_tokens", "base", "added", "n_sentences", "n_removed", "removed", "gone_id", "row_key",
    "span_id", "span_starts", "place", "text_sha256",
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


@pytest.fixture(scope="session")
def crowded(docs):
    """``docs`` with further columns of clashing names."""
    from pyspark.sql import functions as F

    return docs.withColumns({name: F.lit("x") for name in CLASHES})


def rows(sql: str) -> list[tuple]:
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con.execute(sql).fetchall()


def ordered(found) -> list[tuple]:
    """Rows in an order that nulls do not break."""
    plain = [tuple(tuple(x) if isinstance(x, list) else x for x in row) for row in found]
    return sorted(plain, key=lambda row: [(x is None, str(type(x)), x if x is not None else 0) for x in row])
