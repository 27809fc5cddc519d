"""Benchmark decontamination by a distributed positional inverted index.

**Index.** Documents are dealt into segments of a bounded number of words. A segment has,
for each of its terms, the ascending positions at which it stands; the words of its
documents are numbered through, with a gap between documents. Postings of all terms are
stored in the shared folder as rows ``(segment, term, positions)``, sorted by term within
a segment, with a table of the documents' places. A segment is made by one task from its
own rows, so a task that is run again makes the same.

**Search.** Only postings of terms that the queries have are read back; a segment's go to
one group of bounded size. For each query, terms are taken from the rarest (by the
postings of the whole corpus) to the most frequent, and the lists, each moved back by its
term's offset, are intersected until none is left or all are done: what is left are the
exact places of the phrase. A proximity query keeps the places of its rarest term around
which every other term has a place within the distance.

Queries are a stated set against all rows: they are taken in blocks of bounded size, and
every block is searched in all segments.

Defined cases: a null or empty text has no words; an item without words is no query; an
item of fewer words than a window is one window; items with equal texts are all reported;
a null item id is left out of the list of ids, but its windows count as hits; repeated
rows of documents are separate documents; a very long text is a segment of its own; empty
tables give no rows (documents) or no hits (benchmark); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import (
    arrow_map,
    checkpointed,
    row_key,
    shared_dir,
    ship,
    short_batches,
    without_rows,
)

# Words of a segment, but for a document that alone has more.
SEGMENT_WORDS = 400_000
# Characters of benchmark text in one block of queries.
QUERY_CHARS = 8_000_000
# Empty places between documents, so that no phrase or neighbourhood spans two.
GAP = 1_000

# Bytes other than digits, a-z and those of non-ASCII characters part words.
_PARTS = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8, A-Z as a-z: runs of digits, letters and non-ASCII."""
    if not text:
        return []
    return text.encode("utf-8", "surrogatepass").lower().translate(_PARTS).split()


# -- index


@dataclass(frozen=True)
class Index:
    """``documents``: segment, place, id and first position of each document, words;
    ``postings``: segment, term, positions."""

    documents: DataFrame
    postings: DataFrame


_SCHEMA = (
    "kind string, segment bigint, doc_id {id}, first int, words int, "
    "term binary, positions array<int>"
)


def numbered(words: list[bytes], numbers: dict[bytes, int]) -> np.ndarray:
    """``words`` as their ``numbers``, in which new ones are entered."""
    number = numbers.setdefault
    return np.fromiter((number(w, len(numbers)) for w in words), np.int32, len(words))


def _segment(
    segment: int,
    ids: pa.Array,
    words: list[np.ndarray],
    numbers: dict[bytes, int],
    schema: pa.Schema,
) -> Iterator[pa.RecordBatch]:
    """Rows of a segment; ``words`` are those of its documents as ``numbers`` has them."""
    counts = np.array([len(w) for w in words], np.int64)
    firsts = np.cumsum(np.r_[0, counts[:-1] + GAP]) if len(counts) else counts
    n = len(counts)
    empty = pa.nulls(n, pa.list_(pa.int32()))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(["documents"] * n),
            pa.array(np.full(n, segment)),
            ids,
            pa.array(firsts, pa.int32()),
            pa.array(counts, pa.int32()),
            pa.nulls(n, pa.binary()),
            empty,
        ],
        schema=schema,
    )
    terms = np.concatenate(words) if words else np.empty(0, np.int32)
    places = np.arange(len(terms), dtype=np.int32)
    places += np.repeat((firsts - np.cumsum(np.r_[0, counts[:-1]])).astype(np.int32), counts)
    order = np.argsort(terms, kind="stable")
    starts = np.searchsorted(terms[order], np.arange(len(numbers) + 1, dtype=np.int32))
    names = pa.array(list(numbers), pa.binary())
    lists = pa.ListArray.from_arrays(
        pa.array(starts, pa.int32()), pa.array(places[order], pa.int32())
    )
    by_name = pa.compute.sort_indices(names)
    names, lists, n = names.take(by_name), lists.take(by_name), len(names)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(["postings"] * n),
            pa.array(np.full(n, segment)),
            pa.nulls(n, ids.type),
            pa.nulls(n, pa.int32()),
            pa.nulls(n, pa.int32()),
            names,
            lists,
        ],
        schema=schema,
    )


def build_index(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    segment_words: int = SEGMENT_WORDS,
) -> Index:
    """Write the index of all words of all texts to the shared folder."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = _SCHEMA.format(id=source.schema["doc_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        ids, words, size = [], [], 0
        # Words are kept as numbers, four bytes each.
        numbers: dict[bytes, int] = {}

        def filled() -> Iterator[pa.RecordBatch]:
            kind = batch.schema.field("doc_id").type
            types = pa.schema(
                [
                    ("kind", pa.string()),
                    ("segment", pa.int64()),
                    ("doc_id", kind),
                    ("first", pa.int32()),
                    ("words", pa.int32()),
                    ("term", pa.binary()),
                    ("positions", pa.list_(pa.int32())),
                ]
            )
            return _segment(segment, pa.array(ids, kind), words, numbers, types)

        for batch in batches:
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text"), strict=True
            ):
                found = words_of(text.as_py())
                if ids and size + len(found) + GAP > segment_words:
                    yield from filled()
                    segment += 1
                    ids, words, size, numbers = [], [], 0, {}
                ids.append(doc_id)
                words.append(numbered(found, numbers))
                size += len(found) + GAP
        if ids:
            yield from filled()

    path = f"{shared_dir(spark)}/index-{uuid4().hex}"
    # Rows of both kinds in the order they are made: no sort, and columns of the other kind
    # are null, so a scan of one kind reads little of the other.
    with short_batches(spark, 250):
        arrow_map(source, run, schema).write.parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    return Index(
        stored.filter("kind = 'documents'").select("segment", "doc_id", "first", "words"),
        stored.filter("kind = 'postings'").select("segment", "term", "positions"),
    )


# -- search


@dataclass(frozen=True)
class Phrase:
    """``words`` in a row; with ``within``, each within so many places of the rarest one."""

    words: tuple[bytes, ...]
    within: int | None = None


def places(
    postings: dict[bytes, np.ndarray], phrase: Phrase, rank: dict[bytes, int]
) -> np.ndarray:
    """First positions of the phrase's occurrences, or those of the rarest term for a
    proximity query. ``postings`` are those of one segment."""
    order = sorted(range(len(phrase.words)), key=lambda k: rank.get(phrase.words[k], 0))
    left: np.ndarray | None = None
    for k in order:
        found = postings.get(phrase.words[k])
        if found is None:
            return np.empty(0, np.int32)
        if left is None:
            left = found - k if phrase.within is None else found
        elif phrase.within is None:
            at = np.searchsorted(found, left + k)
            at[at == len(found)] = len(found) - 1
            left = left[found[at] == left + k]
        else:
            at = np.searchsorted(found, left - phrase.within)
            near = at < len(found)
            near[near] = found[at[near]] <= left[near] + phrase.within
            left = left[near]
        if not len(left):
            break
    return left if left is not None else np.empty(0, np.int32)


def search(
    index: Index, queries: list[tuple[int, Phrase]]
) -> DataFrame:
    """``segment, query, position, length`` of each occurrence of ``queries``, a block of
    bounded size of numbered phrases."""
    spark = index.postings.sparkSession
    ship(spark)
    terms = sorted({w for _, phrase in queries for w in phrase.words})
    wanted = spark.createDataFrame(pd.DataFrame({"term": terms}), "term binary")
    found = index.postings.join(F.broadcast(wanted), "term")
    counts = found.groupBy("term").agg(F.sum(F.size("positions")).alias("n")).collect()
    frequency = {bytes(r["term"]): r["n"] for r in counts}
    ordered = sorted(frequency, key=lambda t: (frequency[t], t))
    rank = {t: k for k, t in enumerate(ordered)}
    # A query with a term that no document has is nowhere.
    live = [(q, p) for q, p in queries if all(w in rank for w in p.words)]
    shared = spark.sparkContext.broadcast((live, rank))

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        live, rank = shared.value
        lists = rows.column("positions").combine_chunks()
        values, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        postings = {
            t: values[ends[k] : ends[k + 1]] for k, t in enumerate(rows.column("term").to_pylist())
        }
        query, position, length = [], [], []
        for q, phrase in live:
            at = places(postings, phrase, rank)
            if len(at):
                query.append(np.full(len(at), q, np.int64))
                position.append(at)
                length.append(np.full(len(at), len(phrase.words), np.int32))
        none = [np.empty(0, np.int32)]
        position = np.concatenate(position or none)
        return pa.table(
            {
                "segment": pa.array(np.full(len(position), key[0].as_py()), pa.int64()),
                "query": pa.array(np.concatenate(query or none), pa.int64()),
                "position": pa.array(position, pa.int32()),
                "length": pa.array(np.concatenate(length or none), pa.int32()),
            }
        )

    return found.groupBy("segment").applyInArrow(
        run, "segment bigint, query bigint, position int, length int"
    )


# -- decontamination


def windows(words: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    """Runs of ``size`` words; of fewer words, but some, the whole run."""
    if not words:
        return []
    return [tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]


def _blocks(items: DataFrame) -> Iterable[list]:
    """Items in blocks of bounded size, on the driver one block at a time."""
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = 1 + total // QUERY_CHARS
    for k in range(count):
        part = items if count == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        yield part.collect()


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, item_ids, contaminated``.

    ``n_hit`` counts words inside any occurrence of a window of any item, ``item_ids`` are
    the items that have one, sorted as strings.
    """
    index = build_index(docs, id_col, text_col)
    return _per_document(index, _hits(index, items, window, item_col, item_text_col))


def _hits(
    index: Index, items: DataFrame, window: int, item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``segment, position, length, item_ids`` of each place of a window of ``items``."""
    spark = index.documents.sparkSession
    items = items.select(
        F.col(item_col).cast("string").alias("item_id"),
        F.col(item_text_col).cast("string").alias("text"),
    )
    hits = None
    for block in _blocks(items):
        numbers: dict[tuple[bytes, ...], int] = {}
        owners: list[tuple[int, str]] = []
        for row in block:
            for w in windows(words_of(row["text"]), window):
                owners.append((numbers.setdefault(w, len(numbers)), row["item_id"]))
        if not numbers:
            continue
        found = search(index, [(q, Phrase(w)) for w, q in numbers.items()])
        owned = pd.DataFrame(sorted(set(owners), key=str), columns=["query", "item_id"])
        owned = spark.createDataFrame(owned, "query bigint, item_id string")
        owned = owned.groupBy("query").agg(F.collect_set("item_id").alias("item_ids"))
        part = found.join(F.broadcast(owned), "query").select(
            "segment", "position", "length", "item_ids"
        )
        hits = part if hits is None else hits.unionByName(part)
    if hits is None:
        hits = spark.createDataFrame(
            [], "segment bigint, position int, length int, item_ids array<string>"
        )
    return hits


def _per_document(index: Index, hits: DataFrame) -> DataFrame:
    """Hits of a segment meet its documents; both are of bounded size."""
    spark = index.documents.sparkSession
    ship(spark)
    kind = index.documents.schema["doc_id"].dataType.simpleString()

    def run(docs: pa.Table, hits: pa.Table) -> pa.Table:
        docs = docs.sort_by("first")
        firsts, words = docs.column("first").to_numpy(), docs.column("words").to_numpy()
        position, length = hits.column("position").to_numpy(), hits.column("length").to_numpy()
        n_hit = np.zeros(len(firsts), np.int64)
        item_ids: list[list[str]] = [[] for _ in firsts]
        if len(position):
            edge = np.zeros(int(firsts[-1]) + int(words[-1]) + 2, np.int32)
            np.add.at(edge, position, 1)
            np.add.at(edge, position + length, -1)
            covered = np.r_[0, np.cumsum(np.cumsum(edge) > 0)]
            n_hit = covered[firsts + words] - covered[firsts]
            owner = np.searchsorted(firsts, position, side="right") - 1
            sets: dict[int, set[str]] = {}
            for doc, ids in zip(owner.tolist(), hits.column("item_ids").to_pylist(), strict=True):
                sets.setdefault(doc, set()).update(ids)
            for doc, ids in sets.items():
                item_ids[doc] = sorted(ids)
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "n_words": pa.array(words, pa.int64()),
                "n_hit": pa.array(n_hit, pa.int64()),
                "item_ids": pa.array(item_ids, pa.list_(pa.string())),
            }
        )

    grouped = index.documents.groupBy("segment").cogroup(hits.groupBy("segment"))
    found = grouped.applyInArrow(
        run, f"doc_id {kind}, n_words bigint, n_hit bigint, item_ids array<string>"
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        "item_ids",
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    short_share: float = 0.0,
) -> DataFrame:
    """The rows of ``docs`` without any window of ``items``. Items of fewer words than a window
    count only where they make up at least ``short_share`` of a document's words."""
    keyed = docs.select(row_key(docs, id_col, text_col).alias("doc_id"), F.col(text_col).alias("text"))
    index = build_index(keyed)
    hits = _hits(index, items, window)
    if short_share > 0:
        hits = checkpointed(hits)
        whole = _per_document(index, hits.filter(F.col("length") >= window)).filter("contaminated")
        bad = whole.select("doc_id")
        short = hits.filter(F.col("length") < window)
        if not short.isEmpty():
            share = F.col("n_hit") >= short_share * F.col("n_words")
            filled = _per_document(index, short).filter("contaminated").filter(share)
            bad = bad.unionByName(filled.select("doc_id"))
    else:
        bad = _per_document(index, hits).filter("contaminated").select("doc_id")
    return without_rows(docs, bad, id_col, text_col)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )
