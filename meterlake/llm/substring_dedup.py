"""Substring deduplication by sliding spans of sentences.

Every run of ``run`` consecutive sentences is hashed to 128 bits. The least place
(document id, text hash, sentence number) of a hash is its first; hashes that occur once go at once.
Sentences that any other place of a repeated run covers are removed. Runs of fewer than
``min_words`` words (a few repeated exclamations) are not compared. A frequent run leaves each
task as one row before the shuffle; the table of repeated runs is broadcast while it is
small and joined by a shuffle with skew handling beyond.

A sentence ends after ``.``, ``!`` or ``?`` or at a line feed; runs are compared without
the white space around their sentences. A text of fewer sentences is one run. A stretch of
``LONG_WORDS`` words or more without such an end, or of sentences so short that no two
neighbours have ``MIN_WORDS`` words, counts as several sentences: it is cut before words whose hash is the least of their neighbourhood (``REACH`` words to each side), so equal
passages are cut alike whatever stands around them; a piece of over ``MOST_WORDS`` words, as
of words that repeat, is cut every ``MOST_WORDS // 2`` words. A sentence of that length is thus
found between any neighbours.

Not found: repeats that hold no two whole neighbouring sentences (or pieces), such as one
sentence of fewer than ``LONG_WORDS`` words between different neighbours; long stretches of
a script without white space, whose words cannot be told.

Defined cases: null and empty texts have no sentences and stay as they are; rows that share
id and text count as one document, so copies of a row do not remove each other, and rows of
one id, or of none, with different texts are documents of their own; null ids come last; texts are read whole; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import arrow_map, checkpointed, fresh, row_key, slices, small_enough, with_column

RUN = 2
MIN_WORDS = 8
LONG_WORDS = 50  # of a sentence that is cut into pieces
REACH = 4
MOST_WORDS = 32
# Rows of the tables of repeated runs and of removals that are broadcast, some 100 bytes each.
BROADCAST_ROWS = 1_000_000

_SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?]+|\n|$)")
_WORD = re.compile(r"\S+")


def _cuts(words: list[str]) -> list[int]:
    """Numbers of the words before which a long stretch is cut."""
    hashes = np.array(
        [xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64
    )
    around = np.lib.stride_tricks.sliding_window_view(hashes, 2 * REACH + 1)
    # The first of equal least hashes.
    least = np.flatnonzero(around.argmin(axis=1) == REACH) + REACH
    cuts, last = [], 0
    for at in [*least.tolist(), len(words)]:
        if at - last > MOST_WORDS:
            cuts += range(last + MOST_WORDS // 2, at - MOST_WORDS // 4, MOST_WORDS // 2)
        cuts.append(at)
        last = at
    return cuts[:-1]


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Start and end of each sentence, or piece of a long stretch, that is not only white
    space; code points."""
    found = []
    for m in _SENTENCE.finditer(text or ""):
        count = len(m.group().split())
        if count:
            found.append((*m.span(), count))
    pieces, at = [], 0
    while at < len(found):
        end, count = at + 1, found[at][2]
        while end < len(found) and found[end - 1][2] + found[end][2] < MIN_WORDS:
            count += found[end][2]
            end += 1
        if count < LONG_WORDS:
            pieces += [span[:2] for span in found[at:end]]
        else:
            start = found[at][0]
            words = list(_WORD.finditer(text, start, found[end - 1][1]))
            for k in _cuts([w.group() for w in words]):
                pieces.append((start, words[k].start()))
                start = words[k].start()
            pieces.append((start, found[end - 1][1]))
        at = end
    return pieces


def runs(text: str | None, run: int, min_words: int) -> list[tuple[int, bytes]]:
    """Number of the first sentence and hash of each run."""
    parts = [text[a:b].strip().encode("utf-8", "surrogatepass") for a, b in sentences(text)]
    counts = [len(p.split()) for p in parts]
    found = []
    for k in range(max(1, len(parts) - run + 1) if parts else 0):
        if sum(counts[k : k + run]) >= min_words:
            found.append((k, xxhash.xxh3_128_digest(b"\n".join(parts[k : k + run]))))
    return found


def _spans(docs: DataFrame, run: int, min_words: int) -> DataFrame:
    """``doc_id, at, hi, lo``: each run of each document."""
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("at", T.IntegerType()),
            T.StructField("hi", T.LongType()),
            T.StructField("lo", T.LongType()),
        ]
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [runs(t, run, min_words) for t in batch.column("text").to_pylist()]
                owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
                digest = np.frombuffer(b"".join(h for f in found for _, h in f), ">i8")
                digest = digest.astype(np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(owner)),
                        pa.array([k for f in found for k, _ in f], pa.int32()),
                        pa.array(digest[:, 0]),
                        pa.array(digest[:, 1]),
                    ],
                    ["doc_id", "at", "hi", "lo"],
                )

    return arrow_map(docs, make, schema)


def repeated_runs(
    docs: DataFrame,
    run: int = RUN,
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, starts``: by ``row_key``, the numbers of the sentences at which a non-first
    repeated run starts."""
    source = docs.select(
        row_key(docs, id_col, text_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    place = F.struct("doc_id", "at")
    spans = _spans(source, run, min_words).withColumn("place", place)
    firsts = spans.groupBy("hi", "lo").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    firsts = checkpointed(firsts.filter("first <> last").select("hi", "lo", "first"))
    later = spans.join(small_enough(firsts, BROADCAST_ROWS), ["hi", "lo"]).filter("place <> first")
    return later.groupBy("doc_id").agg(F.sort_array(F.collect_set("at")).alias("starts"))


def remove_repeats(
    docs: DataFrame,
    run: int = RUN,
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with the text cut, and ``n_sentences``, ``n_removed`` and ``removed``: spans
    ``start:end`` of the old text (code points, end exclusive), comma-joined."""
    starts = checkpointed(repeated_runs(docs, run, min_words, id_col, text_col))
    starts = small_enough(starts, BROADCAST_ROWS)
    results = ["n_sentences", "n_removed", "removed"]
    docs = docs.drop(*results).withColumn(text_col, F.col(text_col).cast("string"))
    key, where = fresh(docs, "span_id"), fresh(docs, "span_starts")
    starts = starts.select(F.col("doc_id").alias(key), F.col("starts").alias(where))
    keyed = docs.withColumn(key, row_key(docs, id_col, text_col))
    source = keyed.join(starts, key, "left").drop(key)
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("n_sentences", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("removed", T.StringType()),
        ]
    )

    def cut(text: str | None, starts: list[int] | None) -> tuple[str | None, int, int, str]:
        found = sentences(text)
        gone = sorted({k for at in starts or [] for k in range(at, min(at + run, len(found)))})
        if not gone:
            return text, len(found), 0, ""
        kept, end = [], 0
        for k in gone:
            kept.append(text[end : found[k][0]])
            end = found[k][1]
        kept.append(text[end:])
        spans = ",".join(f"{found[k][0]}:{found[k][1]}" for k in gone)
        return "".join(kept), len(found), len(gone), spans

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text_col):
                done = [
                    cut(t, s)
                    for t, s in zip(
                        batch.column(text_col).to_pylist(), batch.column(where).to_pylist(), strict=True
                    )
                ]
                columns = list(zip(*done, strict=True)) or [[], [], [], []]
                batch = batch.drop_columns([where])
                batch = batch.set_column(
                    batch.schema.get_field_index(text_col), text_col, pa.array(columns[0], pa.string())
                )
                for name, values, kind in zip(
                    results, columns[1:], (pa.int64(), pa.int64(), pa.string()), strict=True
                ):
                    batch = with_column(batch, name, pa.array(values, kind))
                yield batch

    return arrow_map(source, make, schema)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_sentences", "n_removed", "removed", "text")
