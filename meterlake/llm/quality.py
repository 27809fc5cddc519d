"""Quality classifier: logistic regression over hashed word n-grams, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

Words are runs between white space. Each is seen twice: as itself, and as its shape (case,
digits and marks, each run of like characters as one). Features are single words, pairs of
words, single shapes, pairs and triples of shapes, and words that repeat the word before.
All are hashed into one table of weights. A feature's value is its share of the document's
features, so a score is a mean of weights and long texts count as short ones do.

The model is trained on a bounded sample (``TRAIN_ROWS`` rows, those of the least hashes of
their ids), in one pass per epoch in that order, and scores every row and whole text.

Defined cases: null and empty texts have no features and get the score of the bias alone;
labels other than 0 and 1 are not learned from; without labels every score is 0.5;
repeated rows give repeated results; an empty table gives no rows; other columns of the
documents are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import arrow_map, slices

TRAIN_ROWS = 6_000
EPOCHS = 2
WIDTH = 1 << 20  # weights
SCALE = 20.0  # of the shares
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1e-4, 1e-4
THRESHOLD = 0.3
REMEMBERED = 200_000
REMEMBERED_CHARS = 48

_RUNS = re.compile(r"[^\W\d_a-z]+|[a-z]+|\d+|(?:\W|_)+")


class Words(dict):
    """Hashes of a word and of its shape, as one number; of the latest words."""

    def __missing__(self, word: str) -> int:
        shape = []
        for run in _RUNS.findall(word):
            head = run[0]
            if head.isdigit():
                shape.append("9")
            elif head.isalpha():
                shape += ["A" if c.isupper() else "a" for c in (run[0], run[-1])]
            else:
                shape.append(run[:3])
        named = re.sub(r"(.)\1+", r"\1", "".join(shape[:12])) + ("+" if len(word) > 1 else "")
        found = zlib.crc32(word.encode("utf-8", "surrogatepass")) << 31 | (
            zlib.crc32(named.encode("utf-8", "surrogatepass")) & 0x7FFFFFFF
        )
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


def features(text: str | None, words: Words) -> np.ndarray:
    """Numbers of the weights of all features, with repeats."""
    found = (text or "").split()
    if not found:
        return np.empty(0, np.int64)
    both = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    word, shape = both >> np.uint64(31), both & np.uint64(0x7FFFFFFF)

    def mixed(kind: int, *parts: np.ndarray) -> np.ndarray:
        code = np.full(len(parts[0]), kind, np.uint64)
        for part in parts:
            code = (code ^ part) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
        return code

    codes = [mixed(1, word), mixed(2, shape)]
    if len(found) > 1:
        codes += [mixed(3, word[:-1], word[1:]), mixed(4, shape[:-1], shape[1:])]
        same = word[:-1] == word[1:]
        codes.append(mixed(6, same.astype(np.uint64)))
    if len(found) > 2:
        codes.append(mixed(5, shape[:-2], shape[1:-1], shape[2:]))
    return (np.concatenate(codes) % np.uint64(WIDTH)).astype(np.int64)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, found: np.ndarray) -> float:
        margin = self.bias
        if len(found):
            margin += SCALE * float(self.weights[found].sum(dtype=np.float64)) / len(found)
        return float(1 / (1 + np.exp(-np.clip(margin, -35, 35))))


def train(rows: list[tuple[str | None, int]], epochs: int = EPOCHS) -> Model:
    """FTRL-proximal over ``rows`` of text and label, in their order."""
    words = Words()
    z, n = np.zeros(WIDTH + 1), np.zeros(WIDTH + 1)  # the last is the bias
    for _ in range(epochs):
        for text, label in rows:
            found = features(text, words)
            at, counts = np.unique(found, return_counts=True)
            at = np.append(at, WIDTH)
            x = np.append(SCALE * counts / max(1, len(found)), 1.0)
            w = _weights(z[at], n[at])
            gradient = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            step = (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - step * w
            n[at] += gradient**2
    w = _weights(z, n)
    return Model(w[:WIDTH].astype(np.float32), float(w[WIDTH]))


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    small = np.abs(z) <= L1
    return np.where(small, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> list[tuple[str | None, int]]:
    """Texts and labels of at most ``rows`` rows of ``labels (doc_id, label)``, in hash order."""
    labels = labels.filter("doc_id is not null and label in (0, 1)").distinct()
    place = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = labels.withColumn("place", place).orderBy("place", "label").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # More than `rows` only where an id repeats.
    found = found.select("place", "label", "text").limit(2 * rows).collect()
    found.sort(key=lambda r: (r["place"], r["label"], r["text"] or ""))
    return [(r["text"], r["label"]) for r in found]


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, score`` for each document."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words = shared.value, Words()
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                found = [model.score(features(t.as_py(), words)) for t in batch.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"]
                )

    return arrow_map(source, run, f"doc_id {kind}, score double")


def held_out(doc_id: Column) -> Column:
    """Documents that the model must not learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.select("doc_id", F.col("quality").alias("label"))
    model = train(sample(docs, labels.filter(~held_out(F.col("doc_id")))))
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
