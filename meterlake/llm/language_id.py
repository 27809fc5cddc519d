"""Language identification by string kernels.

The kernel of two texts is the number of character n-grams (1 to 3, lower case) that both
have, over the root of the product of how many each has: a blended-spectrum presence
kernel. Kernel ridge regression, one language against the rest, is fitted on a Nyström
approximation: landmarks are a few documents of each language, and coefficients ``a``
solve ``(C'C + r n W) a = C'Y`` with ``C`` the kernel of training texts and landmarks and
``W`` that of the landmarks. N-grams that no landmark has count in the norm of a text, so a
text that is mostly foreign scores low.

The kernel is linear in the presence bits, so landmarks and coefficients are multiplied
once into a matrix of n-grams by languages; a batch of texts is scored by one product.
An n-gram is a number of 21 bits for each code point, so any alphabet is told apart; a
hash table leads from the numbers of the landmarks' n-grams to their columns.

The model is fitted on a bounded sample (``PER_LANGUAGE`` texts of each language, those of
the least hashes of id and text; rows that repeat both count once) and scores every row and whole text.

Defined cases: ``und`` with score 0 for a null text, for one without a letter, and for all
if there is nothing to learn from; a text without a known n-gram gets the first language
with score 0; of equal outputs the first language in order; repeated rows give repeated
results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterlake.llm.common import arrow_map
from meterlake.llm.lockstep import Lookup

PER_LANGUAGE = 400
LANDMARKS = 60  # of each language
RIDGE = 1e-3
BATCH = 256  # texts of one product, fewer where the matrix would exceed CELLS
CELLS = 4 << 20
UNKNOWN = "und"
# Score below which no learned language fits. Of 2,499 held-out texts of sf0.1 the least has
# 0.13; foreign sentences with one word of a learned language have 0.02 to 0.11.
LEAST = 0.12


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # numbers of the landmarks' n-grams, in order of their columns
    weights: np.ndarray  # columns by languages

    def columns(self) -> Lookup:
        """The columns by n-gram; a worker keeps those of one model."""
        key = self.grams.tobytes()
        if key not in _COLUMNS:
            _COLUMNS.clear()
            table = Lookup(len(self.grams))
            table.put(self.grams, np.arange(len(self.grams), dtype=np.int32))
            _COLUMNS[key] = table
        return _COLUMNS[key]

    def rows(self) -> int:
        """How many texts a product takes."""
        return max(1, min(BATCH, CELLS // max(1, len(self.grams))))


_COLUMNS: dict[bytes, Lookup] = {}


def _grams(text: str) -> np.ndarray:
    """The numbers of the text's distinct n-grams."""
    one = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
    two = one[:-1] << 21 | one[1:]
    three = two[:-1] << 21 | one[2:]
    every = np.sort(np.concatenate([one, two, three]))
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    return every[new]


def _matrix(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Presence bits, a column for each n-gram of the landmarks, and the texts' norms."""
    grams = [_grams(text) for text in texts]
    sizes = np.fromiter(map(len, grams), np.int64, len(grams))
    column = model.columns().get(np.concatenate(grams)) if grams else np.zeros(0, np.int32)
    row = np.repeat(np.arange(len(grams)), sizes)
    bits = np.zeros((len(texts), len(model.grams)), np.float32)
    bits[row[column >= 0], column[column >= 0]] = 1
    return bits, np.sqrt(np.maximum(sizes, 1))[:, None]


def fit(samples: list[tuple[str, str]]) -> Model | None:
    """``samples`` are texts and languages in a stable order; the first of each language are
    the landmarks."""
    samples = [(t, lang) for t, lang in samples if t]
    languages = sorted({lang for _, lang in samples})
    if not languages:
        return None
    marks = [
        t for lang in languages for t in [t for t, other in samples if other == lang][:LANDMARKS]
    ]
    # Every n-gram of a landmark gets a column.
    grams = np.unique(np.concatenate([_grams(text) for text in marks]))
    model = Model(languages, grams, np.empty(0))
    bits, norms = _matrix(marks, model)
    landmarks = (bits / norms).astype(np.float64)
    own = landmarks @ landmarks.T
    gram = RIDGE * len(samples) * (own + 1e-6 * np.eye(len(own)))
    target = np.zeros((len(own), len(languages)))
    for at in range(0, len(samples), model.rows()):
        part = samples[at : at + model.rows()]
        bits, norms = _matrix([t for t, _ in part], model)
        kernel = bits / norms @ landmarks.T
        answers = np.array([[lang == other for other in languages] for _, lang in part], float)
        gram += kernel.T @ kernel
        target += kernel.T @ answers
    model.weights = (landmarks.T @ np.linalg.solve(gram, target)).astype(np.float32)
    return model


def sample(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, str]]:
    """Texts and languages of ``labelled (doc_id, text, lang)``: of each language those of the
    least hashes, at most ``per_language``; with the hashes' order."""
    place = F.xxhash64(F.col("doc_id").cast("string"), F.col("text"))
    # Different rows, nearly: copies of one must not hide that a language has few others.
    different = labelled.groupBy("lang").agg(F.approx_count_distinct(place).alias("n"))
    counts = {r["lang"]: r["n"] for r in different.collect()}
    if not counts:
        return []
    # A share that gives some more than enough of each language reaches the driver.
    shares = F.create_map(
        *(
            F.lit(x)
            for lang, n in counts.items()
            for x in (lang, 1.0 if n <= 3 * per_language else 1.5 * per_language / n)
        )
    )
    share = F.pmod(place, F.lit(1 << 20)) / float(1 << 20)
    few = labelled.withColumn("place", place).filter(share < F.element_at(shares, F.col("lang")))
    # One of equal places, combined before the shuffle; then the least of each language.
    few = few.groupBy("lang", "place").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    rows = few.withColumn("rank", rank).filter(F.col("rank") <= per_language)
    rows = rows.select("lang", "place", "text").collect()
    rows.sort(key=lambda r: (r["place"], r["text"] or ""))
    return [(r["text"] or "", r["lang"]) for r in rows]


def predict(texts: list[str | None], model: Model | None) -> tuple[list[str], np.ndarray]:
    """Languages and scores of a batch of texts."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    told = [k for k, t in enumerate(texts) if t and any(map(str.isalpha, t))]
    step = model.rows() if model is not None else 1
    for at in range(0, len(told) if model is not None else 0, step):
        part = told[at : at + step]
        bits, norms = _matrix([texts[k] for k in part], model)
        out = bits @ model.weights / norms
        best = out.argmax(axis=1)
        scores[part] = np.clip(out[np.arange(len(part)), best], 0, 1)
        for k, b in zip(part, best.tolist(), strict=True):
            names[k] = model.languages[b]
    return names, scores


def identify(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score`` for each document."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                names, scores = predict(batch.column("text").to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)],
                    ["doc_id", "lang_pred", "score"],
                )

    return arrow_map(source, run, f"doc_id {kind}, lang_pred string, score double")


def keep_identified(
    docs: DataFrame, model: Model | None, least: float = LEAST, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of at least ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                names, scores = predict(batch.column(text_col).to_pylist(), shared.value)
                known = np.array([name != UNKNOWN for name in names], bool)
                yield batch.filter(pa.array(known & (scores >= least)))

    return arrow_map(docs, run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """Documents that the model must not learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame) -> Model | None:
    """Fit on ``docs (doc_id, text, lang)`` but those held out."""
    labelled = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    return fit(sample(labelled.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs, learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
