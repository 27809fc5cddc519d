"""Token counts of a unigram tokenizer by count-only Viterbi.

An Aho-Corasick automaton over the vocabulary lists the pieces that end at each place of a
word. Dynamic programming carries, for each place, the best score of a path to it and the
number of its pieces; no path is stored. Ties are those of the ``tokenizers`` library's
Unigram model: paths are extended from left to right and only a greater score replaces
one, so of equal scores that with the longest last piece stays. A character that no piece
matches alone costs ten less than the least score; unknown characters in a row are one
piece, or their bytes where the vocabulary has a piece for each byte.

The vocabulary and scores are those of a sentencepiece file. As in the library's Metaspace
splitting, a space starts a word and becomes its first character, and a text starts with
one. Words repeat, so each worker remembers the counts of a bounded number of them.

Defined cases: null and empty texts have no tokens; texts are read whole; repeated rows
give repeated results; an empty table gives no rows; a column that clashes with a result
is replaced, others are kept.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import arrow_map, sent, slices, with_column

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 400_000
REMEMBERED_CHARS = 48


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, by id."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter(dict):
    """Token counts by word."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        self.find = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.find.add_word(piece, (len(piece), score))
        self.find.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        names = {piece for piece, _ in pieces}
        self.by_bytes = all(f"<0x{b:02X}>" in names for b in range(256))

    def __missing__(self, word: str) -> int:
        found = self.count_word(word)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found

    def count_word(self, word: str) -> int:
        # best[i], count[i]: score and pieces of the best path to i; open[i]: it ends unknown.
        n = len(word)
        best: list[float | None] = [0.0] + [None] * n
        count, unknown = [0] * (n + 1), [False] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for end, (length, score) in self.find.iter(word):
            ends[end + 1].append((length, score))
        for i in range(1, n + 1):
            # From the longest piece on: the earliest start is the first to try.
            known = False
            for length, score in sorted(ends[i], reverse=True):
                known = known or length == 1
                score += best[i - length]
                if best[i] is None or score > best[i]:
                    best[i], count[i] = score, count[i - length] + 1
            if not known:
                score = self.unknown + best[i - 1]
                if best[i] is None or score > best[i]:
                    more = len(word[i - 1].encode("utf-8", "surrogatepass")) if self.by_bytes else (
                        0 if unknown[i - 1] else 1
                    )
                    best[i], count[i], unknown[i] = score, count[i - 1] + more, True
        return count[n]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if text[0] in (" ", SPACE):
            text = text[1:]
        return sum(map(self.__getitem__, [SPACE + w for w in text.replace(SPACE, " ").split(" ")]))


@functools.lru_cache(2)
def _counter(pieces: tuple[tuple[str, float], ...]) -> Counter:
    return Counter(list(pieces))


def count_tokens(
    docs: DataFrame, path: str, text_col: str = "text", out: str = "n_tokens"
) -> DataFrame:
    """``docs`` with the column ``out``, the number of tokens of the text."""
    shared = sent(docs.sparkSession, ("pieces", path), lambda: tuple(vocabulary(path)))
    docs = docs.drop(out).withColumn(text_col, F.col(text_col).cast("string"))
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for whole in batches:
            for batch in slices(whole, text_col):
                found = [counter.count(t) for t in batch.column(text_col).to_pylist()]
                yield with_column(batch, out, pa.array(found, pa.int64()))

    return arrow_map(docs, run, schema)


def op3_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs, path or public_tokenizers.path("piece_bpe_32k.model")).drop("text")
