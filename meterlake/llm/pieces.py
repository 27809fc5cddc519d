"""SentencePiece encoding and decoding with a table of last tokens by prefix.

**Rule.** A BPE model of sentencepiece merges, again and again, the two neighbouring pieces
whose joined piece has the greatest score, the leftmost of equal ones. So each prefix of a
text that ends with a token has one last token, and a sequence of tokens is the encoding if
each two neighbours alone would be encoded as these two: until the first merge across a
border all merges are those of the tokens themselves.

**Pairs.** Two tokens are tested by walking up the parts that lie at their border, in the
order in which they came to be. If at some time the parts that touch have a joined piece
that would come before the next piece of either side, the pair is not compatible. Of equal
scores the left side's own merge comes first, then that across, then the right side's.

**Table.** ``lockstep`` reads the bytes of all different stretches of a batch by the
automaton of all pieces; of the matches that end at a place, the one compatible pair with the
last token of the prefix before it is that prefix's last token. Ids are recovered backwards.

A stretch is a run of spaces with what follows up to the next space: no piece has a space
after another character, which ``load`` checks. Characters that are no piece become pieces
of their bytes, and nothing is merged across them. Equal stretches are encoded once; a
worker remembers a bounded number of them.

Model files are those of sentencepiece, of type BPE, with byte pieces, no normalization, a
space before the text and no removal of white space; ``load`` raises for any other kind.

Defined cases: a null text counts as empty and has the begin and end ids only; null ids
decode to the empty text, null ids inside are left out, ids outside the vocabulary raise;
control ids decode to nothing; texts are read whole; repeated rows give repeated results; an
empty table gives no rows; a column whose name clashes with a result is replaced.
"""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice, pairwise

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import arrow_map, no_cycles, sent, slices, with_column
from meterlake.llm.lockstep import Lookup, Paths, gathered, spines, starts_of

SPACE = "▁"
# Stretches that a worker remembers before it starts anew.
REMEMBERED = 300_000
# Bytes of text that a worker turns into one batch.
_BATCH = 8 << 20
_NEVER = 1 << 30


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of an encoded protocol buffer."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (message[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if message[at - 1] < 128:
                return value, at

    at = 0
    while at < len(message):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = message[at : at + size], at + size
        yield key >> 3, value


class Pairs:
    """Which tokens may be neighbours. Tokens are merged pieces by id; ``left`` and ``right``
    are the parts (-1: a character), ``rank`` the order of merging (-1: a character), and
    ``joins`` the rank of the joined piece by two tokens."""

    def __init__(self, left: list[int], right: list[int], rank: list[int], joins: dict[int, int]):
        self.ends, self.begins = spines(right), spines(left)
        ranks = np.array([*rank, _NEVER], np.int32)  # the last entry is for "no part"
        self.end_ranks, self.begin_ranks = ranks[self.ends], ranks[self.begins]
        self.joins = Lookup(len(joins))
        self.joins.put(np.fromiter(joins, np.int64), np.fromiter(joins.values(), np.int32))

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        ok = np.ones(len(first), bool)
        row = np.arange(len(first))
        i, j = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        while len(row):
            a, b = first[row], second[row]
            across = self.joins.get(self.ends[a, i].astype(np.int64) << 20 | self.begins[b, j])
            own, other = self.end_ranks[a, i + 1], self.begin_ranks[b, j + 1]
            wrong = (across >= 0) & (across < own) & (across <= other)
            ok[row[wrong]] = False
            go = ~wrong & ((own < _NEVER) | (other < _NEVER))
            row, up = row[go], (own <= other)[go]
            i, j = i[go] + up, j[go] + ~up
        return ok

    def compatible_one(self, first: int, second: int) -> bool:
        return bool(self.compatible(np.array([first]), np.array([second]))[0])


class Tokenizer:
    """A compiled model file; of fixed size, so it is sent to the workers."""

    KEPT = ("labels", "bytes_at", "begin", "end", "unknown", "control", "known_characters", "paths")

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        top = list(_fields(model.serialized_model_proto()))
        trainer = dict(_fields(next(v for k, v in top if k == 2)))
        normalizer = dict(_fields(next(v for k, v in top if k == 3)))
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        kind = {
            i: "byte" if model.is_byte(i) else "control" if model.is_control(i) else
            "unknown" if model.is_unknown(i) else "unused" if model.is_unused(i) else "plain"
            for i in range(size)
        }
        plain = {names[i]: i for i in range(size) if kind[i] == "plain"}
        if (
            trainer.get(3) != 2  # type: BPE
            or normalizer.get(2)  # a character map
            or normalizer.get(3, 1) != 1  # a space before the text
            or normalizer.get(4, 1) != 0  # removal of white space
            or normalizer.get(5, 1) != 1  # spaces as their own character
            or "unused" in kind.values()
            or sum(k == "byte" for k in kind.values()) != 256
            or any(SPACE in name.lstrip(SPACE) for name in plain)
            or any(c not in plain for name in plain for c in name)
            or model.piece_to_id(SPACE) not in plain.values()
        ):
            raise ValueError("only BPE over plain text with byte pieces is supported")
        self.labels = names
        self.bytes_at = model.piece_to_id("<0x00>")
        if [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)] != [*range(self.bytes_at, self.bytes_at + 256)]:
            raise ValueError("byte pieces are not in order")
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        self.control = frozenset(i for i in kind if kind[i] == "control")
        self.known_characters = "".join(sorted(c for c in plain if len(c) == 1))
        self.paths = self._paths(plain, {p: model.get_score(i) for p, i in plain.items()}, size)
        self._prepare()

    @staticmethod
    def _paths(plain: dict[str, int], scores: dict[str, float], size: int) -> Paths:
        order = {score: k for k, score in enumerate(sorted(set(scores.values()), reverse=True))}
        ranks = {piece: order[scores[piece]] for piece in plain if len(piece) > 1}
        left, right, rank = [-1] * size, [-1] * size, [-1] * size
        live, joins = {}, {}
        for piece, token in plain.items():
            parts = list(piece)
            while len(parts) > 1:
                # The pair to merge: the least rank, the leftmost of equal ones.
                best = min((ranks.get(a + b, _NEVER), k) for k, (a, b) in enumerate(pairwise(parts)))
                if best[0] == _NEVER:
                    break
                at = best[1]
                if len(parts) == 2:
                    left[token], right[token], rank[token] = plain[parts[0]], plain[parts[1]], best[0]
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 1:
                live[token] = piece.encode()  # others are never made
            for cut in range(1, len(piece)):
                if piece[:cut] in plain and piece[cut:] in plain:
                    joins[plain[piece[:cut]] << 20 | plain[piece[cut:]]] = ranks[piece]
        for token in live:
            if left[token] >= 0 and rank[token] < max(rank[left[token]], rank[right[token]]):
                raise ValueError("a piece comes before its parts")
        pairs = Pairs(left, right, rank, joins)
        return Paths(live, pairs.compatible, pairs.compatible_one)

    def _prepare(self) -> None:
        self.known = frozenset(self.known_characters)
        self.runs = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.breaks: dict[frozenset[str], re.Pattern] = {}
        low = range(self.bytes_at, self.bytes_at + 256)
        self.surface = [
            bytes([i - self.bytes_at]) if i in low else b"" if i in self.control else
            " \u2047 ".encode() if i == self.unknown else name.replace(SPACE, " ").encode()
            for i, name in enumerate(self.labels)
        ]
        self.forget()

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k in self.KEPT}

    def __setstate__(self, state: dict) -> None:
        vars(self).update(state)
        self._prepare()

    def forget(self) -> None:
        """Drop what was remembered: a task's worker goes on with other work."""
        if hasattr(self, "seen"):  # its factory names it: a cycle, which would stay for long
            self.seen.default_factory = None
        self.seen: dict[str, int] = defaultdict()
        self.seen.default_factory = self.seen.__len__
        self.flat, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _stretches(self, text: str) -> list[str]:
        """The stretches of a text that is not empty; unknown characters by themselves."""
        text = SPACE + text.replace(" ", SPACE)
        strange = frozenset(text) - self.known
        if not strange:
            return self._runs(text)
        found = []
        for part in self._break(strange).split(text):
            if part in strange:
                found.append(part)
            elif part:
                found += self._runs(part)
        return found

    def _runs(self, text: str) -> list[str]:
        if SPACE + SPACE in text:
            return self.runs.findall(text)
        found = text.replace(SPACE, "\0" + SPACE).split("\0")  # which is no known character
        return found if found[0] else found[1:]

    def _break(self, strange: frozenset[str]) -> re.Pattern:
        if strange not in self.breaks:
            if len(self.breaks) >= 1000:
                self.breaks.clear()
            self.breaks[strange] = re.compile(f"([{''.join(map(re.escape, sorted(strange)))}])")
        return self.breaks[strange]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts, one text after the other and without begin and end ids, and
        how many each has."""
        seen = self.seen
        found = [list(map(seen.__getitem__, self._stretches(t))) if t else [] for t in texts]
        if len(seen) > len(self.counts):
            self._learn(list(islice(seen, len(self.counts), None)))
        which = np.fromiter(chain.from_iterable(found), np.int64)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        before = np.r_[0, np.cumsum(self.counts[which])]
        per_text = np.diff(before[np.r_[0, np.cumsum(lengths)]])
        ids = gathered(self.flat, starts_of(self.counts), self.counts, which)
        if len(seen) > REMEMBERED:
            self.forget()
        return ids, per_text

    def _learn(self, stretches: list[str]) -> None:
        strange = [k for k, s in enumerate(stretches) if len(s) == 1 and s not in self.known]
        words = [s.encode() for s in stretches]
        as_bytes = [words[k] for k in strange]
        for k in strange:
            words[k] = b""
        ids, counts = self.paths.encode(words)
        if strange:
            places = np.repeat(starts_of(counts)[strange], list(map(len, as_bytes)))
            ids = np.insert(ids, places, np.frombuffer(b"".join(as_bytes), np.uint8).astype(np.int32) + self.bytes_at)
            counts[strange] = list(map(len, as_bytes))
        self.flat, self.counts = np.r_[self.flat, ids], np.r_[self.counts, counts]

    # -- decoding

    def text_of(self, ids: list[int]) -> str:
        """The text of ``ids``: pieces joined, without the space before the text."""
        a, b = 0, len(ids)
        while a < b and ids[a] in self.control:
            a += 1
        while b > a and ids[b - 1] in self.control:
            b -= 1
        ids = ids[a:b]
        cuts = [k for c in self.control if c in ids for k, i in enumerate(ids) if i == c]
        if cuts:  # bytes do not go on across a control id
            edges = pairwise([-1, *sorted(cuts), len(ids)])
            parts = [ids[x + 1 : y] for x, y in edges if y > x + 1]
        else:
            parts = [ids] if ids else []
        out = []
        for k, part in enumerate(parts):
            raw = b"".join([self.surface[i] for i in part])
            if k == 0 and part[0] != self.unknown and self.labels[part[0]].startswith(SPACE):
                raw = raw[1:]
            try:
                out.append(raw.decode())
            except UnicodeDecodeError:
                out.append(_read(raw))
        return "".join(out)


def _read(raw: bytes) -> str:
    """UTF-8 as text; a byte that begins no whole character is one replacement character."""
    out, at = [], 0
    while at < len(raw):
        size = 1 + (raw[at] >= 0xC0) + (raw[at] >= 0xE0) + (raw[at] >= 0xF0)
        try:
            out.append(raw[at : at + size].decode())
            at += size
        except UnicodeDecodeError:
            out.append("\ufffd")
            at += 1
    return "".join(out)


@functools.lru_cache(2)
def load(path: str) -> Tokenizer:
    """Read and compile the model file at ``path``, on the driver."""
    return Tokenizer(path)


def _with(docs: DataFrame, column: str, kind: T.DataType) -> tuple[DataFrame, T.StructType]:
    docs = docs.drop(column)
    return docs, T.StructType([*docs.schema.fields, T.StructField(column, kind)])


def encode(
    docs: DataFrame,
    path: str,
    text_col: str = "text",
    out: str = "ids",
    decoded: str | None = None,
    packed: bool = False,
) -> DataFrame:
    """``docs`` with the column ``out``: an array of ids with begin and end ids, or with
    ``packed`` their bytes as unsigned 32-bit numbers, the least byte first; and where it is
    named, with the column ``decoded``: the text of these ids."""
    shared = sent(docs.sparkSession, ("sentencepiece", path), lambda: load(path))
    source = docs.withColumn(text_col, F.col(text_col).cast("string"))
    source, schema = _with(source, out, T.BinaryType() if packed else T.ArrayType(T.IntegerType(), False))
    if decoded:
        source, _ = _with(source, decoded, T.StringType())
        schema = T.StructType(
            [f for f in schema.fields if f.name != decoded] + [T.StructField(decoded, T.StringType())]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = shared.value
        try:
            for whole in batches:
                for batch in slices(whole, text_col, _BATCH):
                    with no_cycles():
                        batch = encoded(batch, tokenizer)
                    yield batch
        finally:
            tokenizer.forget()
            tokenizer.paths.forget()

    def encoded(batch: pa.RecordBatch, tokenizer: Tokenizer) -> pa.RecordBatch:
        inner, counts = tokenizer.encode(batch.column(text_col).to_pylist())
        ends = np.r_[0, np.cumsum(counts + 2)]
        ids = np.empty(int(ends[-1]), np.int32)
        ids[ends[:-1]], ids[ends[1:] - 1] = tokenizer.begin, tokenizer.end
        rest = np.ones(len(ids), bool)
        rest[ends[:-1]] = rest[ends[1:] - 1] = False
        ids[rest] = inner
        if packed:
            offsets = pa.py_buffer((4 * ends).astype(np.int32))
            column = pa.Array.from_buffers(
                pa.binary(), batch.num_rows, [None, offsets, pa.py_buffer(ids.astype("<u4"))]
            )
        else:
            column = pa.ListArray.from_arrays(ends.astype(np.int32), ids)
        batch = with_column(batch, out, column)
        if decoded:
            plain = ids.tolist()
            texts = [tokenizer.text_of(plain[a:b]) for a, b in pairwise(ends.tolist())]
            batch = with_column(batch, decoded, pa.array(texts, pa.string()))
        return batch

    return arrow_map(source, run, schema)


def decode(docs: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the column ``out``: the text of the array of ids ``ids_col``."""
    shared = sent(docs.sparkSession, ("sentencepiece", path), lambda: load(path))
    source, schema = _with(docs, out, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = shared.value
        for whole in batches:
            for batch in slices(whole, ids_col, _BATCH):
                texts = [
                    tokenizer.text_of([i for i in ids or [] if i is not None])
                    for ids in batch.column(ids_col).to_pylist()
                ]
                yield with_column(batch, out, pa.array(texts, pa.string()))

    return arrow_map(source, run, schema)


def op11_sentencepiece(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    path = path or public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, path, decoded="decoded", packed=True).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
