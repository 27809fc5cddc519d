"""BPE encoding and decoding with a tokenization automaton.

**Automaton.** States are sets of tokens that may come next; an arc is labelled with a
token. It starts as one state with a loop for each base symbol. Each merge ``(u, v)`` is
one gadget: every path ``p -u-> q -v-> r`` is closed by leading the ``u`` arcs to a copy
of ``q`` without the ``v`` arc, and replaced by an arc ``p -uv-> r``. After all merges the
automaton accepts one token sequence for each word, which is that of the merges. All arcs
of one label lead to one state, so a state goes by the label of its arcs and is kept as
the gadgets that removed arcs from it, with their times: compiling is linear in the
merges, and a cell of the transition table is filled in when a word first needs it.

**Encoding.** Words that are read end in a mark of their own, so that closing tokens match
there only. ``lockstep`` reads the bytes of all new words of a batch by a transition
table of the tokens' bytes; of the tokens that end at a place the one is taken whose arc
leaves the state that its start is in. Each prefix of a word has at most one such state, so
nothing is tried twice. Between batches a worker keeps a bounded number of the pieces
between white space that it has read, and cells of the automaton's table.

Tokenizer files are JSON as the ``tokenizers`` library writes it, with words closed by a
suffix: normalization to NFC, white space to one space and lower case; a pattern that
picks the words; bytes as characters; no decoder, so decoding joins labels by a space.
``load`` raises for any other kind.

Defined cases: a null text counts as empty and gives no ids; null ids decode to the empty
text; an id outside the vocabulary is left out of the decoded text, as is a null id;
special tokens in a text are encoded as such; repeated rows give repeated results; an
empty table gives no rows; a column whose name clashes with a result is replaced.
"""

from __future__ import annotations

import functools
import json
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer as Library

from meterlake.llm.common import arrow_map, no_cycles, sent, slices, with_column
from meterlake.llm.lockstep import Lookup, Paths, gathered, starts_of

# Pieces between white space that a worker remembers; beyond it the less used ones go.
REMEMBERED = 60_000
# The mark at a word's end; no UTF-8 text has it.
END = b"\xff"
_NEVER = 1 << 60


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Automaton:
    """States by the label of the arcs that lead to them, -1 for the first; tokens are ids."""

    def __init__(self, base: list[int], merges: list[tuple[int, int, int]], tokens: int):
        self.left, self.right = [-1] * tokens, [-1] * tokens  # the parts of a merged token
        self.born = [0] * tokens  # the time of its gadget
        self.live = [False] * tokens  # some arc has it
        self.removed: dict[int, int] = {}  # (state, token) to the time of the gadget
        for token in base:
            self.live[token] = True
        for time, (u, v, joined) in enumerate(merges, 1):
            if self.live[joined]:
                raise ValueError("two merges give one token")
            if self.live[u] and self.live[v] and self.has_arc(u, v):
                self.removed[u << 20 | v] = time
                self.left[joined], self.right[joined] = u, v
                self.born[joined], self.live[joined] = time, True
        self.lefts, self.rights, self.times = map(np.array, (self.left, self.right, self.born))
        self.gone = Lookup(len(self.removed))
        self.gone.put(np.fromiter(self.removed, np.int64), np.fromiter(self.removed.values(), np.int32))

    def has_arc(self, state: int, token: int) -> bool:
        """Whether the state after ``state`` has an arc ``token``. Where the gadget of a token
        ``uv`` leads is the state after ``v`` as it then was, so removals from that state
        count if they came before. A state got the arc ``uv`` if it then had the arc ``u``,
        so removals of ``u`` count up to then."""
        removed, born, left, right = self.removed, self.born, self.left, self.right
        until = _NEVER
        while state >= 0:
            part, upto = token, _NEVER
            while part >= 0:
                time = removed.get(state << 20 | part)
                if time is not None and time < until and time <= upto:
                    return False
                upto, part = born[part], left[part]
            until, state = born[state], right[state]
        return True

    def have_arcs(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """``has_arc`` for arrays: the cells ``(state, token)`` of the transition table."""
        ok = np.ones(len(state), bool)
        row, until = np.arange(len(state)), np.full(len(state), _NEVER)
        while len(row):
            part, upto, at = token[row], np.full(len(row), _NEVER), np.arange(len(row))
            while len(at):
                time = self.gone.get(state[at].astype(np.int64) << 20 | part)
                bad = (time >= 0) & (time < until[at]) & (time <= upto)
                ok[row[at[bad]]] = False
                upto, part = self.times[part], self.lefts[part]
                more = ~bad & (part >= 0)
                at, part, upto = at[more], part[more], upto[more]
            until, state = self.times[state], self.rights[state]
            more = ok[row] & (state >= 0)
            row, state, until = row[more], state[more], until[more]
        return ok


class Tokenizer:
    """A compiled tokenizer file; small and of fixed size, so it is sent to the workers.

    Normalization and the split into words are the library's, so that both follow one
    version of Unicode; for ASCII both are plain. The merges are the automaton's.
    """

    KEPT = ("special", "labels", "paths", "pattern", "rest")

    def __init__(self, spec: str):
        found = json.loads(spec)
        model = found["model"]
        steps = [step["type"] for step in found["normalizer"]["normalizers"]]
        splits = found["pre_tokenizer"]["pretokenizers"]
        if (
            model["type"] != "BPE"
            or steps != ["NFC", "Replace", "Lowercase"]
            or [split["type"] for split in splits] != ["Split", "ByteLevel"]
            or not (splits[0]["invert"] and splits[0]["behavior"] == "Removed")
            or not model["end_of_word_suffix"]
            or found["decoder"] or found["post_processor"]
            or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges"))
        ):
            raise ValueError("only BPE with word ends over bytes is supported")
        vocab = model["vocab"]
        end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in found["added_tokens"]}
        self.labels = {i: t for t, i in (vocab | self.special).items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        joined = {u + v for u, v in pairs}
        auto = Automaton(
            [i for t, i in vocab.items() if t not in joined],
            [(vocab[u], vocab[v], vocab[u + v]) for u, v in pairs],
            max(self.labels) + 1,
        )
        # Tokens that no arc has are never emitted.
        codes = {c: bytes([b]) for b, c in enumerate(byte_alphabet())}
        labels = {}
        for label, token in vocab.items():
            if auto.live[token]:
                closes = label.endswith(end)
                symbols = label[: -len(end)] if closes else label
                form = b"".join(codes[c] for c in symbols)
                if END not in form:
                    labels[token] = form + (END if closes else b"")
        self.paths = Paths(labels, auto.have_arcs, auto.has_arc)
        self.pattern = splits[0]["pattern"]["Regex"]
        self.rest = json.dumps(found | {"model": model | {"vocab": {}, "merges": []}, "added_tokens": []})
        self._prepare()

    def _prepare(self) -> None:
        self.breaks = regex.compile(f"\n|{self.pattern}")
        self.specials = regex.compile(f"({'|'.join(map(regex.escape, self.special)) or '(?!)'})")
        library = Library.from_str(self.rest)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.codes = {ord(c): b for b, c in enumerate(byte_alphabet())}
        self.forget()

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k in self.KEPT}

    def __setstate__(self, state: dict) -> None:
        vars(self).update(state)
        self._prepare()

    def _words(self, pieces: list[str], number: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """The words of pieces (texts without white space) by their number, one piece after
        the other, and how many each has. All pieces are split at once, as one text."""
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if pieces[0].isascii():
            found = self.breaks.findall("\n".join(pieces).lower())
            words = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
            breaks = np.flatnonzero(words == number["\n"])
            ends = np.r_[breaks - np.arange(len(breaks)), len(words) - len(breaks)]
            return np.delete(words, breaks), np.diff(ends, prepend=0)
        joined = self.normalizer.normalize_str(" ".join(pieces))
        if joined.count(" ") != len(pieces) - 1:  # a piece became more or none
            each = [self.splitter.pre_tokenize_str(self.normalizer.normalize_str(p)) for p in pieces]
            words = np.fromiter((number[w] for split in each for w, _ in split), np.int64)
            return words, np.fromiter(map(len, each), np.int64, len(each))
        split = self.splitter.pre_tokenize_str(joined)
        words = np.fromiter((number[w] for w, _ in split), np.int64, len(split))
        place = np.fromiter((span[0] for _, span in split), np.int64, len(split))
        breaks = np.cumsum(np.fromiter(map(len, joined.split(" ")), np.int64, len(pieces)) + 1)
        return words, np.diff(np.searchsorted(place, breaks), prepend=0)

    def _bytes(self, word: str) -> bytes:
        """A word is in ASCII, or in the characters that stand for its bytes."""
        return (word if word.isascii() else word.translate(self.codes)).encode("latin-1") + END

    def _pieces(self, text: str) -> list[str]:
        # Python's split also breaks at these four, which are no white space here.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [p for p in regex.split(r"[^\S\x1c-\x1f]+", text) if p]
        return text.split()

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts, one text after the other, and how many each has."""
        known = self.known
        found: list[list[int]] = []
        for text in texts:
            if not text:
                found.append([])
            elif not any(s in text for s in self.special):
                found.append(list(map(known.__getitem__, self._pieces(text))))
            else:
                pieces = []
                for part in self.specials.split(text):
                    pieces += [part] if part in self.special else self._pieces(part)
                found.append(list(map(known.__getitem__, pieces)))
        if len(known) > len(self.counts):
            self._learn(list(islice(known, len(self.counts), None)))
        which = np.fromiter(chain.from_iterable(found), np.int64)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        before = np.r_[0, np.cumsum(self.counts[which])]
        per_text = np.diff(before[np.r_[0, np.cumsum(lengths)]])
        ids = gathered(self.flat, starts_of(self.counts), self.counts, which)
        self.uses = np.bincount(which, minlength=len(known)) + np.pad(
            self.uses, (0, len(known) - len(self.uses))
        )
        if len(known) > REMEMBERED:
            self._keep_used()
        return ids, per_text

    def _keep_used(self) -> None:
        """Keep the more used half of the pieces that a worker may remember."""
        keep = np.sort(np.argsort(-self.uses, kind="stable")[: REMEMBERED // 2])
        flat = gathered(self.flat, starts_of(self.counts), self.counts, keep)
        counts, uses, names = self.counts[keep], self.uses[keep] // 2, list(self.known)
        self.forget()
        for k in keep.tolist():
            self.known[names[k]]
        self.flat, self.counts, self.uses = flat, counts, uses

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces, of which equal words are encoded once."""
        word: dict[str, int] = defaultdict()
        word.default_factory = word.__len__
        plain = np.fromiter(map(str.isascii, pieces), bool, len(pieces))
        kinds = np.flatnonzero(plain), np.flatnonzero(~plain)
        found = [self._words([pieces[k] for k in kind.tolist()], word) for kind in kinds]
        words = np.concatenate([w for w, _ in found])
        of_piece = np.zeros(len(pieces), np.int64)
        firsts = np.zeros(len(pieces), np.int64)
        order = np.concatenate(kinds)
        of_piece[order] = np.concatenate([n for _, n in found])
        firsts[order] = starts_of(of_piece[order])
        word.default_factory = None  # it names the dict: a cycle, which would stay for long
        ids, counts = self.paths.encode([b"" if w == "\n" else self._bytes(w) for w in word])
        # A special token is its id, and no path: as if it were a further word.
        for special, token in self.special.items():
            k = self.known.get(special, -1) - len(self.counts)
            if k >= 0:
                ids, counts = np.r_[ids, np.int32(token)], np.r_[counts, 1]
                words = np.r_[words, len(counts) - 1]
                firsts[k], of_piece[k] = len(words) - 1, 1
        words = gathered(words, firsts, of_piece, np.arange(len(pieces)))
        before = np.r_[0, np.cumsum(counts[words])]
        per_piece = np.diff(before[np.r_[0, np.cumsum(of_piece)]])
        self.flat = np.r_[self.flat, gathered(ids, starts_of(counts), counts, words)]
        self.counts = np.r_[self.counts, per_piece]

    def forget(self) -> None:
        """Drop what was remembered; without the cycle through its factory it goes at once."""
        if hasattr(self, "known"):
            self.known.default_factory = None
        self.known: dict[str, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.flat, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)


def text_of(ids: list[int], labels: dict[int, str]) -> str:
    """Labels of the arcs, joined by a space."""
    return " ".join([labels[i] for i in ids if i in labels])


@functools.lru_cache(2)
def load(path: str) -> Tokenizer:
    """Read and compile the tokenizer file at ``path``, on the driver."""
    with open(path, encoding="utf-8") as file:
        return Tokenizer(file.read())


def _with(docs: DataFrame, column: str, kind: T.DataType) -> tuple[DataFrame, T.StructType]:
    docs = docs.drop(column)
    return docs, T.StructType([*docs.schema.fields, T.StructField(column, kind)])


# Bytes of text that a worker turns into one batch.
_BATCH = 1 << 19


def encode(
    docs: DataFrame, path: str, text_col: str = "text", out: str = "ids", decoded: str | None = None
) -> DataFrame:
    """``docs`` with the column ``out``: an array of token ids; and where it is named, with
    the column ``decoded``: the text of these ids."""
    shared = sent(docs.sparkSession, ("bpe", path), lambda: load(path))
    source = docs.withColumn(text_col, F.col(text_col).cast("string"))
    source, schema = _with(source, out, T.ArrayType(T.IntegerType(), False))
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
        ids, counts = tokenizer.encode(batch.column(text_col).to_pylist())
        ends = np.r_[0, np.cumsum(counts)]
        batch = with_column(batch, out, pa.ListArray.from_arrays(ends.astype(np.int32), ids))
        if decoded:
            labels, plain = tokenizer.labels, ids.tolist()
            texts = [text_of(plain[a:b], labels) for a, b in pairwise(ends.tolist())]
            batch = with_column(batch, decoded, pa.array(texts, pa.string()))
        return batch

    return arrow_map(source, run, schema)


def decode(docs: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the column ``out``: the text of the token ids."""
    shared = sent(docs.sparkSession, ("labels", path), lambda: load(path).labels)
    source, schema = _with(docs, out, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = shared.value
        for whole in batches:
            for batch in slices(whole, ids_col, _BATCH):
                texts = [text_of(x.as_py() or [], labels) for x in batch.column(ids_col)]
                yield with_column(batch, out, pa.array(texts, pa.string()))

    return arrow_map(source, run, schema)


def op9_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    path = path or public_tokenizers.path("word_bpe_49k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, path, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias(
            "ids_sha256"
        ),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
