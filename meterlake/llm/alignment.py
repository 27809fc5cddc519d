"""Alignment of two tokenizers' tokens over the same bytes.

**Products.** The bytes of a text are columns, the occurrences of a tokenizer's tokens are
rows of an incidence matrix in compressed sparse rows; a token has the bytes it covers. With
``A`` and ``B`` for the two tokenizers, Gustavson's row products ``A . B^T`` (row ``i`` is the
sum of those rows of ``B^T`` that row ``i`` of ``A`` names) give the overlap links: pairs of
occurrences and the number of bytes they share. Overlapping pairs whose ranges end together
are the end links. Their ends cut the text into groups; with incidence matrices of tokens and
groups the same product gives the shared-group links.

**Stretches.** A single space between two characters that are no white space always begins a
token of either tokenizer, so a text is aligned by its stretches between such spaces, and the
groups of a text are those of its stretches. Equal stretches are encoded and multiplied once;
a worker remembers a bounded number of them.

**Pairs of ids.** Tokens that end together cover the same bytes up to the shorter one's
length: one token's bytes end with the other's. All pairs of ids of this kind are numbered
from the two vocabularies alone (``Pairs``), so counts of pairs over a corpus of any size
have that many entries at most, and may be collected and broadcast.

``A`` is a byte-level BPE file of the ``tokenizers`` library and reads a space and the text;
``B`` is a sentencepiece file of type BPE, which adds the space. Strings of special tokens
inside texts are plain text.

Defined cases: texts that are null, empty, or whose joined token bytes differ from a space
and the text have no tokens, zeros and empty groups; texts are read whole; repeated rows give
repeated results and count each time; a null id is an id like any other, since nothing is
joined by ids; an empty table gives no rows; a column whose name clashes with a result is
replaced, others are kept.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice
from typing import NamedTuple
from uuid import uuid4

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer as Library

from meterlake.llm.bpe import byte_alphabet
from meterlake.llm.common import arrow_map, no_cycles, sent, shared_dir, slices
from meterlake.llm.lockstep import Lookup, gathered, starts_of

SPACE = "▁"
# Stretches that a worker remembers before it starts anew, bytes of text of a batch, and
# characters that are encoded by one call.
REMEMBERED = 200_000
_BATCH = 4 << 20
_BLOCK = 1 << 18


# -- sparse matrices


class Rows(NamedTuple):
    """A matrix in compressed sparse rows."""

    starts: np.ndarray  # of each row's entries, and their end
    columns: np.ndarray
    values: np.ndarray
    width: int


def incidence(starts: np.ndarray, columns: np.ndarray, width: int) -> Rows:
    return Rows(starts, columns, np.ones(len(columns), np.int64), width)


def transposed(m: Rows) -> Rows:
    row = np.repeat(np.arange(len(m.starts) - 1), np.diff(m.starts))
    order = np.argsort(m.columns, kind="stable")
    starts = np.r_[0, np.cumsum(np.bincount(m.columns, minlength=m.width))]
    return Rows(starts, row[order], m.values[order], len(m.starts) - 1)


def product(a: Rows, b: Rows) -> Rows:
    """Row ``i`` is the sum of the rows of ``b`` that row ``i`` of ``a`` names, times its values."""
    n = np.diff(b.starts)
    row = np.repeat(np.repeat(np.arange(len(a.starts) - 1), np.diff(a.starts)), n[a.columns])
    column = gathered(b.columns, b.starts[:-1], n, a.columns)
    value = np.repeat(a.values, n[a.columns]) * gathered(b.values, b.starts[:-1], n, a.columns)
    order = np.argsort(row * b.width + column, kind="stable")
    row, column, value = row[order], column[order], value[order]
    first = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (np.diff(column) != 0)][: len(row)])
    value = np.add.reduceat(value, first) if len(first) else value
    starts = np.r_[0, np.cumsum(np.bincount(row[first], minlength=len(a.starts) - 1))]
    return Rows(starts, column[first], value, b.width)


def entries(m: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.repeat(np.arange(len(m.starts) - 1), np.diff(m.starts)), m.columns, m.values


class Aligned(NamedTuple):
    """Links between the occurrences of two token sequences over the same bytes."""

    overlap: Rows  # bytes that two occurrences share
    end_a: np.ndarray  # the end links
    end_b: np.ndarray
    group_a: np.ndarray  # the group of each occurrence
    group_b: np.ndarray
    shared: Rows  # occurrences of one group


def aligned(sizes_a: np.ndarray, sizes_b: np.ndarray) -> Aligned:
    """``sizes_a, sizes_b`` are the bytes of the occurrences, alike in sum."""
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    width = int(ends_a[-1]) if len(ends_a) else 0
    byte = np.arange(width)
    a = incidence(np.r_[0, ends_a], byte, width)
    b = incidence(np.r_[0, ends_b], byte, width)
    overlap = product(a, transposed(b))
    i, j, _ = entries(overlap)
    together = ends_a[i] == ends_b[j]
    i, j = i[together], j[together]
    cuts = ends_a[i]
    group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
    in_a = incidence(np.arange(len(ends_a) + 1), group_a, len(cuts))
    in_b = incidence(np.arange(len(ends_b) + 1), group_b, len(cuts))
    return Aligned(overlap, i, j, group_a, group_b, product(in_a, transposed(in_b)))


# -- vocabularies


def _odd_characters() -> str:
    """White space, controls and invisible characters, and the mark for a space."""
    kinds = ("Zs", "Zl", "Zp", "Cc", "Cf")
    return SPACE + "".join(c for c in map(chr, range(1 << 16)) if c.isspace() or unicodedata.category(c) in kinds)


class Pairs:
    """The pairs of ids whose tokens can end together, numbered."""

    def __init__(self, bytes_a: list[bytes], bytes_b: list[bytes]):
        by_a, by_b = defaultdict(list), defaultdict(list)
        for by, labels in ((by_a, bytes_a), (by_b, bytes_b)):
            for token, label in enumerate(labels):
                if label:
                    by[label].append(token)
        found = {
            (a, b)
            for label, tokens in by_a.items()
            for cut in range(len(label))
            for b in by_b.get(label[cut:], ())
            for a in tokens
        }
        found |= {
            (a, b)
            for label, tokens in by_b.items()
            for cut in range(1, len(label))
            for a in by_a.get(label[cut:], ())
            for b in tokens
        }
        pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
        self.a, self.b = pairs[:, 0], pairs[:, 1]
        self.numbers = Lookup(len(pairs))
        self.numbers.put(self.a << 20 | self.b, np.arange(len(pairs), dtype=np.int32))

    def __len__(self) -> int:
        return len(self.a)

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.numbers.get(a.astype(np.int64) << 20 | b)


class Aligner:
    """Both tokenizers and what a worker remembers of stretches."""

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as file:
            self.spec = file.read()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b).serialized_model_proto()
        self._prepare()
        codes = {c: bytes([b]) for b, c in enumerate(byte_alphabet())}
        names = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for label, token in names.items():
            self.bytes_a[token] = b"".join(codes[c] for c in label)
        self.bytes_b = [
            bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else
            b"" if self.b.is_control(i) or self.b.is_unknown(i) else name.replace(SPACE, " ").encode()
            for i, name in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        if any(" " in label.decode("utf-8", "replace").lstrip(" ") for label in self.bytes_b):
            raise ValueError("a token with a space after another character")
        self.pairs = Pairs(self.bytes_a, self.bytes_b)
        self._tables()

    def _prepare(self) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Library.from_str(self.spec)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        odd = _odd_characters()
        self.odd = frozenset(odd)
        inside = "".join(map(re.escape, odd))
        self.irregular = re.compile(f"[{inside}] | [{inside}]|^[{inside}]|[{inside}]$")
        self.starts = re.compile(f"(?<![{inside}]) (?=[^{inside}])")
        self.forget()

    def _tables(self) -> None:
        self.sizes_a = np.fromiter(map(len, self.bytes_a), np.int64)
        self.sizes_b = np.fromiter(map(len, self.bytes_b), np.int64)
        # Numbers with what may come after them in a group; those of ``B`` after those of ``A``.
        self.written = [f"{i}{c}" for ids in (self.bytes_a, self.bytes_b) for c in ",|;" for i in range(len(ids))]
        self.written_sizes = np.fromiter(map(len, self.written), np.int64)

    def __getstate__(self) -> dict:
        return {k: getattr(self, k) for k in ("spec", "model", "bytes_a", "bytes_b", "pairs")}

    def __setstate__(self, state: dict) -> None:
        vars(self).update(state)
        self._prepare()
        self._tables()

    def forget(self) -> None:
        """Drop what was remembered: a task's worker goes on with other work."""
        if hasattr(self, "seen"):  # its factory names it: a cycle, which would stay for long
            self.seen.default_factory = None
        self.seen: dict[str, int] = defaultdict()
        self.seen.default_factory = self.seen.__len__
        self.valid = np.zeros(0, bool)
        # Of each stretch: tokens of both, groups, overlap and shared-group links.
        self.counts = np.zeros((0, 5), np.int64)
        self.links = np.zeros(0, np.int32)  # the pairs of all end links
        self.groups: list[str] = []

    def _stretches(self, text: str) -> list[str]:
        """The stretches of a space and the text, each without its first space."""
        if SPACE in text:  # which is read as a space, so the bytes differ
            return [SPACE]
        if not self.irregular.search(text):
            return text.split(" ")
        text = " " + text
        cuts = [m.start() for m in self.starts.finditer(text)]
        if not cuts or cuts[0]:
            cuts = [0, *cuts]
        return [text[a + 1 : b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]

    def _encode_a(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, how many each stretch has, and whether their bytes are the stretch's."""
        ids, counts = [], []
        together = "".join([" " + s for s in stretches])
        plain = all(s and s[0] not in self.odd and s[-1] not in self.odd for s in stretches)
        if plain:
            found = np.array(self.a.encode(together, add_special_tokens=False).ids, np.int64)
            ends = np.cumsum(np.fromiter((len(s.encode()) + 1 for s in stretches), np.int64))
            place = np.searchsorted(np.cumsum(self.sizes_a[found]), ends)
            if len(found) and np.array_equal(np.cumsum(self.sizes_a[found])[np.minimum(place, len(found) - 1)], ends):
                counts = np.diff(place + 1, prepend=0)
                return found, counts, self._same(found, counts, self.bytes_a, stretches)
        each = [e.ids for e in self.a.encode_batch([" " + s for s in stretches], add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(each), np.int64)
        counts = np.fromiter(map(len, each), np.int64, len(each))
        return ids, counts, self._same(ids, counts, self.bytes_a, stretches)

    def _encode_b(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        each = self.b.encode(stretches, num_threads=1)
        ids = np.fromiter(chain.from_iterable(each), np.int64)
        counts = np.fromiter(map(len, each), np.int64, len(each))
        return ids, counts, self._same(ids, counts, self.bytes_b, stretches)

    @staticmethod
    def _same(ids: np.ndarray, counts: np.ndarray, labels: list[bytes], stretches: list[str]) -> np.ndarray:
        tokens = [labels[i] for i in ids.tolist()]
        texts = [b" " + s.encode() for s in stretches]
        sizes = np.r_[0, np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))]
        per_text = np.diff(sizes[np.r_[0, np.cumsum(counts)]])
        if b"".join(tokens) == b"".join(texts) and per_text.tolist() == list(map(len, texts)):
            return np.ones(len(stretches), bool)
        first = starts_of(counts).tolist()
        return np.array([b"".join(tokens[f : f + n]) == t for f, n, t in zip(first, counts.tolist(), texts, strict=True)])

    def _learn(self, stretches: list[str]) -> None:
        at = 0
        while at < len(stretches):
            block, size = [], 0
            # Those with white space at an edge are encoded by themselves.
            while at < len(stretches) and size < _BLOCK:
                block.append(stretches[at])
                size += len(stretches[at]) + 1
                at += 1
            odd = [s for s in block if not s or s[0] in self.odd or s[-1] in self.odd]
            self._learn_block(block, set(odd))

    def _learn_block(self, block: list[str], odd: set[str]) -> None:
        order = [k for k, s in enumerate(block) if s not in odd]
        order += [k for k, s in enumerate(block) if s in odd]
        block = [block[k] for k in order]
        cut = len(block) - len(odd)
        parts = [self._encode_a(part) for part in (block[:cut], block[cut:]) if part]
        a, n_a, ok_a = (np.concatenate(x) for x in zip(*parts, strict=True))
        b, n_b, ok_b = self._encode_b(block)
        ok = ok_a & ok_b
        a, b = a[np.repeat(ok, n_a)], b[np.repeat(ok, n_b)]
        n_a, n_b = n_a * ok, n_b * ok
        found = aligned(self.sizes_a[a], self.sizes_b[b])
        owner_a, owner_b = np.repeat(np.arange(len(block)), n_a), np.repeat(np.arange(len(block)), n_b)
        of_link = owner_a[found.end_a]
        per = lambda rows: np.bincount(owner_a[entries(rows)[0]], minlength=len(block))
        n_groups = np.bincount(of_link, minlength=len(block))
        counts = np.stack([n_a, n_b, n_groups, per(found.overlap), per(found.shared)], axis=1)
        pairs = self.pairs.number(a[found.end_a], b[found.end_b])
        if (pairs < 0).any():
            raise ValueError("tokens that end together share no ending")
        # All groups as one text: the tokens of ``A`` and then those of ``B``, group by group.
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[found.end_a], last_b[found.end_b] = 1, 2
        code = np.r_[a + last_a * len(self.bytes_a), 3 * len(self.bytes_a) + b + last_b * len(self.bytes_b)]
        order_in = np.argsort(np.r_[2 * found.group_a, 2 * found.group_b + 1], kind="stable")
        code, owner = code[order_in], np.r_[owner_a, owner_b][order_in]
        written = "".join([self.written[c] for c in code.tolist()])
        ends = np.cumsum(np.bincount(owner, self.written_sizes[code], len(block)).astype(np.int64)).tolist()
        groups = [written[x:y] for x, y in zip([0, *ends], ends, strict=False)]
        # Back in the order in which the stretches were seen.
        back = np.argsort(order)
        self.valid = np.r_[self.valid, ok[back]]
        self.counts = np.r_[self.counts, counts[back]]
        self.links = np.r_[self.links, gathered(pairs, starts_of(n_groups), n_groups, back)]
        self.groups += [groups[k] for k in back.tolist()]

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Of each text the counts; the pairs of the end links, one text after the other; and
        the groups."""
        found = [list(map(self.seen.__getitem__, self._stretches(t))) if t else [] for t in texts]
        if len(self.seen) > len(self.valid):
            self._learn(list(islice(self.seen, len(self.valid), None)))
        if not self.valid.all():
            found = [f if self.valid[f].all() else [] for f in found]
        which = np.fromiter(chain.from_iterable(found), np.int64)
        ends = np.r_[0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))]
        sums = np.r_[np.zeros((1, 5), np.int64), np.cumsum(self.counts[which], axis=0)]
        per_text = np.diff(sums[ends], axis=0)
        n_links = self.counts[:, 2]
        links = gathered(self.links, starts_of(n_links), n_links, which)
        groups = ["".join([self.groups[k] for k in f])[:-1] for f in found]
        if len(self.seen) > REMEMBERED:
            self.forget()
        return per_text, links, groups


@functools.lru_cache(2)
def load(path_a: str, path_b: str) -> Aligner:
    """Both vocabularies, on the driver."""
    return Aligner(path_a, path_b)


_COUNTS = ("n_a", "n_b", "n_groups", "n_overlaps", "n_shared")


def align(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_a, n_b`` (tokens), ``n_groups``, ``n_overlaps, n_shared`` (overlap and
    shared-group links), ``groups`` (ids as ``a1,a2|b1;a3|b2``) and ``pairs`` (the number of
    each end link's pair of ids, see ``pair_table``)."""
    shared = sent(docs.sparkSession, ("alignment", path_a, path_b), lambda: load(path_a, path_b))
    docs = docs.drop(*_COUNTS, "groups", "pairs").withColumn(text_col, F.col(text_col).cast("string"))
    schema = T.StructType(
        [*docs.schema.fields]
        + [T.StructField(name, T.LongType()) for name in _COUNTS]
        + [T.StructField("groups", T.StringType())]
        + [T.StructField("pairs", T.ArrayType(T.IntegerType(), False))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = shared.value
        try:
            for whole in batches:
                for batch in slices(whole, text_col, _BATCH):
                    with no_cycles():
                        batch = found(batch, aligner)
                    yield batch
        finally:
            aligner.forget()

    def found(batch: pa.RecordBatch, aligner: Aligner) -> pa.RecordBatch:
        counts, links, groups = aligner.align(batch.column(text_col).to_pylist())
        ends = np.r_[0, np.cumsum(counts[:, 2])].astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                *(pa.array(counts[:, k]) for k in range(5)),
                pa.array(groups, pa.string()),
                pa.ListArray.from_arrays(ends, links.astype(np.int32)),
            ],
            schema.names,
        )

    return arrow_map(docs, run, schema)


def token_links(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The links between the occurrences of a text, one in a row: ``id_col``, the places
    ``a_at, b_at`` and ids ``a_id, b_id`` of the tokens, the bytes they share (0: only a
    group), whether they end together, and whether they share a group."""
    shared = sent(docs.sparkSession, ("alignment", path_a, path_b), lambda: load(path_a, path_b))
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    kind = source.schema[id_col].dataType.simpleString()
    names = [id_col, "a_at", "b_at", "a_id", "b_id", "n_bytes", "ends_together", "same_group"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = shared.value
        for whole in batches:
            for batch in slices(whole, "text", 1 << 18):
                for k, text in enumerate(batch.column("text").to_pylist()):
                    yield rows(aligner, batch.column(0).slice(k, 1), text)

    def rows(aligner: Aligner, ident: pa.Array, text: str | None) -> pa.RecordBatch:
        parts = [text] if text else []
        (a, _, ok_a), (b, _, ok_b) = (
            (f(parts) if parts else (np.zeros(0, np.int64), None, np.zeros(0, bool)))
            for f in (aligner._encode_a, aligner._encode_b)
        )
        if not (ok_a.all() and ok_b.all()):
            a, b = a[:0], b[:0]
        found = aligned(aligner.sizes_a[a], aligner.sizes_b[b])
        width = max(1, len(b))
        over, share = entries(found.overlap), entries(found.shared)
        key_over, key_share = over[0] * width + over[1], share[0] * width + share[1]
        keys = np.union1d(key_over, key_share)
        i, j = keys // width, keys % width
        n_bytes = np.zeros(len(keys), np.int64)
        n_bytes[np.searchsorted(keys, key_over)] = over[2]
        columns = [
            i, j, a[i], b[j], n_bytes,
            np.isin(keys, found.end_a * width + found.end_b), np.isin(keys, key_share),
        ]
        return pa.RecordBatch.from_arrays(
            [ident.take(pa.array(np.zeros(len(keys), np.int64))), *map(pa.array, columns)], names
        )

    return arrow_map(
        source,
        run,
        f"`{id_col}` {kind}, a_at long, b_at long, a_id long, b_id long, n_bytes long, "
        "ends_together boolean, same_group boolean",
    )


def pair_counts(found: DataFrame, n_pairs: int) -> DataFrame:
    """``pair, n`` of the end links of ``found``, which ``align`` gave: counted in each task,
    then added. There are no more rows than pairs in the vocabularies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_pairs, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_pairs)
        pair = np.flatnonzero(total)
        for at in range(0, len(pair), 1 << 16):
            some = pair[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["pair", "n"])

    parts = arrow_map(found.select("pairs"), run, "pair int, n long")
    return parts.groupBy("pair").agg(F.sum("n").alias("n"))


def link_strengths(found: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``found``, a written result of ``align``, with ``n_best`` (end links whose pair is
    the most frequent of its ``B`` id in all of ``found``, ties included) and ``count_sum``
    (the sum of the pairs' frequencies over the end links) in place of ``pairs``."""
    pairs = load(path_a, path_b).pairs
    # At most one row for each pair of the vocabularies, however large the corpus is.
    rows = pair_counts(found, len(pairs)).toArrow()
    count = np.zeros(len(pairs), np.int64)
    count[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    highest = np.zeros(int(pairs.b.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, pairs.b, count)
    shared = found.sparkSession.sparkContext.broadcast((count, count == highest[pairs.b]))
    kept = [f for f in found.schema.fields if f.name not in ("pairs", "n_best", "count_sum")]
    schema = T.StructType([*kept, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = shared.value
        for batch in batches:
            links = batch.column("pairs").flatten().to_numpy()
            ends = np.r_[0, np.cumsum(batch.column("pairs").value_lengths().to_numpy())]
            sums = [np.r_[0, np.cumsum(x[links])][ends] for x in (best, count)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), *(pa.array(np.diff(s).astype(np.int64)) for s in sums)],
                schema.names,
            )

    return arrow_map(found.drop("n_best", "count_sum"), run, schema)


def pair_table(spark: SparkSession, path_a: str, path_b: str) -> DataFrame:
    """``pair, a_id, b_id``: the numbers that ``align`` gives to pairs of ids."""
    pairs = load(path_a, path_b).pairs
    columns = [np.arange(len(pairs), dtype=np.int32), pairs.a, pairs.b]
    return spark.createDataFrame(pa.table(columns, ["pair", "a_id", "b_id"]))


def op12_alignment(
    spark: SparkSession, sf_dir: str, path_a: str | None = None, path_b: str | None = None
) -> DataFrame:
    import public_tokenizers

    paths = path_a or public_tokenizers.path("byte_bpe_50k.json"), path_b or public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    place = f"{shared_dir(spark)}/alignment-{uuid4().hex}"
    groups = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    align(docs, *paths).select(
        "doc_id", "n_a", "n_b", "n_groups", F.size("pairs").cast("long").alias("n_links"),
        "n_overlaps", "n_shared", groups.alias("groups_sha256"), "pairs",
    ).write.parquet(place)
    found = link_strengths(spark.read.parquet(place), *paths)
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
        "n_overlaps", "n_shared",
    )
