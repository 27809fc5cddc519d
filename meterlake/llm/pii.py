"""Personal data: patterns, and a skip-chain conditional random field over their tokens.

**Patterns** give the base spans: e-mail and IP addresses, payment cards and telephone
numbers. Each is found in time linear in the text.

**Field.** Variables are the tokens (between white space, without marks around them) that
hold a digit or ``@``; words of letters are context, their label is fixed to none. Labels
are none and the four kinds. Features are a token's shape, its digits, checks, and the
shapes beside it. Neighbouring tokens share a chain potential; tokens of a document with
the same characters but for marks share a skip potential with the occurrence before,
however far, so edges are fewer than twice the tokens. Loopy sum-product messages pass
along all edges of a batch of documents at once, damped, for a fixed number of rounds.
Tokens whose belief in a kind is at least ``BELIEF`` and that no base span touches are
added; added tokens of a kind side by side are one span.

The field is trained by pseudo-likelihood on a bounded sample (``TRAIN_DOCS`` documents
with such tokens, those of the least hashes of their ids), with the base spans as labels.

Defined cases: null and empty texts have no spans; texts are read whole; without a token to
learn from nothing is added; repeated rows give repeated results; an empty table gives no
rows; other columns are not read.
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

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 3_000
BELIEF = 0.9
ROUNDS, DAMPING = 12, 0.5
WIDTH = 1 << 14  # rows of feature weights
FEATURES = 9  # of a token
STEPS, RATE, DECAY = 150, 0.5, 1e-4

Span = tuple[int, int, int]  # start, kind, end

# -- patterns

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each ``@`` back over the local part and on over the domain."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        # Characters before an @ that no match took cannot be in a later local part.
        end = max(end, at + 1)
        at = text.find("@", end)


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and int(part) <= 255)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """A run of dotted numbers holds a match in each four of its numbers."""
    for m in _NUMBERS.finditer(text):
        parts, at = m.group().split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(map(_octet, four)):
                yield at, end
            at = end + 1


def base_spans(text: str | None) -> list[Span]:
    """Spans of the patterns, by start and then kind."""
    if not text:
        return []
    found: list[Span] = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    if any(c in text for c in "0123456789"):
        if "." in text:
            found += [(a, 1, b) for a, b in _ips(text)]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def named(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# -- tokens

_SEEDS = re.compile(r"[0-9@]")
_EDGE = ".,;:!?\"'*%&$#|=<>[]{}`~^_/\\"
_MARKS = re.compile(r"[^0-9a-z@]+")


def tokens(text: str | None) -> list[tuple[int, int]]:
    """Start and end of each token with a digit or ``@``."""
    found, end = [], 0
    m = _SEEDS.search(text) if text else None
    while m:
        start, stop = m.start(), m.end()
        while start > end and not text[start - 1].isspace():
            start -= 1
        while stop < len(text) and not text[stop].isspace():
            stop += 1
        end = stop
        while start < stop and text[start] in _EDGE:
            start += 1
        while stop > start and text[stop - 1] in _EDGE:
            stop -= 1
        if start < stop:
            found.append((start, stop))
        m = _SEEDS.search(text, end)
    return found


def _shape(token: str) -> str:
    out, last, run = [], "", 0
    for c in token[:64] + "\0":
        kind = "9" if c in "0123456789" else "a" if c.isalpha() else c
        if kind == last:
            run += 1
        else:
            if last:
                out.append(last + (str(run) if last == "9" else ""))
            last, run = kind, 1
    return "".join(out)


def _features(text: str, spans: list[tuple[int, int]], k: int, shapes: list[str]) -> list[int]:
    start, end = spans[k]
    token, shape = text[start:end], shapes[k]
    digits = "".join(c for c in token if c in "0123456789")
    near_before = k > 0 and start - spans[k - 1][1] <= 2
    near_after = k + 1 < len(spans) and spans[k + 1][0] - end <= 2
    parts = token.split(".")
    names = (
        "bias",
        f"shape {shape}",
        f"kinds {re.sub('[0-9]+', '9', shape)}",
        f"digits {min(len(digits), 20)} of {min(len(token), 24) - len(digits) == 0}",
        f"luhn {12 <= len(digits) <= 19 and luhn(digits)} {len(digits) == len(token)}",
        f"octets {len(parts) == 4 and all(p.isdecimal() and p.isascii() and _octet(p) for p in parts)}",
        f"at {token.count('@')} {'.' in token.rpartition('@')[2]}",
        f"before {shapes[k - 1] if near_before else ''}",
        f"after {shapes[k + 1] if near_after else ''}",
    )
    return [zlib.crc32(n.encode("utf-8", "surrogatepass")) % WIDTH for n in names]


@dataclass
class Graph:
    """Tokens of a batch of documents, their features, and the edges between them."""

    owner: list[int]
    spans: list[tuple[int, int]]
    features: np.ndarray
    edges: np.ndarray  # pairs of tokens
    kinds: np.ndarray  # of edges: 0 chain, 1 skip


def graph(texts: list[str | None]) -> Graph:
    owner, spans, features, edges, kinds = [], [], [], [], []
    for d, text in enumerate(texts):
        found = tokens(text)
        shapes = [_shape(text[a:b]) for a, b in found]
        last: dict[str, int] = {}
        for k, (a, b) in enumerate(found):
            n = len(spans)
            if k and a - found[k - 1][1] <= 40:
                edges.append((n - 1, n))
                kinds.append(0)
            same = _MARKS.sub("", text[a:b].lower())
            if len(same) >= 4:
                if same in last and last[same] != n - 1:
                    edges.append((last[same], n))
                    kinds.append(1)
                last[same] = n
            owner.append(d)
            spans.append((a, b))
            features.append(_features(text, found, k, shapes))
    return Graph(
        owner,
        spans,
        np.array(features, np.int64).reshape(len(spans), FEATURES),
        np.array(edges, np.int64).reshape(-1, 2),
        np.array(kinds, np.int64),
    )


# -- field


@dataclass
class Field:
    unary: np.ndarray  # features by labels; label 0 is none
    pair: np.ndarray  # chain and skip potentials, symmetric


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def train(texts: list[str | None]) -> Field | None:
    """Pseudo-likelihood: each token's label given its features and its neighbours' labels."""
    g = graph(texts)
    n, labels = len(g.spans), len(KINDS) + 1
    if not n:
        return None
    truth = np.zeros(n, np.int64)
    spans = [base_spans(t) for t in texts]
    for k, (d, (a, b)) in enumerate(zip(g.owner, g.spans, strict=True)):
        truth[k] = next((kind + 1 for s, kind, e in spans[d] if s < b and a < e), 0)
    both = np.concatenate([g.edges, g.edges[:, ::-1]])
    kinds = np.concatenate([g.kinds, g.kinds])
    answers = np.eye(labels)[truth]
    field = Field(np.zeros((WIDTH, labels)), np.zeros((2, labels, labels)))
    sums = [np.zeros_like(field.unary), np.zeros_like(field.pair)]
    for _ in range(STEPS):
        logits = field.unary[g.features].sum(axis=1)
        np.add.at(logits, both[:, 1], field.pair[kinds, truth[both[:, 0]]])
        error = (np.exp(_log_softmax(logits)) - answers) / n
        unary, pair = DECAY * field.unary, DECAY * field.pair
        np.add.at(unary, g.features, error[:, None, :])
        np.add.at(pair, (kinds, truth[both[:, 0]]), error[both[:, 1]])
        pair = (pair + pair.transpose(0, 2, 1)) / 2
        for weights, gradient, total in ((field.unary, unary, sums[0]), (field.pair, pair, sums[1])):
            total += gradient**2
            weights -= RATE * gradient / np.sqrt(total + 1e-12)
    return field


def beliefs(g: Graph, field: Field) -> np.ndarray:
    """Label probabilities of each token after loopy message passing."""
    logits = _log_softmax(field.unary[g.features].sum(axis=1))
    m = len(g.edges)
    if not m:
        return np.exp(logits)
    source = np.concatenate([g.edges[:, 0], g.edges[:, 1]])
    target = np.concatenate([g.edges[:, 1], g.edges[:, 0]])
    potential = field.pair[np.concatenate([g.kinds, g.kinds])]
    back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    messages = np.zeros((2 * m, logits.shape[1]))
    for _ in range(ROUNDS):
        total = logits.copy()
        np.add.at(total, target, messages)
        outgoing = (total[source] - messages[back])[:, :, None] + potential
        top = outgoing.max(axis=1, keepdims=True)
        new = top[:, 0] + np.log(np.exp(outgoing - top).sum(axis=1))
        messages = DAMPING * messages + (1 - DAMPING) * _log_softmax(new)
    total = logits.copy()
    np.add.at(total, target, messages)
    return np.exp(_log_softmax(total))


def added_spans(
    texts: list[str | None], base: list[list[Span]], field: Field | None
) -> list[list[Span]]:
    """Spans of each text that the field adds to the base spans."""
    out: list[list[Span]] = [[] for _ in texts]
    if field is None:
        return out
    g = graph(texts)
    if not g.spans:
        return out
    belief = beliefs(g, field)
    labels = belief.argmax(axis=1)
    sure = (labels > 0) & (belief.max(axis=1) >= BELIEF)
    for k in np.flatnonzero(sure).tolist():
        d, (a, b), kind = g.owner[k], g.spans[k], int(labels[k]) - 1
        if any(s < b and a < e for s, _, e in base[d]):
            continue
        if out[d] and out[d][-1][1] == kind and a - out[d][-1][2] <= 1:
            out[d][-1] = (out[d][-1][0], kind, b)
        else:
            out[d].append((a, kind, b))
    return out


# -- tables


def sample(docs: DataFrame, rows: int = TRAIN_DOCS) -> list[str]:
    """Texts with a digit or ``@`` of at most ``rows`` documents, those of the least hashes."""
    told = docs.filter(F.col("text").rlike("[0-9@]")).select(
        F.xxhash64(F.col("doc_id").cast("string")).alias("place"), "text"
    )
    count = told.count()
    share = min(1.0, 1.5 * rows / count) if count > rows else 1.0
    part = told.filter(F.pmod("place", F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
    # The share leaves little more than `rows`; the limit holds where ids repeat.
    found = part.limit(2 * rows).collect()
    return [r["text"] for r in sorted(found, key=lambda r: (r["place"], r["text"]))[:rows]]


def find(
    docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, base, added`` for each document: arrays of ``start, kind, end``."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kind = source.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])

    def structs(spans: list[list[Span]]) -> pa.Array:
        rows = [[{"start": a, "kind": KINDS[k], "end": b} for a, k, b in x] for x in spans]
        return pa.array(rows, pa.list_(span))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                texts = batch.column("text").to_pylist()
                base = [base_spans(t) for t in texts]
                added = added_spans(texts, base, field)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), structs(base), structs(added)],
                    ["doc_id", "base", "added"],
                )

    spans = "array<struct<start: int, kind: string, end: int>>"
    return arrow_map(source, run, f"doc_id {kind}, base {spans}, added {spans}")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find(docs, train(sample(docs)))
    order = F.array(*map(F.lit, KINDS))

    def joined(spans: Column) -> Column:
        ranked = F.array_sort(
            F.transform(
                spans,
                lambda s: F.struct(
                    s["start"].alias("start"),
                    F.array_position(order, s["kind"]).alias("rank"),
                    s["end"].alias("end"),
                    s["kind"].alias("kind"),
                ),
            )
        )
        return F.array_join(
            F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    counts = [
        F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as bigint)").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"),
    )
