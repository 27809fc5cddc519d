"""Spelling variants of words by a relational trie.

**Words** are counted in each task before they are shuffled. The words of a corpus that
occur often enough are a table of their own, and all else follows from it.

**Trie.** For each word and for each reversed word the table of places has the prefixes from
half of its length on: two words that differ by one code point share a beginning or an end
that is at least half as long as either, so one of the two tries finds them and no state
starts near the root. A prefix with two or more ways on is a node. Edges lead from a node by
their first code point to the next node on the way, with all code points up to it as their
label; a word's end is a code point of its own. Chains without branches are one edge, so a
long word takes no more steps than it has branches.

**Frontier.** A state is ``(word, position, node, edits)``. States without edits are the
word's own places. One join with the edges makes the edit: another code point in the place of
the word's, or one more before it; the label's rest must match. States with one edit are then
joined with the edges level by level until none is left; those that reach a word's end are
neighbours. Of two words that differ by a replacement the one with the lesser code point
starts, of two that differ in length the shorter one; pairs are turned round afterwards. A
node that many words pass is dealt out by word over several tasks, and its edges (no more
than there are letters) go to each of them.

A node is known by its prefix, or from ``LONG`` code points on by the prefix's 128-bit hash;
neighbours are looked up among the words by their spelling, so a hash is never proof. A pair
that both tries could find is left to the first, so each is found once.

**Forms.** A word's form is its most frequent neighbour if that is ``ratio`` times as
frequent. Frequencies grow along forms, so chains are short; roots are found by doubling the
step in each round.

Defined cases: null and empty texts have no words; texts are read whole; rows that repeat
count each time; a null id is written as nothing where it goes into a hash; an empty table
gives no rows; other columns are not read; ties go to the least neighbour in code-point order.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import arrow_map, no_cycles, slices, written

LETTER = "[A-Za-zÀ-ÿ]"
# Different runs that a task counts before it hands them on.
HELD = 300_000
# Words that pass a node, above which they are dealt out over several tasks.
HOT = 4096
# Code points from which on a prefix is known by its hash.
LONG = 32
# Words whose places one task lists.
WORDS_A_TASK = 50_000
END = "\0"

_SMALL = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def lowered(run: str) -> str:
    """Only A to Z become small."""
    return run.lower() if run.isascii() else run.translate(_SMALL)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    return table


class Runs:
    """Runs of letters counted over many texts. The hash of a document's id and a run is that
    of the run alone, which is known once, xor that of the id moved on by the run's bytes: all
    occurrences of a batch are hashed at once."""

    def __init__(self, least_length: int, slip: int):
        self.find = re.compile(f"{LETTER}{{{least_length},}}").findall
        self.least_length, self.slip, self.table = least_length, slip, _crc_table()
        self.clear()

    def clear(self) -> None:
        if hasattr(self, "number"):  # its factory names it: a cycle, which would stay for long
            self.number.default_factory = None
        self.number: dict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.words: list[str] = []
        self.hashes, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.slipped: Counter[str] = Counter()

    def add(self, ids: list, texts: list[str | None]) -> None:
        number = self.number
        found = [list(map(number.__getitem__, self.find(t))) if t else [] for t in texts]
        new = [lowered(run) for run in islice(number, len(self.words), None)]
        raw = [w.encode() for w in new]
        self.words += new
        self.hashes = np.r_[self.hashes, np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw))]
        self.sizes = np.r_[self.sizes, np.fromiter(map(len, raw), np.int64, len(raw))]
        run = np.fromiter(chain.from_iterable(found), np.int64)
        counts = np.bincount(run, minlength=len(self.words))
        if self.slip and len(run):
            doc = np.repeat(np.arange(len(found)), np.fromiter(map(len, found), np.int64, len(found)))
            h = self._hashes(ids, doc, run)
            for at in np.flatnonzero(h % np.uint32(self.slip) == 0).tolist():
                word = self.words[run[at]]
                cut = int(h[at]) % len(word)
                counts[run[at]] -= 1
                if len(word) > self.least_length:
                    self.slipped[word[:cut] + word[cut + 1 :]] += 1
        counts[: len(self.counts)] += self.counts
        self.counts = counts

    def _hashes(self, ids: list, doc: np.ndarray, run: np.ndarray) -> np.ndarray:
        start = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids]
        moved = np.array(start, np.uint32)
        size = self.sizes[run]
        out = np.zeros(len(run), np.uint32)
        order = np.argsort(size, kind="stable")
        sizes, cuts = np.unique(size[order], return_index=True)
        at = 0
        for n, a, b in zip(sizes.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=True):
            for _ in range(n - at):
                moved = self.table[moved & np.uint32(255)] ^ (moved >> np.uint32(8))
            at = n
            out[order[a:b]] = moved[doc[order[a:b]]]
        return out ^ self.hashes[run]

    def rows(self) -> pa.RecordBatch:
        """``word, n``, a word once for each way it was written, and forgets them."""
        there = np.flatnonzero(self.counts)
        words = [self.words[k] for k in there.tolist()] + list(self.slipped)
        n = np.r_[self.counts[there], np.fromiter(self.slipped.values(), np.int64, len(self.slipped))]
        self.clear()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])


def word_counts(
    docs: DataFrame,
    least_length: int = 5,
    least_count: int = 3,
    slip: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``word, n``: words of ``least_length`` code points or more that occur ``least_count``
    times or more. With ``slip``, runs whose hash with the document's id it divides lose one
    code point, as misspelt copies would."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(least_length, slip)
        for whole in batches:
            for batch in slices(whole, "text"):
                with no_cycles():
                    runs.add(batch.column("id").to_pylist(), batch.column("text").to_pylist())
                if len(runs.number) > HELD:
                    yield runs.rows()
        yield runs.rows()

    parts = arrow_map(source, run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _rest(text: str | Column, at: Column) -> Column:
    """The code points of ``text`` from ``at`` on, counted from 0."""
    return F.substring(text, at + 1, F.length(text))


def _node(side: Column, x: Column, depth: Column) -> Column:
    prefix = F.substring(x, F.lit(1), depth)
    known = F.when(depth < LONG, prefix).otherwise(F.concat(F.lit("#"), F.md5(prefix.cast("binary"))))
    return F.concat(side.cast("string"), known)


def _bit(code: Column) -> Column:
    """One of 64 bits for a code point; several share one."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(code, F.lit(64)))


def places(words: DataFrame) -> DataFrame:
    """``side, x, depth, node, next`` of the words' prefixes from half of their length on; ``x``
    is the word with its end, reversed on side 1, and ``next`` a code point's number."""
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("word").alias("x")),
        F.struct(F.lit(1).alias("side"), F.reverse("word").alias("x")),
    )
    rows = words.select(F.explode(sides).alias("s")).select("s.*")
    size = F.length("x")
    depths = F.sequence(F.floor(size / 2).cast("int"), size)
    rows = rows.select("side", F.concat("x", F.lit(END)).alias("x"), F.explode(depths).alias("depth"))
    return rows.select(
        "side", "x", "depth", _node(F.col("side"), F.col("x"), F.col("depth")).alias("node"),
        F.ascii(F.substring("x", F.col("depth") + 1, F.lit(1))).alias("next"),
    )


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``states (side, x, depth, parts)``, the words' places at nodes, and ``edges (node, next,
    label, child, follow, ways, parts)``; ``child`` is null where the label ends a word. ``ways``
    has a bit for each code point that leads on from the child, ``follow`` for those that can
    come after ``next``: the label's second one, or the child's where the label has no other.
    Several code points share a bit, so these only spare work."""
    rows = places(words)
    nodes = rows.groupBy("node").agg(
        F.count("*").alias("n"), F.min("next").alias("least"), F.max("next").alias("most"),
        F.bit_or(_bit(F.col("next"))).alias("ways"),
    )
    nodes = nodes.filter("least < most").select("node", "n", "ways")
    # A word has no more places than code points.
    onward = Window.partitionBy("side", "x").orderBy("depth")
    at = rows.drop("next").join(nodes, "node").drop("node").select(
        "side", "x", "depth", F.ceil(F.col("n") / HOT).cast("int").alias("parts"),
        (F.coalesce(F.lead("depth").over(onward), F.length("x")) - F.col("depth")).alias("size"),
        F.lead("ways").over(onward).alias("ways"),
    )
    at = written(at, "trie")
    # All words that go the same way from a node have the same label and child, so one stands
    # for them.
    one = at.withColumns(
        {
            "node": _node(F.col("side"), F.col("x"), F.col("depth")),
            "next": F.substring("x", F.col("depth") + 1, F.lit(1)),
        }
    ).dropDuplicates(["node", "next"])
    label = F.substring("x", F.col("depth") + 1, F.col("size"))
    second = F.ascii(F.substring("x", F.col("depth") + 2, F.lit(1)))
    edges = one.select(
        "node", "next", "parts", "ways", label.alias("label"),
        F.when(F.col("ways").isNotNull(), _node(F.col("side"), F.col("x"), F.col("depth") + F.col("size")))
        .alias("child"),
        F.when(F.col("size") > 1, _bit(second)).otherwise(F.col("ways")).alias("follow"),
    )
    return at.select("side", "x", "depth", "parts"), written(edges, "edges")


def _has(ways: str, bit: Column) -> Column:
    return F.col(ways).bitwiseAND(bit) != 0


def _onward(rest: Column, label: Column) -> Column:
    """Whether ``label`` matches ``rest`` and there may be a way on, or it ends a word there."""
    further = F.ascii(F.substring(rest, F.length(label) + 1, F.lit(1)))
    return rest.startswith(label) & F.when(F.col("child").isNull(), rest == label).otherwise(
        _has("ways", _bit(further))
    )


def edited(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States with one edit, ``word, near, rest, node``: the word, the spelling it is led to,
    what of it is still to be matched (empty at its end) and from where."""
    s = states.select(
        "side", "x", "depth", _node(F.col("side"), F.col("x"), F.col("depth")).alias("node"),
        F.pmod(F.xxhash64("x"), F.col("parts")).cast("int").alias("part"),
        F.substring("x", F.col("depth") + 1, F.lit(1)).alias("own"),
        _bit(F.ascii(F.substring("x", F.col("depth") + 1, F.lit(1)))).alias("own_bit"),
        _bit(F.ascii(F.substring("x", F.col("depth") + 2, F.lit(1)))).alias("then_bit"),
    )
    e = edges.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    both = s.join(e, ["node", "part"]).filter((F.col("next") != F.col("own")) & (F.col("next") != END))
    # The edge's code point before the word's own, or in its place: then there must be a way on.
    before = _has("follow", F.col("own_bit"))
    instead = (F.col("own") != END) & (F.col("next") > F.col("own")) & _has("follow", F.col("then_bit"))
    both = both.filter(before | instead)
    label = _rest("label", F.lit(1))

    def state(skipped: int, may: Column) -> Column:
        rest = _rest("x", F.col("depth") + skipped)
        return F.when(
            may & _onward(rest, label),
            F.struct(
                F.concat(F.substring("x", F.lit(1), F.col("depth")), F.col("next"), rest).alias("near"),
                _rest(rest, F.length(label)).alias("rest"),
                F.col("child").alias("node"),
            ),
        )

    both = both.select("side", "x", "depth", F.explode(F.array(state(0, before), state(1, instead))).alias("s"))
    # Two words are led to each other where half of the longer one is common, by the trie of
    # beginnings if it can.
    half = F.floor((F.length("s.near") - 1) / 2).cast("int")
    end = lambda name: F.substring(name, F.length(name) - half, half)
    own_side = (F.col("side") == 0) | (end(F.col("x")) != end(F.col("s.near")))
    both = both.filter("s is not null").filter((F.col("depth") >= half) & own_side)
    plain = lambda name: F.when(
        F.col("side") == 0, F.replace(name, F.lit(END), F.lit(""))
    ).otherwise(F.reverse(F.replace(name, F.lit(END), F.lit(""))))
    return both.select(
        plain(F.col("x")).alias("word"), plain(F.col("s.near")).alias("near"), "s.rest", "s.node"
    )


def stepped(states: DataFrame, edges: DataFrame) -> DataFrame:
    """One level on: states whose next label matches."""
    s = states.withColumn("next", F.substring("rest", 1, 1))
    both = s.join(edges.select("node", "next", "label", "child", "ways"), ["node", "next"])
    return both.filter(_onward(F.col("rest"), F.col("label"))).select(
        "word", "near", _rest("rest", F.length("label")).alias("rest"), F.col("child").alias("node")
    )


def neighbours(words: DataFrame) -> DataFrame:
    """``word, near``: all pairs, both ways round, of ``words`` that differ by one inserted,
    deleted or replaced code point."""
    states, edges = trie(words)
    frontier = written(edited(states, edges), "frontier")
    found = frontier.filter("node is null")
    frontier = frontier.filter("node is not null")
    while not frontier.isEmpty():
        level = written(stepped(frontier, edges), "frontier")
        found = found.unionByName(level.filter("node is null"))
        frontier = level.filter("node is not null")
    found = found.select("word", "near")
    return found.unionByName(found.select(F.col("near").alias("word"), F.col("word").alias("near")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for each row of ``forms (word, form)``: the last word along the forms."""
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        further = at.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        at = written(further, "roots")
        if at.filter("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """For each row of ``words (word, n)``: ``word, form, root, n, n_near, form_n``."""
    words = written(words.select("word", "n"), "words")
    # A few megabytes of words make work for many tasks.
    tasks = max(words.sparkSession.sparkContext.defaultParallelism, math.ceil(words.count() / WORDS_A_TASK))
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    near = neighbours(words.repartition(tasks, "word")).join(counts, "near")
    # The most frequent neighbour, of equal ones the least.
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    )
    found = words.join(best, "word", "left")
    has = -F.col("best.minus") >= ratio * F.col("n")
    found = found.select(
        "word",
        F.when(has, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, -F.col("best.minus")).alias("form_n"),
    )
    found = written(found, "forms")
    last = roots(found.filter("form is not null").select("word", "form"))
    return found.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return spelling_variants(word_counts(docs, 5, 3, slip=97))
