"""Near-duplicate documents by SimHash fingerprints and covering locality-sensitive hashing.

**Fingerprint.** One or several lanes of up to 64 bits. A bit is 1 if it is set in over
half the hashes of the document's shingles. Documents are linked whose lanes differ in at
most ``distance`` bits in all; by default one lane of three-word shingles and three bits.

**Candidates.** Bit ``i`` of a lane is given a non-zero vector ``m(i)`` of ``r + 1`` bits,
all vectors alike often. Mask ``v`` (``1 .. 2^(r+1) - 1``) has the bits for which
``m(i) . v`` is odd. If two lanes differ in at most ``r`` bits, the conditions
``m(i) . v = 0`` on those bits are at most ``r`` in ``r + 1`` unknowns, so some non-zero
mask has none of them: the two agree on that mask and meet in its table. Each mask has
about half the bits. Documents that meet in any table are compared, also if they differ in
more bits than the radius.

**Buckets.** Equal fingerprints are one node. Nodes that meet in a bucket are compared in
it, and the bucket gives the edges of a spanning forest of its links, fewer than its
nodes, never all pairs. A bucket of more than ``most`` nodes is dealt out anew by masks
over the bits that its own mask leaves free: the same guarantee holds, and the free bits
halve, so after three deals a bucket of one 64-bit lane has at most 256 nodes. Nodes of
several lanes may still agree on one lane in any number; buckets that are over-full then
are compared in blocks, each pair of blocks in a task of its own.

**Groups** are connected components of the links, found on the cluster.

Defined cases: null and empty texts have no words and fingerprint zero, and link as any
other; a text of fewer words than a shingle is one shingle; texts are hashed whole;
repeated rows have equal fingerprints; null ids are left out when a group's least id is
sought, and a group with no other id has a null component; an empty table gives no rows;
other columns are not read by ``near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import arrow_map, checkpointed, row_key, slices, without_rows
from meterlake.llm.components import components


@dataclass(frozen=True)
class Settings:
    shingle: int = 3  # words of a feature; 0: distinct words
    lanes: int = 1
    bits: int = 64  # of a lane
    radius: int = 3  # within which the masks of a lane are sure to meet
    distance: int = 3  # links differ in so many bits at most
    most: int = 16384  # nodes of a bucket


def masks(positions: list[int], radius: int) -> list[int]:
    """The covering masks over the bits at ``positions``."""
    vectors = [1 + k % ((1 << (radius + 1)) - 1) for k in range(len(positions))]
    return [
        sum(1 << p for p, m in zip(positions, vectors, strict=True) if (m & v).bit_count() % 2)
        for v in range(1, 1 << (radius + 1))
    ]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


# -- fingerprints


def shingles_of(text: str | None, size: int) -> list[bytes]:
    """Shingles of ``size`` words, in UTF-8; with ``size`` 0 the distinct words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if size == 0:
        return sorted(set(words))
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return [b" ".join(s) for s in zip(*(words[k:] for k in range(size)), strict=False)]


def _majority(hashes: np.ndarray) -> np.ndarray:
    """Bits set in over half the rows of ``hashes``, an array of unsigned 64-bit columns."""
    ones = np.zeros(hashes.shape[1] * 64, np.int64)
    for at in range(0, len(hashes), 8192):  # long texts in bounded steps
        part = hashes[at : at + 8192]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)


def _lanes(found: list[bytes], lanes: int) -> np.ndarray:
    """The first lane takes the hash itself, each other one a mix of it."""
    if not found:
        return np.zeros(lanes, np.uint64)
    digest = xxhash.xxh64_intdigest
    first = np.array([digest(x, 42) for x in found], np.uint64)
    hashes = np.empty((len(found), lanes), np.uint64)
    hashes[:, 0] = first
    for k in range(1, lanes):
        mixed = first + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        hashes[:, k] = mixed ^ (mixed >> np.uint64(31))
    return _majority(hashes)


def fingerprint(text: str | None, s: Settings) -> list[int]:
    """Lanes as unsigned numbers."""
    keep = np.uint64((1 << s.bits) - 1)
    return (_lanes(shingles_of(text, s.shingle), s.lanes) & keep).tolist()


def fingerprints(
    docs: DataFrame, s: Settings, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lanes`` for each document; lanes are longs, their bits those of the fingerprint."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                lanes = [
                    [_signed(x) for x in fingerprint(t, s)] for t in batch.column("text").to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(lanes, pa.list_(pa.int64()))],
                    ["doc_id", "lanes"],
                )

    return arrow_map(source, run, f"doc_id {kind}, lanes array<bigint>")


# -- links


def _forest(lanes: np.ndarray, nodes: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between the rows of ``lanes``: each node is
    compared with those that no tree has reached yet."""
    edges, left, reached = [], np.arange(len(nodes)), []
    while len(left) or reached:
        if not reached:
            reached, left = [int(left[0])], left[1:]
        i = reached.pop()
        near = np.bitwise_count(lanes[left] ^ lanes[i]).sum(axis=1, dtype=np.int64) <= distance
        for j in left[near].tolist():
            edges.append((int(nodes[i]), int(nodes[j])))
            reached.append(j)
        left = left[~near]
    return edges


def _table(*columns: list | np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _compared(rows: DataFrame, s: Settings) -> DataFrame:
    """Forest edges of each bucket of ``rows (bucket, node, lanes)``, streamed in bucket order."""
    ordered = rows.select("bucket", "node", "lanes").repartition("bucket").sortWithinPartitions("bucket")

    def edges_of(bucket: np.ndarray, node: np.ndarray, lanes: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        counts = np.diff(np.r_[starts, len(bucket)])
        pair = starts[counts == 2]
        near = np.bitwise_count(lanes[pair] ^ lanes[pair + 1]).sum(axis=1, dtype=np.int64)
        pair = pair[near <= s.distance]
        a, b = [node[pair]], [node[pair + 1]]
        for at, n in zip(starts[counts > 2], counts[counts > 2], strict=True):
            found = np.array(
                _forest(lanes[at : at + n], node[at : at + n], s.distance), np.int64
            ).reshape(-1, 2)
            a.append(found[:, 0])
            b.append(found[:, 1])
        return _table(np.concatenate(a), np.concatenate(b), names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = (
                batch.column("bucket").to_numpy(),
                batch.column("node").to_numpy(),
                batch.column("lanes").flatten().to_numpy().view(np.uint64).reshape(
                    batch.num_rows, -1
                ),
            )
            if rest is not None:
                part = tuple(np.concatenate(x) for x in zip(rest, part, strict=True))
            # The last bucket may go on in the next batch.
            cut = int(np.searchsorted(part[0], part[0][-1]))
            if cut:
                yield edges_of(*(x[:cut] for x in part))
            rest = tuple(x[cut:] for x in part)
        if rest is not None:
            yield edges_of(*rest)

    return arrow_map(ordered, run, "a bigint, b bigint")


def _deal(nodes: DataFrame, s: Settings) -> DataFrame:
    """``nodes`` once for each mask of each table lane: ``bucket, node, lane, mask``."""
    lanes = range(s.lanes)
    tables = [(lane, mask) for lane in lanes for mask in masks(list(range(s.bits)), s.radius)]
    keys = F.array(
        *(
            F.struct(
                F.lit(lane).alias("lane"),
                F.lit(_signed(mask)).alias("mask"),
                F.get("lanes", F.lit(lane)).bitwiseAND(F.lit(_signed(mask))).alias("key"),
            )
            for lane, mask in tables
        )
    )
    rows = nodes.select("node", F.explode(keys).alias("k"))
    return rows.select(
        F.xxhash64("k.lane", "k.mask", "k.key").alias("bucket"), "node", "k.lane", "k.mask"
    )


def _deal_anew(rows: DataFrame, s: Settings) -> DataFrame:
    """Rows of over-full buckets once for each mask over the bits that are free in their lane."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                lane = batch.column("lane").to_numpy()
                used = batch.column("mask").to_numpy().view(np.uint64)
                for k, mask in sorted(set(zip(lane.tolist(), used.tolist(), strict=True))):
                    chosen = batch.filter(pa.array((lane == k) & (used == mask)))
                    free = [p for p in range(s.bits) if not mask >> p & 1]
                    for m in masks(free, s.radius):
                        more = pa.array(np.full(chosen.num_rows, _signed(mask | m), np.int64))
                        columns = [chosen.column(c) for c in ("node", "lanes", "lane")]
                        yield pa.RecordBatch.from_arrays(
                            [*columns, more], ["node", "lanes", "lane", "mask"]
                        )

    dealt = arrow_map(
        rows.select("node", "lanes", "lane", "mask"), run, "node bigint, lanes array<bigint>, lane int, mask bigint"
    )
    key = F.get("lanes", F.col("lane")).bitwiseAND(F.col("mask"))
    return dealt.select(F.xxhash64("lane", "mask", key).alias("bucket"), "node", "lane", "mask")


def _blocks(rows: DataFrame, s: Settings) -> DataFrame:
    """Over-full buckets as one bucket for each pair of their blocks."""
    half = s.most // 2
    blocks = F.ceil(F.col("count") / half).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    pairs = rows.withColumn("own", own).withColumn("blocks", blocks).select(
        "bucket", "node", "lanes", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    return pairs.select(
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"),
        "node",
        "lanes",
    )


def _met(rows: DataFrame) -> DataFrame:
    """Rows of buckets with company, with their ``count``; one shuffle serves both sides."""
    dealt = rows.repartition("bucket")
    sizes = dealt.groupBy("bucket").count().filter("count > 1")
    return checkpointed(dealt.join(sizes, "bucket"))


def links(nodes: DataFrame, s: Settings) -> DataFrame:
    """Edges ``a, b`` between ``nodes (node, lanes)``; all that are linked are connected."""
    found, rows = [], _deal(nodes, s)
    for _ in range(3):
        met = _met(rows)
        few = met.filter(F.col("count") <= s.most).select("bucket", "node")
        found.append(_compared(few.join(nodes, "node"), s))
        over = met.filter(F.col("count") > s.most)
        if over.isEmpty():
            break
        over = over.join(nodes, "node")
        rows = _deal_anew(over, s)
    else:
        found.append(_compared(_blocks(over, s), s))
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges


# -- groups


def near_duplicates(
    docs: DataFrame, s: Settings | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lanes, component_id`` for each document; the component is its least id."""
    s = s or Settings()
    prints = checkpointed(fingerprints(docs, s, id_col, text_col))
    node = F.get("lanes", F.lit(0)) if s.lanes == 1 else F.xxhash64("lanes")
    nodes = prints.groupBy("lanes").agg(F.min("doc_id").alias("least")).withColumn("node", node)
    nodes = checkpointed(nodes)
    joined = components(links(nodes.select("node", "lanes"), s))
    linked = nodes.join(joined, "node").select("lanes", "component", "least")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = linked.join(least, "component").select("lanes", "component_id")
    alone = nodes.join(linked.select("lanes"), "lanes", "left_anti").select(
        "lanes", F.col("least").alias("component_id")
    )
    return prints.join(linked.unionByName(alone), "lanes").select("doc_id", "lanes", "component_id")


def deduplicate(
    docs: DataFrame, s: Settings | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay: of each group that with the least id, null ids last;
    rows that repeat its id and text stay with it."""
    keyed = docs.select(row_key(docs, id_col, text_col).alias("doc_id"), F.col(text_col).alias("text"))
    groups = near_duplicates(keyed, s)
    dropped = groups.filter(F.col("doc_id") != F.col("component_id")).select("doc_id")
    return without_rows(docs, dropped, id_col, text_col)


OP6 = Settings()


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, OP6).select(
        "doc_id",
        F.lower(F.lpad(F.hex(F.get("lanes", F.lit(0))), 16, "0")).alias("fingerprint"),
        "component_id",
    )
