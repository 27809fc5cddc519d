"""Exact, substring and near deduplication against brute force."""

from __future__ import annotations

import dataclasses
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from meterlake.llm import exact_dedup, simhash, substring_dedup
from meterlake.llm.components import components
from tests.llm.data import DOCS, SF, ordered, rows


def test_exact_equals_sql(spark):
    found = exact_dedup.op1_exact_dedup(spark, SF)
    columns = ["doc_id", "group_size", "keep_id", "kept", "text_sha256"]
    expected = rows(f"select {', '.join(columns)} from ({exact_dedup.OP1_SQL})")
    assert ordered(found.select(columns).collect()) == ordered(expected)


def test_exact_cases(docs, crowded):
    found = exact_dedup.classify(docs, keep="largest")
    got = ordered(found.select("doc_id", "keep_id", "group_size", "kept").collect())
    assert got == ordered(
        [
            (1, 2, 3, False), (2, 2, 3, True), (2, 2, 3, False),
            (3, 4, 3, False), (4, 4, 3, True), (None, 4, 3, False),
            (None, None, 1, True), (5, 5, 1, True), (6, 6, 1, True), (7, 7, 1, True),
        ]
    )
    kept = exact_dedup.deduplicate(crowded)
    assert kept.columns == crowded.columns
    assert ordered(kept.select("doc_id").collect()) == ordered([(1,), (3,), (None,), (5,), (6,), (7,)])
    assert exact_dedup.classify(docs.filter("false")).count() == 0


def test_exact_counts_rows_that_repeat_id_and_text(spark, monkeypatch):
    """A hot row is made of its count, in several runs; null ids too; without a broadcast."""
    monkeypatch.setattr(exact_dedup, "RUN", 4)
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", 0)
    data = [(7, "hot")] * 11 + [(5, "hot")] * 2 + [(None, "lost")] * 9 + [(1, "lone"), (None, "alone")]
    found = exact_dedup.classify(spark.createDataFrame(data, "doc_id long, text string"), keep="largest")
    got = ordered(found.select("doc_id", "keep_id", "group_size", "kept").collect())
    assert got == ordered(
        [(7, 7, 13, True)] + [(7, 7, 13, False)] * 10 + [(5, 7, 13, False)] * 2
        + [(None, None, 9, True)] + [(None, None, 9, False)] * 8
        + [(1, 1, 1, True), (None, None, 1, True)]
    )


def test_exact_tells_texts_of_one_hash_apart(docs):
    one = exact_dedup.classify(docs, hash_of=lambda text: F.unhex(F.md5(F.lit("one"))))
    plain = exact_dedup.classify(docs)
    assert ordered(one.collect()) == ordered(plain.collect())


def _without_repeats(texts, run, min_words):
    """Sentences and removed ones of each text, in plain Python."""
    first, parts = {}, {}
    for doc, text in sorted(texts.items()):
        spans = substring_dedup.sentences(text)
        parts[doc] = spans
        for k in range(max(1, len(spans) - run + 1) if spans else 0):
            key = tuple(text[a:b].strip() for a, b in spans[k : k + run])
            if sum(len(p.split()) for p in key) >= min_words:
                first.setdefault(key, []).append((doc, k))
    gone = {doc: set() for doc in texts}
    for places in first.values():
        for doc, k in sorted(places)[1:]:
            gone[doc] |= set(range(k, min(k + run, len(parts[doc]))))
    return {doc: [parts[doc][k] for k in sorted(gone[doc])] for doc in texts}


def test_substring_equals_brute_force(spark):
    texts = dict(rows("select doc_id, text from documents"))
    expected = _without_repeats(texts, substring_dedup.RUN, substring_dedup.MIN_WORDS)
    found = {r.doc_id: r for r in substring_dedup.op2_substring_dedup(spark, SF).collect()}
    assert len(found) == len(texts) and any(expected.values())
    for doc, spans in expected.items():
        assert found[doc].removed == ",".join(f"{a}:{b}" for a, b in spans)
        kept, end = "", 0
        for a, b in spans:
            kept += texts[doc][end:a]
            end = b
        assert found[doc].text == kept + texts[doc][end:]


def test_substring_cases(docs, crowded):
    found = substring_dedup.remove_repeats(crowded)
    assert found.count() == 10 and set(crowded.columns) == set(found.columns)
    by = {r.doc_id: r for r in found.collect()}
    assert by[1].n_removed == 0 and by[2].n_removed == 1 and by[2].text == ""
    # The long text repeats itself: the run at its second sentence is one already.
    assert by[5].n_sentences == 4000 and by[5].n_removed == 3999
    assert (by[4].n_sentences, by[4].text) == (0, "")
    assert substring_dedup.remove_repeats(docs.filter("false")).count() == 0


def _groups(nodes, near):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for k, a in enumerate(nodes):
        for b in nodes[:k]:
            if near(a, b):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def test_simhash_equals_brute_force(spark):
    prints = {}
    for doc, text in rows("select doc_id, text from documents"):
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        pieces = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(p, 42) for p in pieces]
        prints[doc] = sum(
            1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
        )
    groups = _groups(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    expected = [(doc, f"{p:016x}", groups[doc]) for doc, p in prints.items()]
    assert ordered(simhash.op6_simhash(spark, SF).collect()) == ordered(expected)


def test_masks_cover_every_near_pair():
    rng = random.Random(1)
    for bits in (64, 56, 7):
        masks = simhash.masks(list(range(bits)), 3)
        assert len(masks) == 15
        for _ in range(500):
            apart = sum(1 << b for b in rng.sample(range(bits), 3))
            assert any(not mask & apart for mask in masks)


def test_links_are_whole_in_dense_and_over_full_buckets(spark):
    rng = random.Random(2)
    values = set()
    for _ in range(2):
        centre = rng.getrandbits(64)
        for _ in range(120):
            value = centre
            for _ in range(rng.randrange(8)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    values = sorted(values)
    expected = _groups(values, lambda a, b: (a ^ b).bit_count() <= 3)
    signed = simhash._signed
    nodes = spark.createDataFrame(
        [(signed(v), [signed(v)]) for v in values], "node long, lanes array<long>"
    )
    for most in (8, 16384):
        edges = simhash.links(nodes, dataclasses.replace(simhash.OP6, most=most))
        found = {r.node: r.component for r in components(edges).collect()}
        got, want = {}, {}
        for v in values:
            got.setdefault(found.get(signed(v), ("alone", v)), set()).add(v)
            want.setdefault(expected[v], set()).add(v)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_forest_spans_each_group():
    rng = np.random.default_rng(3)
    lanes = rng.integers(0, 4, (60, 1)).astype(np.uint64)
    edges = simhash._forest(lanes, np.arange(60), 0)
    assert len(edges) == 60 - len(np.unique(lanes))
    assert all(lanes[a] == lanes[b] for a, b in edges)


def test_near_copies_go_and_others_stay(spark):
    """Case, white space and single words of long texts; other texts of the same length stay."""
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    text = lambda n: ["".join(rng.choices(letters, k=6)) for _ in range(n)]
    documents, copies = [], set()
    for k in range(40):
        words = text(200)
        documents.append((10 * k, " ".join(words)))
        if k % 2:
            documents.append((10 * k + 1, "\n ".join(words).title()))
            copies.add(10 * k + 1)
        edited = " ".join([*words[:-1], "changed"])
        documents.append((10 * k + 2, edited))
        apart = [simhash.fingerprint(t, simhash.OP6)[0] for t in (" ".join(words), edited)]
        if (apart[0] ^ apart[1]).bit_count() <= 3:
            copies.add(10 * k + 2)
    assert any(c % 10 == 2 for c in copies)
    kept = simhash.deduplicate(spark.createDataFrame(documents, "doc_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in documents} - copies


def test_near_cases(docs, crowded):
    found = simhash.near_duplicates(docs, simhash.OP6)
    by = {(r.doc_id, r.component_id) for r in found.collect()}
    assert {(1, 1), (2, 1), (3, 3), (4, 3), (None, 3), (5, 5), (7, 7)} <= by
    kept = simhash.deduplicate(crowded)
    assert kept.columns == crowded.columns
    # Of null, empty and equal texts the least id stays; ids that are null come last.
    left = ordered(kept.select("doc_id", "text").collect())
    assert left == ordered([d[:2] for d in (DOCS[0], DOCS[3], DOCS[5], *DOCS[7:])])
    repeated = docs.unionByName(docs)
    assert simhash.deduplicate(repeated).count() == 2 * len(left)
    assert simhash.near_duplicates(docs.filter("false")).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(50)] + [(100, 101)], "a long, b long")
    found = {r.node: r.component for r in components(edges).collect()}
    assert found == {**{k: 0 for k in range(51)}, 100: 100, 101: 100}
    assert components(edges.filter("false")).count() == 0
