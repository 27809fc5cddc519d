"""Spelling variants against a plain implementation."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from meterlake.llm import spelling
from tests.llm.data import SF, ordered, rows


def _counts(documents):
    found = Counter()
    for doc, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if h % 97 == 0:
                cut = h % len(run)
                run = run[:cut] + run[cut + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def _near(a, b):
    """By definition: a replaced, inserted or deleted code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def _expected(counts):
    by_size, near = {}, {w: [] for w in counts}
    for w in counts:
        by_size.setdefault(len(w), []).append(w)
    for w in counts:
        for size in (len(w) - 1, len(w), len(w) + 1):
            near[w] += [v for v in by_size.get(size, ()) if _near(w, v)]
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-counts[v], v))
            if counts[best] >= 2 * counts[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return [(w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()]


def test_query_equals_brute_force(spark):
    counts = _counts(rows("select doc_id, text from documents"))
    assert len(counts) > 500
    found = ordered(spelling.op13_spelling(spark, SF).collect())
    expected = _expected(counts)
    assert sum(r[1] is not None for r in expected) > 5
    assert found == ordered(expected)


def test_dense_words(spark, monkeypatch):
    """Words of few letters, with long ones, runs of one letter, prefixes and repeats."""
    monkeypatch.setattr(spelling, "HOT", 3)
    rng = random.Random(5)
    counts = {"".join(rng.choices("abé", k=rng.randrange(5, 9))): rng.randrange(3, 500) for _ in range(400)}
    counts |= {"a" * k: 3 * k for k in range(5, 30)}
    long = "".join(rng.choices("abcd", k=200))
    counts |= {long: 3, long + "x": 7, long[:-1]: 9, long[:40] + long[41:]: 20, "y" + long: 6, long[:100] + "z" + long[101:]: 50}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = ordered(spelling.spelling_variants(words).collect())
    assert found == ordered(_expected(counts))


def test_chains_of_forms(spark):
    chain = [("w" * 5 + "x" * k, 3 * 2**k) for k in range(20)]
    found = spelling.spelling_variants(spark.createDataFrame(chain, "word string, n long")).collect()
    assert {r.root for r in found} == {chain[-1][0]}
    assert {r.n_near for r in found} == {1, 2}


def test_words_of_texts(spark, docs, crowded, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 2)
    found = {r.word: r.n for r in spelling.word_counts(crowded, slip=97).collect()}
    assert found == _counts([("" if d[0] is None else d[0], d[1]) for d in docs.select("doc_id", "text").collect()])
    many = spark.createDataFrame([(k, "Straße Àbcdefg ×÷×÷×÷ " * 300) for k in range(200)], "doc_id long, text string")
    slips = {r.word: r.n for r in spelling.word_counts(many, slip=97).collect()}
    assert slips == _counts([tuple(r) for r in many.collect()]) and len(slips) > 3
    plain = {r.word: r.n for r in spelling.word_counts(docs, 1, 1).collect()}
    assert plain["Über"] == 1
    assert plain["twice"] == 3
    twice = {r.word: r.n for r in spelling.word_counts(docs.unionByName(docs), 1, 1).collect()}
    assert twice == {w: 2 * n for w, n in plain.items()}
    assert spelling.word_counts(docs.filter("false")).count() == 0
    none = spelling.word_counts(docs.filter("false"))
    assert spelling.spelling_variants(none).count() == 0
    nulls = docs.withColumn("text", F.lit(None).cast("string"))
    assert spelling.spelling_variants(spelling.word_counts(nulls)).count() == 0
