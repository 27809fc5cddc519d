"""Repeated passages that hold no two whole sentences, and rows that share an id."""

from __future__ import annotations

import random

from meterlake.llm import substring_dedup


def _words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(n))


def test_a_long_sentence_goes_between_other_neighbours(spark):
    rng = random.Random(21)
    for n in (50, 51, 90):
        long = _words(rng, n) + "."
        texts = [f"{_words(rng, 12)}. {long} {_words(rng, 12)}." for _ in range(2)]
        frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found = {r.doc_id: r.text for r in substring_dedup.remove_repeats(frame).collect()}
        assert found[0] == texts[0]
        assert found[1] == texts[1].replace(" " + long, "")


def test_a_repeated_word_makes_a_long_sentence_of_pieces():
    spans = substring_dedup.sentences("ha " * 200)
    assert len(spans) > 1 and max(b - a for a, b in spans) <= 3 * substring_dedup.MOST_WORDS
    assert spans[0][0] == 0 and spans[-1][1] == 600
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_most_of_a_passage_without_ends_goes(spark):
    rng, texts, passages = random.Random(22), [], []
    for _ in range(40):
        passages.append(_words(rng, 80))
        texts += [f"{_words(rng, rng.randrange(5, 60))} {passages[-1]} {_words(rng, rng.randrange(5, 60))}" for _ in range(2)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.text for r in substring_dedup.remove_repeats(frame).collect()}
    for k, passage in enumerate(passages):
        assert found[2 * k] == texts[2 * k]
        gone = set(passage.split()) - set(found[2 * k + 1].split())
        assert len(gone) >= 40
        # Only words of the passage go.
        assert set(texts[2 * k + 1].split()) - set(found[2 * k + 1].split()) == gone


def test_a_passage_of_short_sentences_goes(spark):
    rng = random.Random(23)
    passage = " ".join(w + "!!" for w in _words(rng, 60).split())
    texts = [f"{_words(rng, 12)}. {passage} {_words(rng, 12)}." for _ in range(2)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.text for r in substring_dedup.remove_repeats(frame).collect()}
    assert found == {0: texts[0], 1: texts[1].replace(" " + passage, "")}


def test_rows_of_one_id_are_told_apart_by_text(spark):
    """A repeat in one text does not cut another of the same id, and is found within the id."""
    rng = random.Random(24)
    passage = f"{_words(rng, 12)}. {_words(rng, 12)}."
    for ident in (7, None):
        clean = " ".join(f"{_words(rng, 12)}." for _ in range(4))
        texts = [f"{passage} {_words(rng, 12)}." for _ in range(2)] + [clean]
        frame = spark.createDataFrame(
            [(1, passage)] * (ident is not None) + [(ident, t) for t in texts], "doc_id long, text string"
        )
        left = [r.text for r in substring_dedup.remove_repeats(frame).collect()]
        assert clean in left
        assert sum(passage in t for t in left) == 1
