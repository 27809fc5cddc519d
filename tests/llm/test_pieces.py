"""SentencePiece encoding and decoding against the library."""

from __future__ import annotations

import hashlib
import random
import struct
from itertools import pairwise

import numpy as np
import pytest
import public_tokenizers
import sentencepiece

from meterlake.llm import lockstep, pieces
from tests.llm.data import SF, ordered, rows
from tests.llm.test_text import odd_texts

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _encoded(own: pieces.Tokenizer, texts: list[str | None]) -> list[list[int]]:
    flat, counts = own.encode(texts)
    return [part.tolist() for part in np.split(flat, np.cumsum(counts)[:-1])]


def test_encoding_equals_the_library(monkeypatch):
    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.load(PIECES)
    rng = random.Random(1)
    texts = odd_texts() + ["".join(rng.choices("aerthin  ", k=rng.randrange(200))) for _ in range(500)]
    texts += [" " * n + "a" * m for n in range(40) for m in (0, 1, 5)]  # pieces of equal score
    texts += ["<s> <unk> <0x41>▁▁", "a" * 5000, "th" * 900 + "é", "\0", "▁", " ", "﻿x", "日本語テキスト" * 20]
    texts += [html for (html,) in rows("select html from pages limit 20")]
    expected = [library.encode(t) for t in texts]
    assert _encoded(own, texts) == expected
    assert [own.text_of([1, *e, 2]) for e in expected] == [library.decode([1, *e, 2]) for e in expected]
    # The same with little memory and words taken one by one.
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    monkeypatch.setattr(lockstep, "KEPT_ANSWERS", 64)
    monkeypatch.setattr(lockstep, "LOCKSTEP", 4)
    monkeypatch.setattr(lockstep, "STEP_SYMBOLS", 50)
    own.paths.forget()
    assert [x for t in texts[:200] for x in _encoded(own, [t])] == expected[:200]
    own.paths.forget()


def test_decoding_equals_the_library():
    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.load(PIECES)
    rng = random.Random(2)
    for _ in range(5000):
        ids = [rng.randrange(rng.choice([10, 300, 32000])) for _ in range(rng.randrange(12))]
        assert own.text_of(ids) == library.decode(ids)


def test_pairs_equal_merging_in_order():
    """Random small vocabularies, with equal scores too, against merging step by step."""
    rng = random.Random(3)
    for _ in range(60):
        names = ["▁", "a", "b", "c"]
        while len(names) < 14:
            joined = rng.choice(names) + rng.choice(names)
            if joined not in names and "▁" not in joined.lstrip("▁"):
                names.append(joined)
        scores = {p: -float(k if rng.random() < 0.7 or "▁▁" not in p else 99) for k, p in enumerate(names)}
        number = {p: k for k, p in enumerate(names)}
        try:
            paths = pieces.Tokenizer._paths(number, scores, len(names))
        except ValueError:
            continue  # a piece before its parts

        def merged(text):
            parts = list(text)
            while True:
                found = [
                    (-scores[a + b], k) for k, (a, b) in enumerate(pairwise(parts)) if a + b in scores  # noqa: B023
                ]
                if not found:
                    return [number[p] for p in parts]  # noqa: B023
                at = min(found)[1]
                parts[at : at + 2] = [parts[at] + parts[at + 1]]

        texts = ["".join(rng.choices("abc▁", k=rng.randrange(1, 14))) for _ in range(40)]
        flat, counts = paths.encode([t.encode() for t in texts])
        got = [part.tolist() for part in np.split(flat, np.cumsum(counts)[:-1])]
        assert got == [merged(t) for t in texts]


def test_query_equals_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = []
    for doc, text in rows("select doc_id, text from documents"):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        decoded = library.decode(ids).encode()
        expected.append((doc, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    assert ordered(pieces.op11_sentencepiece(spark, SF).collect()) == ordered(expected)


def test_cases(crowded):
    found = pieces.encode(crowded, PIECES, decoded="decoded")
    assert set(found.columns) == set(crowded.columns)
    got = found.select("doc_id", "text", "ids", "decoded").collect()
    assert {(r.doc_id, tuple(r.ids), r.decoded) for r in got if not r.text} == {
        (3, (1, 2), ""), (4, (1, 2), ""), (None, (1, 2), "")
    }
    assert all(r.decoded == (r.text or "") for r in got)
    again = pieces.decode(found, PIECES, out="text_sha256").select("decoded", "text_sha256").collect()
    assert all(r.text_sha256 == r.decoded for r in again)
    assert pieces.encode(crowded.filter("false"), PIECES).count() == 0


def test_takes_no_other_kind(tmp_path):
    with pytest.raises((ValueError, OSError, RuntimeError)):
        pieces.load(public_tokenizers.path("word_bpe_49k.json"))
