"""Tokenizers, language, quality, benchmark passages and personal data against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from meterlake.llm import bpe, decontaminate, language_id, pii, quality, token_counts
from tests.llm.data import DOCS, SF, ordered, rows

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def odd_texts() -> list[str]:
    rng = random.Random(5)
    kinds = (lambda: rng.randrange(32, 127), lambda: rng.randrange(0x80, 0x3000), lambda: rng.randrange(0x10000, 0x1FFFF))
    texts = ["".join(chr(rng.choice(kinds)()) for _ in range(rng.randrange(50))) for _ in range(300)]
    texts += ["".join(rng.choices("aehtnsAEÉ' ", k=rng.randrange(80))) for _ in range(300)]
    return texts + ["a<|endoftext|>b <|startoftext|>", "x\x1cy\x1fz\x85w​q", "ΑΣ ΑΣΑΣ", "İstanbul", "IT'S we'LL", ""]


# -- BPE


def test_bpe_equals_the_library():
    library, own = Tokenizer.from_file(WORD_BPE), bpe.load(WORD_BPE)
    texts = odd_texts() + [html for (html,) in rows("select html from pages limit 20")]
    texts += ["x" * 3000 + "yz" * 400 + " " + "ab" * 90, "é" * 500]
    flat, counts = own.encode(texts)
    parts = np.split(flat, np.cumsum(counts)[:-1])
    for part, expected in zip(parts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = part.tolist()
        assert ids == expected.ids
        assert bpe.text_of(ids, own.labels) == library.decode(ids, skip_special_tokens=False)


def test_automaton_equals_merging_in_order():
    """Random small vocabularies against merging the first pair again and again."""
    rng = random.Random(6)
    for _ in range(60):
        tokens, merges = ["a", "b", "c"], []
        while len(merges) < 12:
            u, v = rng.choice(tokens), rng.choice(tokens)
            if u + v not in tokens:
                merges.append((u, v))
                tokens.append(u + v)
        number = {t: k for k, t in enumerate(tokens)}
        auto = bpe.Automaton([0, 1, 2], [(number[u], number[v], number[u + v]) for u, v in merges], len(tokens))

        def merged(word):
            parts = list(word)
            for u, v in merges:  # noqa: B023
                k = 0
                while k + 1 < len(parts):
                    if (parts[k], parts[k + 1]) == (u, v):
                        parts[k : k + 2] = [u + v]
                    k += 1
            return [number[p] for p in parts]  # noqa: B023

        for _ in range(60):
            word = "".join(rng.choices("abc", k=rng.randrange(1, 12)))
            path = merged(word)
            assert all(auto.has_arc(a, b) for a, b in zip([-1, *path], path, strict=False))
            if len(path) > 1:
                assert auto.have_arcs(np.array(path[:-1]), np.array(path[1:])).all()
            # No other sequence of tokens with this text is accepted.
            other = [number[c] for c in word]
            if other != path:
                assert not all(auto.has_arc(a, b) for a, b in zip([-1, *other], other, strict=False))
                assert not auto.have_arcs(np.array(other[:-1]), np.array(other[1:])).all()


@pytest.mark.parametrize("remembered", [1, 2, 7, 300])
def test_bpe_forgets_pieces_not_results(monkeypatch, remembered):
    monkeypatch.setattr(bpe, "REMEMBERED", remembered)
    library, own = Tokenizer.from_file(WORD_BPE), bpe.load(WORD_BPE)
    texts = [t for (t,) in rows("select text from documents order by doc_id limit 60")]
    texts += ["", None, "<|endoftext|> a<|startoftext|>", "na\u00efve x\x1cy", "\u043f\u0440\u0438\u0432\u0435\u0442 123.5"]
    for _ in range(2):
        for at in range(0, len(texts), 9):
            part = texts[at : at + 9]
            ids, counts = own.encode(part)
            assert len(own.known) <= remembered
            expected = [library.encode(t or "", add_special_tokens=False).ids for t in part]
            assert ids.tolist() == [i for e in expected for i in e]
            assert counts.tolist() == list(map(len, expected))


def test_bpe_query_round_trip(spark):
    library = Tokenizer.from_file(WORD_BPE)
    expected = []
    for doc, text in rows("select doc_id, text from documents"):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((doc, len(ids), sha(" ".join(map(str, ids))), sha(decoded)))
    assert ordered(bpe.op9_bpe(spark, SF).collect()) == ordered(expected)


def test_bpe_cases(crowded):
    found = bpe.encode(crowded, WORD_BPE)
    assert set(found.columns) == set(crowded.columns)
    got = bpe.decode(found, WORD_BPE).select("doc_id", "ids", "decoded").collect()
    assert len(got) == 10
    assert {(r.doc_id, r.decoded) for r in got if not r.ids} == {(3, ""), (4, ""), (None, "")}
    assert bpe.encode(crowded.filter("false"), WORD_BPE).count() == 0


def test_bpe_takes_no_other_kind():
    with pytest.raises((ValueError, KeyError, TypeError)):
        bpe.load(public_tokenizers.path("byte_bpe_50k.json"))


# -- token counts


def test_counts_equal_the_library(spark):
    pieces = token_counts.vocabulary(PIECES)
    library = Tokenizer(models.Unigram(pieces, 0, True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    own = token_counts.Counter(pieces)
    texts = odd_texts() + ["<s> <0x41>▁▁", "  two", "\n\n"]
    assert [own.count(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts)]
    expected = [(d, len(library.encode(t or "").ids)) for d, t in rows("select doc_id, text from documents")]
    assert ordered(token_counts.op3_token_counts(spark, SF).collect()) == ordered(expected)


def test_count_ties_and_unknowns():
    names = ["a", "b", "ab", "ba", "aa", "aab", "▁", "▁a", "c▁"]
    pieces = [("<unk>", 0.0), *((p, -1.0 * len(p)) for p in names), ("é", -3.0)]
    library = Tokenizer(models.Unigram(pieces, 0, False))
    library.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    own, rng = token_counts.Counter(pieces), random.Random(7)
    for _ in range(500):
        text = "".join(rng.choices("aabbcé ", k=rng.randrange(1, 20)))
        assert own.count(text) == len(library.encode(text).ids)


def test_count_cases(crowded):
    found = token_counts.count_tokens(crowded, PIECES)
    assert set(found.columns) == set(crowded.columns)
    assert {(r.doc_id, r.n_tokens) for r in found.collect()} >= {(3, 0), (4, 0), (None, 0)}
    assert token_counts.count_tokens(crowded.filter("false"), PIECES).count() == 0


# -- language


def test_language_of_held_out_documents(spark):
    truth = dict(rows("select doc_id, lang from documents"))
    found = language_id.op5_language_id(spark, SF).collect()
    assert sorted(r.doc_id for r in found) == sorted(truth)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_kernel_scores_equal_the_plain_kernel():
    """Weights over n-grams give what kernels with the landmarks and coefficients give."""
    samples = [("the cat sat", "en"), ("der hund lief", "de"), ("a dog ran", "en"), ("die katze", "de")]
    _equal_kernels(samples, ("the hund", "katze ran xyz", "", "a"))


def test_kernel_of_large_alphabets():
    """More characters than fit a byte, and code points beyond 16 bits."""
    wide = "".join(chr(0x4E00 + 7 * k) for k in range(400))
    samples = [(wide, "zh"), ("\U00020000\U00020001 " + wide[::-1], "zh"), ("москва и река", "ru"), ("река нева", "ru")]
    _equal_kernels(samples, (wide[100:140], "\U00020001 нева", "река ok"))


def _equal_kernels(samples, texts):
    languages = sorted({lang for _, lang in samples})
    model = language_id.fit(samples)

    def grams(text):
        return {text[k : k + n] for n in (1, 2, 3) for k in range(len(text) - n + 1)}

    marks = [t for lang in languages for t, other in samples if other == lang]

    def kernel(a, b):
        x, y = grams(a), grams(b)
        return len(x & y) / max(1, len(x)) ** 0.5 / max(1, len(y)) ** 0.5

    c = np.array([[kernel(t, m) for m in marks] for t, _ in samples])
    w = np.array([[kernel(a, b) for b in marks] for a in marks])
    y = np.array([[lang == other for other in languages] for _, lang in samples], float)
    ridge = language_id.RIDGE * len(samples) * (w + 1e-6 * np.eye(len(w)))
    a = np.linalg.solve(c.T @ c + ridge, c.T @ y)
    for text in texts:
        expected = np.array([kernel(text, m) for m in marks]) @ a
        bits, norms = language_id._matrix([text], model)
        got = (bits @ model.weights / norms)[0]
        assert np.allclose(got, expected, atol=1e-4)


def test_foreign_texts_with_one_known_word_go(spark):
    """With a full sample; a model of few texts gives all texts higher scores."""
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.1')}/documents.parquet")
    model = language_id.learn(docs)
    foreign = [
        "Москва является столицей России и крупнейшим городом страны ok",
        "这是一个很长的中文句子，用来测试语言识别的能力 ok",
        "Быстрая коричневая лиса перепрыгивает через ленивую собаку the",
    ]
    strange = spark.createDataFrame([(k, t) for k, t in enumerate(foreign)], "doc_id long, text string")
    assert language_id.keep_identified(strange, model).count() == 0
    lettered = docs.filter("regexp_like(text, '[A-Za-z]')")
    assert language_id.keep_identified(lettered, model).count() == lettered.count()


def test_language_sample_is_bounded(spark):
    """Rows without an id, and one row many times: the sample is of different texts, by hash."""
    rows = [(None, f"text {k}", "en") for k in range(3000)] + [(1, "same", "de")] * 3000
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language_id.sample(labelled, 50)
    assert len(found) == len(set(found)) == 51
    assert found == language_id.sample(labelled.repartition(7), 50)
    assert found.count(("same", "de")) == 1


def test_language_cases(docs, crowded):
    model = language_id.learn(docs)
    found = {(r.doc_id, r.lang_pred, r.score == 0) for r in language_id.identify(crowded, model).collect()}
    assert {(3, "und", True), (4, "und", True), (6, "und", True), (None, "und", True)} <= found
    assert {r[1] for r in found} <= {"und", *model.languages}
    none = language_id.identify(docs, language_id.learn(docs.filter("false")))
    assert {(r.lang_pred, r.score) for r in none.collect()} == {("und", 0.0)}
    kept = language_id.keep_identified(crowded, model)
    assert kept.columns == crowded.columns
    assert {3, 4, 6}.isdisjoint({r.doc_id for r in kept.collect()})
    assert language_id.identify(docs.filter("false"), model).count() == 0


# -- quality


def test_quality_of_held_out_documents(spark):
    truth = dict(rows("select doc_id, quality from labels"))
    found = quality.op8_quality(spark, SF).collect()
    assert len(found) == rows("select count(*) from documents")[0][0]
    good, bad = [], []
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        if r.held_out and r.doc_id in truth:
            (good if truth[r.doc_id] else bad).append(r.score)
    pairs = [g > b for g in good for b in bad]
    assert sum(pairs) >= 0.9 * len(pairs)


def test_quality_follows_ftrl():
    """One document of one feature repeated: the closed form of the first update."""
    model = quality.train([("", 1)], epochs=1)
    gradient = -0.5
    step = abs(gradient) / quality.ALPHA
    z = gradient - step * 0
    expected = -(z - np.sign(z) * quality.L1) / ((quality.BETA + 0.5) / quality.ALPHA + quality.L2)
    assert model.bias == pytest.approx(expected)


def test_quality_cases(spark, docs, crowded):
    model = quality.train([("good words here", 1), ("BAD!! BAD!!", 0), (None, 1)])
    found = quality.score(crowded, model).collect()
    assert len(found) == 10
    assert len({r.score for r in found if r.doc_id in (3, 4)}) == 1
    empty = quality.train([])
    assert {r.score for r in quality.score(docs, empty).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (7, 5)], "doc_id long, label int")
    assert quality.sample(docs, labels) == [(DOCS[0][1], 1)]
    assert quality.score(docs.filter("false"), model).count() == 0


# -- benchmark passages

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _hits(documents, items, window=10):
    windows = {}
    for item, text in items:
        words = _words(text)
        for k in range(max(1, len(words) - window + 1) if words else 0):
            windows.setdefault(tuple(words[k : k + window]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    found = []
    for doc, text in documents:
        words, hit, ids = _words(text), set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    ids |= windows[tuple(words[k : k + n])]
        found.append((doc, len(words), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    return found


def test_contamination_equals_brute_force(spark):
    expected = _hits(rows("select doc_id, text from documents"), rows("select item_id, text from benchmark"))
    assert any(r[5] for r in expected)
    assert ordered(decontaminate.op7_decontaminate(spark, SF).collect()) == ordered(expected)


def test_contamination_with_small_segments_and_blocks(spark, docs, crowded, monkeypatch):
    monkeypatch.setattr(decontaminate, "QUERY_CHARS", 30)
    monkeypatch.setattr(decontaminate, "SEGMENT_WORDS", 4)
    items = [(1, "in allen Wipfeln"), (2, "IN ALLEN wipfeln!"), (3, None), (4, "--"), (5, "text, twice"), (10, "a very long text that has no end long words of")]
    table = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, term string")
    got = decontaminate.contamination(crowded, table)
    found = [
        (r.doc_id, r.n_words, r.n_hit, r.n_items, sha(",".join(r.item_ids)), r.contaminated)
        for r in got.collect()
    ]
    assert ordered(found) == ordered(_hits([d[:2] for d in DOCS], items))
    clean = decontaminate.decontaminate(crowded, table)
    assert clean.columns == crowded.columns
    assert {r.doc_id for r in clean.collect()} == {3, 4, 6, None}
    none = decontaminate.contamination(docs, table.filter("false"))
    assert {r.contaminated for r in none.collect()} == {False}
    assert decontaminate.contamination(docs.filter("false"), table).count() == 0


def test_phrases_and_neighbourhoods(spark):
    rng = random.Random(8)
    documents = [(k, " ".join(rng.choices("abcd", k=40))) for k in range(30)]
    index = decontaminate.build_index(
        spark.createDataFrame(documents, "doc_id long, text string"), segment_words=2000
    )
    phrases = [b"a b c".split(), b"d d a b".split(), b"a a a".split(), b"a z".split()]
    queries = [(k, decontaminate.Phrase(tuple(p))) for k, p in enumerate(phrases)]
    found = decontaminate.search(index, queries).groupBy("query").count()
    got = {r["query"]: r["count"] for r in found.collect()}
    for k, phrase in enumerate(phrases):
        words = [w.decode() for w in phrase]
        expected = sum(
            t.split()[i : i + len(words)] == words for _, t in documents for i in range(40)
        )
        assert got.get(k, 0) == expected
    near = decontaminate.search(index, [(0, decontaminate.Phrase((b"a", b"b"), within=1))])
    rarest = min("ab", key=lambda w: (sum(t.split().count(w) for _, t in documents), w))
    other = "b" if rarest == "a" else "a"
    expected = sum(
        t.split()[i] == rarest and other in t.split()[max(0, i - 1) : i + 2]
        for _, t in documents
        for i in range(40)
    )
    assert near.count() == expected


# -- personal data

_PATTERNS = [
    re.compile(p)
    for p in (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    )
]


def _spans(text):
    found = []
    for kind, pattern in enumerate(_PATTERNS):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_base_spans_equal_the_patterns():
    rng = random.Random(9)
    parts = ["a", "@", "@", ".", "1", "12", "+", "-", " ", "(", ")", "255", "%", "é", "_", "4929348385146306", "x@y.z", "+1 (2) 3"]
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randrange(25)))
        assert pii.base_spans(text) == _spans(text)
    # Linear in the text.
    assert pii.base_spans("a" * 300_000 + "1" * 300_000 + "@") == []


def test_pii_query(spark):
    found = {r.doc_id: r for r in pii.op10_pii(spark, SF).collect()}
    texts = dict(rows("select doc_id, text from documents"))
    assert found.keys() == texts.keys() and any(r.spans for r in found.values())
    for doc, text in texts.items():
        spans, r = _spans(text), found[doc]
        assert r.base_sha256 == sha(pii.named(spans))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(k == kind for _, k, _ in spans) for kind in range(4)
        ]
        assert set(filter(None, pii.named(spans).split(","))) <= set(r.spans.split(","))


def test_field_adds_what_neighbours_hide():
    rng = random.Random(10)
    phone = lambda: f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"
    texts = [f"word {phone()} word other {rng.randrange(10)}.{rng.randrange(10)} version" for _ in range(300)]
    field = pii.train(texts)
    # The pattern runs on into the next number and then has too many digits.
    text = f"call {phone()} 190.137.223.204 now, release 2.0"
    base = pii.base_spans(text)
    assert [k for _, k, _ in base] == [1]
    ((start, kind, end),) = pii.added_spans([text], [base], field)[0]
    assert pii.KINDS[kind] == "phone" and text[start:end].startswith("+1 (")


def test_messages_equal_exact_marginals_on_a_tree():
    rng = np.random.default_rng(11)
    labels, n = len(pii.KINDS) + 1, 5
    g = pii.Graph(
        [0] * n, [(k, k + 1) for k in range(n)], np.arange(n).reshape(n, 1),
        np.array([[0, 1], [1, 2], [1, 3], [3, 4]]), np.array([0, 0, 1, 0]),
    )
    pair = rng.normal(size=(2, labels, labels))
    pair = (pair + pair.transpose(0, 2, 1)) / 2
    field = pii.Field(rng.normal(size=(pii.WIDTH, labels)), pair)
    logits = pii._log_softmax(field.unary[:n])
    joint = np.zeros((labels,) * n)
    for k in range(n):
        joint = joint + logits[k].reshape([-1 if a == k else 1 for a in range(n)])
    for (a, b), kind in zip(g.edges, g.kinds, strict=True):
        shape = [labels if axis in (a, b) else 1 for axis in range(n)]
        joint = joint + pair[kind].reshape(shape)
    p = np.exp(joint - joint.max())
    p /= p.sum()
    exact = [p.sum(axis=tuple(a for a in range(n) if a != k)) for k in range(n)]
    assert np.allclose(pii.beliefs(g, field), exact, atol=1e-2)


def test_pii_cases(docs, crowded):
    field = pii.train(["call +1 (222) 333-4444 now", None, ""])
    found = pii.find(crowded, field).collect()
    assert len(found) == 10 and all(r.base == [] for r in found)
    assert pii.train([]) is None and pii.find(docs, None).count() == 10
    assert pii.find(docs.filter("false"), field).count() == 0
