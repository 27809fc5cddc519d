"""The pipeline against its stages in plain Python, and its planted cases."""

from __future__ import annotations

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from meterlake.llm import language_id, simhash
from tests.llm.data import SF, ordered, rows
from tests.llm.test_dedup import _groups
from tests.llm.test_text import _hits


def test_pipeline_equals_brute_force(spark, tmp_path):
    # The given documents, and near copies of some: in capitals, or with the last word changed.
    texts = sorted(rows("select doc_id, text, lang from documents where text is not null"))
    texts += [(10_000 + d, t.upper().replace(" ", "  "), lang) for d, t, lang in texts[:20]]
    texts += [(20_000 + d, t.rsplit(" ", 1)[0] + " xx", lang) for d, t, lang in texts[:60]]
    documents = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    (tmp_path / "benchmark.parquet").symlink_to(f"{SF}/benchmark.parquet")
    documents = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = language_id.learn(documents)
    kept = []
    for doc, text, _ in texts:
        (name,), (score,) = language_id.predict([text], model)
        if name != "und" and score >= language_id.LEAST:
            kept.append((doc, text))
    seen, unique = set(), []
    for doc, text in kept:
        if text not in seen:
            unique.append((doc, text))
        seen.add(text)
    prints = {d: simhash.fingerprint(t, simhash.OP6)[0] for d, t in unique}
    groups = _groups(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    single = [(d, t) for d, t in unique if groups[d] == d]
    hits = _hits(single, rows("select item_id, text from benchmark"))
    clean = [pair for pair, hit in zip(single, hits, strict=True) if not hit[5]]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for doc, text in clean:
        ids = library.encode(text, add_special_tokens=False).ids
        expected.append((doc, len(ids), tuple(ids), library.decode(ids, skip_special_tokens=False)))
    assert len(expected) < len(single) < len(unique) < len(kept)
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert ordered(found.select("doc_id", "n_tokens", "ids", "decoded").collect()) == ordered(expected)


def test_stages_keep_columns(spark, crowded):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert set(stage(spark, crowded, SF).columns) == set(crowded.columns), name
        assert stage(spark, crowded.filter("false"), SF).count() == 0, name


def test_queries_are_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
