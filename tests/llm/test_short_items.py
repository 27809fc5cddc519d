"""Benchmark items of fewer words than a window, in the pipeline's stage."""

from __future__ import annotations

import corpus_pipeline


def test_short_items_drop_only_documents_made_of_them(spark, tmp_path):
    ten = "one two three four five six seven eight nine ten"
    items = [("a", "the cat"), ("b", ten + " eleven")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    texts = {
        1: "a long clean document in which the cat is named only once",
        2: "The cat!",
        3: "before " + ten + " after and much else that is clean",
        4: "nothing of it",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = corpus_pipeline.benchmark_stage(spark, docs, str(tmp_path))
    assert {r.doc_id for r in kept.collect()} == {1, 4}
