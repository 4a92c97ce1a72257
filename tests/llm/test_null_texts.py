"""Null texts are copies of nothing, whatever their ids."""

import corpus_pipeline
from llm_help import docs, noise
from foldmark.llm.near_duplicates import near_duplicates


def test_null_texts_are_no_copies(spark):
    import random

    text = noise(random.Random(2), 60)
    rows = docs(spark, [(None, None), (None, None), (5, None), (5, None), (6, text), (7, text)])
    found = sorted((r.doc_id is None, r.doc_id or 0, r.class_id, r.class_size) for r in near_duplicates(rows).collect())
    assert found == [(False, 5, 5, 1), (False, 5, 5, 1), (False, 6, 6, 2), (False, 7, 6, 2), (True, 0, None, 1), (True, 0, None, 1)]
    kept = corpus_pipeline.drop_near_duplicates(spark, rows, "")
    assert sorted((r.doc_id or 0, r.text is None) for r in kept.collect()) == [(0, True), (0, True), (5, True), (5, True), (6, False)]
