"""Rows that share an id, or have none, are kept unless their texts are near copies."""

from __future__ import annotations

from ledgerlight.llm import simhash


def test_texts_link_and_ids_do_not(spark):
    rows = [(1, "a b c d e"), (1, "f g h i j"), (2, "f g h i j"), (None, "k l m n o"), (None, "p q r s t"), (9, "p q r s t"), (None, "u v w x y"), (None, "u v w x y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((tuple(r) for r in simhash.keep_one(docs).collect()), key=repr)
    assert got == sorted([(1, "a b c d e"), (1, "f g h i j"), (None, "k l m n o"), (9, "p q r s t"), (None, "u v w x y")], key=repr)
