"""The shared counts and rare words' ratios of the toxicity models against a plain version."""

from __future__ import annotations

import numpy as np

from ledgerlight.llm import toxicity
from ledgerlight.llm.words import ALNUM, text_slices

from . import plain

COPIES = [("red fish swims", 40), ("blue fish swims", 1), ("a fish", 1), ("swims", 3)]


def _hash(word):
    import pyarrow as pa

    return int(next(text_slices(pa.array([word]), ALNUM, lower=True)).hashes()[0])


def test_shared_counts_are_different_words_before(spark):
    texts = [t for t, n in COPIES for _ in range(n)]
    got = {r.word & (1 << 64) - 1: r.shared for r in toxicity._shared_counts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)).collect()}
    before = {}
    for t in texts:
        w = [None, *plain.test_words(t)]
        for a, b in zip(w, w[1:], strict=False):
            before.setdefault(b, set()).add(a)
    assert got == {_hash(w): len(x) for w, x in before.items()} and got[_hash("fish")] == 3 and got[_hash("swims")] == 2


def test_rare_words_have_their_own_ratio_and_copies_change_nothing(spark):
    rows = [(k, f"common words here tox{k % 7}" if k % 2 else f"common words here good{k % 7}") for k in range(200)] + [(1001, "once vile"), (1002, "once kind")]
    rows = [r for r in rows if r[0] < 200 or r[0] > 1000]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(d, d % 2) for d, _ in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    held = set(model.words.tolist())
    assert all(_hash(f"{w}{k}") in held for w in ("tox", "good") for k in range(7))
    words = dict(zip(model.words.tolist(), model.word_ratio.tolist(), strict=True))
    assert words[_hash("tox1")] > model.other_word > words[_hash("good1")]
    more = docs.unionByName(docs.selectExpr("doc_id + 100000 as doc_id", "text"))
    again = toxicity.fit(more, labels)
    assert np.array_equal(again.words, model.words) and np.allclose(again.word_ratio, model.word_ratio)
