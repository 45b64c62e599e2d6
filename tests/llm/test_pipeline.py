"""The stages of the pipeline against plain versions, each on its own input."""

from __future__ import annotations

import corpus_pipeline
from ledgerlight.llm import toxicity
from ledgerlight.llm.common import table

from . import plain

SF = "/root/testdata/sf0.01"


def test_stages(spark, folder):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        seen[name] = (docs, spark.read.parquet(path))
        docs = seen[name][1]
        if name != "packing":
            assert docs.columns == columns

    def pairs(df):
        return [(r.doc_id, r.text) for r in df.collect()]

    before, after = map(pairs, seen["toxicity"])
    model = toxicity.fit(seen["toxicity"][0], table(spark, SF, "labels"))
    scores = toxicity.with_score(seen["toxicity"][0], model).collect()
    assert sorted(after) == sorted((r.doc_id, r.text) for r in scores if r.score < 0.5) and len(after) > 0.8 * len(before)

    before, after = map(pairs, seen["near_dedup"])
    roots = {c for _, _, c in plain.near_duplicates(before)}
    assert sorted(after) == sorted(p for p in before if p[0] in roots)

    before, after = map(pairs, seen["substring_dedup"])
    removed = {d: (n, digest) for d, _, n, digest in plain.substring_dedup(before)}
    texts = dict(after)
    for d, text in before:
        n, digest = removed[d]
        assert texts[d] == text if n == 0 else plain.sha(texts[d]) == digest

    before, after = map(pairs, seen["decontamination"])
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    assert sorted(after) == sorted(p for p, r in zip(sorted(before), sorted(plain.contamination(before, items)), strict=True) if not r[-1])

    pieces = seen["packing"][1].collect()
    assert {r.doc_id for r in pieces} == {d for d, _ in after}
    filled = {}
    for r in pieces:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert max(filled.values()) <= 2048
