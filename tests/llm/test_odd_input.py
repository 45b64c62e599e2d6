"""Odd input of the operators: column names that clash, rows that repeat, columns that tables lack."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from ledgerlight.llm import decontaminate, shards, simhash, token_counts
from ledgerlight.llm.queries import ORACLES, QUERIES

from .test_operators import BYTE_BPE, SF


def named(spark, rows, *more):
    """Rows (doc_id, text) with further columns of these names."""
    spec = "".join(f", {c} long" for c in more)
    return spark.createDataFrame([(*r, *[7] * len(more)) for r in rows], f"doc_id long, text string{spec}")


@pytest.mark.parametrize("rows", [[], [(3, "one text alone")], [(3, "a b c d"), (4, "a b c d")], [(None, None)]])
def test_few_fingerprints_end_at_once(spark, rows):
    docs = named(spark, rows)
    found = simhash.near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.component_id) for r in found), key=repr) == sorted(((d, min((x for x, _ in rows if x), default=None)) for d, _ in rows), key=repr)
    assert simhash.keep_one(docs).count() == min(len(rows), 1)
    assert len([m for bits, t in simhash.allocate(len(rows), simhash.np.zeros((64, 64))) if t >= 0 for m in bits]) <= 64


def test_first_key_and_hit_columns_may_exist(spark):
    docs = named(spark, [(1, "a b c d e"), (2, "a b c d e"), (3, "alpha beta gamma delta")], "first_key", "key", "hit_id", "hit_key", "component")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
    tests = spark.createDataFrame([(1, "beta gamma")], "item_id long, text string")
    clean = decontaminate.drop_contaminated(docs, tests)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [1, 2]


def test_substring_stage_keeps_all_columns(spark):
    passage = " ".join(f"w{k}" for k in range(20))
    docs = named(spark, [(1, passage), (2, f"before {passage} after"), (3, None)], "lang", "kept_text", "n_words", "more")
    got = corpus_pipeline.substring_dedup(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.more) for r in got.collect()) == [(1, passage, 7), (2, "before after", 7), (3, None, 7)]


def test_equal_rows_are_divided_among_shards(spark):
    rows = [(None if k % 6 == 0 else 5, "the same text") for k in range(1000)] + [(k, f"text number {k}") for k in range(2000)]
    docs = named(spark, rows, "base", "base_shard", "base_part", "of1", "of2").repartition(4)
    placed = shards.shard_documents(docs, 8)
    got = placed.collect()
    total = sum(len((t or "").encode()) + 1 for _, t in rows)
    sizes = {}
    for r in got:
        sizes.setdefault(r.shard, []).append((r.slot, r.size))
    assert len(got) == len(rows) and sorted(sizes) == list(range(8))
    for held in sizes.values():
        assert sorted(s for s, _ in held) == list(range(len(held)))
        assert abs(sum(n for _, n in held) - total / 8) <= shards.TOLERANCE * total / 8 + 40
    assert placed.select(*docs.columns).exceptAll(docs).count() == 0


def test_proximity_stays_in_one_document(spark):
    docs = named(spark, [(1, "alpha beta x"), (2, "gamma delta"), (3, "alpha x beta gamma"), (4, "beta alpha gamma"), (5, "alpha beta"), (6, "alpha beta gamma")])
    tests = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    hit = {s: {r.doc_id for r in decontaminate.contamination(docs, tests, slop=s).collect() if r.n_hit} for s in (0, 1)}
    assert hit == {0: {6}, 1: {3, 4, 6}}


def test_stored_pre_tokens_count_as_the_library(monkeypatch):
    random.seed(8)
    texts = ["".join(random.choice("ab'st re12 \n\t.,!\u2019\u2014\xe9\xa0\x85\x1c\x1f\u0130\u4e2d\u2003\u2028<|end>") for _ in range(200)) for _ in range(300)]
    texts += ["don't I'LL we've  x   \n\n y", "<|endoftext|> a", "\u2026\u201cquoted\u201d \u2013 done", "", " ", "\n", "'s's 's", "  a", "a  "]
    for limit in (250_000, 50):
        monkeypatch.setattr(token_counts, "STORE_PIECES", limit)
        counter = token_counts.PieceCounts(BYTE_BPE)
        split = [t for t in texts if counter.splits(t)]
        assert counter.by_piece and 0 < len(split) < len(texts)
        for text in split + split:
            assert counter.count(text) == len(counter.tokenizer.encode(text, add_special_tokens=False).ids), repr(text)


@pytest.mark.parametrize("name", ["op2_relative_lz", "op4_prefix_targets"])
def test_sql_agrees(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    con.execute(ORACLES[name])
    names = [d[0] for d in con.description]
    ours = sorted((tuple(r[n] for n in sorted(names)) for r in df.collect()), key=repr)
    assert ours == sorted((tuple(r[names.index(n)] for n in sorted(names)) for r in con.fetchall()), key=repr)


@pytest.mark.parametrize("name", ["op4_prefix_targets", "op5_histogram_shards", "op12_line_bitmaps"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"):
        assert unwanted not in plan


def test_shards_query_keeps_its_contract(spark):
    import zlib

    given = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op5_histogram_shards"](spark, SF).collect()
    assert {r.doc_id: (r.size, r.text_crc32, r.law, r.grown_shard) for r in got} == {
        d: (len(t.encode()) + 1, zlib.crc32(t.encode()), "bytes", None) for d, t in given.items()
    }
    assert len(got) == len(given) and {r.shard for r in got} <= set(range(16))
