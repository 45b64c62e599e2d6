"""Each operator against a plain version, on the smallest given tables and on odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import chat, decontaminate, encoding, packing, rules, shards, simhash, substrings, token_counts, token_file, toxicity
from ledgerlight.llm.queries import ORACLES, QUERIES

from . import plain

SF = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(20_000))
ODD = [
    (1, None), (2, ""), (3, " \t\r\n\x0b\x0c "), (4, "A"), (5, PASSAGE), (6, f"Before, {PASSAGE} after."), (6, f"Before, {PASSAGE} after."),
    (7, PASSAGE), (8, LONG), (9, LONG + " end"), (10, "no space nb\x00x\x1fy"), (11, "<|endoftext|> a\n\n b "), (12, "漢字かな 🙂 é́x"),
    (13, "same line\nsame line\n\nsame line\r\n#*$"), (14, "x " * 40), (15, "don't I'LL 123 ..."), (16, ""), (17, "a b c d e f g h i j k l m n o p"),
    (18, "z a b c d e f g h i j k l m n o p"), (19, "nine ten eleven twelve thirteen fourteen fifteen one two three four five six"),
]


@pytest.fixture(scope="module")
def given(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with columns whose names the operators use themselves."""
    clash = "text_key bigint, row_key bigint, score double, shard int, slot bigint, size bigint, k1 bigint, k2 bigint, part int, kept_text string, n_words bigint"
    more = (0, 0, 0.0, 0, 0, 0, 0, 0, 0, "", 0)
    return spark.createDataFrame([(*r, *more) for r in ODD], f"doc_id bigint, text string, {clash}").repartition(3)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("doc_id < 0")


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


# ------------------------------------------------------------------ 1


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 31, 32])
def test_packed_ids_come_back(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1003, dtype=np.uint64)
    packed = token_file.pack(ids, bits)
    assert len(packed) == -(-1003 * bits // 8)
    assert (token_file.unpack(packed, bits, 0, 1003) == ids).all()
    assert (token_file.unpack(packed, bits, 77, 500) == ids[77:500]).all()


def test_words_encode_as_the_whole_text():
    random.seed(3)
    texts = [t or "" for _, t in ODD] + ["".join(random.choice("ab '\n\t 1éÉ漢́İΣ.,<|endoftext|>🙂 ") for _ in range(300)) for _ in range(60)]
    by_word = encoding.Encoder(WORD_BPE, by_word=True)
    expected = [by_word.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [list(x) for x in by_word.encode(texts)] == expected
    assert [list(x) for x in encoding.Encoder(WORD_BPE).encode(texts)] == expected


def _expected_tokens(docs, end):
    tokenizer = token_counts.load(WORD_BPE)
    start, out = 0, []
    for d, t in sorted(docs, key=lambda r: r[0]):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, end], dtype="<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_token_file(spark, given, odd, empty, folder):
    assert rows(QUERIES["op1_packed_tokens"](spark, SF)) == _expected_tokens(given, 1)
    token_file.write_token_file(odd, f"{folder}/odd", WORD_BPE, 1, by_word=True)
    assert rows(token_file.read_documents(spark, f"{folder}/odd")) == _expected_tokens(ODD, 1)
    whole = token_file.read_range(spark, f"{folder}/odd", 0, 1 << 40)
    assert (token_file.read_range(spark, f"{folder}/odd", 100, 700) == whole[100:700]).all() and whole[0] == 1
    token_file.write_token_file(empty, f"{folder}/empty", WORD_BPE, 1)
    assert rows(token_file.read_documents(spark, f"{folder}/empty")) == []


# ------------------------------------------------------------------ 2


def test_substring_dedup(spark, given, odd, empty):
    assert rows(QUERIES["op2_relative_lz"](spark, SF)) == plain.substring_dedup(given)
    got = substrings.remove_duplicates(odd)
    assert "_kept_text" in got.columns and got.columns[: len(odd.columns)] == odd.columns
    assert rows(got, "doc_id", "_n_words", "n_removed", F.sha2("_kept_text", 256)) == plain.substring_dedup(ODD)
    spans = {r.doc_id: [(x.word_from, x.word_to, x.reference) for x in r.factors] for r in got.collect()}
    assert spans[6] == [(1, 16, 5)] and spans[7] == [(0, 15, 5)] and spans[18] == [(1, 17, 17)]
    assert substrings.remove_duplicates(empty).count() == 0


@pytest.mark.parametrize("hot_keys", [1, 500, 10_000])
def test_factors_are_stretches_of_their_reference(spark, monkeypatch, hot_keys):
    """Passages that begin, break off and repeat at other places than in their first document, in few different words.

    No window, some and all of them are looked up as frequent ones.
    """
    monkeypatch.setattr(substrings, "HOT_KEYS", hot_keys)
    rng = np.random.default_rng(7)
    lines = [[f"w{x}" for x in rng.integers(0, 40, n)] for n in rng.integers(5, 60, 40)]
    texts = [[w for k in rng.integers(0, 40, rng.integers(1, 12)) for w in lines[k][rng.integers(0, 4) :]] for _ in range(120)]
    docs = [(d, " ".join(w)) for d, w in enumerate(texts)]
    docs += [(200, docs[3][1]), (201, f"new {docs[3][1]}"), (202, " ".join(["a"] * 60)), (203, " ".join(["a"] * 50))]
    got = substrings.remove_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"))
    expected = plain.factors(docs)
    expected[200] = [(0, len(docs[3][1].split()), 3, 0)]  # an exact copy is one factor of the first such text
    given = dict(docs)
    n = 0
    for r in got.collect():
        assert [tuple(x) for x in r.factors] == expected[r.doc_id], r.doc_id
        for a, b, of, at in r.factors:
            n += 1
            assert of < r.doc_id and b - a >= 13 and given[r.doc_id].split()[a:b] == given[of].split()[at : at + b - a]
    assert n > 300


def test_null_id_is_the_last(spark):
    docs = spark.createDataFrame([(None, PASSAGE), (3, PASSAGE), (3, f"x {PASSAGE}")], "doc_id bigint, text string")
    assert rows(substrings.remove_duplicates(docs), "doc_id", "n_removed") == [(3, 0), (3, 0), (None, 15)]


# ------------------------------------------------------------------ 3


def test_toxicity_finds_held_out_documents(spark):
    got = {r.doc_id: r for r in QUERIES["op3_kneser_ney"](spark, "/root/testdata/sf0.1").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    held = [(got[r.doc_id].predicted, r.toxic) for r in labels if r.doc_id in got and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 for d, r in got.items())
    assert sum(p == t for p, t in held) > 0.97 * len(held)
    assert sum(p == t == 1 for p, t in held) > 0.85 * sum(t for _, t in held)


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(d, int(d % 2)) for d in range(1, 20)] + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(odd, labels)
    scored = toxicity.with_score(odd, model)
    assert scored.count() == len(ODD) and all(0 <= r["_score"] <= 1 for r in scored.collect())
    one_class = toxicity.fit(odd, labels.where("toxic = 0"))
    assert all(r["_score"] < 0.01 for r in toxicity.with_score(odd, one_class).collect())
    none = toxicity.fit(empty, labels)
    assert {round(r["_score"], 3) for r in toxicity.with_score(odd, none).collect()} == {0.5}
    assert toxicity.drop_toxic(empty, labels).count() == 0


# ------------------------------------------------------------------ 4


def test_chat_examples(spark):
    odd = [(1, 0, "user", "### x: \\# </turn>"), (1, 1, "assistant", None), (1, 2, "user", "b"), (1, 3, "assistant", "re\\ply <"), (2, 0, "user", "alone"),
           (3, 0, "a:\n### b", ""), (None, None, None, None), (1, 3, "assistant", "re\\ply <")]
    turns = spark.createDataFrame(odd, "conv_id bigint, turn bigint, role string, text string")
    pieces = chat.format_turns(turns)
    back = sorted(((r.conv_id, r.turn_no, r.role, r.text) for r in chat.read_turns(pieces).collect()), key=repr)
    assert (1, 0, "user", "### x: \\# </turn>") in back and (3, 0, "a:\n### b", "") in back and (None, 0, "", "") in back and len(back) == len(odd)
    examples = chat.expand(pieces)
    texts = examples.orderBy("target_turn").collect()
    assert [(r.reply, r.example_chars) for r in chat.read_replies(examples).orderBy("target_turn").collect()] == [
        ("", len(texts[0].example)), ("re\\ply <", len(texts[1].example)), ("re\\ply <", len(texts[2].example))
    ]
    assert [r.example[r.loss_from : r.loss_to] for r in texts] == ["", "re\\\\ply \\<", "re\\\\ply \\<"]
    assert texts[1].example.startswith(texts[0].example) and examples.where("conv_id = 2").count() == 0
    assert chat.format_turns(turns.where("conv_id < 0")).count() == 0


# ------------------------------------------------------------------ 5


@pytest.mark.parametrize("n", [1, 2, 16])
def test_shards(spark, n):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = shards.shard_documents(docs, n).collect()
    sizes = np.bincount([r.shard for r in got], weights=[r.size for r in got], minlength=n)
    assert len(got) == docs.count() and sum(sizes) == sum(len((r.text or "").encode()) + 1 for r in got)
    # No splitter is further from its place than the largest group of equal texts or the tolerance.
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in got)
    for k in range(n):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))


def test_one_text_in_many_rows_is_divided(spark, odd, empty):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.col("id").cast("string")).alias("text"))
    got = shards.shard_documents(docs, 8).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert len(got) == 8 and max(r.b for r in got) - min(r.b for r in got) < 40
    placed = shards.shard_documents(odd, 4)
    assert placed.count() == len(ODD) and {"_shard", "_slot", "_size"} <= set(placed.columns)
    assert shards.shard_documents(empty, 4).count() == 0


# ------------------------------------------------------------------ 6


def test_packing(spark, odd, empty):
    for docs in (spark.read.parquet(f"{SF}/documents.parquet"), odd):
        got = packing.pack_documents(docs, WORD_BPE, 0, by_word=True).collect()
        tokenizer = token_counts.load(WORD_BPE)
        expected = []
        for r in docs.select("doc_id", "text").collect():
            ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
            expected += [(r.doc_id, p, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes())) for p, s in enumerate(range(0, len(ids), 2048))]
        assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(expected)
        filled = {}
        for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == filled.get(r.sequence_id, 0)
            filled[r.sequence_id] = r.offset + r.length
        assert max(filled.values()) <= 2048
        assert len(filled) <= -(-sum(filled.values()) // 2048) + 1
    assert packing.pack_documents(empty, WORD_BPE, 0).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plans_cover_every_piece(seed):
    random.seed(seed)
    counts = {random.randint(1, 2048): random.randint(1, 300) for _ in range(150 * (seed + 1))}
    plan = packing.make_plan(counts)
    used = np.zeros(2049, dtype=int)
    for lengths, copies in plan.fillings:
        assert sum(lengths) <= 2048 and copies > 0
        for x in lengths:
            used[x] += copies
    assert {x: n for x, n in enumerate(used) if n} == counts
    bound = max(-(-sum(x * n for x, n in counts.items()) // 2048), sum(n for x, n in counts.items() if x > 1024))
    assert plan.sequences <= 1.05 * bound + 2


# ------------------------------------------------------------------ 7


def test_contamination(spark, given, odd, empty, monkeypatch):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert rows(QUERIES["op7_positional_index"](spark, SF)) == plain.contamination(given, items)
    tests = [("a", PASSAGE), ("b", "Four FIVE six"), ("a", "other text"), ("c", None), ("d", "!?"), (None, "don't"), ("e", "é́x")]
    table = spark.createDataFrame(tests, "item_id string, text string")
    digest = ("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long"), F.sha2(F.array_join("item_ids", ","), 256), F.col("n_hit") > 0)
    expected = [r for r in plain.contamination(ODD, [t for t in tests if t[0]]) if r[0] != 15]
    found = decontaminate.contamination(odd, table)
    assert [r for r in rows(found, *digest) if r[0] != 15] == expected
    assert [(r.n_hit, r.item_ids) for r in found.where("doc_id = 15").collect()] == [(2, [])]
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 10)  # many blocks give the same
    assert rows(decontaminate.contamination(odd, table), *digest) == rows(found, *digest)
    assert decontaminate.contamination(empty, table).count() == 0
    assert decontaminate.contamination(odd, table.where("item_id = 'x'")).where("n_hit > 0").count() == 0
    assert rows(decontaminate.drop_contaminated(odd, table.where("item_id = 'a'")), "doc_id") == rows(odd.where("doc_id not in (5, 6, 7)"), "doc_id")


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha beta x gamma"), (2, "alpha beta x y gamma"), (3, "alpha beta gamma")], "doc_id bigint, text string")
    tests = spark.createDataFrame([("t", "alpha beta gamma")], "item_id string, text string")
    assert rows(decontaminate.contamination(docs, tests).where("n_hit > 0"), "doc_id") == [(3,)]
    assert rows(decontaminate.contamination(docs, tests, slop=1).where("n_hit > 0"), "doc_id") == [(1,), (3,)]


# ------------------------------------------------------------------ 8


def test_token_counts(spark, given, odd, empty):
    tokenizer = token_counts.load(BYTE_BPE)

    def expected(docs):
        return sorted((d, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for d, t in docs)

    assert rows(QUERIES["op8_overlap_counts"](spark, SF).drop("over_limit")) == sorted(expected(given), key=repr)
    assert rows(token_counts.token_counts(odd, BYTE_BPE)) == sorted(expected(ODD), key=repr)
    assert token_counts.token_counts(empty, BYTE_BPE).count() == 0


@pytest.mark.parametrize(("chunk", "overlap"), [(1000, 100), (300, 80), (700, 16)])
def test_chunks_count_as_the_whole(chunk, overlap):
    tokenizer = token_counts.load(BYTE_BPE)
    random.seed(chunk)
    texts = ["a" * 5000, " " * 5000, "\n \n" * 2000, "don't 12 <|endoftext|> " * 300, "漢字かな" * 1000, "<|endoftext|>" * 500, "x<|endoftext|>  \t\n" * 300]
    texts += ["".join(random.choice("ab '\n\t 1é漢<|endoftext|>🙂") for _ in range(3000)) for _ in range(20)]
    for text in texts:
        assert token_counts.count_long(text, tokenizer, chunk, overlap) == len(tokenizer.encode(text, add_special_tokens=False).ids)


# ------------------------------------------------------------------ 9


def test_counts_and_base_rule(spark, given, odd, empty):
    wanted = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = QUERIES["op9_decision_list"](spark, SF)
    assert rows(judged, *wanted) == sorted(((d, *plain.counts(t)) for d, t in given), key=repr)
    assert rows(rules.text_counts(odd), *wanted) == sorted(((d, *plain.counts(t)) for d, t in ODD), key=repr)
    for r in judged.collect():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.rule == 0)
    assert rules.text_counts(empty).count() == 0
    no_labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert rules.judge(odd, no_labels)[1] == []


def test_learned_list():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 2))
    bad = (x[:, 0] > 0.8) | ((x[:, 1] < 0.2) & (x[:, 0] > 0.3))
    learned = rules.learn(["a", "b"], x, bad, rng.random(3000) < 0.33)
    said = np.zeros(3000, dtype=bool)
    for rule in learned:
        said |= rules._covers(rule, ["a", "b"], x)
    assert (said == bad).mean() > 0.97 and all(len(r) <= rules.MAX_CONDITIONS for r in learned)


# ----------------------------------------------------------------- 10


def test_near_duplicates(spark, given, odd, empty, monkeypatch):
    assert rows(QUERIES["op10_pigeonhole_simhash"](spark, SF)) == sorted(plain.near_duplicates(given), key=repr)
    shown = ("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"), "component_id")
    expected = sorted(plain.near_duplicates(ODD), key=repr)
    assert rows(simhash.near_duplicates(odd), *shown) == expected
    monkeypatch.setattr(simhash, "BUCKET", 2)  # divided buckets lose no link
    assert rows(simhash.near_duplicates(odd), *shown) == expected
    kept = sorted({c for _, _, c in expected})
    assert rows(simhash.keep_one(odd), "doc_id") == sorted(((d,) for d in kept), key=repr)
    assert simhash.near_duplicates(empty).count() == 0


def test_rows_of_one_id_and_of_none(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (1, "f g h i j"), (2, "f g h i j"), (None, "k l m n o"), (None, "p q r s t"), (9, "p q r s t")], "doc_id bigint, text string")
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(1, 1), (2, 1), (None, 9), (9, 9)}


@pytest.mark.parametrize("n", [10, 10**5, 10**9, 10**11])
def test_thresholds_keep_the_principle(n):
    both = np.full((64, 64), n / 4)
    np.fill_diagonal(both, n / 2)
    plan = simhash.allocate(n, both)
    assert sorted(b for bits, _ in plan for b in bits) == list(range(64)) and sum(t + 1 for _, t in plan) == simhash.TAU + 1
