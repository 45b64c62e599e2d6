"""Runs and collapsed texts against a search over all periods."""

from __future__ import annotations

import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from ledgerlight.llm import periodic_runs
from ledgerlight.llm.queries import QUERIES
from ledgerlight.llm.words import PLAIN, text_slices

from .plain import sha, words
from .test_operators import ODD, SF, rows


def plain_runs(w, min_length=24, min_repeats=3):
    """(start, length, period): every maximal stretch, its smallest period found by trying all."""
    found, ids = {}, {x: k for k, x in enumerate(dict.fromkeys(w))}
    v = np.array([ids[x] for x in w], dtype=np.int64)
    for q in range(1, len(w) // min_repeats + 1):
        same = np.concatenate([[False], v[q:] == v[:-q], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            length = b - a + q
            if length >= max(min_length, min_repeats * q) and not any((v[a + p : a + length] == v[a : a + length - p]).all() for p in range(1, q)):
                found[a, q] = length
    return sorted((a, n, q) for (a, q), n in found.items())


def collapsed(w, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def tail_repeated(doc_id, text):
    h, w = zlib.crc32(str(doc_id).encode()), words(text)
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def expected(doc_id, text):
    w = tail_repeated(doc_id, text)
    runs = plain_runs(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    listed = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    return doc_id, len(runs), *best, milli, sha(listed), sha(collapsed(w, runs)), len(w)


def test_given_rows(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = rows(QUERIES["op13_periodic_runs"](spark, SF))
    assert got == sorted((expected(d, t) for d, t in given), key=repr)
    assert sum(r[1] for r in got) > 5


def _search(texts, **how):
    out = []
    for s in text_slices(pa.array(texts), PLAIN, slice_bytes=5000):
        owner, start, length, period = periodic_runs.find_runs(s, **how)
        for k in range(len(s.rows)):
            out.append([(int(a) - int(s.first_word[k]), int(n), int(q)) for o, a, n, q in zip(owner, start, length, period, strict=True) if o == k])
    return out


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(seed):
    """Few different words, blocks repeated a few times with breaks, blocks made of smaller repeats."""
    r = random.Random(seed)
    texts = []
    for _ in range(60):
        w = []
        for _ in range(r.randint(1, 6)):
            block = [r.choice("abc") for _ in range(r.randint(1, 60))]
            if r.random() < 0.5:
                block = block * r.randint(1, 4) + [r.choice("abx")]
            w += (block * r.randint(1, 7))[: r.randint(1, 400)]
            if w and r.random() < 0.4:
                w[r.randrange(len(w))] = "z"
        texts.append(" ".join(w))
    assert _search(texts) == [plain_runs(t.split()) for t in texts]
    assert _search(texts, min_length=30, min_repeats=4) == [plain_runs(t.split(), 30, 4) for t in texts]
    assert _search(texts, min_length=5) == [plain_runs(t.split(), 5) for t in texts]


def test_long_periods_and_one_word():
    r = random.Random(9)
    for q in (17, 32, 33, 64, 65, 500, 1333):
        block = [f"w{r.randrange(10**6)}" for _ in range(q)]
        w = ["x"] + (block * 5)[: 3 * q] + ["y"]
        assert _search([" ".join(w)]) == [[(1, 3 * q, q)]]
        assert _search([" ".join(w[:-2])]) == [[]]
    assert _search([" ".join(["a"] * 200_000)]) == [[(0, 200_000, 1)]]
    assert _search(["a " * 23, "a " * 24]) == [[], [(0, 24, 1)]]


def test_odd_rows(spark):
    more = [*ODD, (40, "a b " * 30), (40, "a b " * 30), (None, "a b " * 30)]
    clash = "n_words int, runs string, collapsed_text string, start int"
    docs = spark.createDataFrame([(*x, 1, "r", None, 2) for x in more], f"doc_id bigint, text string, {clash}").repartition(3)
    got = periodic_runs.with_runs(docs)
    assert got.columns == [*docs.columns, "_n_words", "_runs", "_collapsed_text"]
    found = sorted(((r.doc_id, r._n_words, [tuple(x) for x in r._runs], r._collapsed_text) for r in got.collect()), key=repr)
    plain = [(d, words(t), plain_runs(words(t)) if d not in (8, 9) else []) for d, t in more]
    assert found == sorted(((d, len(w), runs, collapsed(w, runs)) for d, w, runs in plain), key=repr)
    assert got.select(*docs.columns).exceptAll(docs).count() == 0
    assert periodic_runs.with_runs(docs.where("doc_id < 0")).collect() == []
    assert periodic_runs.repeated_tails(docs).where("doc_id is null").first().text == "a b " * 30


def test_strongest_breaks_ties(spark):
    kind = "array<struct<start:bigint,length:bigint,period:bigint>>"
    df = spark.createDataFrame([([(0, 30, 10), (5, 24, 8), (5, 27, 9), (9, 31, 10)],), ([(3, 24, 8), (9, 30, 10)],), ([],)], f"runs {kind}")
    got = [tuple(r[0]) if r[0] else None for r in df.select(periodic_runs.strongest(df.runs)).collect()]
    assert got == [(9, 31, 10), (3, 24, 8), None]
