"""Cost bounds of the text operators: what one segment's search keeps, and which steps a word of letters goes through."""

import json
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from ledgerlight.llm import decontaminate, encoding

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def test_hits_of_a_frequent_word_are_merged_as_they_come():
    words, items = 50_000, 20
    segment = pa.record_batch({
        "first_word": pa.array([[0, words // 2, words]], pa.list_(pa.int32())), "terms": pa.array([[0]], pa.list_(pa.int32())),
        "counts": pa.array([[words]], pa.list_(pa.int32())), "postings": pa.array([np.array([0, *[1] * (words - 1)], "<u4").tobytes()], pa.binary()),
    })
    window = [(0, offset) for offset in range(10)]
    searches = [(item, 10, window) for item in range(items) for _ in range(10)]
    tracemalloc.start()
    found = decontaminate._search(segment, 0, searches, 0)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found.tolist() == [[item, doc, 0, words // 2] for item in range(items) for doc in (0, 1)]
    assert peak < 150 << 20  # ten million hits of 32 bytes were kept at once


def test_words_of_letters_skip_the_steps_that_leave_them_alone(tmp_path):
    words = ["ciónjaueas", "ououéê", "eneinßzu", "Àÿæ", "the", "QUEÉAIE,", "don't", "a1b", "e\u0301a"]
    encoder = encoding.Encoder(WORD_BPE, by_word=True)
    assert encoder.of_letters is not encoder.tokenizer
    expected = [e.ids for e in encoding.load(WORD_BPE).encode_batch(words, add_special_tokens=False)]
    assert [list(x) for x in encoder.encode(words)] == expected

    other = json.load(open(WORD_BPE))
    other["normalizer"]["normalizers"].append({"type": "Replace", "pattern": {"String": "the"}, "content": "of"})
    path = tmp_path / "other.json"
    path.write_text(json.dumps(other))
    assert (changed := encoding.Encoder(str(path), by_word=True)).of_letters is changed.tokenizer
