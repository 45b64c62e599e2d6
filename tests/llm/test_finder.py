"""Words of a text are found in the models by the first bits of their hashes, not by a search from end to end."""

import numpy as np
import pyarrow as pa
import pytest

from ledgerlight.llm import toxicity
from ledgerlight.llm.words import ALNUM, text_slices

TOP = (1 << 64) - 1


@pytest.mark.parametrize("keys", [[], [0], [TOP], [5, 5, 6], [0, 1, 2, TOP - 1, TOP], "many"])
def test_finder_finds_what_a_binary_search_finds(keys):
    drawn = np.random.default_rng(3).integers(0, TOP, 5_000, dtype=np.uint64, endpoint=True)
    keys = np.sort(drawn[:3_000]) if keys == "many" else np.array(keys, dtype=np.uint64)
    wanted = np.concatenate([drawn, keys, np.array([0, 1, 5, 7, TOP - 1, TOP], dtype=np.uint64)])
    at, held = toxicity.Finder(keys).find(wanted)
    first = np.searchsorted(keys, wanted)
    assert held.tolist() == np.isin(wanted, keys).tolist()
    assert at.tolist() == np.minimum(first, max(len(keys) - 1, 0)).tolist()


def test_words_are_not_searched_from_end_to_end(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 5_000, 4_000)) for _ in range(10)]
    [s] = text_slices(pa.array(texts), ALNUM)
    before, words = toxicity._words(s)
    keys = [np.unique(x)[::2] for x in (words, before, toxicity._pair(before, words))]
    ratios = [rng.normal(size=len(k)).astype(np.float32) for k in keys]
    model = toxicity.Model(keys[0], ratios[0], ratios[0] > 1, 0.5, keys[1], ratios[1], keys[2], ratios[2], ratios[2] > 1)
    model.features(s)
    searched = []
    monkeypatch.setattr(toxicity.np, "searchsorted", lambda *a, **k: searched.append(a))
    assert np.isfinite(model.features(s)).all() and not searched
