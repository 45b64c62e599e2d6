"""Words met for the first time cost few steps, and are encoded as the library does it."""

import public_tokenizers
import pytest

from ledgerlight.llm.encoding import _LETTERS, Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
WORDS = ["the", "The,", "THE$$$", "olá", "Olá!!", "Éñÿß", "ẞ", "İx", "a'll", "don't.", "x&&&", "x.***", "x###y", "7th%", "", "$%&*#", "é́", "ﬁn", "x<|endoftext|>", "&*"]


@pytest.fixture
def encoder():
    return Encoder(PATH, by_word=True)


def test_ids_are_those_of_whole_texts(encoder):
    texts = [" ".join(WORDS), "\n".join(reversed(WORDS)), "", "the the the", *(f"{w}{m}" for w in WORDS for m in ("#", "$$", "%%%", "&*", ".,#"))]
    texts += [c.upper() + c + a for c in _LETTERS for a in ("", "z", "é*")]
    for _ in range(2):  # new words, then stored ones
        got = [ids.tolist() for ids in encoder.encode(texts)]
        assert got == [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_words_before_marks_are_encoded_by_the_model_alone(encoder):
    assert encoder.of_letters
    stored = []
    store = encoder._store
    encoder._store = lambda words, **of: (stored.extend(words), store(words, **of))
    encoder.encode(["Gladly$$$ gladly### gladly, gladly%%% gladly&&& gladly***"])
    assert set(stored) == {"$$$", "###", ",", "%%%", "&&&", "***"}


def test_a_repeated_word_is_looked_up_once_among_all_stored(encoder):
    class Counted(dict):
        asked = []

        def get(self, key, *other):
            Counted.asked.append(key)
            return super().get(key, *other)

    encoder.known = Counted()
    encoder.encode(["one two one two", "two\none one"])
    assert sorted(Counted.asked) == ["one", "two"]
