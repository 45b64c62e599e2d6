"""Token ids of whole texts from a tokenizer file, with a bounded store of words already encoded."""

from __future__ import annotations

import json
import re
from itertools import accumulate, chain

import numpy as np

from .token_counts import load

STORE_WORDS = 500_000
"""Words stored before the store grows old; an old store is kept for look-up until the next one is full."""
GROUP_WORDS = 2_000
# Letters with one lower-case form and no other composition, then marks that never join a letter.
_SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?#$%&*]*)")
_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
# What leaves lower-case letters in one form as they are, and a word of them whole.
_KEEPS_LETTERS = ["NFC", "Replace", "Lowercase"]
_LETTERS_WHOLE = re.compile(r"(?:'[a-z]+\|)*\[\\p\{L\}\]\+\|.*")


class Encoder:
    """Encodes texts as the tokenizers library does, without added special tokens.

    ``by_word``: the tokenizer drops white space and nothing it does reaches over a space or line feed, so a text's ids
    are those of its pieces between them, and a piece met before need not be encoded again. (True of word_bpe_49k: it
    splits at white space, and neither its normalizer nor its special strings contain any. It lower-cases, and cuts between
    letters and marks other than apostrophes.) With other tokenizers, texts are encoded whole.
    """

    def __init__(self, path: str, by_word: bool = False) -> None:
        self.tokenizer = load(path)
        self.by_word = by_word
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # The tokenizer itself where no letters can skip its steps.
        self.of_letters = (self._bytes_of_letters() or self.tokenizer) if by_word else None
        vocabulary = self.tokenizer.get_vocab() if by_word else {}
        self.four_bytes = [n.to_bytes(4, "little") for n in range(max(vocabulary.values(), default=0) + 1)]

    def _bytes_of_letters(self) -> dict[int, str] | None:
        """For words of simple lower-case letters that all steps before the model leave whole: how the model sees a letter."""
        described = json.loads(self.tokenizer.to_str())
        steps = [n.get("type") for n in (described["normalizer"] or {}).get("normalizers", [])]
        split, *rest = (described["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        whole = _LETTERS_WHOLE.fullmatch((split.get("pattern") or {}).get("Regex", ""))
        byte_level = [r.get("type") == "ByteLevel" and not (r["add_prefix_space"] or r["use_regex"]) for r in rest]
        special = any(_SIMPLE.fullmatch(a["content"]) for a in described["added_tokens"])
        if steps != _KEEPS_LETTERS or not whole or not split.get("invert") or byte_level != [True] or special:
            return None
        from tokenizers import pre_tokenizers

        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        return {ord(c): to_bytes.pre_tokenize_str(c)[0][0] for c in _LETTERS}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (unsigned 32-bit) of each text."""
        if not self.by_word:
            encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(e.ids, dtype="<u4") for e in encoded]
        known = self.known
        if len(known) > STORE_WORDS:
            self.older, self.known = known, {}
            known = self.known
        pieces = [text.replace("\n", " ").split(" ") for text in texts]
        flat = list(chain.from_iterable(pieces))
        # Each different piece is looked up once among all that are stored, and its repeats among those of these texts.
        here = dict.fromkeys(flat)
        here.update(zip(here, map(known.get, list(here)), strict=True))
        missing = [piece for piece, ids in here.items() if ids is None]
        if missing:
            self._learn(missing)
            here.update(zip(missing, map(known.__getitem__, missing), strict=True))
        found = list(map(here.__getitem__, flat))
        ends = list(accumulate(map(len, pieces)))
        return [np.frombuffer(b"".join(found[end - len(words) : end]), dtype="<u4") for words, end in zip(pieces, ends, strict=True)]

    def _learn(self, words: list[str]) -> None:
        """Store the ids of ``words``, which are not known; ``The``, ``the`` and ``the,`` are encoded as ``the`` and ``,`` once."""
        known, older, joined, letters, others = self.known, self.older, [], set(), set()
        for word, ids in zip(words, map(older.get, words), strict=True):
            if ids is not None:
                known[word] = ids
                continue
            match = _SIMPLE.fullmatch(word)
            if match is None:
                others.add(word)
                continue
            core, marks = match.groups()
            core = core.lower()
            if core == word:
                letters.add(word)
                continue
            joined.append((word, core, marks))
            for part, to in ((core, letters), (marks, others)):
                if part not in known and part not in to:
                    ids = older.get(part)
                    if ids is None:
                        to.add(part)
                    else:
                        known[part] = ids
        if self.of_letters is self.tokenizer:
            others |= letters
        else:
            tokenize, seen, four = self.tokenizer.model.tokenize, self.of_letters, self.four_bytes
            for word in letters:
                known[word] = b"".join([four[token.id] for token in tokenize(word.translate(seen))])
        self._store(list(others))
        for word, core, marks in joined:
            known[word] = known[core] + known[marks]

    def _store(self, words: list[str]) -> None:
        """One call for many words; offsets tell whose an id is."""
        for at in range(0, len(words), GROUP_WORDS):
            group = words[at : at + GROUP_WORDS]
            encoding = self.tokenizer.encode(" ".join(group), add_special_tokens=False)
            ids = np.array(encoding.ids, dtype="<u4")
            begin = np.array([0, *accumulate(len(w) + 1 for w in group)])
            owner = np.searchsorted(begin, np.array([o[0] for o in encoding.offsets], dtype=np.int64), side="right") - 1
            raw, cut = ids.tobytes(), (4 * np.searchsorted(owner, np.arange(len(group) + 1))).tolist()
            self.known.update(zip(group, (raw[a:b] for a, b in zip(cut, cut[1:], strict=False)), strict=True))


def worker_encoder(path: str, by_word: bool) -> Encoder:
    """The encoder of this Python worker, which Spark uses for many tasks: words of earlier tasks are still stored."""
    import tokenizers

    kept = vars(tokenizers).setdefault("_ledgerlight_encoders", {})
    if (path, by_word) not in kept:
        kept[path, by_word] = Encoder(path, by_word)
    return kept[path, by_word]
