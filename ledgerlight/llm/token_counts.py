"""Token counts of whole texts, with overlap resynchronisation for huge ones.

A text of up to ``CHUNK_CHARS`` characters is encoded at once. A longer one is encoded in overlapping chunks with offsets.
Two neighbouring chunks are spliced where both have a stable boundary: the end of a pre-token (not just of a token), at
least ``MARGIN`` characters before the end of the left chunk. Pre-tokens are found from left to right and look ahead a
few characters at most, and a token never crosses one, so from such a place on the right chunk gives exactly the tokens of
the whole text, if the left one does up to there. When no common boundary is found, the overlap is widened: the left chunk
is encoded again with twice the overlap, in the end up to the end of the text. So the count is exact in every case, and
memory follows the longest stretch without a boundary instead of the longest text.

This holds for tokenizers with a pre-tokenizer and without normalizer, as the byte-level ones; for others, texts are
encoded whole.

Within a text of ordinary size the tokens of a pre-token depend on nothing else, and most pre-tokens come up again and
again. Where the tokenizer splits by the byte-level pattern, each worker stores the number of tokens of up to
``STORE_PIECES`` pre-tokens, as the library gives them. Texts with a special string, or with characters outside the
blocks where that pattern's classes are beyond doubt (``_KNOWN``), go to the library whole.

Cases: null and empty texts have 0 tokens and 0 bytes; repeated rows each get a result; other columns are ignored; an
empty table gives an empty result. Special strings inside texts are handled as the library does by default.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
MARGIN = 64
"""More than any look-ahead of the pre-tokenizer and than any special token."""
BATCH_CHARS = 1 << 18
LIMIT = 1024
STORE_PIECES = 250_000
"""Pre-tokens stored before the store grows old; an old store is kept for look-up until the next one is full."""

# The byte-level pre-tokenizer's pattern, its white space spelled out for the blocks of _KNOWN.
_SPACE = r"\t-\r \x85\xa0"
_PIECE = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
# Latin letters and their marks, and punctuation without the white space and separators among it.
_KNOWN = regex.compile(r"[\x00-\u024f\u2010-\u2027\u2030-\u205e]*")


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _boundaries(encoding, base: int) -> tuple[list[int], list[int]]:
    """Ends of pre-tokens (places in the text, ascending), and the numbers of tokens up to them."""
    ends, numbers = [], []
    words, offsets = encoding.word_ids, encoding.offsets
    for k in range(len(words)):
        last = k + 1 == len(words)
        if last or words[k] is None or words[k + 1] is None or words[k] != words[k + 1]:
            end = base + offsets[k][1]
            # Nothing may reach over the place from either side, nor be lost between the two sides.
            if last or base + offsets[k + 1][0] == end:
                ends.append(end)
                numbers.append(k + 1)
    return ends, numbers


def count_long(text: str, tokenizer, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of one long text, by chunks."""

    def encode(start: int, stop: int) -> tuple[list[int], list[int], int]:
        encoding = tokenizer.encode(text[start:stop], add_special_tokens=False)
        return *_boundaries(encoding, start), len(encoding.ids)

    start, stop = 0, min(chunk, len(text))
    ends, numbers, total = encode(start, stop)
    counted, skipped = 0, 0  # tokens of finished chunks; tokens of the present one that lie before its splice
    wide = overlap
    while stop < len(text):
        next_start = max(start + 1, stop - wide)
        next_stop = min(len(text), next_start + max(chunk, 2 * wide))
        right_ends, right_numbers, right_total = encode(next_start, next_stop)
        right = dict(zip(right_ends, right_numbers, strict=True))
        # The first boundary of both in the overlap that the left chunk's end cannot have moved.
        splice = next(
            (
                (left, right[end])
                for end, left in zip(ends, numbers, strict=True)
                if next_start < end <= stop - MARGIN and left >= skipped and end in right
            ),
            None,
        )
        if splice is None:
            wide *= 2
            stop = min(len(text), stop + wide)
            ends, numbers, total = encode(start, stop)
            continue
        counted += splice[0] - skipped
        skipped = splice[1]
        start, stop, wide = next_start, next_stop, overlap
        ends, numbers, total = right_ends, right_numbers, right_total
    return counted + total - skipped


class PieceCounts:
    """Numbers of tokens of texts, from those of pre-tokens met before."""

    def __init__(self, path: str) -> None:
        self.tokenizer = load(path)
        form = json.loads(self.tokenizer.to_str())
        before = form["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        self.by_piece = bool(plain) and form["normalizer"] is None and not form["model"].get("dropout")
        self.special = [token["content"] for token in form["added_tokens"]]
        self.whole = form["normalizer"] is not None or form["pre_tokenizer"] is None
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def splits(self, text: str) -> bool:
        return self.by_piece and _KNOWN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def count(self, text: str) -> int:
        """Tokens of a text that ``splits``."""
        pieces = _PIECE.findall(text)
        found = list(map(self.known.get, pieces))
        if None in found:
            if len(self.known) > STORE_PIECES:
                self.older, self.known = self.known, {}
                found = [None] * len(pieces)
            self._learn({p for p, n in zip(pieces, found, strict=True) if n is None})
            return sum(map(self.known.__getitem__, pieces))
        return sum(found)

    def _learn(self, pieces: set[str]) -> None:
        held = {p: n for p in pieces if (n := self.older.get(p)) is not None}
        self.known.update(held)
        new = [p for p in pieces if p not in held]
        for k in range(0, len(new), 4096):
            some = new[k : k + 4096]
            encoded = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            self.known.update(zip(some, (len(e.ids) for e in encoded), strict=True))


_counters: dict[str, PieceCounts] = {}


def worker_counts(path: str) -> PieceCounts:
    """The counter of this Python worker, which Spark uses for many tasks."""
    if path not in _counters:
        _counters[path] = PieceCounts(path)
    return _counters[path]


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row of ``docs`` (doc_id, text), by the tokenizer file at ``path``.

    The file must be readable at ``path`` on every executor.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counts(path)
        tokenizer, whole = counter.tokenizer, counter.whole
        for batch in batches:
            sizes, numbers = [], []
            waiting: list[str] = []
            places: list[int] = []
            chars = 0

            def encode_waiting() -> None:
                for place, encoding in zip(places, tokenizer.encode_batch_fast(waiting, add_special_tokens=False), strict=True):
                    numbers[place] = len(encoding.ids)
                waiting.clear()
                places.clear()

            for value in batch.column("text"):
                text = value.as_py() or ""
                sizes.append(len(text.encode()))
                if len(text) <= CHUNK_CHARS and counter.splits(text):
                    numbers.append(counter.count(text))
                elif len(text) <= CHUNK_CHARS or whole:
                    places.append(len(numbers))
                    waiting.append(text)
                    numbers.append(0)
                    chars += len(text)
                    if chars > BATCH_CHARS:
                        encode_waiting()
                        chars = 0
                else:
                    numbers.append(count_long(text, tokenizer))
            encode_waiting()
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()), "n_tokens": pa.array(numbers, pa.int64())}
            )

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")


# ---------------------------------------------------------------- the query


def op8_overlap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents by the byte-level tokenizer."""
    import public_tokenizers

    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
