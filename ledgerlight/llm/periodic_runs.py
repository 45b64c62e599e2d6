"""Runs of repeating words: every maximal stretch of a text that repeats with one period, and the text without repeats.

Seed and extend on diagonals. A run of period q and length L matches itself at lag q over L - q words, which for the runs
sought (L at least ``MIN_LENGTH`` and ``MIN_REPEATS`` q) is at least 16 words and at least 2q. So every run of period up to
16 holds a pair of equal 16-grams at lag q, and every longer period between k / 2 and k a pair of equal k-grams at lag q,
k = 32, 64, ... The k-grams of one document are sorted by hash, and neighbouring occurrences at a lag of that level are the
seeds. Neighbours are enough: two occurrences of a k-gram inside a run of smallest period q, q <= k, cannot be less than q
apart, as the shorter lag would be a period of the run too (Fine and Wilf). That keeps the seeds of a level below the number of
words, whatever repeats. A seed is extended in both directions by comparing words, and a table for each lag of the furthest
place covered suppresses further seeds on a stretch already extended. For the same reason the lag of a seed is the smallest period
of its stretch.

Documents do not meet each other, so nothing is shuffled, and memory is linear in the longest text. Words are compared by
64-bit hashes within one document.

Cases: null and empty texts have no words and no run; a null id is an id like any other; repeated rows each get their result;
other columns are kept (names given here get leading underscores on a clash); an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from .common import prefixed, table
from .words import _STEP, PLAIN, Slice, mix, text_slices

MIN_LENGTH = 24
MIN_REPEATS = 3
SEED = 16
"""The least overlap of a run with itself: MIN_LENGTH words less a period of a third of them."""

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN_TYPE = StructType().add("start", LongType()).add("length", LongType()).add("period", LongType())
_OWNER = np.uint64(0x9E3779B97F4A7C15)


def _extend(ids: np.ndarray, at: int, lag: int, first: int, last: int) -> tuple[int, int]:
    """The stretch around ``at``, within words first to last, whose words equal those ``lag`` further on."""
    left, step = at, 64
    while left > first:
        stop = max(first, left - step)
        differ = np.flatnonzero(ids[stop:left] != ids[stop + lag : left + lag])
        if len(differ):
            left = stop + int(differ[-1]) + 1
            break
        left, step = stop, step * 4
    right, step = at, 64
    while right + lag < last:
        stop = min(last - lag, right + step)
        differ = np.flatnonzero(ids[right:stop] != ids[right + lag : stop + lag])
        if len(differ):
            right += int(differ[0])
            break
        right, step = stop, step * 4
    return left, right


def _seeds(s: Slice, ids: np.ndarray, min_length: int, min_repeats: int, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each level the places and lags of neighbouring equal k-grams, one of each row of adjoining seeds."""
    owner, count = s.owner(), np.repeat(s.counts, s.counts)
    last = np.repeat(s.first_word[1:], s.counts)
    gram = ids
    k = 1
    while 2 * k <= seed:
        gram, k = _double(gram, k), 2 * k
    low = 0
    while True:
        starts = np.arange(len(gram))
        at = np.flatnonzero((starts + k <= last[: len(gram)]) & (count[: len(gram)] >= max(min_length, min_repeats * (low + 1))))
        if not len(at):
            return
        own = mix(gram[at] + owner[at].astype(np.uint64) * _OWNER)
        order = np.argsort(own, kind="stable")
        place, lag = at[order[:-1]], np.diff(at[order])
        same = (own[order[1:]] == own[order[:-1]]) & (lag > low) & (lag <= k)
        place, lag = place[same], lag[same]
        same = owner[place] == owner[place + lag]
        place, lag = place[same], lag[same]
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        # A seed right behind another one of its lag lies on the same stretch.
        head = np.ones(len(place), dtype=bool)
        head[1:] = (np.diff(place) != 1) | (np.diff(lag) != 0)
        yield place[head], lag[head]
        gram, low, k = _double(gram, k), k, 2 * k


def _double(gram: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the windows of 2k words from those of k words."""
    n = max(0, len(gram) - k)
    return mix(gram[:n] * _STEP + gram[k : k + n])


def find_runs(
    s: Slice, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word (within the slice), length and period of every run, by text, start and period."""
    ids = s.hashes()
    owner = s.owner()
    # The least overlap over all periods, rounded down to a power of two.
    least = min(max(min_length, min_repeats * q) - q for q in range(1, max(2, min_length) + 1))
    found: list[tuple[int, int, int, int]] = []
    for places, lags in _seeds(s, ids, min_length, min_repeats, 1 << (least.bit_length() - 1)):
        furthest: dict[int, int] = {}
        for at, lag in zip(places.tolist(), lags.tolist(), strict=True):
            if at < furthest.get(lag, -1):
                continue
            text = int(owner[at])
            left, right = _extend(ids, at, lag, int(s.first_word[text]), int(s.first_word[text + 1]))
            furthest[lag] = right
            length = right + lag - left
            if length >= max(min_length, min_repeats * lag):
                found.append((text, left, length, lag))
    columns = np.array(sorted({(t, a, q, n) for t, a, n, q in found}), dtype=np.int64).reshape(-1, 4)
    return columns[:, 0], columns[:, 1], columns[:, 3], columns[:, 2]


def _results(s: Slice, min_length: int, min_repeats: int) -> dict[str, pa.Array]:
    text, start, length, period = find_runs(s, min_length, min_repeats)
    gone = np.zeros(len(s.starts) + 1, dtype=np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, start + length, -1)
    kept = np.cumsum(gone[:-1]) == 0
    data = s.data.tobytes()
    collapsed = []
    for k in range(len(s.rows)):
        words = data[s.begin[k] : s.begin[k + 1]].split()
        keep = kept[s.first_word[k] : s.first_word[k + 1]]
        collapsed.append(b" ".join(words if keep.all() else compress(words, keep.tolist())).decode())
    runs = pa.StructArray.from_arrays([pa.array(start - s.first_word[text]), pa.array(length), pa.array(period)], fields=list(RUN))
    ends = np.searchsorted(text, np.arange(len(s.rows) + 1))
    return {
        "n_words": pa.array(s.counts.astype(np.int64)),
        "runs": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs),
        "collapsed_text": pa.array(collapsed, pa.string()),
    }


def with_runs(docs: DataFrame, text_column: str = "text", min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """``docs`` with n_words, runs (start, length, period; by start, then period) and collapsed_text.

    The collapsed text keeps a word unless some run holds it behind that run's first period; words are joined by one space.
    ``min_repeats`` is 3 or more.
    """
    if min_repeats < 3 or min_length < 1:
        raise ValueError("runs need three repeats or more, and a positive length")
    names = {n: prefixed(docs, [], n) for n in ("n_words", "runs", "collapsed_text")}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in text_slices(batch.column(text_column), PLAIN):
                rows = batch.slice(s.rows.start, len(s.rows))
                got = _results(s, min_length, min_repeats)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, *got.values()], [*batch.schema.names, *(names[n] for n in got)]
                )

    schema = StructType(list(docs.schema.fields)).add(names["n_words"], LongType()).add(names["runs"], ArrayType(RUN_TYPE))
    return docs.mapInArrow(search, schema.add(names["collapsed_text"], StringType()))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; ties: smallest start, then smallest period. Null if none."""
    none = F.lit(None).cast(RUN_TYPE)

    def better(best: Column, run: Column) -> Column:  # runs come by start, then period
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(runs, none, better)


# ---------------------------------------------------------------- the query


def repeated_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, a tenth of the texts with a tail that repeats, as the query's contract states; null ids stay as they are."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for row, (doc_id, text) in enumerate(zip(ids, texts, strict=True)):
                h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
                words = text.encode().split() if text and h % 10 == 0 else []
                if words:
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    words[a:] = (words[a : a + p] * ((n - a) // p + 1))[: n - a]
                    texts[row] = b" ".join(words).decode()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    narrow = docs.select("doc_id", "text")
    return narrow.mapInArrow(rewrite, narrow.schema)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs and collapsed text of every document."""
    found = with_runs(repeated_tails(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
        F.col("n_words"),
    )
