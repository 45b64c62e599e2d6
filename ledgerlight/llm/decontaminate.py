"""Benchmark decontamination with a distributed positional inverted index.

The corpus is indexed in segments of a few MB: a segment holds, for each test term, the places of that term in the words
of its documents, ascending. The index is split by document, so it needs no shuffle, a frequent term is nowhere a hot key,
and a lost executor costs its own segments. Terms that no test holds cannot take part in a match and get no postings.

A test window is searched from its rarest term (by counts over the whole corpus): its postings minus the term's offset are
candidate starts, and the list of each further term, rarest first, is intersected with them. With ``slop`` above 0, a
term may stand up to so many words from its place (proximity match).

Tests are taken in blocks of at most ``BLOCK_WORDS`` words, so what is sent to the tasks has a fixed bound however many
tests there are; each block has its own index. (One test item must fit in a block.)

Cases: a null or empty text has no words and is never hit; an item without words has no window; rows equal in id and text
are reported each; items with equal ids are one item; an item with null id marks words and is not listed; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prefixed, shared_folder, staged, table, text_key
from .words import ALNUM, text_slices

WINDOW = 10
BLOCK_WORDS = 1_000_000
SEGMENT_BYTES = 4 << 20
MERGE_HITS = 1 << 18
"""So many hits of a segment, or twice as many as are left of them, are merged to spans before more are searched."""

INDEX_SCHEMA = (
    "segment bigint, doc_ids array<bigint>, text_keys array<bigint>, first_word array<int>, "
    "terms array<int>, counts array<int>, postings binary"
)
SPAN_SCHEMA = "segment bigint, place int, item_id string, word_from int, word_to int"


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("item_id")
        for s in text_slices(batch.column("text"), ALNUM, lower=True):
            terms = s.hashes().view(np.int64)
            yield pa.record_batch(
                {
                    "item_id": ids.slice(s.rows.start, len(s.rows)),
                    "terms": pa.ListArray.from_arrays(pa.array(s.first_word, pa.int32()), pa.array(terms)),
                }
            )


def build_index(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Segments of ``docs`` (doc_id, text) with the postings of ``vocabulary``, ascending 64-bit term hashes."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = sent.value, TaskContext.get().partitionId() << 32
        for batch in batches:
            for s in text_slices(batch.column("text"), ALNUM, lower=True, slice_bytes=SEGMENT_BYTES):
                words = s.hashes()
                term = np.searchsorted(known, words)
                term[term == len(known)] = 0
                place = np.flatnonzero(known[term] == words) if len(known) else np.empty(0, dtype=np.int64)
                term = term[place]
                order = np.argsort(term, kind="stable")
                term, place = term[order], place[order]
                begin = np.flatnonzero(np.diff(term, prepend=-1))
                # Stored as steps from place to place: small numbers compress well.
                step = np.diff(place, prepend=0)
                step[begin] = place[begin]
                rows = slice(s.rows.start, s.rows.stop)
                yield pa.record_batch(
                    {
                        "segment": pa.array([number], pa.int64()),
                        "doc_ids": pa.array([batch.column("doc_id")[rows].to_pylist()], pa.list_(pa.int64())),
                        "text_keys": pa.array([batch.column("text_key")[rows].to_pylist()], pa.list_(pa.int64())),
                        "first_word": pa.array([s.first_word.astype(np.int32)], pa.list_(pa.int32())),
                        "terms": pa.array([term[begin].astype(np.int32)], pa.list_(pa.int32())),
                        "counts": pa.array([np.diff(begin, append=len(term)).astype(np.int32)], pa.list_(pa.int32())),
                        "postings": pa.array([step.astype("<u4").tobytes()], pa.binary()),
                    }
                )
                number += 1

    return docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key")).mapInArrow(segments, INDEX_SCHEMA)


def _windows(items: list[tuple[str | None, list[int]]], size: int) -> list[tuple[int, list[int]]]:
    """(item, its consecutive terms): windows of ``size`` words, or all words of an item with fewer."""
    out = []
    for k, (_, terms) in enumerate(items):
        if 0 < len(terms) < size:
            out.append((k, terms))
        out.extend((k, terms[i : i + size]) for i in range(len(terms) - size + 1))
    return out


def find_spans(index: DataFrame, items: list[tuple[str | None, list[int]]], vocabulary: np.ndarray, size: int, slop: int = 0) -> DataFrame:
    """Word spans of the index that match windows of ``items``: segment, place (of the document in it), item_id, words."""
    counts = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts"))
    frequency = np.zeros(len(vocabulary), dtype=np.int64)
    for term, count in counts.collect():  # at most one row for each term of the block
        frequency[term] = count
    number = {int(h): k for k, h in enumerate(vocabulary)}
    searches = []
    for item, terms in _windows(items, size):
        ids = [number[t & 0xFFFFFFFFFFFFFFFF] for t in terms]
        by_rarity = sorted(range(len(ids)), key=lambda j: (frequency[ids[j]], j))
        searches.append((item, len(ids), [(ids[j], j) for j in by_rarity]))
    sent = index.sparkSession.sparkContext.broadcast((searches, [i for i, _ in items]))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, names = sent.value
        for batch in batches:
            for row in range(batch.num_rows):
                found = _search(batch, row, wanted, slop)
                if len(found):
                    yield pa.record_batch(
                        {
                            "segment": pa.array(np.full(len(found), batch.column("segment")[row].as_py())),
                            "place": pa.array(found[:, 1].astype(np.int32)),
                            "item_id": pa.array([names[k] for k in found[:, 0]], pa.string()),
                            "word_from": pa.array(found[:, 2].astype(np.int32)),
                            "word_to": pa.array(found[:, 3].astype(np.int32)),
                        }
                    )

    return index.select("segment", "first_word", "terms", "counts", "postings").mapInArrow(match, SPAN_SCHEMA)


def _search(batch: pa.RecordBatch, row: int, searches: list, slop: int) -> np.ndarray:
    """Spans (item, document, first word, word after) of one segment; overlapping spans of an item are one."""
    terms = np.asarray(batch.column("terms")[row].values)
    counts = np.asarray(batch.column("counts")[row].values)
    steps = np.frombuffer(batch.column("postings")[row].as_py(), dtype="<u4").astype(np.int64)
    first_word = np.asarray(batch.column("first_word")[row].values).astype(np.int64)
    ends = np.cumsum(counts)
    lists: dict[int, np.ndarray] = {}
    where = dict(zip(terms.tolist(), range(len(terms)), strict=True))

    def postings(term: int) -> np.ndarray | None:
        if term not in lists:
            k = where.get(term)
            lists[term] = None if k is None else np.cumsum(steps[ends[k] - counts[k] : ends[k]])
        return lists[term]

    hits: list[np.ndarray] = []
    held, most = 0, MERGE_HITS
    for item, length, by_rarity in searches:
        starts = doc = None
        for term, offset in by_rarity:
            places = postings(term)
            if places is None:
                starts = None
                break
            if starts is None:
                starts, doc = places - offset, np.searchsorted(first_word, places, side="right") - 1
                continue
            # The first place near enough in the same document.
            at = np.searchsorted(places, np.maximum(starts + (offset - slop), first_word[doc]))
            near = places[np.minimum(at, len(places) - 1)]
            fits = (at < len(places)) & (near <= starts + (offset + slop)) & (near < first_word[doc + 1])
            starts, doc = starts[fits], doc[fits]
            if not len(starts):
                break
        if starts is not None and len(starts):
            # With slop, a match may begin or end beyond its document by as many words: only those inside are hit.
            base = np.maximum(starts - first_word[doc], 0)
            end = np.minimum(starts + length, first_word[doc + 1]) - first_word[doc]
            hits.append(np.stack([np.full(len(starts), item), doc, base, end], axis=1))
            held += len(starts)
            if held > most:  # copies of a passage and frequent words overlap, so that little is left of them
                hits = [_merged(hits)]
                held = len(hits[0])
                most = max(MERGE_HITS, 2 * held)
    return _merged(hits)


def _merged(hits: list[np.ndarray]) -> np.ndarray:
    """The spans (item, document, first word, word after) of ``hits``, overlapping ones of an item as one."""
    if not hits:
        return np.empty((0, 4), dtype=np.int64)
    all_ = np.concatenate(hits)
    all_ = all_[np.lexsort((all_[:, 2], all_[:, 1], all_[:, 0]))]
    # A span ends where the next one of its item and document begins behind all words reached so far.
    group = np.flatnonzero(np.any(np.diff(all_[:, :2], axis=0, prepend=-1) != 0, axis=1))
    number = np.zeros(len(all_), dtype=np.int64)
    number[group] = 1
    number = np.cumsum(number)
    reach = np.maximum.accumulate(all_[:, 3] + number * (1 << 40)) - number * (1 << 40)
    new = np.ones(len(all_), dtype=bool)
    new[1:] = (number[1:] != number[:-1]) | (all_[1:, 2] > reach[:-1])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(all_)) - 1
    return np.stack([all_[begin, 0], all_[begin, 1], all_[begin, 2], reach[last]], axis=1)


def contamination(docs: DataFrame, tests: DataFrame, size: int = WINDOW, slop: int = 0) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text_key, n_words, n_hit, item_ids, spans.

    ``tests``: item_id, text. A document word inside any occurrence of a window of ``size`` consecutive test words (an
    item of fewer words is one window) is hit; ``spans`` has the hit words as (word_from, word_to), ``item_ids`` the items.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    items = tests.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(
        _item_terms, "item_id string, terms array<bigint>"
    )
    items = staged(items.where(F.size("terms") > 0), folder, "items")
    total = items.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_WORDS))
    found = rows = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == block)
        listed = [(r[0], r[1]) for r in part.collect()]  # about BLOCK_WORDS terms
        hashes = np.array([t for _, terms in listed for t in terms], dtype=np.int64).view(np.uint64)
        vocabulary = np.unique(hashes)
        index = staged(build_index(docs, vocabulary), folder, f"index{block}")
        if rows is None:  # segments are cut alike for every block
            rows = index
        spans = find_spans(index, listed, vocabulary, size, slop)
        found = spans if found is None else found.unionByName(spans)
    per_doc = found.groupBy("segment", "place").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        F.array_sort(F.collect_set(F.struct("word_from", "word_to"))).alias("spans"),
    )
    listed_docs = rows.select(
        F.col("segment").alias("doc_segment"), "first_word", F.posexplode(F.arrays_zip("doc_ids", "text_keys")).alias("doc_place", "doc")
    ).select(
        "doc_segment", "doc_place", F.col("doc.doc_ids").alias("doc_id"), F.col("doc.text_keys").alias("text_key"),
        (F.element_at("first_word", F.col("doc_place") + 2) - F.element_at("first_word", F.col("doc_place") + 1)).cast("long").alias("n_words"),
    )
    same = (F.col("segment") == F.col("doc_segment")) & (F.col("place") == F.col("doc_place"))
    joined = listed_docs.join(per_doc, same, "left")
    # Words in the union of the spans, which are sorted by their first word.
    walked = F.aggregate(
        F.coalesce("spans", F.array().cast("array<struct<word_from:int,word_to:int>>")),
        F.struct(F.lit(0).alias("reach"), F.lit(0).cast("long").alias("hit")),
        lambda acc, x: F.struct(
            F.greatest(acc["reach"], x["word_to"]).alias("reach"),
            (acc["hit"] + F.greatest(x["word_to"] - F.greatest(acc["reach"], x["word_from"]), F.lit(0))).alias("hit"),
        ),
    )
    return joined.select(
        "doc_id", "text_key", "n_words", walked["hit"].alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), "spans",
    )


def drop_contaminated(docs: DataFrame, tests: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a test window."""
    hit_id, hit_key = prefixed(docs, [], "hit_id"), prefixed(docs, [], "hit_key")
    hit = contamination(docs, tests, size).where("n_hit > 0").select(F.col("doc_id").alias(hit_id), F.col("text_key").alias(hit_key))
    same = docs["doc_id"].eqNullSafe(F.col(hit_id)) & (text_key(docs["text"]) == F.col(hit_key))
    return docs.join(hit.distinct(), same, "left_anti")


# ---------------------------------------------------------------- the query


def op7_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document by the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
