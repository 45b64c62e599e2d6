"""Substring dedup by relative Lempel-Ziv parsing against an index of all documents.

The reference of a document is every document with a smaller id. It is indexed by windows of ``WINDOW`` words: the index
gives, for a window, the first document that holds it and the place there. A document is factored from left to right: a
factor starts at a window found in the index and goes on while the next window is found at the next place of the same
reference, so a factor is one stretch of its reference, word by word. It ends where the first occurrences part; it is not
searched for a later document that might go on for longer. A plain greedy parse would go on behind the factor's last word
and miss a copied passage that begins inside it, so the windows across each factor's end are looked up as well: factors may
overlap by less than a window. Every factor is as long as a window at least, and its words are a duplicate span.

The index is not built for all windows. Each window has an anchor, its least hashed run of ``ANCHOR`` words, which equal
windows share; a document has about one anchor for each four or five words. Step 1 finds the anchors that more than one
document holds. Step 2 takes them back to the documents, and only windows with a shared anchor go on. Step 3 finds each such
window's first document and takes it back. Each step groups with partial minima; the windows of a passage in a third of all
documents take their first document from a small table of frequent windows, the others by a join, and so do copies of a
frequent text; each step is written to the shared folder before the next. Exact copies of a whole text skip the
steps: all of their windows start in their first document.

A window is identified by 95 bits of hash, on top of an anchor that two documents share: with 10^12 candidate windows the
chance of one false match is about one in 10^5.

Cases: null and empty texts have no words; texts with fewer words than a window lose none; rows with equal doc_id are the
same document and never each other's reference (a factor's place is then that in one of them); a null doc_id counts as
larger than all others; other columns are kept (names given here get leading underscores on a clash); an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import discard, prefixed, shared_folder, staged, table, text_key
from .words import PLAIN, text_slices

WINDOW, ANCHOR = 13, 6
NO_ID = (1 << 63) - 1
# The greatest share of one window, or one text, of the rows of a join by hash is 1 in this number.
HOT_KEYS = 10_000
FACTOR = ("word_from", "word_to", "reference", "reference_from")


def _anchors(s, words: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows of a slice, their hashes, and their anchors."""
    at, hashes = s.window_hashes(words, window)
    runs = len(words) - anchor + 1
    if not len(at) or runs <= 0:
        return at, hashes, np.empty(0, dtype=np.uint64)
    # Hashes of all runs, also of those across texts: a window's own runs all lie in its text.
    value = np.full(runs, anchor, dtype=np.uint64)
    for j in range(anchor):
        value = value * np.uint64(0x9FB21C651E98DF25) + words[j : runs + j]
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(32)
    least = value[: runs - window + anchor].copy()
    for j in range(1, window - anchor + 1):
        np.minimum(least, value[j : j + len(least)], out=least)
    return at, hashes, least[at]


def _anchor_rows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """anchor, row_key: the anchors of every document (``docs``: row_key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column("row_key"))
            for s in text_slices(batch.column("text"), PLAIN):
                at, _, least = _anchors(s, s.hashes(), window, anchor)
                if len(at):
                    owner = s.owner()[at]
                    new = np.ones(len(at), dtype=bool)
                    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
                    yield pa.record_batch(
                        {"anchor": pa.array(least[new].view(np.int64)), "row_key": pa.array(keys[s.rows.start + owner[new]])}
                    )

    return docs.select("row_key", "text").mapInArrow(run, "anchor bigint, row_key bigint")


def _candidate_windows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """Windows with an anchor of their document's list (``docs``: id, row_key, text, anchors)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = np.asarray(batch.column("row_key")), np.asarray(batch.column("id"))
            shared = batch.column("anchors")
            for s in text_slices(batch.column("text"), PLAIN):
                at, hashes, least = _anchors(s, s.hashes(), window, anchor)
                owner = s.owner()[at]
                cuts = np.searchsorted(owner, np.arange(len(s.rows) + 1))
                held = np.zeros(len(at), dtype=bool)
                for k in range(len(s.rows)):
                    part = slice(cuts[k], cuts[k + 1])
                    held[part] = np.isin(least[part], np.asarray(shared[s.rows.start + k].values).astype(np.int64).view(np.uint64))
                if held.any():
                    at, hashes, least, owner = at[held], hashes[held], least[held], owner[held]
                    row = s.rows.start + owner
                    # The first place of each window in its document.
                    lead = np.zeros(len(at), dtype=bool)
                    lead[np.unique(hashes ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]] = True
                    second = ((least ^ (hashes << np.uint64(7))) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(33)
                    yield pa.record_batch(
                        {
                            "w1": pa.array(hashes.view(np.int64)), "w2": pa.array(second.astype(np.int32)),
                            "id": pa.array(ids[row]), "row_key": pa.array(keys[row]),
                            "place": pa.array((at - s.first_word[owner]).astype(np.int32)), "lead": pa.array(lead),
                        }
                    )

    columns = docs.select("id", "row_key", "text", "anchors")
    return columns.mapInArrow(run, "w1 bigint, w2 int, id bigint, row_key bigint, place int, lead boolean")


def _taken_back(rows: DataFrame, first: DataFrame, key1: str, key2: str) -> DataFrame:
    """Rows with what is known of their key (``first``: of1, of2, n, the key's number of rows, and more).

    A key that makes up more than one in ``HOT_KEYS`` of all rows is looked up in a broadcast table, which has fewer
    than ``HOT_KEYS`` rows whatever the data are; so no task of the join by hash gets more than that share for one key.
    """
    same = (F.col(key1) == F.col("of1")) & (F.col(key2) == F.col("of2"))
    frequent = F.col("n") * HOT_KEYS > rows.count()
    hot = F.broadcast(first.where(frequent))
    rest = rows.join(hot.select("of1", "of2"), same, "left_anti").join(first.where(~frequent), same)
    return rows.join(hot, same).unionByName(rest)


def duplicate_windows(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[DataFrame, str]:
    """What to take from each document, and the folder that holds it.

    ``docs``: id (not null), row_key, text. Rows: row_key, whole (an exact copy: all windows), found (place of a window,
    and the reference document in which it starts first, with the place there).
    """
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession)
    # Exact copies, by two independent hashes of the whole text.
    texts = docs.select("id", "row_key", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(11), "text").alias("t2"))
    texts = staged(texts, folder, "texts")
    firsts = texts.groupBy("t1", "t2").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.where("first < last").withColumnsRenamed({"t1": "of1", "t2": "of2"})
    copies = _taken_back(texts, staged(firsts, folder, "firsts"), "t1", "t2").where("first < id")
    copies = staged(copies.select("row_key", "first").groupBy("row_key").agg(F.min("first").alias("first")), folder, "copies")

    rows = _anchor_rows(docs, window, anchor)
    spread = rows.groupBy("anchor").agg(F.min("row_key").alias("least"), F.max("row_key").alias("most"))
    shared = staged(spread.where("least < most").select("anchor"), folder, "shared")

    own = rows.join(shared, "anchor", "left_semi").groupBy("row_key").agg(F.collect_set("anchor").alias("anchors"))
    own = own.join(copies, "row_key", "left_anti").withColumnRenamed("row_key", "of_row")
    once = docs.join(own, F.col("row_key") == F.col("of_row"))
    windows = staged(_candidate_windows(once, window, anchor), folder, "windows")
    discard(spark, folder, "shared")

    place = F.min_by("place", F.when(F.col("lead"), F.col("id"))).alias("begin")
    held = [F.min("id").alias("reference"), F.max("id").alias("last"), place, F.count(F.lit(1)).alias("n")]
    first = windows.groupBy("w1", "w2").agg(*held).where("reference < last")
    first = staged(first.select(F.col("w1").alias("of1"), F.col("w2").alias("of2"), "reference", "begin", "n"), folder, "first")
    found = _taken_back(windows, first, "w1", "w2").where("reference < id")
    found = found.groupBy("row_key").agg(F.collect_set(F.struct("place", "reference", "begin")).alias("found"))
    marks = found.select("row_key", F.lit(None).cast("long").alias("whole"), "found")
    whole = copies.select("row_key", F.col("first").alias("whole"), F.lit(None).cast("array<struct<place:int,reference:bigint,begin:int>>").alias("found"))
    marks = staged(marks.unionByName(whole), folder, "marks")
    discard(spark, folder, "windows")
    discard(spark, folder, "first")
    return marks, folder


def _factors(places: np.ndarray, references: np.ndarray, begins: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """Factors (first word, word after, reference, first word there) of windows found at ``places``, ascending."""
    new = np.ones(len(places), dtype=bool)
    new[1:] = (places[1:] != places[:-1] + 1) | (references[1:] != references[:-1]) | (begins[1:] != begins[:-1] + 1)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(places)) - 1
    columns = (places[begin], places[last] + window, references[begin], begins[begin])
    return list(zip(*(c.tolist() for c in columns), strict=True))


def remove_duplicates(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, text_column: str = "text") -> DataFrame:
    """``docs`` with kept_text (the words that stay, joined by a space), n_words, n_removed and factors.

    ``factors`` has the duplicate spans: word_from, word_to, reference (the document in which they start first) and
    reference_from (the word there).
    """
    names = {n: prefixed(docs, [], n) for n in ("kept_text", "n_words", "n_removed", "factors")}
    key, of_row, of_whole, of_found, of_begin = (prefixed(docs, [], n) for n in ("row_key", "of_row", "of_whole", "of_found", "of_begin"))
    identity, text = F.coalesce(docs["doc_id"], F.lit(NO_ID)), F.coalesce(docs[text_column], F.lit(""))
    row_key = F.xxhash64(identity, text_key(docs[text_column]))
    marks, _ = duplicate_windows(docs.select(identity.alias("id"), row_key.alias("row_key"), text.alias("text")), window, anchor)
    marks = marks.select(F.col("row_key").alias(of_row), F.col("whole").alias(of_whole), F.array_sort("found").alias(of_found))
    marked = docs.withColumn(key, row_key).join(marks, F.col(key) == F.col(of_row), "left")
    columns = docs.columns
    found = (F.col(of_found)[field].alias(name) for field, name in (("place", of_row), ("reference", of_found), ("begin", of_begin)))
    marked = marked.select(*columns, of_whole, *found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(columns)
        for batch in batches:
            kept, numbers, removed, factors = [], [], [], []
            whole, found = batch.column(n), [batch.column(n + k) for k in (1, 2, 3)]
            for row, value in enumerate(batch.column(columns.index(text_column))):
                words = (value.as_py() or "").encode().split()
                spans: list[tuple[int, int, int, int]] = []
                if whole[row].is_valid and len(words) >= window:
                    spans = [(0, len(words), whole[row].as_py(), 0)]
                elif found[0][row].is_valid:
                    spans = _factors(*(np.asarray(of[row].values) for of in found), window)
                stay = np.ones(len(words), dtype=bool)
                for a, b, *_ in spans:
                    stay[a:b] = False
                numbers.append(len(words))
                removed.append(len(words) - int(stay.sum()))
                kept.append(b" ".join(words[k] for k in np.flatnonzero(stay)) if spans else b" ".join(words))
                factors.append([dict(zip(FACTOR, span, strict=True)) for span in spans])
            out = [
                *batch.columns[:n], pa.array(kept, pa.binary()).cast(pa.string()), pa.array(numbers, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(factors, pa.list_(pa.struct([(name, pa.int64()) for name in FACTOR]))),
            ]
            yield pa.RecordBatch.from_arrays(out, [*columns, *names.values()])

    span = StructType([StructField(name, LongType()) for name in FACTOR])
    schema = StructType([*docs.schema.fields]).add(names["kept_text"], StringType()).add(names["n_words"], LongType())
    return marked.mapInArrow(run, schema.add(names["n_removed"], LongType()).add(names["factors"], ArrayType(span)))


# ---------------------------------------------------------------- the query


def op2_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat a passage of an earlier one."""
    cut = remove_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


OP2_SQL = r"""
with words as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
    select doc_id, i, array_to_string(w[i:i + 12], ' ') as passage
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) as i from words)),
firsts as (select passage, min(doc_id) as first from windows group by passage having min(doc_id) < max(doc_id)),
hits as (select doc_id, i from windows join firsts using (passage) where first < doc_id),
gone as (select distinct doc_id, i + j as place from hits, range(0, 13) r(j)),
placed as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as place from words),
kept as (
    select doc_id, count(*) filter (where gone.place is not null) as n_removed,
           string_agg(word, ' ' order by place) filter (where gone.place is null) as rest
    from placed left join gone using (doc_id, place) group by doc_id)
select words.doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(rest, '')) as kept_sha256
from words left join kept using (doc_id)
"""
