"""Line dedup across documents: of a line that several documents hold, only the first document keeps it.

Range partition with secondary sort, in DataFrame functions only. Each line becomes (128-bit hash of its key, document,
position); texts do not move. The lines are exchanged by range of the hash, sorted by hash, document and position, and read as a
stream in which a line's first occurrence names its document. What comes back to a document is a bitmap: 64 lines a word,
and only the words that lose a line, so a document without repeats costs nothing.

A line that makes up a large part of all lines would fill one range. Such lines are found exactly before the exchange, by
counts of hash buckets and then of the hashes in full buckets (both combine before their shuffle). At most ``HOT_SHARES`` a
partition can exceed the limit, so their first documents are broadcast, and their lines are decided where they lie.

The key of a line is the line without white space at its ends, A-Z in lower case; keys of fewer than ``MIN_CHARS`` code
points are left alone. Documents are compared by id; a null id is one document behind all others.

Cases: null and empty texts are one empty line; rows of one id belong to one document, and each keeps or loses its own lines; rows
equal in id and text get equal bitmaps; other columns are kept (names given here get leading underscores on a clash); an empty
table gives an empty result; a document that loses every line has an empty text.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import prefixed, row_key, shared_folder, staged, table

MIN_CHARS = 10
HOT_SHARES = 4
"""A line is hot if its lines outnumber this part of a shuffle partition's mean."""
HOT_ROWS = 256
"""No line with fewer lines is hot."""
BUCKETS = 1 << 16

# The white space of \\x20\\x09-\\x0D.
BLANKS = " \t\n\x0b\x0c\r"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def _place(doc_id: Column) -> Column:
    """Documents in their order, null last."""
    return F.struct(doc_id.isNull().alias("none"), doc_id.alias("id"))


def lines_of(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every line with a long enough key: h1, h2, doc_id, row, pos."""
    lines = docs.select("doc_id", row_key(docs).alias("row"), F.posexplode(split_lines(docs["text"])).alias("pos", "line"))
    lines = lines.select("doc_id", "row", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return lines.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("2"), F.col("key")).alias("h2"), "doc_id", "row", "pos")


def hot_lines(lines: DataFrame) -> DataFrame:
    """h1, h2 and first document of the lines that would fill a partition; at most HOT_SHARES a shuffle partition."""
    partitions = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod("h1", F.lit(BUCKETS)).alias("bucket")
    limit = max(HOT_ROWS, lines.count() / (HOT_SHARES * partitions))
    full = lines.groupBy(bucket).agg(F.count("*").alias("n")).where(F.col("n") > limit).select("bucket")
    among = lines.withColumn("bucket", bucket).join(F.broadcast(full), "bucket", "left_semi")
    counted = among.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(_place(F.col("doc_id"))).alias("first"))
    return counted.where(F.col("n") > limit).select("h1", "h2", "first")


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """row and pos of every line that an earlier document holds."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    lines = staged(lines_of(docs, min_chars), folder, "lines")
    hot = staged(hot_lines(lines), folder, "hot")
    of_hot = lines.join(F.broadcast(hot), ["h1", "h2"]).where(_place(F.col("doc_id")) != F.col("first")).select("row", "pos")
    others = lines.join(F.broadcast(hot.select("h1", "h2")), ["h1", "h2"], "left_anti")
    ranges = others.repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", F.asc_nulls_last("doc_id"), "pos")
    stream = Window.partitionBy("h1", "h2").orderBy(F.asc_nulls_last("doc_id"), "pos")
    first = ranges.withColumn("first", F.first("doc_id").over(stream))
    return first.where(~F.col("doc_id").eqNullSafe(F.col("first"))).select("row", "pos").unionAll(of_hot)


def line_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """row, n_dropped and keep for the rows that lose lines.

    ``keep`` is an array of (word, bits): bit b of word w is set if line 64 w + b stays. Words not listed keep all their lines.
    """
    gone = repeated_lines(docs, min_chars)
    bit = F.expr("shiftleft(1L, cast(pmod(pos, 64) as int))")
    words = gone.groupBy("row", F.expr("cast(pos div 64 as int)").alias("word")).agg(F.bit_or(bit).alias("gone"))
    pair = F.struct("word", F.bitwise_not("gone").alias("bits"))
    return words.groupBy("row").agg(
        F.sum(F.bit_count("gone")).cast("long").alias("n_dropped"), F.sort_array(F.collect_list(pair)).alias("keep")
    )


def with_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with n_lines, n_dropped and keep (null: all lines stay)."""
    bitmaps = staged(line_bitmaps(docs, min_chars), shared_folder(docs.sparkSession), "bitmaps")
    names = {n: prefixed(docs, [], n) for n in ("row", "n_lines", "n_dropped", "keep")}
    keyed = docs.withColumn(names["row"], row_key(docs))
    found = bitmaps.select(F.col("row").alias(names["row"]), F.col("n_dropped").alias("lost"), F.col("keep").alias("kept_bits"))
    lost, bits = prefixed(docs, list(names.values()), "lost"), prefixed(docs, list(names.values()), "kept_bits")
    found = found.withColumnsRenamed({"lost": lost, "kept_bits": bits})
    # The same join at every size: bitmaps grow with the documents, so they are not broadcast where they happen to be few.
    joined = keyed.join(found.hint("merge"), names["row"], "left")
    return joined.select(
        *(F.col(f"`{c}`") for c in docs.columns),
        F.size(split_lines(F.col("text"))).cast("long").alias(names["n_lines"]),
        F.coalesce(F.col(lost), F.lit(0)).cast("long").alias(names["n_dropped"]),
        F.col(bits).alias(names["keep"]),
    )


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often lambdas inside refer to it."""
    return F.transform(F.array(value), use)[0]


def kept_text(text: Column, keep: Column) -> Column:
    """The lines that ``keep`` lets stay, joined by line breaks; all of them where it is null."""
    all_kept = F.lit(-1).cast("long")

    def every_word(lines: Column) -> Column:
        words = F.sequence(F.lit(0), F.shiftright(F.size(lines) - 1, 6))
        bits = _with(F.map_from_entries(keep), lambda listed: F.transform(words, lambda w: F.coalesce(F.try_element_at(listed, w), all_kept)))
        return F.struct(lines.alias("lines"), bits.alias("bits"))

    def filtered(both: Column) -> Column:
        return F.filter(both["lines"], lambda _, at: F.getbit(F.get(both["bits"], F.shiftright(at, 6)), F.pmod(at, F.lit(64))) == 1)

    kept = _with(_with(split_lines(text), every_word), filtered)
    return F.when(keep.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(kept, "\n"))


# ---------------------------------------------------------------- the query


def op12_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts of every document and the digest of what its bitmap keeps."""
    marked = with_bitmaps(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(kept_text(F.col("text"), F.col("keep")).cast("binary"), 256)
    return marked.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


OP12_SQL = r"""
with lines as (
  select rowid_, doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as pos
  from (select row_number() over () as rowid_, doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)
), keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from lines
), firsts as (
  select k, min(doc_id) as first from keyed where length(k) >= 10 group by k having count(distinct doc_id) > 1
), marked as (
  select l.*, coalesce(l.doc_id <> f.first, false) as gone from keyed l left join firsts f on l.k = f.k
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by rowid_, doc_id
"""
