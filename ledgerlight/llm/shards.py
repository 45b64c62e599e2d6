"""Sharding by histogram sort.

The key of a row is a hash of its text, then a hash of id and text, so equal texts lie side by side. Splitters between shards
are found without moving any row: each round counts the exact bytes in candidate key ranges across all partitions, keeps
the range that holds each target, and divides only those ranges further, until every splitter is within the tolerance or
its key is exhausted. Then rows are exchanged once. A round returns at most ``shards`` times 2^``STEP_BITS`` counts.

A splitter falls between different texts while the tolerance allows; a text whose copies outweigh it is divided by id.

Cases: null text has size 1 and sorts by the hash of the empty text; a null id hashes as null; rows equal in id and text are
numbered, so that they can be divided like copies with different ids; other columns are kept (names given here get leading
underscores on a clash); an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import prefixed, shared_folder, staged, table

KEY_BITS = 63
STEP_BITS = 10
TOLERANCE = 0.002
"""Allowed distance of a splitter from its target, as a part of the mean shard."""
SLOT_ROWS = 4096
"""Rows that are numbered together on average."""


def row_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def row_keys(id_column: Column, text: Column) -> tuple[Column, Column]:
    first = F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 1)
    return first, F.shiftrightunsigned(F.xxhash64(F.lit(7), id_column, F.coalesce(text, F.lit(""))), 1)


def find_splitters(keyed: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """Lowest keys (k1, k2) of shards 1 and up. ``keyed``: k1, k2, size."""
    total = keyed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    slack = tolerance * total / shards
    # A splitter under search: its target, the bytes below its range, the range's fixed first key and prefix with bits.
    open_ = {s: (total * s / shards, 0, None, 0, 0) for s in range(1, shards)}
    found: dict[int, tuple[int, int]] = {}
    while open_:
        ranges = {state[2:] for state in open_.values()}
        for_range: dict[tuple, list[tuple[int, int]]] = {}
        by_level: dict[tuple[bool, int], list[tuple]] = {}
        for r in ranges:
            by_level.setdefault((r[0] is not None, r[2]), []).append(r)
        for (second, bits), members in by_level.items():
            step = min(STEP_BITS, KEY_BITS - bits)
            key, low = F.col("k2" if second else "k1"), KEY_BITS - bits - step
            prefix = F.shiftright(key, KEY_BITS - bits) if bits else F.lit(0).cast("long")
            held = F.lit(False)
            if second:
                for fixed in {m[0] for m in members}:
                    held = held | ((F.col("k1") == fixed) & prefix.isin([m[1] for m in members if m[0] == fixed]))
            else:
                held = prefix.isin([m[1] for m in members])
            group = [F.col("k1") if second else F.lit(-1).cast("long"), F.shiftright(key, low)]
            counts = keyed.where(held).groupBy(group[0].alias("fixed"), group[1].alias("probe")).agg(F.sum("size").alias("bytes"))
            for fixed, probe, size in counts.collect():  # at most 2^STEP_BITS for each splitter
                for_range.setdefault((fixed if second else None, probe >> step, bits), []).append((probe, size))
        for s, (target, below, fixed, prefix, bits) in list(open_.items()):
            step = min(STEP_BITS, KEY_BITS - bits)
            best, inside = None, None
            at = below
            for probe, size in sorted(for_range.get((fixed, prefix, bits), [])):
                for edge, value in ((at, probe), (at + size, probe + 1)):
                    if best is None or abs(edge - target) < abs(best[0] - target):
                        best = (edge, value)
                if at <= target < at + size:
                    inside = (at, probe)
                at += size
            low = KEY_BITS - bits - step
            exhausted = low == 0 and fixed is not None
            if best is None or abs(best[0] - target) <= slack or inside is None or exhausted:
                edge = (best[1] if best else prefix << step) << low
                found[s] = (edge, 0) if fixed is None else (fixed, edge)
                del open_[s]
            elif low == 0:  # one text outweighs the tolerance: go on within its copies
                open_[s] = (target, inside[0], inside[1], 0, 0)
            else:
                open_[s] = (target, inside[0], fixed, inside[1], bits + step)
    return [found[s] for s in sorted(found)]


def shard_of(k1: Column, k2: Column, splitters: list[tuple[int, int]], low: int = 0) -> Column:
    """The shard of a key: a binary search written as nested conditions."""
    if not splitters:
        return F.lit(low)
    middle = len(splitters) // 2
    a, b = splitters[middle]
    if a >> KEY_BITS:
        after = F.lit(False)
    else:
        after = (k1 > a) if b >> KEY_BITS else (k1 > a) | ((k1 == a) & (k2 >= b))
    return F.when(after, shard_of(k1, k2, splitters[middle + 1 :], low + middle + 1)).otherwise(
        shard_of(k1, k2, splitters[:middle], low)
    )


def _tell_apart(keyed: DataFrame, repeated: DataFrame, k1: str, k2: str, folder: str) -> DataFrame:
    """``keyed`` with other second keys for rows that share both keys, as many as there are rows."""
    names = [prefixed(keyed, [], "of1"), prefixed(keyed, [], "of2")]
    repeated = repeated.select(F.col("k1").alias(names[0]), F.col("k2").alias(names[1]))
    same = (F.col(k1) == F.col(names[0])) & (F.col(k2) == F.col(names[1]))
    number = F.monotonically_increasing_id()
    several = keyed.join(repeated, same, "left_semi").withColumn(k2, F.shiftrightunsigned(F.xxhash64(F.col(k2), number), 1))
    # Numbers are used only as they were written.
    return keyed.join(repeated, same, "left_anti").unionByName(staged(several, folder, "repeated_rows"))


def shard_documents(
    docs: DataFrame, shards: int, id_column: str = "doc_id", text_column: str = "text", tolerance: float = TOLERANCE
) -> DataFrame:
    """``docs`` with shard (from 0), slot (gapless from 0 in each shard) and size; shards have nearly equal bytes."""
    spark = docs.sparkSession
    wanted = ("shard", "slot", "size", "k1", "k2", "part", "base", "base_shard", "base_part")
    names = {n: prefixed(docs, [], n) for n in wanted}
    folder = shared_folder(spark)
    k1, k2 = row_keys(docs[id_column], docs[text_column])
    keyed = docs.withColumns({names["k1"]: k1, names["k2"]: k2, names["size"]: row_size(docs[text_column])})

    def keys_of(rows: DataFrame, name: str) -> DataFrame:
        return staged(rows.select(*(F.col(names[n]).alias(n) for n in ("k1", "k2", "size"))), folder, name)

    narrow = keys_of(keyed, "keys")
    repeated = narrow.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1")
    if repeated.head(1):
        keyed = _tell_apart(keyed, staged(repeated, folder, "repeated"), names["k1"], names["k2"], folder)
        narrow = keys_of(keyed, "numbered_keys")
    splitters = find_splitters(narrow, shards, tolerance)
    # Slots: rows are numbered in parts of a shard, and a part begins where the parts before it end.
    bits = max(6, math.ceil(math.log2(max(1, narrow.count() / shards / SLOT_ROWS))))

    def place(df: DataFrame, a: Column, b: Column) -> DataFrame:
        # Parts come from the second key: neither a text nor an id with many rows makes a large part.
        part = F.shiftright(b, KEY_BITS - bits)
        return df.withColumns({names["shard"]: shard_of(a, b, splitters), names["part"]: part})

    counted = place(narrow, F.col("k1"), F.col("k2")).groupBy(names["shard"], names["part"]).agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy(names["shard"]).orderBy(names["part"]).rowsBetween(Window.unboundedPreceding, -1))
    bases = counted.select(
        F.col(names["shard"]).alias(names["base_shard"]), F.col(names["part"]).alias(names["base_part"]),
        F.coalesce(before, F.lit(0)).alias(names["base"]),
    )
    keyed = place(keyed, F.col(names["k1"]), F.col(names["k2"]))
    within = Window.partitionBy(names["shard"], names["part"]).orderBy(names["k1"], names["k2"])
    numbered = keyed.withColumn(names["slot"], F.row_number().over(within) - 1)
    joined = numbered.join(
        bases, (F.col(names["shard"]) == F.col(names["base_shard"])) & (F.col(names["part"]) == F.col(names["base_part"]))
    )
    return joined.select(
        *(F.col(f"`{c}`") for c in docs.columns), names["shard"],
        (F.col(names["base"]) + F.col(names["slot"])).cast("long").alias(names["slot"]), names["size"],
    )


# ---------------------------------------------------------------- the query


def op5_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = shard_documents(docs, 16)
    return placed.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
