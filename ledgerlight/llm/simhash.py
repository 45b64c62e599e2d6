"""SimHash near-duplicates, found with the generalised pigeonhole principle.

Copies collapse first: all further work is on distinct fingerprints. Their 64 bits are grouped into partitions of
correlated bits, and partition i gets a threshold t_i >= -1 with sum(t_i + 1) = tau + 1, so two fingerprints within tau
bits of each other are within t_i bits in some partition i (a partition with -1 is not searched). Number of partitions
and thresholds come from a dynamic programme on the estimated costs, which use bit counts over all fingerprints. Each
fingerprint probes, in partition i, every value of its bits with t_i of them masked; fingerprints of a bucket are
verified, and the bucket reports a forest that connects its linked members, not all pairs. A bucket above ``BUCKET``
members is divided by the same principle, on bits that its key does not fix, before it is verified; that loses no pair.

Connected components come from the large-star, small-star rounds on these forests, written to the shared folder each round.

Cases: null and empty texts, and texts without words, have fingerprint zero and link like any other; fewer words than a
shingle are one shingle; rows with equal doc_id are one document; rows with null doc_id are one document too, whose
component_id is null unless it reaches another; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from .common import keep_first, rank, shared_folder, staged, table

SHINGLE, SEED, TAU = 4, 42, 4
BITS = 64
BUCKET = 20_000
PROBE_COST, PAIR_COST = 1.0, 0.002
"""Relative cost of one probe row and of one comparison within a bucket."""
NO_ID = (1 << 63) - 1
DIVIDE_BITS, DIVIDE_LEVELS = 12, 3


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, key: str = "doc_id") -> DataFrame:
    """``key`` and fingerprint (64 bits as a long) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            values = np.zeros(batch.num_rows, dtype=np.uint64)
            for k, text in enumerate(batch.column("text")):
                words = (text.as_py() or "").encode().lower().split()  # ASCII letters and ASCII white space only
                if not words:
                    continue
                joined = b" ".join(words)
                ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
                starts = np.concatenate([[0], ends[:-1] + 1])
                n = max(1, len(words) - shingle + 1)
                last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
                votes = np.zeros(BITS, dtype=np.int64)
                for at in range(0, n, 65_536):
                    spans = zip(starts[at : min(n, at + 65_536)].tolist(), last[at : at + 65_536].tolist(), strict=True)
                    hashes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in spans], dtype="<u8")
                    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    votes += bits.sum(axis=0, dtype=np.int64)
                values[k] = np.packbits(2 * votes > n, bitorder="little").view("<u8")[0]
            yield pa.record_batch({key: batch.column(key), "fingerprint": pa.array(values.view(np.int64))})

    kept = docs.select(key, "text")
    return kept.mapInArrow(run, StructType([kept.schema[key]]).add("fingerprint", LongType()))


def _bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bits i and j both set: one row of 64 x 64 counts for each task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS), dtype=np.int64)
        for batch in batches:
            raw = np.asarray(batch.column("fingerprint")).astype("<i8").view(np.uint8).reshape(-1, 8)
            for at in range(0, len(raw), 65_536):  # counts below 2^24 are exact in these floats
                bits = np.unpackbits(raw[at : at + 65_536], axis=1, bitorder="little").astype(np.float32)
                both += (bits.T @ bits).astype(np.int64)
        yield pa.record_batch({"pair": pa.array(np.arange(BITS * BITS)), "both": pa.array(both.ravel())})

    summed = nodes.select("fingerprint").mapInArrow(count, "pair bigint, both bigint").groupBy("pair").agg(F.sum("both"))
    both = np.zeros(BITS * BITS, dtype=np.int64)
    for pair, value in summed.collect():  # 4096 rows
        both[pair] = value
    return nodes.count(), both.reshape(BITS, BITS)


def group_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Partitions of nearly equal width in which correlated bits stand together."""
    p = both / max(n, 1)
    mean = np.diag(p)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    related = np.abs((p - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    free, out = list(range(BITS)), []
    for part in range(parts):
        width = (len(free) + parts - part - 1) // (parts - part)
        chosen = [max(free, key=lambda b: related[b, free].max())]
        while len(chosen) < width:
            left = [b for b in free if b not in chosen]
            chosen.append(max(left, key=lambda b: related[b, chosen].sum()))
        out.append(sorted(chosen))
        free = [b for b in free if b not in chosen]
    return out


def allocate(n: int, both: np.ndarray, tau: int = TAU) -> list[tuple[list[int], int]]:
    """Partitions with their thresholds: the plan of least estimated cost."""
    mean = np.diag(both) / max(n, 1)
    best = (float("inf"), [])
    for parts in range(1, tau + 2):
        groups = group_bits(both, n, parts)
        costs = []
        for bits in groups:
            # Distribution of the distance of two fingerprints in these bits.
            distance = np.ones(1)
            for b in bits:
                differ = 2 * mean[b] * (1 - mean[b])
                distance = np.convolve(distance, [1 - differ, differ])
            width, row = len(bits), [0.0]
            for t in range(min(tau, width) + 1):
                shared = sum(distance[h] * comb(width - h, t - h) for h in range(t + 1))
                # A probe is never free, so few fingerprints do not make a plan of many masks.
                row.append(max(n, 1) * comb(width, t) * PROBE_COST + n * n / 2 * shared * PAIR_COST)
            costs.append(row)
        # Thresholds plus one add up to tau + 1.
        table_ = {0: (0.0, [])}
        for row in costs:
            step: dict[int, tuple[float, list[int]]] = {}
            for used, (cost, chosen) in table_.items():
                for extra, more in enumerate(row[: tau + 2 - used]):
                    if used + extra not in step or cost + more < step[used + extra][0]:
                        step[used + extra] = (cost + more, [*chosen, extra - 1])
            table_ = step
        if tau + 1 in table_ and table_[tau + 1][0] < best[0]:
            best = (table_[tau + 1][0], list(zip(groups, table_[tau + 1][1], strict=True)))
    return best[1]


def _mask(bits: tuple[int, ...] | list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def probes(nodes: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """A row for each bucket of each fingerprint: mask (bits that the bucket fixes), value, fingerprint, node."""
    masks = [_mask(sorted(set(bits) - set(hidden))) for bits, t in plan if t >= 0 for hidden in combinations(bits, t)]
    listed = nodes.withColumn("mask", F.explode(F.array(*(F.lit(m).cast("long") for m in masks))))
    return listed.select("mask", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("value"), "fingerprint", "node")


def _divide(rows: DataFrame, folder: str, tau: int) -> DataFrame:
    """``rows`` with buckets above ``BUCKET`` members divided by bits that their keys leave open."""
    for level in range(DIVIDE_LEVELS):
        large = staged(rows.groupBy("mask", "value").count().where(F.col("count") > BUCKET).drop("count"), folder, f"large{level}")
        keys = large.select("mask").distinct().collect()  # masks, of which there are as many as probes of a fingerprint
        finer = []
        for (mask,) in keys:
            open_ = [b for b in range(BITS) if not mask >> b & 1]
            if len(open_) >= (tau + 1) * 2:
                cut = [open_[k :: tau + 1][:DIVIDE_BITS] for k in range(tau + 1)]
                finer.append((mask, [_mask(bits) | mask for bits in cut]))
        if not finer:
            break
        # Bits not in any cut only let more pairs meet: with tau + 1 cuts one of them is free of differences.
        options = F.array(*(F.struct(F.lit(m).cast("long").alias("of"), F.array(*(F.lit(x).cast("long") for x in cuts)).alias("cuts")) for m, cuts in finer))
        large = large.select(F.col("mask").alias("large_mask"), F.col("value").alias("large_value")).where(F.col("large_mask").isin([m for m, _ in finer]))
        is_large = (F.col("mask") == F.col("large_mask")) & (F.col("value") == F.col("large_value"))
        divided = rows.join(large, is_large).select(
            F.explode(F.filter(options, lambda o: o["of"] == F.col("mask"))[0]["cuts"]).alias("mask"), "fingerprint", "node"
        )
        divided = divided.select("mask", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("value"), "fingerprint", "node")
        rows = staged(rows.join(large, is_large, "left_anti").unionByName(divided), folder, f"rows{level}")
    return rows


def _forest(prints: np.ndarray, tau: int) -> tuple[list[int], list[int]]:
    """Edges that connect what links within ``tau`` bits connect, one fewer than members at most."""
    n, left, right = len(prints), [], []
    label = np.arange(n)
    for i in range(n - 1):
        near = np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= tau) + i + 1
        if len(near):
            other, first = np.unique(label[near], return_index=True)
            fresh = other != label[i]
            if fresh.any():
                for j in near[first[fresh]].tolist():
                    left.append(i)
                    right.append(j)
                label[np.isin(label, other[fresh])] = label[i]
    return left, right


def links(rows: DataFrame, tau: int = TAU) -> DataFrame:
    """Verified links (u, v: nodes) of all buckets; they connect all fingerprints within ``tau`` bits."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def finish(bucket: np.ndarray, out: list[np.ndarray]) -> None:
            if len(bucket) > 1:
                left, right = _forest(bucket[:, 2].view(np.uint64), tau)
                if left:
                    out.append(bucket[:, 3][np.array([left, right])])

        def pack(out: list[np.ndarray]) -> pa.RecordBatch:
            pairs = np.concatenate(out, axis=1)
            return pa.record_batch({"u": pa.array(pairs[0]), "v": pa.array(pairs[1])})

        for batch in batches:
            block = np.stack([np.asarray(batch.column(c)) for c in ("mask", "value", "fingerprint", "node")], axis=1)
            block = np.concatenate([*held, block]) if held else block
            cuts = np.flatnonzero(np.any(np.diff(block[:, :2], axis=0) != 0, axis=1)) + 1
            out: list[np.ndarray] = []
            for bucket in np.split(block, cuts)[:-1]:
                finish(np.ascontiguousarray(bucket), out)
            held = [block[cuts[-1] :] if len(cuts) else block]
            if out:
                yield pack(out)
        if held:
            out = []
            finish(np.ascontiguousarray(held[0]), out)
            if out:
                yield pack(out)

    dealt = rows.repartition("mask", "value").sortWithinPartitions("mask", "value", "fingerprint")
    return dealt.mapInArrow(verify, "u bigint, v bigint")


def components(edges: DataFrame, folder: str) -> DataFrame:
    """node, root (the smallest node reachable) of every node with an edge (u, v).

    Large-star and small-star by turns until nothing changes; each half round is two groupings with partial minima and
    a join, so a node with very many edges is no hot spot.
    """

    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")).withColumnRenamed("a", "of")

    edges = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), folder, "edges0")
    before, turn = None, 0
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or state[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, turn = state, turn + 1
        both = edges.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(edges.select(F.col("v").alias("a"), F.col("u").alias("b")))
        large = both.join(least(both), F.col("a") == F.col("of")).where("b > a").select(F.col("b").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), folder, f"large_star{turn}")
        down = large.select(F.col("u").alias("a"), F.col("v").alias("b"))
        smallest = least(down)
        small = down.join(smallest, F.col("a") == F.col("of")).select(F.col("b").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(smallest.select(F.col("of").alias("u"), F.col("m").alias("v")))
        edges = staged(small.where("u <> v").distinct(), folder, f"edges{turn}")


def _linked(nodes: DataFrame, folder: str, tau: int) -> DataFrame:
    """Links (u, v) of ``nodes`` (fingerprint, node)."""
    n, both = _bit_statistics(nodes)
    if n < 2:  # nothing to link, and no statistics to plan by
        return nodes.select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0)
    return links(_divide(probes(nodes, allocate(n, both, tau)), folder, tau), tau)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, tau: int = TAU) -> DataFrame:
    """doc_id, fingerprint (long), component_id of every row of ``docs`` (doc_id, text)."""
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession)
    prints = staged(fingerprints(docs, shingle), folder, "fingerprints")
    identity = F.coalesce("doc_id", F.lit(NO_ID))
    nodes = staged(prints.groupBy("fingerprint").agg(F.min(identity).alias("node")), folder, "nodes")
    found = _linked(nodes, folder, tau)
    # Rows of one doc_id are one document, whatever their fingerprints.
    repeated = prints.select(identity.alias("id"), "fingerprint").distinct().groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    own = prints.select(identity.alias("u"), "fingerprint").join(repeated, F.col("u") == F.col("id"), "left_semi")
    own = own.join(nodes, "fingerprint").select("u", F.col("node").alias("v")).where("u <> v").distinct()
    roots = components(found.unionByName(own), folder)
    labelled = nodes.join(roots, "node", "left").select(F.col("fingerprint").alias("of"), F.coalesce("root", "node").alias("component_id"))
    joined = prints.join(labelled, F.col("fingerprint") == F.col("of"))
    return joined.select("doc_id", "fingerprint", F.nullif("component_id", F.lit(NO_ID)).alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, tau: int = TAU) -> DataFrame:
    """``docs`` with one row of each component of fingerprints: the first by (doc_id with null last, text hash).

    Only texts link here: rows of one doc_id, or of none, are not one document unless their fingerprints say so.
    """
    folder = shared_folder(docs.sparkSession)
    prints = fingerprints(docs.select(rank(docs).alias("first"), "text"), shingle, key="first")
    firsts = staged(prints.groupBy("fingerprint").agg(F.min("first").alias("first")), folder, "firsts")
    roots = components(_linked(firsts.select("fingerprint", F.col("fingerprint").alias("node")), folder, tau), folder)
    grouped = firsts.join(roots, F.col("fingerprint") == F.col("node"), "left")
    return keep_first(docs, grouped.select(F.coalesce("root", "fingerprint").alias("component"), "first"))


# ---------------------------------------------------------------- the query


def op10_pigeonhole_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
