"""Best-fit packing of documents into sequences of fixed length, by a configuration linear programme.

Only the histogram of piece lengths reaches the driver: at most ``capacity`` counts, however many documents there are. On
it, the configuration programme (fewest sequences such that the chosen fillings cover every length class) is solved by
multiplicative weights: a class's weight falls as it is covered, and each round prices the weights with a knapsack dynamic
programme and buys a step of the best filling. The fractional solution is rounded down, its fillings are made of exact
lengths (the last piece fills the sequence exactly), and what remains goes best-fit into what has room. Of a few shares
of the solution that may be kept, the one with the fewest sequences counts. The plan has a row for each place in a
filling; its size depends on the number of lengths, not on the documents.

Pieces then find their places without meeting each other: a piece's rank among those of its length is its part's base
plus its place in the part, and the plan maps length and rank to sequence and offset.

Cases: null and empty texts are one piece of the end id alone; longer documents are cut into full pieces, the last may be
shorter; repeated rows are packed each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_folder, staged, table, text_key
from .encoding import worker_encoder

CAPACITY = 2048
CLASSES = 256
"""Length classes of the linear programme."""
STEP, ROUNDS = 0.2, 8
"""Part of its tightest open class's need that a bought filling covers, and rounds for each class: the accuracy."""
KEPT = (1.0, 0.9, 0.75, 0.5, 0.25)
"""Shares of the fractional solution that are tried when it is rounded."""
GROUP_CHARS = 1 << 18
PART_ROWS = 4096
PIECE_SCHEMA = "doc_id bigint, text_key bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, by_word: bool = False) -> DataFrame:
    """The pieces of every document (doc_id, text): its ids and ``end_id``, cut every ``capacity`` ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = worker_encoder(tokenizer, by_word), np.array([end_id], dtype="<u4")
        for batch in batches:
            row = 0
            while row < batch.num_rows:
                group, chars = [], 0
                while row + len(group) < batch.num_rows and (not group or chars < GROUP_CHARS):
                    text = batch.column("text")[row + len(group)].as_py() or ""
                    group.append(text)
                    chars += len(text)
                out: list[tuple] = []
                for k, ids in enumerate(encoder.encode(group)):
                    ids = np.concatenate([ids, end])
                    doc_id, key = batch.column("doc_id")[row + k].as_py(), batch.column("text_key")[row + k].as_py()
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        out.append((doc_id, key, piece, start, len(part), zlib.crc32(part.tobytes())))
                row += len(group)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = ["doc_id", "text_key", "piece", "start", "length", "ids_crc32"]
                yield pa.record_batch({n: pa.array(v, t) for n, v, t in zip(names, zip(*out, strict=True), kinds, strict=True)})

    return docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key")).mapInArrow(cut, PIECE_SCHEMA)


# ---------------------------------------------------------------- the plan (driver, on the histogram)


def _price(weights: np.ndarray, sizes: np.ndarray, limits: np.ndarray, room: int) -> list[int]:
    """Classes of the filling with most weight: an unbounded knapsack, with repeats above ``limits`` left out."""
    best, choice = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(int(sizes[0]), room + 1):
        upto = int(np.searchsorted(sizes, c, side="right"))
        value = best[c - sizes[:upto]] + weights[:upto]
        k = int(np.argmax(value))
        best[c], choice[c] = value[k], k
        if best[c - 1] > best[c]:
            best[c], choice[c] = best[c - 1], -1
    filling, c, used = [], room, {}
    while c > 0:
        k = int(choice[c])
        if k < 0:
            c -= 1
            continue
        if used.get(k, 0) < limits[k]:
            filling.append(k)
            used[k] = used.get(k, 0) + 1
        c -= int(sizes[k])
    return filling


def solve_configurations(sizes: np.ndarray, counts: np.ndarray, room: int, step: float = STEP) -> list[tuple[list[int], float]]:
    """Fillings (classes, ascending ``sizes``) and how often each is used, fractional."""
    need, covered = counts.astype(float), np.zeros(len(sizes))
    used: dict[tuple[int, ...], float] = {}
    limits = np.ceil(need).astype(int)
    rounds = 0
    while covered.min() < 1 and rounds < ROUNDS * len(sizes):
        rounds += 1
        # Weight of one piece of a class: its part of the need, less as the class is covered; length breaks ties.
        lag = np.exp(np.clip((covered.min() - covered) / step, -60, 0))
        filling = _price((lag + 1e-6) * sizes / room, sizes, limits, room)
        kinds, times = np.unique(filling, return_counts=True)
        open_ = covered[kinds] < 1
        amount = step * float((need[kinds] / times)[open_ if open_.any() else slice(None)].min())
        covered[kinds] += amount * times / need[kinds]
        key = tuple(sorted(filling, reverse=True))
        used[key] = used.get(key, 0.0) + amount
    scale = 1 / max(covered.min(), 1.0)  # what the rounds left uncovered goes best-fit
    return [(list(k), v * scale) for k, v in used.items()]


@dataclass
class Plan:
    """Fillings by exact lengths: sequences ``first`` to ``first + copies - 1`` hold these lengths in this order."""

    fillings: list[tuple[list[int], int]]

    @property
    def sequences(self) -> int:
        return sum(copies for _, copies in self.fillings)

    def places(self) -> np.ndarray:
        """Rows (length, first rank, first sequence, copies, offset), by length and rank."""
        rank: dict[int, int] = {}
        rows, sequence = [], 0
        for lengths, copies in self.fillings:
            offset = 0
            for length in lengths:
                at = rank.get(length, 0)
                rows.append((length, at, sequence, copies, offset))
                rank[length] = at + copies
                offset += length
            sequence += copies
        out = np.array(rows, dtype=np.int64).reshape(-1, 5)
        return out[np.lexsort((out[:, 1], out[:, 0]))]


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Fillings for all pieces of ``histogram`` (length to count)."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in histogram.items():
        left[length] = count
    full: list[tuple[list[int], int]] = []
    if left[capacity]:
        full.append(([capacity], int(left[capacity])))
        left[capacity] = 0
    width = -(-capacity // CLASSES)
    of_class = np.arange(capacity + 1) // width  # nearest below: true lengths are fitted when fillings are made
    counts = np.bincount(of_class, weights=left, minlength=capacity // width + 1)
    counts[1] += counts[0]
    counts[0] = 0
    classes = np.flatnonzero(counts)
    if not len(classes):
        return Plan(full)
    solution = solve_configurations(classes, counts[classes], capacity // width)
    solution = [([int(classes[k]) for k in filling], amount) for filling, amount in sorted(solution, key=lambda x: -x[1])]
    return Plan(full + min((_round(solution, left.copy(), width, capacity, kept) for kept in KEPT), key=lambda f: sum(c for _, c in f)))


def _round(solution: list[tuple[list[int], float]], left: np.ndarray, width: int, capacity: int, kept: float) -> list[tuple[list[int], int]]:
    """Whole fillings from ``kept`` of the fractional solution, and best-fit for what they leave."""
    fillings = []
    for wanted, amount in solution:
        copies = math.floor(amount * kept)
        while copies > 0:
            lengths, much = _exact(wanted, left, width, capacity)
            if not lengths:
                break
            times = np.bincount(lengths, minlength=capacity + 1)
            much = int(min(copies, (left[lengths] // times[lengths]).min()))
            if much < 1:
                break
            left -= times * much
            fillings.append((lengths, much))
            copies -= much
    return fillings + _best_fit(left, capacity)


def _exact(wanted: list[int], left: np.ndarray, width: int, capacity: int) -> tuple[list[int], int]:
    """Lengths of the wanted classes that are still there; the last fills the sequence exactly, or there is no filling."""
    lengths: list[int] = []
    room = capacity
    taken: dict[int, int] = {}

    def free(length: int) -> bool:
        return left[length] > taken.get(length, 0)

    for k, of in enumerate(wanted):
        if k + 1 == len(wanted):
            break
        here = [x for x in range(max(1, of * width), min((of + 1) * width, capacity + 1, room + 1)) if free(x)]
        if not here:
            return [], 0
        length = max(here, key=lambda x: left[x])
        lengths.append(length)
        taken[length] = taken.get(length, 0) + 1
        room -= length
    if room < 1 or not free(room):
        return [], 0
    return [*lengths, room], 1


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """What is left, longest first, each into the fullest sequence that has room; equal sequences are kept as one."""
    open_: dict[int, list[tuple[list[int], int]]] = {}
    for length in range(capacity, 0, -1):
        count = int(left[length])
        for room in sorted(r for r in open_ if r >= length):
            waiting = open_.pop(room, [])
            while waiting and count:
                lengths, copies = waiting.pop()
                each = min(room // length, count)
                many = min(copies, count // each)
                if many < copies:
                    waiting.append((lengths, copies - many))
                open_.setdefault(room - each * length, []).append((lengths + [length] * each, many))
                count -= each * many
            if waiting:
                open_.setdefault(room, []).extend(waiting)
            if not count:
                break
        each = capacity // length
        if count >= each:
            open_.setdefault(capacity - each * length, []).append(([length] * each, count // each))
        if count % each:
            open_.setdefault(capacity - (count % each) * length, []).append(([length] * (count % each), 1))
    return [filling for _, waiting in sorted(open_.items()) for filling in waiting]


# ---------------------------------------------------------------- placing


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a written table with doc_id, text_key, piece, length) with sequence_id and offset."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    plan = make_plan(histogram, capacity)
    total = sum(histogram.values())
    sent = pieces.sparkSession.sparkContext.broadcast(plan.places())

    # A frequent length is numbered in parts, so that no task gets all of its pieces.
    parts = max(8, math.ceil(total / PART_ROWS))
    part = F.pmod(F.xxhash64("doc_id", "text_key", "piece"), F.lit(parts))
    dealt = pieces.withColumn("part", part)
    counted = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = counted.select(F.col("length").alias("of_length"), F.col("part").alias("of_part"), F.coalesce(before, F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "text_key", "piece")
    numbered = dealt.withColumn("number", F.row_number().over(within) - 1)
    ranked = numbered.join(bases, (F.col("length") == F.col("of_length")) & (F.col("part") == F.col("of_part")))
    ranked = ranked.withColumn("rank", F.col("base") + F.col("number")).select(*pieces.columns, "rank")

    columns = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sent.value
        # Rows are ascending in (length, first rank); a rank is below 2^40.
        keys = rows[:, 0] * (1 << 40) + rows[:, 1]
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)).astype(np.int64) for c in ("length", "rank"))
            at = np.searchsorted(keys, length * (1 << 40) + rank, side="right") - 1
            sequence, offset = rows[at, 2] + rank - rows[at, 1], rows[at, 4]
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes) + ", sequence_id bigint, offset bigint"
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, by_word: bool = False) -> DataFrame:
    """doc_id, text_key, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs``."""
    pieces = staged(cut_pieces(docs, tokenizer, end_id, capacity, by_word), shared_folder(docs.sparkSession), "pieces")
    return pack_pieces(pieces, capacity)


# ---------------------------------------------------------------- the query


def op6_configuration_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    packed = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0, by_word=True)
    return packed.drop("text_key")
