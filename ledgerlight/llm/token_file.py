"""Token ids in files with fixed-width bit packing.

Format: a folder with two Parquet tables. ``blocks`` has a row for each block of whole documents: its part and number, the
ids before it in its part, the bits of an id, the documents' ids and places, and the packed ids. Id k of a block stands at
bits ``k * bits`` and up (lowest bit first), so any range can be unpacked without what stands before it; eight ids fill
``bits`` bytes exactly, which is what the numpy code works on. ``parts`` has the ids before each part. Documents are in
ascending order of doc_id by part, block and place.

Parquet gives task commits (a lost executor leaves no half file), any store that Spark writes, and row groups that a
range of parts, blocks or ids prunes. Texts move once, to their place in the order; what is written is never sorted again.

Cases: a null text is empty; null ids come first; rows with equal ids are ordered by a hash of their text; other columns
are ignored; an empty table gives an empty file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, table, text_key
from .encoding import Encoder, worker_encoder

BLOCK_IDS = 1 << 16
"""A block ends with the document that reaches so many ids."""
GROUP_CHARS = 1 << 18

BLOCK_SCHEMA = "part int, block int, first bigint, n_ids bigint, bits int, doc_ids array<bigint>, places array<bigint>, payload binary"


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    n = len(ids)
    groups = np.zeros((-(-n // 8), 8), dtype=np.uint64)
    groups.ravel()[:n] = ids
    out = np.zeros((len(groups), bits), dtype=np.uint8)
    for j in range(8):
        byte, shift = divmod(j * bits, 8)
        value = groups[:, j] << np.uint64(shift)
        for k in range(-(-(bits + shift) // 8)):
            out[:, byte + k] |= ((value >> np.uint64(8 * k)) & np.uint64(255)).astype(np.uint8)
    return out.tobytes()[: -(-n * bits // 8)]


def unpack(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block, from their bytes only."""
    first = start // 8
    piece = np.frombuffer(payload, dtype=np.uint8)[first * bits : -(-stop // 8) * bits]
    count = -(-stop // 8) - first
    groups = np.zeros((count, bits), dtype=np.uint8)
    groups.ravel()[: len(piece)] = piece
    out = np.empty((count, 8), dtype=np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(8):
        byte, shift = divmod(j * bits, 8)
        value = np.zeros(count, dtype=np.uint64)
        for k in range(-(-(bits + shift) // 8)):
            value |= groups[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, j] = (value >> np.uint64(shift)) & mask
    return out.ravel()[start - first * 8 : stop - first * 8]


def write_token_file(docs: DataFrame, path: str, tokenizer: str, end_id: int, by_word: bool = False) -> None:
    """Encode ``docs`` (doc_id, text), append ``end_id`` to each, and write them to the folder ``path``."""
    vocabulary = Encoder(tokenizer).tokenizer.get_vocab_size(with_added_tokens=True)
    bits = bits_for(max(vocabulary, end_id + 1))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = worker_encoder(tokenizer, by_word), TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4")
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        places = [0]
        block, first = 0, 0

        def finish() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            return pa.record_batch(
                {
                    "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()),
                    "first": pa.array([first], pa.int64()), "n_ids": pa.array([len(ids)], pa.int64()),
                    "bits": pa.array([bits], pa.int32()), "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                    "places": pa.array([places], pa.list_(pa.int64())), "payload": pa.array([pack(ids, bits)], pa.binary()),
                }
            )

        for batch in batches:
            ids_column, texts = batch.column("doc_id"), batch.column("text")
            row = 0
            while row < batch.num_rows:
                group, chars = [], 0
                while row + len(group) < batch.num_rows and (not group or chars < GROUP_CHARS):
                    text = texts[row + len(group)].as_py() or ""
                    group.append(text)
                    chars += len(text)
                for k, ids in enumerate(encoder.encode(group)):
                    doc_ids.append(ids_column[row + k].as_py())
                    parts += [ids, end]
                    places.append(places[-1] + len(ids) + 1)
                    if places[-1] >= BLOCK_IDS:
                        yield finish()
                        block, first = block + 1, first + places[-1]
                        doc_ids, parts, places = [], [], [0]
                row += len(group)
        if doc_ids:
            yield finish()

    keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key"))
    ordered = keyed.repartitionByRange("doc_id", "text_key").sortWithinPartitions("doc_id", "text_key")
    ordered.select("doc_id", "text").mapInArrow(encode, BLOCK_SCHEMA).write.option("compression", "none").mode("overwrite").parquet(f"{path}/blocks")

    spark = docs.sparkSession
    sizes = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    base, rows = 0, []
    for part, n in sizes:  # a row for each part
        rows.append((part, base))
        base += n
    spark.createDataFrame(rows, "part int, base bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/parts")


def blocks_of(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a file with ``base``, the ids before each one's part. Parts are few: a row for each writing task."""
    return spark.read.parquet(f"{path}/blocks").join(F.broadcast(spark.read.parquet(f"{path}/parts")), "part")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids before it), n_tokens, ids_crc32 and ids of every document, read from the file."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                places = np.asarray(batch.column("places")[row].values)
                ids = unpack(batch.column("payload")[row].as_py(), batch.column("bits")[row].as_py(), 0, int(places[-1])).astype("<u4")
                before = batch.column("base")[row].as_py() + batch.column("first")[row].as_py()
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)]
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_ids")[row].values, "start": pa.array(before + places[:-1]),
                        "n_tokens": pa.array(np.diff(places)), "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )

    columns = ["base", "first", "bits", "doc_ids", "places", "payload"]
    return blocks_of(spark, path).select(*columns).mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of the whole file: only the blocks that hold them are read."""
    held = blocks_of(spark, path).where((F.col("base") + F.col("first") < stop) & (F.col("base") + F.col("first") + F.col("n_ids") > start))
    rows = held.select((F.col("base") + F.col("first")).alias("at"), "n_ids", "bits", "payload").orderBy("at").collect()
    pieces = [unpack(bytes(r.payload), r.bits, max(0, start - r.at), min(r.n_ids, stop - r.at)) for r in rows]
    return np.concatenate(pieces) if pieces else np.empty(0, dtype=np.uint32)


# ---------------------------------------------------------------- the query


def op1_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written to a token file, and what is read back from it."""
    import public_tokenizers

    path = f"{shared_folder(spark)}/tokens"
    write_token_file(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1, by_word=True)
    return read_documents(spark, path)
