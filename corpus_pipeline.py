"""From documents to packed training sequences, in five stages.

Each stage works on all rows that the one before kept, and is written as Parquet and read again, so a lost executor never
reaches back into an earlier stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm.common import shared_folder, table
from ledgerlight.llm.decontaminate import drop_contaminated
from ledgerlight.llm.packing import pack_documents
from ledgerlight.llm.simhash import keep_one
from ledgerlight.llm.substrings import remove_duplicates
from ledgerlight.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models score 0.5 or more go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that fingerprints within the operator's bit distance connect, the document with the smallest id stays."""
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words and more that an earlier document holds are cut out; a text without any is left as it is."""
    cut = remove_duplicates(docs)
    kept_text, _, n_removed, _ = (F.col(c) for c in cut.columns[len(docs.columns) :])
    new = {"text": kept_text, "n_chars": F.length(kept_text).cast("long")}
    columns = [F.when(n_removed > 0, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns]
    return cut.select(*columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter item, go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their places in the sequences."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0, by_word=True).drop("text_key")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None
"""SQL has no tokenizer and no language model; tests compare each stage with a plain version."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``."""
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
