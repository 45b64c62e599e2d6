"""Tables, written intermediate results and a row key, as all operators of this package use them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own_folder: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that the cluster shares (``spark.checkpoint.dir``).

    Where that is unset, as in tests, a temporary folder serves on a local master only.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_folder:
            _own_folder[app] = tempfile.mkdtemp(prefix="ledgerlight-llm-")
        named = _own_folder[app]
    return f"{named.rstrip('/')}/llm/{uuid.uuid4().hex}"


@contextmanager
def _dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when each has ended; their results are in written tables."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def staged(df: DataFrame, folder: str, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written to ``folder`` and read back: a lost executor costs its own tasks, and no plan is run twice."""
    spark, path = df.sparkSession, f"{folder}/{name}"
    with _dropping_shuffles(spark):
        df.write.option("compression", codec).mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, folder: str, name: str = "") -> None:
    """Delete a staged table that no later step reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}".rstrip("/"))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_key(text: Column) -> Column:
    """A 64-bit hash that tells rows of one document id apart; rows equal in both are treated alike."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def row_key(df: DataFrame) -> Column:
    """A 64-bit hash of doc_id and text: rows equal in both are the same document."""
    return F.xxhash64(df["doc_id"].isNull(), df["doc_id"], F.coalesce(df["text"], F.lit("")))


def rank(df: DataFrame) -> Column:
    """Orders rows by doc_id, null last, then by the hash of the text; ends with the row's key."""
    return F.struct(df["doc_id"].isNull().alias("none"), df["doc_id"].alias("doc_id"), text_key(df["text"]).alias("text"), row_key(df).alias("key"))


def keep_first(df: DataFrame, grouped: DataFrame) -> DataFrame:
    """``df`` with one row of each component; ``grouped`` (component, first) holds the ranks of all rows."""
    of_first = prefixed(df, [], "first_key")
    name = prefixed(df, [of_first], "key")
    first = grouped.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.key").alias(of_first))
    kept = df.withColumn(name, row_key(df))
    return kept.join(first, F.col(name) == F.col(of_first), "left_semi").dropDuplicates([name]).drop(name)


def prefixed(df: DataFrame, taken: set[str] | list[str], wanted: str) -> str:
    """``wanted``, with underscores before it until no column of ``df`` or ``taken`` has the name."""
    have = {c.lower() for c in [*df.columns, *taken]}
    while wanted.lower() in have:
        wanted = f"_{wanted}"
    return wanted
