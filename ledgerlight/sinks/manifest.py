"""Partitioned tables with one atomic switch.

A load writes whole partitions into a generation of its own and then commits a manifest that names, for each partition,
the generation that holds it. Readers resolve the newest manifest once and read exactly the files it names, so they see
the table before a load or after it, never in between, whatever the load does meanwhile. A load that dies leaves
files that no manifest names; running it again gives the same table.

A table may hold several data sets (rows, an index, counts) that one manifest switches together.

    folder/data/<data set>/g=<generation>/<column>=<value>/part-*.parquet
    folder/manifests/m<number>

Only names reach the driver: partitions, generations, schemas.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = "rows"
# How table files are written: about a quarter smaller than by default.
FILES = {"compression": "zstd"}
# How Spark names the partition of a null value.
NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"
_MANIFEST = re.compile(r"^m(\d{12})$")
_GENERATION = re.compile(r"^g=((\d{12})-[0-9a-f]{8})$")


class ConcurrentLoad(RuntimeError):
    """Another load has committed first."""


@dataclass(frozen=True)
class DataSet:
    """Schema (with the partition column last), and the generation of each partition folder."""

    schema: str
    column: str
    parts: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Manifest:
    number: int = 0
    sets: dict[str, DataSet] = field(default_factory=dict)

    def parts(self, name: str = ROWS) -> dict[str, str]:
        return self.sets[name].parts if name in self.sets else {}


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, on whatever file system it is (driver metadata only)."""
    path, fs = _file_system(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def delete(spark: SparkSession, folder: str) -> None:
    path, fs = _file_system(spark, folder)
    fs.delete(path, True)


def _states(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(m.group(1)) for m in map(_MANIFEST.match, children(spark, f"{folder}/manifests")) if m)


def _generations(spark: SparkSession, folder: str, name: str) -> list[str]:
    return sorted(m.group(1) for m in map(_GENERATION.match, children(spark, f"{folder}/data/{name}")) if m)


def current(spark: SparkSession, folder: str) -> Manifest | None:
    """The newest state of a table, ``None`` before its first load."""
    known = _states(spark, folder)
    return _load(spark, folder, known[-1]) if known else None


def state_count(spark: SparkSession, folder: str) -> int:
    return len(_states(spark, folder))


def _load(spark: SparkSession, folder: str, number: int) -> Manifest:
    path, fs = _file_system(spark, f"{folder}/manifests/m{number:012d}")
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(number, {name: DataSet(**entry) for name, entry in json.loads(text).items()})


def commit(spark: SparkSession, folder: str, manifest: Manifest) -> None:
    """The one switch: a complete file takes the name of the next manifest, unless another load has taken it."""
    text = json.dumps({name: vars(entry) for name, entry in manifest.sets.items()}, sort_keys=True)
    draft, fs = _file_system(spark, f"{folder}/manifests/draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    final, _ = _file_system(spark, f"{folder}/manifests/m{manifest.number:012d}")
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise ConcurrentLoad(f"{folder}: manifest {manifest.number} exists")


class Load:
    """One load of a table: partitions are written first, and all of them appear with ``commit``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.before = current(spark, folder) or Manifest()
        # Generations sort by the manifest they are meant for; the rest of the name is this load's own.
        self.generation = f"{self.before.number + 1:012d}-{uuid.uuid4().hex[:8]}"
        self.after = replace(self.before, number=self.before.number + 1)

    def _path(self, name: str) -> str:
        return f"{self.folder}/data/{name}/g={self.generation}"

    def write(self, df: DataFrame, column: str, name: str = ROWS, in_order: bool = False) -> None:
        """Rows put into this load's generation, behind rows it already holds.

        Rows that lie ``in_order`` of the column over the tasks, as a range shuffle leaves them, are not shuffled again.
        """
        rows = df.select(*_ordered(df.schema, column).names)
        if not in_order:
            # Even files for each partition; one too large for a task is split.
            rows = rows.hint("rebalance", F.col(column))
        rows.write.mode("append").options(**FILES).partitionBy(column).parquet(self._path(name))

    def held(self, schema: T.StructType, column: str, name: str = ROWS) -> DataFrame:
        """What this load has written of a data set so far."""
        return _read(self.spark, self.folder, name, _ordered(schema, column), self.written(name))

    def written(self, name: str = ROWS) -> dict[str, str]:
        return {c: self.generation for c in children(self.spark, self._path(name)) if "=" in c}

    def put(self, schema: T.StructType, column: str, kept: Iterable[str], name: str = ROWS) -> None:
        """The data set becomes the ``kept`` partition folders of the state before and all that this load wrote."""
        old = self.before.parts(name)
        parts = {folder: old[folder] for folder in kept} | self.written(name)
        entry = DataSet(_ordered(schema, column).json(), column, parts)
        self.after = replace(self.after, sets={**self.after.sets, name: entry})

    def commit(self) -> Manifest:
        commit(self.spark, self.folder, self.after)
        return self.after


def _ordered(schema: T.StructType, last: str) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != last] + [schema[last]])


def _read(spark: SparkSession, folder: str, name: str, schema: T.StructType, parts: dict[str, str]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    base = f"{folder}/data/{name}"
    paths = [f"{base}/g={generation}/{part}" for part, generation in sorted(parts.items())]
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def read(
    spark: SparkSession, folder: str, manifest: Manifest, name: str = ROWS, parts: Iterable[str] | None = None
) -> DataFrame:
    """A data set as of a manifest, or some of its partition folders."""
    entry = manifest.sets[name]
    chosen = entry.parts if parts is None else {p: entry.parts[p] for p in parts if p in entry.parts}
    return _read(spark, folder, name, T.StructType.fromJson(json.loads(entry.schema)), chosen)


def part_name(column: str, value: object) -> str:
    """The partition folder of a value that needs no escaping (a month, a day, a number, null)."""
    return f"{column}={NULL_VALUE if value is None else value}"


def drop_unnamed(spark: SparkSession, folder: str, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` manifests, and the files of finished or dead loads that none of these names.

    A load that is under way is not touched: it is meant for a manifest that does not exist yet.
    """
    known = _states(spark, folder)
    if not known:
        return
    kept = [_load(spark, folder, n) for n in known[-keep:]]
    for number in known[:-keep]:
        delete(spark, f"{folder}/manifests/m{number:012d}")
    for name in children(spark, f"{folder}/data"):
        named = {(g, p) for m in kept for p, g in m.parts(name).items()}
        for generation in _generations(spark, folder, name):
            path = f"{folder}/data/{name}/g={generation}"
            if int(generation.split("-")[0]) > known[-1]:
                continue
            if not any(g == generation for g, _ in named):
                delete(spark, path)
                continue
            for part in children(spark, path):
                if "=" in part and (generation, part) not in named:
                    delete(spark, f"{path}/{part}")
