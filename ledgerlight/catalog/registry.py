"""Query registry: a Spark query, its result columns, and the SQL to check it with."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .oracle_views import compose
from .tables import Tables

# Result types that read the same from Spark and from SQL.
_SPARK_TYPES = {"d": "double", "i": "bigint", "s": "string", "b": "boolean"}
_SQL_TYPES = {"d": "double", "i": "bigint", "s": "varchar", "b": "boolean"}


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    columns: dict[str, str]
    oracle: str | None
    # Views of which the oracle sees some rows only, with the condition.
    only: dict[str, str] | None = None

    def run(self, tables: Tables) -> DataFrame:
        df = self.build(tables)
        return df.select(*(F.col(c).cast(_SPARK_TYPES[t]).alias(c) for c, t in self.columns.items()))

    def sql(self) -> str | None:
        if self.oracle is None:
            return None
        cast = ", ".join(f"cast({c} as {_SQL_TYPES[t]}) as {c}" for c, t in self.columns.items())
        return compose(f"select {cast} from ({self.oracle.strip()}) result", self.only)


QUERIES: dict[str, Query] = {}
_tables: dict[tuple[str, str, str], Tables] = {}


def folder_state(spark: SparkSession, folder: str) -> str:
    """Changes with any file of the folder: names, sizes and times (driver metadata only)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    listed = sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found)
    return hashlib.sha256(repr(listed).encode()).hexdigest()[:12]


def tables_of(spark: SparkSession, folder: str) -> Tables:
    """The tables of a folder; new ones when its files have changed."""
    key = (spark.sparkContext.applicationId, folder.rstrip("/"), folder_state(spark, folder))
    if key not in _tables or _tables[key].spark is not spark:
        _tables[key] = Tables(spark, folder, key[2])
    return _tables[key]


def query(name: str, columns: str, oracle: str | None = None, only: dict[str, str] | None = None):
    """Register a query; ``columns`` is like ``"canal:s qtd:i faturamento:d"``."""
    spec = dict(item.split(":") for item in columns.split())

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(build, spec, oracle, only)
        return build

    return register


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(q: Query):
        return lambda spark, folder: q.run(tables_of(spark, folder))

    return {name: runner(q) for name, q in QUERIES.items()}


def oracle_statements() -> dict[str, str]:
    return {name: sql for name, q in QUERIES.items() if (sql := q.sql())}
