"""Load strategies on plain Parquet.

A table lives under one folder, with one sub-folder per company where the table
has companies. Dimensions: each load writes a new version next to the old one and
readers take the newest version that Spark marked complete (``_SUCCESS``). Facts
are partitioned by month, visits by day; a load writes the partitions it touches
and switches them all at once (``manifest``). Either way a job that dies half-way
leaves the table as it was, and no plan ever overwrites the files it reads.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.periods import Day, as_day, month_key
from ..schemas import MONTH_PARTITION
from . import manifest
from .manifest import children

_VERSION = re.compile(r"^v(\d{8})$")
_COMPANY = re.compile(r"^empresa=(.+)$")
_SAFE_CODE = re.compile(r"^[A-Za-z0-9_-]+$")


def _versions(spark: SparkSession, folder: str, complete: bool) -> list[int]:
    found = [int(m.group(1)) for m in map(_VERSION.match, children(spark, folder)) if m]
    if complete:
        found = [v for v in found if "_SUCCESS" in children(spark, f"{folder}/v{v:08d}")]
    return sorted(found)


def _company_folder(path: str, company: str | None) -> str:
    if company is None:
        return path
    if not _SAFE_CODE.match(company):
        raise ValueError(f"company code {company!r} cannot name a folder")
    return f"{path}/empresa={company}"


def _current(spark: SparkSession, folder: str) -> str | None:
    done = _versions(spark, folder, complete=True)
    return f"{folder}/v{done[-1]:08d}" if done else None


def _has_companies(spark: SparkSession, path: str) -> bool:
    return any(_COMPANY.match(c) for c in children(spark, path))


def table_exists(spark: SparkSession, path: str) -> bool:
    companies = [c for c in children(spark, path) if _COMPANY.match(c)]
    folders = [path, *(f"{path}/{c}" for c in companies)]
    return any(manifest.current(spark, f) or _current(spark, f) for f in folders)


def _state(spark: SparkSession, folder: str, schema: T.StructType | None) -> DataFrame | None:
    """The current rows of one folder; the frame stays with the files of this state."""
    state = manifest.current(spark, folder)
    if state is not None:
        return manifest.read(spark, folder, state)
    version = _current(spark, folder)
    if version is None:
        return None
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(version)


def read_table(
    spark: SparkSession, path: str, company: str | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Current state of a table, of one company or of all.

    Give the ``schema`` of facts: a version without any row has no file to take it
    from. Facts come with the month they are partitioned by.
    """
    if schema is not None:
        stored = [f for f in schema.fields if f.name != "empresa"] if _has_companies(spark, path) else schema.fields
        schema = T.StructType([*stored, T.StructField(MONTH_PARTITION, T.StringType())])
    companies = [m.group(1) for m in map(_COMPANY.match, children(spark, path)) if m]
    if company is not None:
        companies = [c for c in companies if c == company]
    if not companies and company is None:
        frames = [_state(spark, path, schema)]
    else:
        states = ((code, _state(spark, f"{path}/empresa={code}", schema)) for code in sorted(companies))
        frames = [state.withColumn("empresa", F.lit(code)) for code, state in states if state is not None]
    if not frames or frames[0] is None:
        raise FileNotFoundError(f"no complete version under {path}")
    return reduce(DataFrame.unionByName, frames)


def _balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Even output files per partition; a partition too large for one task is split."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def _write_version(slices: Sequence[DataFrame], folder: str, partition_by: Sequence[str]) -> None:
    """A version from its slices, one after the other; the last one marks it complete."""
    spark = slices[0].sparkSession
    known = _versions(spark, folder, complete=False)
    number = (known[-1] + 1) if known else 1
    for place, df in enumerate(slices, 1):
        writer = _balanced(df, partition_by).write.mode("error" if place == 1 else "append").options(**manifest.FILES)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.option(_MARK, place == len(slices)).parquet(f"{folder}/v{number:08d}")


# Spark's setting for the file that marks a finished write.
_MARK = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


@contextmanager
def set_aside(slices: Iterable[DataFrame], folder: str) -> Iterator[DataFrame]:
    """Rows written to a folder, slice by slice, and read from there; the folder goes at the end."""
    spark = None
    try:
        for df in slices:
            spark, schema = df.sparkSession, df.schema
            df.write.mode("append").options(**manifest.FILES).parquet(folder)
        yield spark.read.schema(schema).parquet(folder)
    finally:
        if spark is not None:
            manifest.delete(spark, folder)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """The whole table becomes ``df``."""
    _write_version([df], path, partition_by)


def replace_company(df: DataFrame, path: str, company: str, partition_by: Sequence[str] = ()) -> None:
    """All rows of one company become those in ``df``; other companies stay."""
    rows = df.filter(F.col("empresa") == company).drop("empresa")
    _write_version([rows], _company_folder(path, company), partition_by)


def with_month(df: DataFrame, date_column: str) -> DataFrame:
    """The fact with the month it is partitioned by."""
    return df.withColumn(MONTH_PARTITION, F.date_format(date_column, "yyyy-MM"))


def replace_fact(df: DataFrame, path: str, company: str, date_column: str, parts: Sequence[Column] = ()) -> None:
    """All rows of a company in a fact become those in ``df``, which ``parts`` split into ``slices`` to be written one by one."""
    rows = with_month(df.filter(F.col("empresa") == company).drop("empresa"), date_column)
    load = manifest.Load(df.sparkSession, _company_folder(path, company))
    _write_parts(load, rows, parts)
    load.put(rows.schema, MONTH_PARTITION, kept=())
    load.commit()


def _write_parts(load: manifest.Load, rows: DataFrame, parts: Sequence[Column]) -> None:
    for part in parts or [F.lit(True)]:
        load.write(rows.filter(part), MONTH_PARTITION)


# Gives the rows, on whatever day, that the source has for keys that have left the window.
Refetch = Callable[[DataFrame], DataFrame]


def replace_window(
    df: DataFrame,
    path: str,
    company: str,
    date_column: str,
    cutoff: Day,
    key: Sequence[str] = (),
    refetch: Refetch | None = None,
    parts: Sequence[Column] = (),
) -> None:
    """All rows of a fact dated ``cutoff`` or later become those in ``df``.

    ``df`` is read once (once for each of its ``parts``): its rows are written to where they stay, and compared from there. With a ``key`` (nulls in it
    are equal to each other), a row whose date has moved into the window leaves its old place, and so does one stored
    without a date. With ``refetch`` too, the source is asked by key for what is no longer in the window: what has moved
    to before the cutoff is stored there, what it does not have is gone. Months that none of this touches keep their
    files. The months change in one switch: readers see the table before or after, and a load that dies changes nothing.
    """
    spark = df.sparkSession
    folder = _company_folder(path, company)
    since = as_day(cutoff)
    key = [c for c in key if c != "empresa"]

    def of_company(rows: DataFrame) -> DataFrame:
        return with_month(rows.filter(F.col("empresa") == company).drop("empresa"), date_column)

    load = manifest.Load(spark, folder)
    stored = _stored(spark, folder, load)
    before = F.col(date_column).isNull() | (F.col(date_column) < F.lit(since))
    rows = of_company(df.filter(F.col(date_column) >= F.lit(since)))
    _write_parts(load, rows, parts)
    landed = load.held(rows.schema, MONTH_PARTITION)
    if stored is None:
        load.put(rows.schema, MONTH_PARTITION, kept=())
        load.commit()
        return
    stored = stored.select(*rows.columns)
    gone = landed
    if key and refetch is not None:
        lost = matching(stored.filter(~before).select(*key).distinct(), landed, key, "left_anti")
        back = of_company(refetch(lost.withColumn("empresa", F.lit(company)))).select(*rows.columns)
        # One read of the source for these as well.
        load.write(back.filter(before), MONTH_PARTITION, _REFETCHED)
        held = load.held(rows.schema, MONTH_PARTITION, _REFETCHED)
        gone = landed.select(*key).unionByName(held.select(*key))
    touched = {manifest.part_name(MONTH_PARTITION, month_key(since))}
    earlier = stored.filter(before)
    if key:
        moved = matching(earlier.select(*key, MONTH_PARTITION), gone, key, "left_semi")
        months = [r[0] for r in moved.select(MONTH_PARTITION).distinct().collect()]  # one for each month
        touched |= {manifest.part_name(MONTH_PARTITION, month) for month in months}
        touched |= set(load.written(_REFETCHED)) if refetch is not None else set()
    kept = _of_parts(earlier, touched)
    if key:
        kept = matching(kept, gone, key, "left_anti")
    load.write(kept.select(*rows.columns), MONTH_PARTITION)
    if key and refetch is not None:
        load.write(held, MONTH_PARTITION)
    first = manifest.part_name(MONTH_PARTITION, month_key(since))
    older = _older_parts(spark, folder, load, first)
    load.put(rows.schema, MONTH_PARTITION, kept=older - touched)
    load.commit()


_REFETCHED = "refetched"


def matching(left: DataFrame, right: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on equal keys, null equal to null."""
    names = [f"_key_{n}" for n in range(len(key))]
    other = right.select(*(F.col(c).alias(n) for c, n in zip(key, names)))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(n)) for c, n in zip(key, names)))
    return left.join(other, same, how)


def _of_parts(rows: DataFrame, parts: set[str]) -> DataFrame:
    months = sorted(p.split("=", 1)[1] for p in parts)
    named = F.col(MONTH_PARTITION).isin([m for m in months if m != manifest.NULL_VALUE])
    return rows.filter(named | F.col(MONTH_PARTITION).isNull() if manifest.NULL_VALUE in months else named)


def _stored(spark: SparkSession, folder: str, load: manifest.Load) -> DataFrame | None:
    """The rows a load finds: as of its manifest, or of the version that an earlier release has written."""
    if load.before.sets:
        return manifest.read(spark, folder, load.before)
    version = _current(spark, folder)
    return spark.read.parquet(version) if version else None


def _older_parts(spark: SparkSession, folder: str, load: manifest.Load, first: str) -> set[str]:
    """Partition folders before ``first``, and that of rows without a date. Those of an older release's version are copied."""
    null = manifest.part_name(MONTH_PARTITION, None)
    if not load.before.sets and (version := _current(spark, folder)):
        stored = spark.read.parquet(version)
        months = {manifest.part_name(MONTH_PARTITION, r[0]) for r in stored.select(MONTH_PARTITION).distinct().collect()}
        older = {p for p in months if p < first or p == null} - set(load.written())
        load.write(_of_parts(stored, older), MONTH_PARTITION)
        return set()
    return {p for p in load.before.parts() if p < first or p == null}


# ------------------------------------------------------------- tables by day, with a key index

INDEX, COUNTS = "index", "counts"
INDEX_BUCKETS = 64
_BUCKET = "balde"


def upsert_days(
    df: DataFrame,
    path: str,
    key: Sequence[str],
    date_column: str,
    order_by: str | None = None,
    counted: Sequence[str] = (),
    buckets: int = INDEX_BUCKETS,
) -> None:
    """Upsert into a table partitioned by day, on whatever day a key was before.

    An index in buckets by hash of the key tells the day of every key. Only the buckets of the new rows' keys are read
    and written again, and only the days that rows come to or leave. Among new rows of one key the last by ``order_by``
    counts. ``counted`` keeps, in the same switch, the number of rows by day and these columns (``read_day_counts``): a row
    that moves is taken off its old day.
    """
    spark = df.sparkSession
    load = manifest.Load(spark, path)
    stored = _stored(spark, path, load)
    if stored is not None and date_column not in stored.columns:
        stored = None  # a version of an earlier layout, whose rows the caller brings along
    first = not load.before.sets
    schema = df.schema

    def bucket(frame: DataFrame) -> DataFrame:
        return frame.select(*key, date_column, bucket_of(key, buckets).alias(_BUCKET))

    fresh = latest_per_key(df, key, order_by)
    fresh = fresh.withColumn(_BUCKET, bucket_of(key, buckets))
    load.write(fresh, _BUCKET, _LANDED)
    if stored is not None and not load.written(_LANDED):
        return  # nothing to put in: the table stays as it is
    landed = load.held(fresh.schema, _BUCKET, _LANDED)
    if stored is None:
        load.write(landed.select(*df.columns), date_column)
        load.write(bucket(landed), _BUCKET, INDEX)
        kept_days, kept_buckets = set(), set()
    else:
        index = bucket(stored) if first else manifest.read(
            spark, path, load.before, INDEX, [manifest.part_name(_BUCKET, b) for b in _values(load.written(_LANDED))]
        )
        known = matching(index, landed, key, "left_semi")
        # Days only, so the list is short.
        days = {r[0] for r in landed.select(date_column).unionByName(known.select(date_column)).distinct().collect()}
        touched = {manifest.part_name(date_column, d) for d in days}
        rows = stored if first else manifest.read(spark, path, load.before, parts=touched)
        old = matching(rows, landed, key, "left_anti").select(*df.columns)
        load.write(old.unionByName(landed.select(*df.columns)), date_column)
        unchanged = matching(index, landed, key, "left_anti")
        load.write(unchanged.unionByName(bucket(landed).select(*index.columns)), _BUCKET, INDEX)
        kept_days = set() if first else set(load.before.parts()) - touched
        kept_buckets = set(load.before.parts(INDEX)) - set(load.written(_LANDED))
    load.put(schema, date_column, kept_days)
    load.put(bucket(df).schema, _BUCKET, kept_buckets, INDEX)
    if counted:
        now = load.held(schema, date_column)
        counts = now.groupBy(date_column, *counted).agg(F.count(F.lit(1)).alias("linhas"))
        load.write(counts, date_column, COUNTS)
        load.put(counts.schema, date_column, kept_days, COUNTS)
    load.commit()


_LANDED = "landed"


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _values(parts: dict[str, str]) -> list[str]:
    return [p.split("=", 1)[1] for p in parts]


def read_day_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows by day and the columns that ``upsert_days`` counts by, of every day."""
    state = manifest.current(spark, path)
    if state is None or COUNTS not in state.sets:
        raise FileNotFoundError(f"no counts under {path}")
    return manifest.read(spark, path, state, COUNTS)


def drop_old_versions(spark: SparkSession, path: str, company: str | None = None, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` complete states of a table."""
    folder = _company_folder(path, company)
    done = _versions(spark, folder, complete=True)
    switched = manifest.current(spark, folder) is not None
    # Versions of an earlier release go once the table has as many states as are kept.
    spared = max(keep - manifest.state_count(spark, folder), 0) if switched else keep
    for number in done[: max(len(done) - spared, 0)]:
        manifest.delete(spark, f"{folder}/v{number:08d}")
    manifest.drop_unnamed(spark, folder, keep)


def latest_per_key(df: DataFrame, key: Sequence[str], order_by: str | None = None) -> DataFrame:
    """One row per key: the last by ``order_by``, ties by the greatest values.

    A plain maximum over a struct: it combines on the map side, so a key with
    very many rows is no burden for any one task.
    """
    rest = [c for c in df.columns if c not in key]
    ranked = ([order_by] if order_by and order_by in rest else []) + [c for c in rest if c != order_by]
    if not ranked:
        return df.distinct()
    return df.groupBy(*key).agg(F.max(F.struct(*ranked)).alias("r")).select(
        *(F.col(c) if c in key else F.col(f"r.{c}").alias(c) for c in df.columns)
    )


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str], order_by: str | None = None) -> DataFrame:
    """``target`` with the rows of ``source`` put in or put over, by key."""
    fresh = latest_per_key(source, key, order_by).select(*target.columns)
    return target.join(fresh.select(*key), list(key), "left_anti").select(*target.columns).unionByName(fresh)


def upsert_columns(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    order_by: str | None = None,
) -> DataFrame:
    """Upsert that, for rows already there, refreshes only ``columns``.

    New rows are put in whole.
    """
    fresh = latest_per_key(source, key, order_by)
    new = fresh.select(*key, F.struct(*(F.col(c) for c in target.columns)).alias("novo"))
    old = target.select(*key, F.struct(*(F.col(c) for c in target.columns)).alias("velho"))
    refreshed = set(columns)
    both = old.join(new, list(key), "full")
    picked = [
        F.when(F.col("velho").isNull() | F.col("novo").isNotNull(), F.col(f"novo.{c}")).otherwise(F.col(f"velho.{c}"))
        if c in refreshed
        else F.when(F.col("velho").isNull(), F.col(f"novo.{c}")).otherwise(F.col(f"velho.{c}"))
        for c in target.columns
    ]
    return both.select(*(p.alias(c) for p, c in zip(picked, target.columns)))


def insert_new(target: DataFrame, source: DataFrame, key: Sequence[str], order_by: str | None = None) -> DataFrame:
    """``target`` plus the rows of ``source`` whose key it lacks; what is there stays."""
    rest = [c for c in source.columns if c not in key]
    ranked = ([order_by] if order_by else []) + [c for c in rest if c != order_by]
    first = source.groupBy(*key).agg(F.min(F.struct(*ranked)).alias("r")).select(
        *(F.col(c) if c in key else F.col(f"r.{c}").alias(c) for c in target.columns)
    )
    return target.unionByName(first.join(target.select(*key), list(key), "left_anti").select(*target.columns))


def store_upsert(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    key: Sequence[str],
    columns: Sequence[str] | None = None,
    order_by: str | None = None,
    parts: Sequence[Column] = (),
) -> None:
    """Upsert into a stored table (all attributes, or only ``columns``); ``parts`` split both sides by a column of the key."""
    target = read_table(spark, path) if table_exists(spark, path) else None

    def merged(part: Column) -> DataFrame:
        new = source.filter(part)
        if target is None:
            return latest_per_key(new, key, order_by)
        old = target.filter(part)
        return upsert(old, new, key, order_by) if columns is None else upsert_columns(old, new, key, columns, order_by)

    _write_version([merged(part) for part in parts or [F.lit(True)]], path, ())
