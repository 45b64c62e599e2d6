"""Stored rollups of the sales mart, kept up month by month.

Each month of the rollups remembers which files of the sales mart it was computed from. After a load only the months
whose files are others are computed again, and all rollups switch together with one manifest; so they are always those
of one state of the mart. Numbers (orders, invoices) get their ids when they first come up and keep them.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import rollups as ops
from ..schemas import MONTH_PARTITION
from . import manifest
from .tables import _company_folder, _of_parts

_SOURCE = "source"
_BATCH = "lote"
_IDS = "number_ids"


def refresh_rollups(spark: SparkSession, sales_path: str, path: str, company: str) -> set[str]:
    """Bring the rollups up to the current state of a company's sales; the months that were computed again."""
    folder = _company_folder(sales_path, company)
    state = manifest.current(spark, folder)
    if state is None:
        raise FileNotFoundError(f"no sales under {folder}")

    def rows(months: set[str]) -> DataFrame:
        return manifest.read(spark, folder, state, parts=months)

    return store_rollups(spark, rows, state.parts(), _company_folder(path, company))


def store_rollups(
    spark: SparkSession, rows: Callable[[set[str]], DataFrame], source: dict[str, str], folder: str
) -> set[str]:
    """Compute the months whose ``source`` tag has changed, from the sales that ``rows`` gives for them."""
    load = manifest.Load(spark, folder)
    before = load.before.parts(_SOURCE) if _same_layout(load.before) else {}
    changed = {month for month, tag in source.items() if before.get(month) != tag}
    if before and not changed and before.keys() == source.keys():
        return set()
    kept = source.keys() - changed
    sales = rows(changed)
    parts = {"days": ops.seller_days(sales), "customers": ops.customer_days(sales)}
    numbers = ops.number_days(sales)
    known = manifest.read(spark, folder, load.before, _IDS) if _IDS in load.before.sets else None
    fresh = ops.new_ids(numbers, known, load.after.number)
    # Ids are used only as they were written: another run of the task could give others.
    load.write(fresh, _BATCH, _IDS, in_order=True)
    load.put(fresh.schema, _BATCH, load.before.parts(_IDS), _IDS)
    ids = load.held(fresh.schema, _BATCH, _IDS)
    parts["numbers"] = ops.number_bitmaps(numbers, ids if known is None else known.unionByName(ids))
    for name, df in parts.items():
        monthly = df.withColumn(MONTH_PARTITION, F.date_format("data_emissao", "yyyy-MM"))
        load.write(monthly, MONTH_PARTITION, name, in_order=True)  # as the operators leave the days
        load.put(monthly.schema, MONTH_PARTITION, kept & load.before.parts(name).keys(), name)
    entry = manifest.DataSet("", MONTH_PARTITION, dict(source))
    load.after = replace(load.after, sets={**load.after.sets, _SOURCE: entry})
    load.commit()
    return changed


def _same_layout(state: manifest.Manifest) -> bool:
    """Whether the bitmaps are in words; those of an earlier release are not, and all months are computed again."""
    entry = state.sets.get("numbers")
    return entry is not None and set(ops.WORDS) <= set(T.StructType.fromJson(json.loads(entry.schema)).names)


def read_rollups(spark: SparkSession, path: str, company: str) -> ops.SalesRollups:
    return rollups_in(spark, _company_folder(path, company), company)


def rollups_in(spark: SparkSession, folder: str, company: str) -> ops.SalesRollups:
    """The rollups of one company, all of one state."""
    state = manifest.current(spark, folder)
    if state is None:
        raise FileNotFoundError(f"no rollups under {folder}")
    names = ("days", "customers", "numbers")
    return ops.SalesRollups(*(manifest.read(spark, folder, state, n).withColumn("empresa", F.lit(company)) for n in names))


def monthly_sales(sales: DataFrame) -> Callable[[set[str]], DataFrame]:
    """``rows`` of a sales table that has its month as a column."""
    return lambda months: _of_parts(sales, months)
