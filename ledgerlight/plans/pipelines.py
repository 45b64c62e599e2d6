"""Refresh jobs: what is loaded, in which order, with which load strategy.

Every step writes an event to the run log. The first failing step stops the job;
tables written before it are complete, the failing one is as it was.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..functions.periods import Day, last_days, month_slices
from ..operators import marts
from ..operators.filters import in_period
from ..operators.monitoring import CONTRACTS, contract_checks, quarantine
from ..operators.rollups import campaign_days, merged_campaign_days
from ..sinks import tables
from ..sinks.field_app import sync_field_tables
from ..sinks.rollups import refresh_rollups
from ..sinks.run_log import log_end, log_start
from ..sinks.shuffles import cleaned_shuffles
from ..sinks.slices import slices
from ..sources.database import OPEN_END, WINDOW_DAYS, default_first_year, read_by_key, read_by_year, read_source_table
from ..sources.exports import EXPORTS, FAILURES, HISTORY_START, history_cutoff, read_export, unread_values
from ..sources.landing import FIELD_APP_TABLES, read_field_app

# A source gives an entity, for all time or for a span of days.
Source = Callable[[str, tuple[Day, Day] | None], DataFrame]


@dataclass(frozen=True)
class Lake:
    """Where the tables of one deployment are."""

    root: str

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def stage(self, name: str) -> str:
        return f"{self.root}/stg/{name}"

    def mart(self, name: str) -> str:
        return f"{self.root}/mart/{name}"

    def quarantine(self, name: str) -> str:
        return f"{self.root}/stg/quarantine/{name}"

    def app(self, name: str) -> str:
        return f"{self.root}/app/{name}"

    def scratch(self, name: str) -> str:
        """A folder for one step alone."""
        return f"{self.root}/tmp/{name}-{uuid.uuid4().hex}"

    @property
    def field(self) -> str:
        return f"{self.root}/crm"

    @property
    def log(self) -> str:
        return f"{self.root}/stg/etl_log"


class Step:
    """What a step reports: rows it wrote and a message."""

    def __init__(self) -> None:
        self.rows: int | None = None
        self.message = ""


@contextmanager
def logged(spark: SparkSession, lake: Lake, task: str) -> Iterator[Step]:
    run = log_start(spark, lake.log, task)
    step = Step()
    try:
        with cleaned_shuffles(spark):
            yield step
    except Exception as error:
        log_end(spark, lake.log, run, ok=False, rows=0, message=str(error))
        raise
    log_end(spark, lake.log, run, ok=True, rows=step.rows, message=step.message)


def stored_rows(
    spark: SparkSession,
    path: str,
    company: str | None = None,
    schema: StructType | None = None,
    since: tuple[str, Day] | None = None,
) -> int:
    """Rows a load left in a table, of the months it wrote.

    Facts are read with their schema; an empty one has no files.
    """
    stored = tables.read_table(spark, path, company, schema)
    return (in_period(stored, *since) if since else stored).count()


def load_fact(
    spark: SparkSession,
    lake: Lake,
    entity: str,
    rows: DataFrame,
    company: str,
    cutoff: Day | None = None,
    source: Source | None = None,
) -> None:
    """A raw fact, in full or from ``cutoff`` on.

    A ``source`` that can be asked by key (``by_key``) gives the rows that have left the window for an earlier day.
    """
    date_column = FACT_DATES[entity]
    path = lake.raw(entity)
    with logged(spark, lake, f"extract:{entity}") as step:
        if cutoff is None:
            tables.replace_fact(rows, path, company, date_column)
        else:
            # A source that does not deliver the key's columns cannot tell which of its lines have moved.
            key = FACT_KEYS[entity] if set(FACT_KEYS[entity]) <= set(rows.columns) else ()
            by_key = getattr(source, "by_key", None)
            refetch = (lambda keys: by_key(entity, keys)) if by_key and key else None
            tables.replace_window(rows, path, company, date_column, cutoff, key, refetch)
        step.rows = stored_rows(spark, path, company, rows.schema, (date_column, cutoff) if cutoff else None)


FACT_DATES = {"invoice_lines": "dt_emis_nota", "orders": "dt_venda"}
# Key of a sales row, and the columns of the lines that it is made of.
SALES_OF_LINES = {"nr_nota": "nr_nota_fis", "it_codigo": "it_codigo", "cod_cliente": "cd_emitente", "estabel": "cod_estabel"}
FACT_KEYS = {"invoice_lines": schemas.KEYS["invoice_lines"], "orders": schemas.KEYS["order_lines"]}


# ------------------------------------------------------------------ export path


def load_export(spark: SparkSession, lake: Lake, landing: str, entity: str, since: Day | None) -> None:
    """An export to its raw table, in one pass over the file.

    Texts that could not be converted are null in the row, counted in the same pass, named in the log and kept, with
    their row, in the quarantine table of the entity, which always belongs to the last load.
    """
    export = EXPORTS[entity]
    with logged(spark, lake, f"csv:{entity}") as step:
        rows = read_export(spark, f"{landing}/{export.file}", entity, failures=True)
        skipped, unread = Observation(), Observation()
        if export.date_column:
            rows = history_cutoff(rows, export.date_column, since, skipped)
        lost = F.size(FAILURES)
        rows = rows.observe(unread, F.count(F.when(lost > 0, 1)).alias("rows"), F.coalesce(F.sum(lost), F.lit(0)).alias("values"))
        tables.replace_table(rows, lake.raw(entity))
        step.rows = stored_rows(spark, lake.raw(entity))
        if unread.get["rows"] or tables.table_exists(spark, lake.quarantine(entity)):
            tables.replace_table(unread_values(tables.read_table(spark, lake.raw(entity))), lake.quarantine(entity))
        said = []
        if export.date_column:
            said.append(f"{skipped.get['skipped']} linhas anteriores a {since} ignoradas")
        if unread.get["rows"]:
            said.append(f"{unread.get['values']} valores ilegiveis em {unread.get['rows']} linhas, em quarentena")
        step.message = "; ".join(said)


def _now() -> Column:
    """The time of a load, the same in all its slices."""
    return F.timestamp_micros(F.lit(time.time_ns() // 1000))


def build_export_marts(spark: SparkSession, lake: Lake, company: str) -> None:
    raw = {entity: tables.read_table(spark, lake.raw(entity)) for entity in EXPORTS}
    with logged(spark, lake, "mart:products"):
        products = marts.products_from_export(raw["products"], company)
        tables.store_upsert(spark, products, lake.mart("products"), schemas.KEYS["products"])
    with logged(spark, lake, "mart:customers"):
        customers = marts.customers_from_export(raw["customers"], company)
        tables.store_upsert(
            spark, customers, lake.mart("customers"), schemas.KEYS["customers"], marts.CUSTOMER_EXPORT_COLUMNS
        )
    with logged(spark, lake, "mart:sellers"):
        sellers = marts.sellers_from_export(raw["customers"], company)
        tables.store_upsert(spark, sellers, lake.mart("sellers"), schemas.KEYS["sellers"], ["nome"])
    products = tables.read_table(spark, lake.mart("products"))
    customers = tables.read_table(spark, lake.mart("customers"))
    with logged(spark, lake, "mart:sales") as step:
        lines = raw["invoice_lines"]
        sales = marts.sales_from_export(lines, products, company, _now())
        tables.replace_fact(sales, lake.mart("sales"), company, "data_emissao", slices("nr_nota", lines.count()))
        step.rows = stored_rows(spark, lake.mart("sales"), company, schemas.SALES)
    with logged(spark, lake, "mart:orders") as step:
        items = raw["order_items"]
        orders = marts.orders_from_export(items, customers, products, company, _now())
        tables.replace_fact(orders, lake.mart("orders"), company, "data_pedido", slices("nr_pedido", items.count()))
        step.rows = stored_rows(spark, lake.mart("orders"), company, schemas.ORDERS)
    follow_sales(spark, lake, company)
    check_mart(spark, lake, company, "orders")


def follow_sales(spark: SparkSession, lake: Lake, company: str, cutoff: Day | None = None) -> None:
    """What hangs on the sales mart: its rollups and campaigns, for the months that changed, and its contract."""
    with logged(spark, lake, "mart:sales_rollups") as step:
        months = refresh_rollups(spark, lake.mart("sales"), lake.mart("sales_rollups"), company)
        step.message = f"{len(months)} meses"
    if months:
        rebuild_campaign_days(spark, lake, company, months)
    check_mart(spark, lake, company, "sales", ("data_emissao", cutoff) if cutoff else None)


def rebuild_campaign_days(spark: SparkSession, lake: Lake, company: str, months: set[str] | None = None) -> None:
    """Days of the campaigns, from the first of the changed ``months`` on, or all of them; nothing where no sale is tagged."""
    if not tables.table_exists(spark, lake.app("sale_tags")) or not tables.table_exists(spark, lake.mart("sales")):
        return
    with logged(spark, lake, "mart:campaign_days") as step:
        path = lake.mart("campaign_days")
        named = [month.split("=")[-1] for month in months or ()]
        since = None
        if named and tables.table_exists(spark, path) and all(re.fullmatch(r"\d{4}-\d{2}", m) for m in named):
            since = f"{min(named)}-01"
        sales = tables.read_table(spark, lake.mart("sales"), company, schemas.SALES)
        tags = tables.read_table(spark, lake.app("sale_tags")).filter(F.col("empresa") == company)
        sales = in_period(sales, "data_emissao", since) if since else sales
        rows = max(sales.count(), tags.count())
        parts = slices("nr_nota", rows)
        days = (campaign_days(marts.tag_sales(sales.filter(part), tags.filter(part))) for part in parts)
        with tables.set_aside(days, lake.scratch("campaign_days")) if len(parts) > 1 else nullcontext(next(days)) as of_parts:
            merged = merged_campaign_days(of_parts) if len(parts) > 1 else of_parts
            merged = merged.withColumn("empresa", F.lit(company)).select(
                *(F.col(f.name).cast(f.dataType) for f in schemas.CAMPAIGN_DAYS)
            )
            by_seller = slices("cod_vendedor", rows)
            if since:
                tables.replace_window(merged, path, company, "data_emissao", since, parts=by_seller)
            else:
                tables.replace_fact(merged, path, company, "data_emissao", by_seller)
        step.message = f"desde {since}" if since else "tudo"


def check_mart(spark: SparkSession, lake: Lake, company: str, name: str, since: tuple[str, Day] | None = None) -> None:
    """Contract of a mart (of what was loaded ``since`` a day): broken rules go to the log, rows that break one to quarantine."""
    with logged(spark, lake, f"check:{name}") as step:
        rows = tables.read_table(spark, lake.mart(name), company)
        rows = in_period(rows, *since) if since else rows
        broken = contract_checks(rows, CONTRACTS[name]).filter("violacoes > 0").collect()  # one row for each rule
        step.message = "; ".join(f"{r.regra}: {r.violacoes}" for r in broken)
        if broken or tables.table_exists(spark, lake.quarantine(name)):
            tables.replace_table(quarantine(rows, CONTRACTS[name]), lake.quarantine(name))


def tidy(spark: SparkSession, lake: Lake, company: str) -> None:
    """Old states of all tables go, but for the last two: a reader may still be at the one before."""
    facts = [lake.raw(e) for e in (*FACT_DATES, *DIMENSIONS, "registrations")]
    facts += [lake.mart(n) for n in ("sales", "orders", "sales_rollups", "campaign_days")] + [lake.stage("type_map")]
    for path in facts:
        tables.drop_old_versions(spark, path, company)
    whole = [lake.raw(e) for e in EXPORTS] + [lake.mart(n) for n in ("products", "customers", "sellers")]
    whole += [lake.quarantine(n) for n in (*EXPORTS, "sales", "orders")] + [lake.stage("unmapped_operations")]
    whole += [lake.app(n) for n in ("campaigns", "sale_tags", "registered")] + [lake.quarantine("requests")]
    for path in whole + [f"{lake.field}/{n}" for n in FIELD_APP_TABLES]:
        tables.drop_old_versions(spark, path)


def sync_field(spark: SparkSession, lake: Lake, landing: str | None) -> None:
    if landing is None:
        return
    with logged(spark, lake, "sync:crm"):
        landed = {name: read_field_app(spark, landing, name) for name in FIELD_APP_TABLES}
        sync_field_tables(spark, landed, lake.field)


def refresh_from_exports(
    spark: SparkSession,
    lake: Lake,
    landing: str,
    company: str,
    since: Day | None = HISTORY_START,
    field_landing: str | None = None,
) -> None:
    """Exports to raw, raw to marts, field app to its mirror."""
    for entity in ("products", "customers", "invoice_lines", "order_items"):
        load_export(spark, lake, landing, entity, since)
    build_export_marts(spark, lake, company)
    sync_field(spark, lake, field_landing)
    tidy(spark, lake, company)


# --------------------------------------------------------------------- ERP path

DIMENSIONS = ("operations", "families", "items", "parties", "reps")


def jdbc_source(
    spark: SparkSession,
    options: dict[str, dict[str, str]],
    company: str,
    as_of: Day,
    first_year: int | None = None,
    slices_per_year: int = 12,
    **settings,
) -> Source:
    """Source over JDBC; ``options`` maps each entity to its database's options.

    Whole facts are read from ``first_year`` on (two years before ``as_of`` if not given), in date slices, and what is
    dated after the year of ``as_of`` in one more. Its ``history_start`` tells ``refresh_full`` what to leave.
    """
    first, last = default_first_year(as_of) if first_year is None else first_year, int(str(as_of)[:4])

    def read(entity: str, span: tuple[Day, Day] | None) -> DataFrame:
        if span is None and entity in FACT_DATES:
            scope = settings.get("scope")
            years = read_by_year(spark, options[entity], entity, company, first, last, slices_per_year, scope=scope)
            later = (f"{last + 1}-01-01", OPEN_END)
            return years.unionByName(read_source_table(spark, options[entity], entity, company, later, **settings))
        return read_source_table(spark, options[entity], entity, company, span, **settings)

    def by_key(entity: str, keys: DataFrame) -> DataFrame:
        spans = month_slices(first, last, slices_per_year)
        return read_by_key(spark, options[entity], entity, company, keys, spans, settings.get("scope"))

    read.history_start = f"{first}-01-01"
    read.by_key = by_key
    return read


def load_dimensions(spark: SparkSession, lake: Lake, source: Source, company: str) -> None:
    for entity in DIMENSIONS:
        with logged(spark, lake, f"extract:{entity}") as step:
            tables.replace_company(source(entity, None), lake.raw(entity), company)
            step.rows = stored_rows(spark, lake.raw(entity), company)


def build_dimensions(spark: SparkSession, lake: Lake, company: str) -> None:
    raw = {entity: tables.read_table(spark, lake.raw(entity), company) for entity in DIMENSIONS}
    with logged(spark, lake, "mart:type_map"):
        tables.replace_company(marts.classify_operations(raw["operations"]), lake.stage("type_map"), company)
    built = {
        "products": marts.build_products(raw["items"], raw["families"]),
        "customers": marts.build_customers(raw["parties"]),
        "sellers": marts.build_sellers(raw["reps"]),
    }
    for name, df in built.items():
        with logged(spark, lake, f"mart:{name}"):
            tables.store_upsert(spark, df, lake.mart(name), schemas.KEYS[name])


def seller_map(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rep to seller code; an empty table when the deployment keeps none."""
    path = lake.stage("seller_map")
    if tables.table_exists(spark, path):
        return tables.read_table(spark, path)
    return spark.createDataFrame([], schemas.SELLER_MAP)


def rebuild_sales(spark: SparkSession, lake: Lake, company: str, cutoff: Day | None, whole: bool) -> None:
    """The sales mart from the raw lines since ``cutoff``; codes without a type go to a table and to the log.

    Sales that are no longer in the window are built again from what the raw lines hold for them on any day.
    """
    with logged(spark, lake, "mart:sales") as step:
        lines = tables.read_table(spark, lake.raw("invoice_lines"), company, schemas.INVOICE_LINES)
        kinds = tables.read_table(spark, lake.stage("type_map"), company)
        customers = tables.read_table(spark, lake.mart("customers"))
        products = tables.read_table(spark, lake.mart("products"))
        now = _now()

        def build(of: DataFrame, since: Day | None) -> DataFrame:
            return marts.build_sales(of, kinds, customers, seller_map(spark, lake), products, since, now)

        def again(keys: DataFrame) -> DataFrame:
            wanted = keys.select(*(F.col(ours).alias(raw) for ours, raw in SALES_OF_LINES.items()))
            return build(tables.matching(lines, wanted, wanted.columns, "left_semi"), None)

        sales = build(lines, cutoff)
        path = lake.mart("sales")
        if whole:
            tables.replace_fact(sales, path, company, "data_emissao", slices("nr_nota", lines.count()))
        else:
            tables.replace_window(sales, path, company, "data_emissao", cutoff, schemas.KEYS["sales"], again)
        step.rows = stored_rows(spark, path, company, schemas.SALES, ("data_emissao", cutoff) if cutoff else None)
        unmapped = lake.stage("unmapped_operations")
        tables.replace_table(marts.unmapped_operations(lines, kinds, cutoff, top=None), unmapped)
        step.message = _unmapped_message(tables.read_table(spark, unmapped), unmapped)
    follow_sales(spark, lake, company, None if whole else cutoff)


def _unmapped_message(unmapped: DataFrame, path: str) -> str:
    """All codes without a type are in the table; the message names the most frequent."""
    number = unmapped.count()
    most = unmapped.orderBy(F.desc("qtd"), "nat_operacao").limit(marts.UNMAPPED_TOP).collect()
    codes = ", ".join(str(r.nat_operacao) for r in most)
    return f"{number} codigos sem tipo, contados como venda, todos em {path}: {codes}" if number else ""


def load_registrations(spark: SparkSession, lake: Lake, source: Source, company: str) -> None:
    path = lake.raw("registrations")
    with logged(spark, lake, "extract:registrations") as step:
        tables.replace_company(source("registrations", None), path, company)
        step.rows = stored_rows(spark, path, company)


def refresh_full(
    spark: SparkSession,
    lake: Lake,
    source: Source,
    company: str,
    field_landing: str | None = None,
    cutoff: Day | None = marts.FULL_SINCE,
    since: Day | None = None,
) -> None:
    """The history that the ERP holds.

    Facts dated ``since`` or later are replaced, older ones stay; the source's own ``history_start`` counts if ``since``
    is not given. Without either, the source holds everything and the facts become what it gives.
    """
    since = since or getattr(source, "history_start", None)
    load_dimensions(spark, lake, source, company)
    build_dimensions(spark, lake, company)
    load_fact(spark, lake, "invoice_lines", source("invoice_lines", None), company, since)
    rebuild_sales(spark, lake, company, cutoff, whole=True)
    load_fact(spark, lake, "orders", source("orders", None), company, since)
    load_registrations(spark, lake, source, company)
    sync_field(spark, lake, field_landing)
    tidy(spark, lake, company)


def refresh_window(
    spark: SparkSession,
    lake: Lake,
    source: Source,
    company: str,
    as_of: Day,
    days: int = WINDOW_DAYS,
    field_landing: str | None = None,
) -> None:
    """Dimensions in full, facts of the last days: catches late changes and cancellations."""
    cutoff, _ = last_days(as_of, days)
    span = (cutoff, OPEN_END)
    load_dimensions(spark, lake, source, company)
    build_dimensions(spark, lake, company)
    load_fact(spark, lake, "invoice_lines", source("invoice_lines", span), company, cutoff, source)
    rebuild_sales(spark, lake, company, cutoff, whole=False)
    load_fact(spark, lake, "orders", source("orders", span), company, cutoff, source)
    load_registrations(spark, lake, source, company)
    sync_field(spark, lake, field_landing)
    tidy(spark, lake, company)
