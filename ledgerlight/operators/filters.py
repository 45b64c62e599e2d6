"""Row filters shared by the indicators. All of them reach the scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import local_day
from ..functions.periods import Day, as_day, month_key
from ..schemas import MANAGER, MONTH_PARTITION


def in_period(df: DataFrame, column: str, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """Dates between both ends, ends included; a missing end is open.

    When the table is partitioned by month, the month range is filtered too, so
    that only the partitions of the period are listed and read.
    """
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(as_day(start)))
        if MONTH_PARTITION in df.columns:
            df = df.filter(F.col(MONTH_PARTITION) >= month_key(start))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(as_day(end)))
        if MONTH_PARTITION in df.columns:
            df = df.filter(F.col(MONTH_PARTITION) <= month_key(end))
    return df


def for_seller(df: DataFrame, seller: str | None, column: str = "cod_vendedor") -> DataFrame:
    return df if seller is None else df.filter(F.col(column) == seller)


def for_company(df: DataFrame, company: str | None) -> DataFrame:
    """Rows of one company; all rows for ``None``. Codes of different companies are never taken for one another."""
    return df if company is None else df.filter(F.col("empresa") == company)


def shared_key(code: str, *tables: DataFrame) -> list[str]:
    """What names a ``code`` in tables that are joined: codes are given out by company, where all of them tell it."""
    return ["empresa", code] if all("empresa" in t.columns for t in tables) else [code]


def customer_key(*tables: DataFrame) -> list[str]:
    return shared_key("cod_cliente", *tables)


def own_code(rows: DataFrame, column: str, company: str | None = None) -> Column:
    """A code or number as what is counted: together with its company, where rows of several may be among each other."""
    if company is not None or "empresa" not in rows.columns:
        return F.col(column)
    return F.when(F.col(column).isNotNull(), F.struct("empresa", column))


def for_listed(df: DataFrame, column: str, listed: list[str] | DataFrame) -> DataFrame:
    """Membership in a short list, or in the same-named column of another table."""
    if isinstance(listed, DataFrame):
        return df.join(listed.select(column), column, "left_semi")
    return df.filter(F.col(column).isin(listed))


def local_period(df: DataFrame, ts_column: str, start: Day | None, end: Day | None) -> DataFrame:
    """Instants whose local calendar day lies in the period.

    The exact test is on the local day. A plain range on the stored instant, one
    day wider at both ends, goes with it because that one can reach the scan.
    """
    stored = F.col(ts_column)
    if start is not None:
        first = F.lit(as_day(start))
        df = df.filter(stored >= F.date_sub(first, 1).cast("timestamp")).filter(local_day(ts_column) >= first)
    if end is not None:
        last = F.lit(as_day(end))
        df = df.filter(stored < F.date_add(last, 2).cast("timestamp")).filter(local_day(ts_column) <= last)
    return df


@dataclass(frozen=True)
class OrderScope:
    """Which order items count. Customers and rep codes are site settings."""

    # --- fixed values: internal reps, sample and gift item codes, cancelled ---
    excluded_sellers: tuple[str, ...] = ("REMESSA POLP", "TRANSFERENCI", "LOGISTICA")
    excluded_item_prefixes: tuple[str, ...] = ("60.", "09.", "A")
    cancelled_state: int | None = 6
    excluded_customers: tuple[str, ...] = ()
    # Order numbers start with the rep code: low end included, high end not.
    rep_range: tuple[int, int] | None = None


def code_in_range(code: Column, low: int, high: int) -> Column:
    """Numeric range on a text code such as ``6003.207033``; other text fails it."""
    number = code.try_cast("decimal(38,10)")
    return (number >= low) & (number < high)


def order_scope_filter(order_items: DataFrame, scope: OrderScope = OrderScope()) -> DataFrame:
    df = order_items
    if scope.excluded_sellers:
        df = df.filter(~F.col("representante").isin(list(scope.excluded_sellers)))
    for customer in scope.excluded_customers:
        df = df.filter(F.col("nome_abrev") != customer)
    for prefix in scope.excluded_item_prefixes:
        df = df.filter(~F.col("it_codigo").startswith(prefix))
    if scope.cancelled_state is not None:
        df = df.filter(F.col("situacao_pedido") != scope.cancelled_state)
    if scope.rep_range:
        df = df.filter(code_in_range(F.col("nr_pedcli"), *scope.rep_range))
    return df


def search_customers(customers: DataFrame, text: str | None) -> DataFrame:
    """Case-insensitive search in name, code and tax id; % and _ are wildcards."""
    wanted = (text or "").strip()
    if not wanted:
        return customers
    pattern = f"%{wanted}%"
    return customers.filter(
        F.col("nome").ilike(pattern) | F.col("cod_cliente").ilike(pattern) | F.col("cnpj").ilike(pattern)
    )


def spans_overlapping(df: DataFrame, start: Day, end: Day, first: str = "data_inicio", last: str = "data_fim") -> DataFrame:
    return df.filter((F.col(last) >= F.lit(as_day(start))) & (F.col(first) <= F.lit(as_day(end))))


def rows_visible_to(df: DataFrame, users: DataFrame, email: str) -> DataFrame:
    """Rows a signed-in user may see: a manager all, anyone else their own.

    The user's seller code and role are read from the user table inside the
    plan; nothing is looked up on the driver.
    """
    me = users.filter(F.col("email") == email)
    my_code = me.agg(F.max("cod_vendedor")).scalar()
    is_manager = me.agg(F.coalesce(F.max(F.col("role") == MANAGER), F.lit(False))).scalar()
    return df.filter(is_manager | (F.col("cod_vendedor") == my_code))
