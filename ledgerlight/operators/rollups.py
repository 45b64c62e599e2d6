"""Rollups of the sales mart, and the indicators that come from them.

- days: one row per day and seller, with sums;
- customers: one row per day, customer and seller, with sums and numbers of sale lines;
- numbers: the different order and invoice numbers of each day and seller as bitmaps over dense ids. A bitmap is four words
  of 64 bits, so the bitmaps of many days and sellers with few numbers each take no more room than the numbers.

Sums add up over any span; bitmaps of any days and sellers merge by OR and count exactly, however often a number comes up in
several of them. So no indicator goes back to the lines, and none needs its rows copied for each distinct count.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import count_where, is_buying_line, is_sale, moved_boxes, signed_value
from ..functions.periods import Day, as_day, previous_span
from ..schemas import BONUS, RETURN
from .filters import for_company, for_seller, in_period, shared_key
from .portfolio import with_recency
from .sales import channel_shares, portfolio_of, with_seller_name

# --- fixed values: columns whose different values of sale lines are counted ---
COUNTED_NUMBERS = ("nr_pedido", "nr_nota")
# --- fixed values: the words of a bitmap, each a bigint, and the ids that a bitmap holds (2**8) ---
WORDS = tuple(f"bits_{n}" for n in range(4))
BITMAP_SHIFT = 8


def _company(df: DataFrame) -> list[str]:
    return ["empresa"] if "empresa" in df.columns else []


def seller_days(sales: DataFrame) -> DataFrame:
    """The days lie in order over the tasks: one shuffle groups the lines and lets months be written from there."""
    kind = F.col("tipo")
    days = sales.repartitionByRange("data_emissao", "cod_vendedor")
    return days.groupBy(*_company(sales), "data_emissao", "cod_vendedor").agg(
        F.sum(signed_value()).alias("faturamento"),
        F.sum(F.when(kind == RETURN, F.col("valor"))).alias("devolucoes"),
        F.sum(moved_boxes()).alias("caixas"),
        F.sum(F.when(kind == BONUS, F.col("qt_caixas"))).alias("caixas_bonificadas"),
        F.max("carregado_em").alias("carregado_em"),
    )


def customer_days(sales: DataFrame) -> DataFrame:
    """In order of days, as ``seller_days``."""
    days = sales.repartitionByRange("data_emissao", "cod_vendedor", "cod_cliente")
    return days.groupBy(*_company(sales), "cod_cliente", "cod_vendedor", "data_emissao").agg(
        F.sum(signed_value()).alias("faturamento"),
        F.sum(moved_boxes()).alias("caixas"),
        F.sum(F.when(is_sale(), F.col("valor"))).alias("valor_venda"),
        count_where(is_sale()).alias("vendas"),
        count_where(is_buying_line()).alias("compras"),
    )


def number_days(sales: DataFrame) -> DataFrame:
    """The numbers of sale lines with their day and seller; ``coluna`` tells orders from invoices.

    As often as lines hold them: ids and bitmaps come out the same, so no shuffle is spent on making them distinct.
    """
    kinds = F.array(*(F.struct(F.lit(c).alias("coluna"), F.col(c).alias("numero")) for c in COUNTED_NUMBERS))
    numbers = sales.filter(is_sale()).select(*_company(sales), "data_emissao", "cod_vendedor", F.inline(kinds))
    return numbers.filter(F.col("numero").isNotNull())


def new_ids(numbers: DataFrame, known: DataFrame | None, batch: int) -> DataFrame:
    """Ids for the numbers that ``known`` lacks, dense in the order of their first day.

    Numbers of one day get ids close together, so they share bitmaps. To be written once and read from there.
    """
    first = numbers.groupBy("numero", "coluna").agg(F.min("data_emissao").alias("dia"))
    if known is not None:
        first = first.join(known.select("numero", "coluna"), ["numero", "coluna"], "left_anti")
    ordered = first.repartitionByRange("coluna", "dia", "numero").sortWithinPartitions("coluna", "dia", "numero")
    return ordered.select("coluna", "numero", F.monotonically_increasing_id().alias("id"), F.lit(batch).alias("lote"))


def number_bitmaps(numbers: DataFrame, ids: DataFrame) -> DataFrame:
    """One bitmap per day, seller and 256 ids; words without a number are null.

    The days lie in order over the tasks, so that months can be written from there.
    """
    by = [c for c in numbers.columns if c != "numero"]
    # Lines of one number lie together after the join, so nothing moves to make them distinct where it is shuffled.
    coded = numbers.join(ids, ["numero", "coluna"]).select(*by, "numero", "lote", "id").distinct()
    places = coded.select(
        *by, "lote", F.shiftright("id", BITMAP_SHIFT).alias("balde"), F.col("id").bitwiseAND(2**BITMAP_SHIFT - 1).alias("lugar")
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("lugar").bitwiseAND(63).cast("int"))
    words = (F.bit_or(F.when(F.shiftright("lugar", 6) == n, bit)).alias(name) for n, name in enumerate(WORDS))
    days = places.repartitionByRange("data_emissao", "cod_vendedor", "balde")
    return days.groupBy(*by, "lote", "balde").agg(*words)


def distinct_numbers(bitmaps: DataFrame, column: str, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """How many different values of ``column`` the bitmaps hold, exactly; one row without ``by``. Ids belong to a company."""
    bitmaps = bitmaps.filter(F.col("coluna") == column)
    own = [c for c in _company(bitmaps) if c not in by]
    merged = bitmaps.groupBy(*by, *own, "lote", "balde").agg(*(F.bit_or(w).alias(w) for w in WORDS))
    held = reduce(lambda a, b: a + b, (_zero(F.bit_count(w).cast("bigint")) for w in WORDS))
    return merged.groupBy(*by).agg(F.coalesce(F.sum(held), F.lit(0)).alias(name))


@dataclass(frozen=True)
class SalesRollups:
    days: DataFrame
    customers: DataFrame
    numbers: DataFrame


def _slice(df: DataFrame, start: Day | None, end: Day | None, seller: str | None, company: str | None) -> DataFrame:
    return for_seller(for_company(in_period(df, "data_emissao", start, end), company), seller)


def _zero(column: Column | str) -> Column:
    return F.coalesce(column, F.lit(0))


def _buyers(customers: DataFrame) -> Column:
    """Different customers with a sale above 0; those of two companies are two."""
    who = F.struct(*_company(customers), "cod_cliente")
    return F.count_distinct(F.when((F.col("compras") > 0) & F.col("cod_cliente").isNotNull(), who))


def sales_summary(
    rollups: SalesRollups,
    sales: DataFrame,
    start: Day,
    end: Day,
    seller: str | None = None,
    company: str | None = None,
) -> DataFrame:
    """As ``sales.sales_summary``. Only the order lines, whose number is as great as that of lines, come from ``sales``."""
    scope = (start, end, seller, company)
    totals = _slice(rollups.days, *scope).agg(
        _zero(F.sum("faturamento")).alias("faturamento_total"),
        _zero(F.sum("devolucoes")).alias("devolucoes"),
        _zero(F.sum("caixas")).alias("caixas_total"),
        _zero(F.sum("caixas_bonificadas")).alias("caixas_bonificadas"),
    )
    with_order = _slice(sales, *scope).filter(is_sale() & F.col("nr_pedido").isNotNull())
    lines = with_order.agg(F.count_distinct(F.struct(*_company(sales), "nr_pedido", "it_codigo")))
    return totals.select(
        "*",
        distinct_numbers(_slice(rollups.numbers, *scope), "nr_pedido", "n").scalar().alias("pedidos"),
        distinct_numbers(_slice(rollups.numbers, *scope), "nr_nota", "n").scalar().alias("notas"),
        _slice(rollups.customers, *scope).agg(_buyers(rollups.customers)).scalar().alias("clientes_positivados"),
        lines.scalar().alias("linhas_pedido"),
    )


def previous_period(
    rollups: SalesRollups, start: Day, end: Day, seller: str | None = None, company: str | None = None
) -> DataFrame:
    scope = (*previous_span(start, end), seller, company)
    return _slice(rollups.customers, *scope).agg(
        _zero(F.sum("faturamento")).alias("faturamento_total"),
        _zero(F.sum("caixas")).alias("caixas_total"),
        _buyers(rollups.customers).alias("clientes_positivados"),
    )


def today_totals(rollups: SalesRollups, as_of: Day, seller: str | None = None, company: str | None = None) -> DataFrame:
    return _slice(rollups.days, as_of, as_of, seller, company).agg(
        _zero(F.sum("faturamento")).alias("faturamento_hoje"), _zero(F.sum("caixas")).alias("caixas_hoje")
    )


def data_freshness(rollups: SalesRollups, company: str | None = None) -> DataFrame:
    return for_company(rollups.days, company).agg(F.max("carregado_em").alias("dados_ate"))


def _revenue_and_boxes():
    return F.sum("faturamento").alias("faturamento"), F.sum("caixas").alias("caixas")


def by_day(
    rollups: SalesRollups, start: Day, end: Day, seller: str | None = None, company: str | None = None
) -> DataFrame:
    grouped = _slice(rollups.days, start, end, seller, company).groupBy(F.col("data_emissao").alias("dia"))
    return grouped.agg(*_revenue_and_boxes()).orderBy("dia")


def seller_totals(
    rollups: SalesRollups, start: Day, end: Day, seller: str | None = None, company: str | None = None
) -> DataFrame:
    """cod_vendedor, faturamento, caixas, positivados."""
    return _seller_totals(rollups, start, end, seller, company, ["cod_vendedor"])


def _seller_totals(rollups: SalesRollups, start: Day, end: Day, seller, company, key: list[str]) -> DataFrame:
    grouped = _slice(rollups.customers, start, end, seller, company).groupBy(*key)
    return grouped.agg(*_revenue_and_boxes(), _buyers(rollups.customers).alias("positivados"))


def by_seller(
    rollups: SalesRollups, sellers: DataFrame, start: Day, end: Day, seller: str | None = None, company: str | None = None
) -> DataFrame:
    key = shared_key("cod_vendedor", rollups.customers, sellers)
    totals = _seller_totals(rollups, start, end, seller, company, key)
    orders = distinct_numbers(_slice(rollups.numbers, start, end, seller, company), "nr_pedido", "pedidos", tuple(key))
    orders = orders.withColumnsRenamed({c: f"de_{c}" for c in key})
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"de_{c}")) for c in key))
    both = totals.join(orders, same, "left").select(*totals.columns, _zero("pedidos").alias("pedidos"))
    return with_seller_name(both, for_company(sellers, company)).orderBy(
        F.desc_nulls_last("faturamento"), F.asc_nulls_last("cod_vendedor")
    )


def by_channel(
    rollups: SalesRollups, customers: DataFrame, start: Day, end: Day, seller: str | None = None, company: str | None = None
) -> DataFrame:
    per_customer = _slice(rollups.customers, start, end, seller, company).groupBy(*_company(customers), "cod_cliente")
    return channel_shares(portfolio_of(customers, seller, company), per_customer.agg(*_revenue_and_boxes()))


def customer_recency(
    rollups: SalesRollups, customers: DataFrame, as_of: Day, seller: str | None = None, company: str | None = None
) -> DataFrame:
    """As ``portfolio.customer_recency``, over customers' days instead of all lines of the history."""
    day = as_day(as_of)
    sold = for_company(in_period(rollups.customers, "data_emissao", end=day), company).filter(F.col("vendas") > 0)
    return with_recency(for_seller(for_company(customers, company), seller), sold, day, F.col("valor_venda"))


def campaign_days(tagged: DataFrame) -> DataFrame:
    """Revenue and boxes per campaign, seller and day, of sales with a campaign."""
    return (
        tagged.filter(F.col("campanha_id").isNotNull())
        .groupBy("campanha_id", "cod_vendedor", "data_emissao")
        .agg(F.sum(signed_value()).alias("faturamento"), F.sum(moved_boxes()).alias("caixas"))
    )


def merged_campaign_days(of_parts: DataFrame) -> DataFrame:
    """The days of all sales from the days of their parts."""
    sums = _revenue_and_boxes()
    return of_parts.groupBy("campanha_id", "cod_vendedor", "data_emissao").agg(*sums)

