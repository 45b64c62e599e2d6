"""The two dashboard documents, block by block.

A board is a dict of lazy frames, one per block. Block and field names are the
fixed names of the document that dashboards read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import Day
from ..operators import orders as order_ops
from ..operators import portfolio, sales
from ..operators import rollups as rollup_ops
from ..operators.filters import for_seller, spans_overlapping
from ..schemas import FIELD_APP_ORIGIN

# Blocks nested in "pedidos", and one-row blocks whose columns stand at top level.
ORDER_BLOCKS = ("carteira_aberta", "fill_rate", "corte_por_motivo", "carteira_por_vendedor")
FLAT_BLOCKS = ("dados_ate", "hoje")


@dataclass(frozen=True)
class ListBlock:
    """A block that holds many items: what names an item, how items are ordered."""

    item: str
    order: str
    descending: bool = True


# Blocks not listed here hold exactly one row.
LIST_BLOCKS = {
    "esfriando": ListBlock("cod_cliente", "faturamento_6m"),
    "por_canal": ListBlock("canal", "faturamento"),
    "por_vendedor": ListBlock("cod_vendedor", "faturamento"),
    "por_familia": ListBlock("familia", "faturamento"),
    "por_dia": ListBlock("dia", "dia", descending=False),
    "por_campanha": ListBlock("nome", "faturamento"),
    "metas": ListBlock("cod_vendedor", "cod_vendedor", descending=False),
    "cadastros": ListBlock("cod_vendedor", "cod_vendedor", descending=False),
    "corte_por_motivo": ListBlock("motivo", "caixas"),
    "carteira_por_vendedor": ListBlock("cod_vendedor", "valor"),
}


@dataclass(frozen=True)
class SalesMarts:
    """The tables a sales board reads."""

    sales: DataFrame
    customers: DataFrame
    sellers: DataFrame
    products: DataFrame
    goals: DataFrame
    users: DataFrame
    visits: DataFrame
    agenda: DataFrame
    campaigns: DataFrame | None = None
    tagged_sales: DataFrame | None = None
    registered: DataFrame | None = None
    # With these, the blocks that they hold do not go back to the sales.
    rollups: rollup_ops.SalesRollups | None = None
    campaign_days: DataFrame | None = None


def sales_board(
    marts: SalesMarts, start: Day, end: Day, as_of: Day, seller: str | None = None, company: str | None = None
) -> dict[str, DataFrame]:
    """All sales blocks. Each reads only its own columns of the partitions it needs.

    With stored rollups the sales themselves are read twice, for the period only: for the order lines and the families.
    """
    if marts.rollups is not None:
        return _sales_board_of_rollups(marts, start, end, as_of, seller, company)
    scope = {"seller": seller, "company": company}
    summary = sales.sales_summary(marts.sales, start, end, **scope)
    recency = portfolio.customer_recency(marts.customers, marts.sales, as_of, **scope)
    counted = None
    blocks = {
        "dados_ate": sales.data_freshness(marts.sales, company),
        "anterior": sales.previous_period(marts.sales, start, end, **scope),
        "resumo": _summary_block(summary),
        "hoje": sales.today_totals(marts.sales, as_of, **scope),
        "carteira": portfolio.portfolio_summary(recency, summary),
        "esfriando": portfolio.cooling_customers(recency),
        "por_canal": sales.by_channel(marts.customers, marts.sales, start, end, **scope),
        "por_vendedor": sales.by_seller(marts.sales, marts.sellers, start, end, **scope),
        "por_familia": sales.by_family(marts.sales, marts.products, start, end, **scope),
        "por_dia": sales.by_day(marts.sales, start, end, **scope),
        "visitas": sales.visit_summary(marts.visits, marts.agenda, start, end, seller),
    }
    if marts.campaigns is not None and marts.tagged_sales is not None:
        blocks["por_campanha"] = sales.by_campaign(marts.campaigns, marts.tagged_sales, start, end, seller).drop("id")
    if marts.registered is not None:
        counted = sales.registrations_by_seller(marts.registered, start, end, FIELD_APP_ORIGIN, seller)
        blocks["cadastros"] = counted
    blocks["metas"] = sales.goals_vs_actuals(
        marts.goals, marts.users, marts.sales, marts.visits, start, end, seller, counted, company
    )
    return blocks


def _sales_board_of_rollups(
    marts: SalesMarts, start: Day, end: Day, as_of: Day, seller: str | None, company: str | None
) -> dict[str, DataFrame]:
    scope = {"seller": seller, "company": company}
    held = marts.rollups
    summary = rollup_ops.sales_summary(held, marts.sales, start, end, **scope)
    recency = rollup_ops.customer_recency(held, marts.customers, as_of, **scope)
    counted = None
    blocks = {
        "dados_ate": rollup_ops.data_freshness(held, company),
        "anterior": rollup_ops.previous_period(held, start, end, **scope),
        "resumo": _summary_block(summary),
        "hoje": rollup_ops.today_totals(held, as_of, **scope),
        "carteira": portfolio.portfolio_summary(recency, summary),
        "esfriando": portfolio.cooling_customers(recency),
        "por_canal": rollup_ops.by_channel(held, marts.customers, start, end, **scope),
        "por_vendedor": rollup_ops.by_seller(held, marts.sellers, start, end, **scope),
        "por_familia": sales.by_family(marts.sales, marts.products, start, end, **scope),
        "por_dia": rollup_ops.by_day(held, start, end, **scope),
        "visitas": sales.visit_summary(marts.visits, marts.agenda, start, end, seller),
    }
    if marts.campaigns is not None and marts.campaign_days is not None:
        wanted = spans_overlapping(marts.campaigns, start, end)
        totals = for_seller(marts.campaign_days, seller).groupBy(F.col("campanha_id").alias("id"))
        totals = totals.agg(F.sum("faturamento").alias("faturamento"), F.sum("caixas").alias("caixas"))
        blocks["por_campanha"] = sales.campaign_lines(wanted, totals).drop("id")
    if marts.registered is not None:
        counted = sales.registrations_by_seller(marts.registered, start, end, FIELD_APP_ORIGIN, seller)
        blocks["cadastros"] = counted
    totals = rollup_ops.seller_totals(held, start, end, **scope)
    blocks["metas"] = sales.goals_vs_totals(marts.goals, marts.users, totals, marts.visits, start, end, seller, counted)
    return blocks


def _summary_block(summary: DataFrame) -> DataFrame:
    return summary.select(
        "faturamento_total", "devolucoes", "caixas_total", "caixas_bonificadas", "pedidos", "notas",
        "clientes_positivados", *sales.ratio_columns(),
    )


def orders_board(
    orders: DataFrame,
    sellers: DataFrame,
    start: Day,
    end: Day,
    seller: str | None = None,
    company: str | None = None,
) -> dict[str, DataFrame]:
    return {
        "carteira_aberta": order_ops.open_backlog(orders, seller, company),
        "fill_rate": order_ops.fill_rate(orders, start, end, seller, company),
        "corte_por_motivo": order_ops.cuts_by_reason(orders, start, end, seller, company),
        "carteira_por_vendedor": order_ops.backlog_by_seller(orders, sellers, seller, company),
    }


def board_lines(blocks: dict[str, DataFrame]) -> DataFrame:
    """The whole board as rows (bloco, item, conteudo): one JSON text per item.

    Works for any number of items: nothing is gathered.
    """
    parts = []
    for name, df in blocks.items():
        spec = LIST_BLOCKS.get(name)
        item = F.col(spec.item).cast("string") if spec else F.lit(None).cast("string")
        content = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
        parts.append(df.select(F.lit(name).alias("bloco"), item.alias("item"), content.alias("conteudo")))
    return reduce(DataFrame.unionByName, parts)


_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def board_measures(blocks: dict[str, DataFrame]) -> DataFrame:
    """Every number of the board as a row (bloco, item, medida, valor)."""
    parts = []
    for name, df in blocks.items():
        spec = LIST_BLOCKS.get(name)
        item = F.coalesce(F.col(spec.item).cast("string"), F.lit("")) if spec else F.lit("")
        numbers = [c for c, kind in df.dtypes if kind in _NUMERIC or kind.startswith("decimal")]
        if not numbers:
            continue
        pairs = F.array(*(F.struct(F.lit(c).alias("medida"), F.col(c).cast("double").alias("valor")) for c in numbers))
        parts.append(df.select(F.lit(name).alias("bloco"), item.alias("item"), F.inline(pairs)))
    return reduce(DataFrame.unionByName, parts)


def _as_array(df: DataFrame, spec: ListBlock) -> DataFrame:
    """All items of a block as one ordered array, which is one value by the contract."""
    rank = F.col(spec.order)
    rank = -rank if spec.descending else rank
    keyed = F.struct(
        rank.isNull().alias("ultimo"), rank.alias("ordem"), F.col(spec.item).cast("string").alias("chave"),
        F.struct(*df.columns).alias("item"),
    )
    ordered = F.sort_array(F.collect_list(keyed))
    return df.agg(F.transform(ordered, lambda x: x["item"]).alias("itens"))


def board_document(blocks: dict[str, DataFrame]) -> DataFrame:
    """The board as one JSON document (one row, column ``documento``), as dashboards read it.

    ``dados_ate`` is a plain value, the totals of the day stand at top level, and the order blocks are nested in
    ``pedidos``. One document is one value, so its lists must fit in one row; it is put together in the same way at
    every size, and ``board_lines`` has the same content as rows, written in parallel. Blocks become scalar
    subqueries, which Spark runs side by side; each is computed once.
    """
    spark = next(iter(blocks.values())).sparkSession
    fields, orders = [], []
    for name, df in blocks.items():
        spec = LIST_BLOCKS.get(name)
        one = _as_array(df, spec) if spec else df.select(F.struct(*df.columns).alias("linha"))
        value = one.scalar()
        if name in ORDER_BLOCKS:
            orders.append(value.alias(name))
        elif name in FLAT_BLOCKS:
            fields += [value[column].alias(column) for column in df.columns]
        else:
            fields.append(value.alias(name))
    if orders:
        fields.append(F.struct(*orders).alias("pedidos"))
    document = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return spark.range(1).select(document.alias("documento"))
