"""Sales indicators over the sales mart.

``start``, ``end`` and ``as_of`` are plain dates; nothing here reads the clock.
Facts are aggregated first and joined to names afterwards, so a join never
carries more than one row per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import (
    count_where,
    distinct_where,
    is_buying_line,
    is_sale,
    moved_boxes,
    percent,
    ratio,
    signed_value,
    sum_where,
)
from ..functions.periods import Day, month_key, previous_span
from ..schemas import AGENDA_PENDING, BONUS, NO_CHANNEL, NO_FAMILY, RETURN, SALE, VISIT_DONE
from .filters import (
    customer_key,
    for_company,
    for_seller,
    in_period,
    local_period,
    own_code,
    shared_key,
    spans_overlapping,
)


def sales_slice(
    sales: DataFrame, start: Day | None, end: Day | None, seller: str | None = None, company: str | None = None
) -> DataFrame:
    """Sales rows of the period, of one seller when given."""
    return for_seller(for_company(in_period(sales, "data_emissao", start, end), company), seller)


def _net_revenue():
    kind = F.col("tipo")
    return (sum_where("valor", kind == SALE) - sum_where("valor", kind == RETURN)).alias("faturamento_total")


def _boxes_total():
    return F.coalesce(F.sum(moved_boxes()), F.lit(0)).alias("caixas_total")


def _buying_customers(rows: DataFrame, company: str | None):
    return distinct_where(own_code(rows, "cod_cliente", company), is_buying_line()).alias("clientes_positivados")


def sales_summary(
    sales: DataFrame, start: Day, end: Day, seller: str | None = None, company: str | None = None
) -> DataFrame:
    """Totals and distinct counts of the period, one row."""
    kind = F.col("tipo")
    with_order = is_sale() & F.col("nr_pedido").isNotNull()
    rows = sales_slice(sales, start, end, seller, company)
    order = own_code(rows, "nr_pedido", company)
    return rows.agg(
        _net_revenue(),
        sum_where("valor", kind == RETURN).alias("devolucoes"),
        _boxes_total(),
        sum_where("qt_caixas", kind == BONUS).alias("caixas_bonificadas"),
        distinct_where(order, with_order).alias("pedidos"),
        distinct_where(own_code(rows, "nr_nota", company), is_sale()).alias("notas"),
        _buying_customers(rows, company),
        # A struct, so that a pair with a missing item still counts.
        distinct_where(F.struct(order, "it_codigo"), with_order).alias("linhas_pedido"),
    )


def ratio_columns():
    """Averages over the columns of a summary; 0 where there is nothing to divide by."""
    orders = F.col("pedidos")
    revenue = F.col("faturamento_total")
    paid_boxes = F.col("caixas_total") - F.col("caixas_bonificadas")
    return [
        ratio(F.col("linhas_pedido"), orders, 1).alias("media_skus_pedido"),
        ratio(revenue, orders, 2).alias("ticket_medio"),
        ratio(revenue, paid_boxes, 2).alias("preco_medio_caixa"),
        ratio(F.col("caixas_total"), orders, 1).alias("drop_size"),
    ]


def sales_ratios(summary: DataFrame) -> DataFrame:
    return summary.select(*ratio_columns())


def previous_period(
    sales: DataFrame, start: Day, end: Day, seller: str | None = None, company: str | None = None
) -> DataFrame:
    """Revenue, boxes and buying customers of the span before the period."""
    first, last = previous_span(start, end)
    rows = sales_slice(sales, first, last, seller, company)
    return rows.agg(_net_revenue(), _boxes_total(), _buying_customers(rows, company))


def today_totals(sales: DataFrame, as_of: Day, seller: str | None = None, company: str | None = None) -> DataFrame:
    return sales_slice(sales, as_of, as_of, seller, company).agg(
        F.coalesce(F.sum(signed_value()), F.lit(0)).alias("faturamento_hoje"),
        F.coalesce(F.sum(moved_boxes()), F.lit(0)).alias("caixas_hoje"),
    )


def data_freshness(sales: DataFrame, company: str | None = None) -> DataFrame:
    return for_company(sales, company).agg(F.max("carregado_em").alias("dados_ate"))


def _revenue_and_boxes():
    """Boxes stay null for a group with returns only."""
    return F.sum(signed_value()).alias("faturamento"), F.sum(moved_boxes()).alias("caixas")


def by_channel(
    customers: DataFrame,
    sales: DataFrame,
    start: Day,
    end: Day,
    seller: str | None = None,
    company: str | None = None,
) -> DataFrame:
    """Customers, share of customers, revenue and boxes per channel.

    Every channel of the portfolio is listed, with or without sales.
    """
    revenue, boxes = _revenue_and_boxes()
    portfolio = portfolio_of(customers, seller, company)
    rows = sales_slice(sales, start, end, seller, company)
    return channel_shares(portfolio, rows.groupBy(*customer_key(portfolio, rows)).agg(revenue, boxes))


def portfolio_of(customers: DataFrame, seller: str | None, company: str | None) -> DataFrame:
    owned = for_seller(for_company(customers, company), seller)
    return owned.select(*customer_key(customers), "canal")


def channel_shares(portfolio: DataFrame, per_customer: DataFrame) -> DataFrame:
    """Channels of the portfolio with their share of its customers and what the customers bought."""
    grouped = (
        portfolio.join(per_customer, customer_key(portfolio, per_customer), "left")
        .groupBy(F.coalesce("canal", F.lit(NO_CHANNEL)).alias("canal"))
        .agg(
            F.count(F.lit(1)).alias("qtd"),
            F.coalesce(F.sum("faturamento"), F.lit(0)).alias("faturamento"),
            F.coalesce(F.sum("caixas"), F.lit(0)).alias("caixas"),
        )
    )
    everyone = portfolio.agg(F.count(F.lit(1))).scalar()
    return grouped.select(
        "canal", "qtd", percent(F.col("qtd"), F.greatest(everyone, F.lit(1))).alias("pct"), "faturamento", "caixas"
    ).orderBy(F.desc("faturamento"), "canal")


def by_seller(
    sales: DataFrame,
    sellers: DataFrame,
    start: Day,
    end: Day,
    seller: str | None = None,
    company: str | None = None,
) -> DataFrame:
    """Revenue, boxes, buying customers and orders per seller; sellers of two companies stay apart."""
    rows = sales_slice(sales, start, end, seller, company)
    key = shared_key("cod_vendedor", rows, sellers)
    grouped = rows.groupBy(*key).agg(
        *_revenue_and_boxes(),
        distinct_where("cod_cliente", is_buying_line()).alias("positivados"),
        distinct_where("nr_pedido", is_sale()).alias("pedidos"),
    )
    return with_seller_name(grouped, for_company(sellers, company)).orderBy(
        F.desc_nulls_last("faturamento"), F.asc_nulls_last("cod_vendedor")
    )


def with_seller_name(grouped: DataFrame, sellers: DataFrame) -> DataFrame:
    """Add the seller's name, or the code where no name is known."""
    key = shared_key("cod_vendedor", grouped, sellers)
    names = sellers.select(*key, F.col("nome").alias("nome_cadastro"))
    rest = [c for c in grouped.columns if c not in ("cod_vendedor", "empresa")]
    return grouped.join(names, key, "left").select(
        "cod_vendedor", F.coalesce("nome_cadastro", "cod_vendedor").alias("nome"), *rest
    )


def by_family(
    sales: DataFrame,
    products: DataFrame,
    start: Day,
    end: Day,
    seller: str | None = None,
    company: str | None = None,
) -> DataFrame:
    """Revenue, boxes and customers with a sale line, per product family.

    The slice shrinks to (item, customer) before the products are joined, and to
    (family, customer) before the customers of a family are counted, so no
    family or item is ever gathered in one place.
    """
    revenue, boxes = _revenue_and_boxes()
    rows = sales_slice(sales, start, end, seller, company)
    item = shared_key("it_codigo", rows, products)
    customer = customer_key(rows)
    pairs = rows.groupBy("it_codigo", *customer).agg(revenue, boxes, F.max(is_sale().cast("int")).alias("comprou"))
    families = for_company(products, company).select(*item, F.col("familia").alias("familia_cadastro"))
    totals = [F.sum("faturamento").alias("faturamento"), F.sum("caixas").alias("caixas")]
    return (
        pairs.join(families, item, "left")
        .groupBy(F.coalesce("familia_cadastro", F.lit(NO_FAMILY)).alias("familia"), *customer)
        .agg(*totals, F.max("comprou").alias("comprou"))
        .groupBy("familia")
        .agg(*totals, F.sum("comprou").alias("pdvs"))
        .orderBy(F.desc_nulls_last("faturamento"), "familia")
    )


def by_day(
    sales: DataFrame, start: Day, end: Day, seller: str | None = None, company: str | None = None
) -> DataFrame:
    """One row per day that has movements."""
    return (
        sales_slice(sales, start, end, seller, company)
        .groupBy(F.col("data_emissao").alias("dia"))
        .agg(*_revenue_and_boxes())
        .orderBy("dia")
    )


def by_campaign(
    campaigns: DataFrame,
    sales: DataFrame,
    start: Day,
    end: Day,
    seller: str | None = None,
    cut_to_period: bool = False,
) -> DataFrame:
    """Campaigns that touch the period, with the sales tagged with them.

    All tagged sales count, whenever they were made, unless ``cut_to_period``.
    """
    tagged = for_seller(sales, seller).filter(F.col("campanha_id").isNotNull())
    if cut_to_period:
        tagged = in_period(tagged, "data_emissao", start, end)
    wanted = spans_overlapping(campaigns, start, end)
    # Only sales of the wanted campaigns are grouped.
    tagged = tagged.join(wanted.select(F.col("id").alias("campanha_id")), "campanha_id", "left_semi")
    return campaign_lines(wanted, tagged.groupBy(F.col("campanha_id").alias("id")).agg(*_revenue_and_boxes()))


def campaign_lines(wanted: DataFrame, grouped: DataFrame) -> DataFrame:
    return (
        wanted.join(grouped, "id", "left")
        .select(
            "id", "nome", "data_inicio", "data_fim", "mecanica",
            F.coalesce("faturamento", F.lit(0)).alias("faturamento"),
            F.coalesce("caixas", F.lit(0)).alias("caixas"),
        )
        .orderBy(F.desc("faturamento"), "id")
    )


def registrations_by_seller(
    registered: DataFrame, start: Day, end: Day, origin: str, seller: str | None = None
) -> DataFrame:
    """Customers that came in through ``origin`` in the period, per seller."""
    rows = for_seller(in_period(registered, "data_cadastro", start, end), seller).filter(F.col("origem") == origin)
    return rows.groupBy("cod_vendedor").agg(F.count(F.lit(1)).alias("qtd"))


def visits_per_seller(visits: DataFrame, start: Day, end: Day) -> DataFrame:
    done = local_period(visits.filter(F.col("status_visita") == VISIT_DONE), "timestamp", start, end)
    return done.groupBy("cod_vendedor").agg(F.count(F.lit(1)).alias("real_visitas"))


def goals_vs_actuals(
    goals: DataFrame,
    users: DataFrame,
    sales: DataFrame,
    visits: DataFrame,
    start: Day,
    end: Day,
    seller: str | None = None,
    registrations: DataFrame | None = None,
    company: str | None = None,
) -> DataFrame:
    """Goals of the month of ``start`` next to what each seller reached.

    Each actual is one aggregate per seller; registrations count 0 when no
    registration table is given.
    """
    totals = (
        sales_slice(sales, start, end, seller, company)
        .groupBy("cod_vendedor")
        .agg(distinct_where("cod_cliente", is_buying_line()).alias("positivados"), *_revenue_and_boxes())
    )
    return goals_vs_totals(goals, users, totals, visits, start, end, seller, registrations)


def goals_vs_totals(
    goals: DataFrame,
    users: DataFrame,
    totals: DataFrame,
    visits: DataFrame,
    start: Day,
    end: Day,
    seller: str | None = None,
    registrations: DataFrame | None = None,
) -> DataFrame:
    """Goals next to sellers' totals (cod_vendedor, positivados, faturamento, caixas)."""
    zero = F.lit(0)
    wanted = for_seller(goals.filter(F.col("mes") == month_key(start)), seller)
    sold = totals.select(
        "cod_vendedor", F.col("positivados").alias("real_positivados"), F.col("faturamento").alias("real_faturamento"),
        F.col("caixas").alias("real_caixas"),
    )
    named = with_seller_name(wanted, users)
    result = named.join(visits_per_seller(visits, start, end), "cod_vendedor", "left").join(sold, "cod_vendedor", "left")
    if registrations is None:
        result = result.withColumn("real_cadastros", zero.cast("bigint"))
    else:
        counted = registrations.select("cod_vendedor", F.col("qtd").alias("real_cadastros"))
        result = result.join(counted, "cod_vendedor", "left")
    actuals = ["real_visitas", "real_positivados", "real_cadastros", "real_faturamento", "real_caixas"]
    return result.select(
        "cod_vendedor", "nome", "meta_visitas", "meta_positivados", "meta_cadastros",
        "meta_faturamento", "meta_caixas", "fase",
        *(F.coalesce(c, zero).alias(c) for c in actuals),
    )


def visit_summary(
    visits: DataFrame, agenda: DataFrame, start: Day, end: Day, seller: str | None = None
) -> DataFrame:
    """Check-ins, done, scheduled and pending visits of the period, one row."""
    seen = for_seller(local_period(visits, "timestamp", start, end), seller).agg(
        F.count(F.lit(1)).alias("checkins"), count_where(F.col("status_visita") == VISIT_DONE).alias("realizadas")
    )
    planned = for_seller(in_period(agenda, "data_visita", start, end), seller).agg(
        F.count(F.lit(1)).alias("agendadas"), count_where(F.col("status") == AGENDA_PENDING).alias("pendentes")
    )
    both = seen.unionByName(planned, allowMissingColumns=True)
    return both.agg(*(F.sum(c).alias(c) for c in ["checkins", "realizadas", "agendadas", "pendentes"]))
