"""Order indicators: open backlog (a snapshot), fill rate and cuts (of the period)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import percent, sum_where
from ..functions.periods import Day
from ..schemas import CUT, INVOICED, NO_REASON, OPEN, SALE
from .filters import for_company, for_seller, in_period, own_code, shared_key
from .sales import with_seller_name


def _sold(orders: DataFrame, seller: str | None, company: str | None) -> DataFrame:
    return for_seller(for_company(orders, company), seller).filter(F.col("tipo") == SALE)


def _open(orders: DataFrame, seller: str | None, company: str | None) -> DataFrame:
    return _sold(orders, seller, company).filter(F.col("status_grupo") == OPEN)


def open_backlog(orders: DataFrame, seller: str | None = None, company: str | None = None) -> DataFrame:
    return _open(orders, seller, company).agg(
        F.coalesce(F.sum("valor"), F.lit(0)).alias("valor"),
        F.coalesce(F.sum("qt_caixas"), F.lit(0)).alias("caixas"),
        F.count_distinct(own_code(orders, "nr_pedido", company)).alias("pedidos"),
        F.count(F.lit(1)).alias("itens"),
    )


def fill_rate(
    orders: DataFrame, start: Day, end: Day, seller: str | None = None, company: str | None = None
) -> DataFrame:
    """Invoiced boxes among invoiced and cut ones; null when there are none."""
    group = F.col("status_grupo")
    totals = _sold(in_period(orders, "data_pedido", start, end), seller, company).agg(
        sum_where("qt_caixas", group == INVOICED).alias("caixas_faturadas"),
        sum_where("qt_caixas", group == CUT).alias("caixas_cortadas"),
        sum_where("valor", group == CUT).alias("valor_cortado"),
        F.sum(F.when(group == INVOICED, F.col("qt_caixas"))).alias("faturadas_ou_nulo"),
    )
    settled = F.col("caixas_faturadas") + F.col("caixas_cortadas")
    return totals.select(
        "caixas_faturadas", "caixas_cortadas", "valor_cortado",
        percent(F.col("faturadas_ou_nulo"), settled, otherwise=None).alias("pct"),
    )


def cuts_by_reason(
    orders: DataFrame, start: Day, end: Day, seller: str | None = None, company: str | None = None
) -> DataFrame:
    return (
        _sold(in_period(orders, "data_pedido", start, end), seller, company)
        .filter(F.col("status_grupo") == CUT)
        .groupBy(F.coalesce("motivo_corte", F.lit(NO_REASON)).alias("motivo"))
        .agg(F.sum("qt_caixas").alias("caixas"), F.sum("valor").alias("valor"))
        .orderBy(F.desc_nulls_last("caixas"), "motivo")
    )


def backlog_by_seller(
    orders: DataFrame, sellers: DataFrame, seller: str | None = None, company: str | None = None
) -> DataFrame:
    grouped = (
        _open(orders, seller, company)
        .groupBy(*shared_key("cod_vendedor", orders, sellers))
        .agg(
            F.sum("valor").alias("valor"),
            F.sum("qt_caixas").alias("caixas"),
            F.count_distinct("nr_pedido").alias("pedidos"),
        )
    )
    return with_seller_name(grouped, for_company(sellers, company)).orderBy(
        F.desc_nulls_last("valor"), F.asc_nulls_last("cod_vendedor")
    )
