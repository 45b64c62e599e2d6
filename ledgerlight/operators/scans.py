"""Source scans that need a join: invoice lines and order items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import line_value
from ..functions.periods import Day
from .filters import OrderScope, in_period, order_scope_filter

INVOICE_KEY = ["nr_nota_fis", "serie", "cod_estabel"]


def invoice_line_scan(headers: DataFrame, lines: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """Invoice lines whose header is dated in the period.

    The date filter sits on the header table; the header side keeps its key only,
    so the join moves as little as possible.
    """
    wanted = in_period(headers, "dt_emis_nota", start, end).select(*INVOICE_KEY)
    return lines.join(wanted, INVOICE_KEY)


def order_item_scan(
    order_items: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    start: Day | None = None,
    end: Day | None = None,
    scope: OrderScope = OrderScope(),
) -> DataFrame:
    """Order items with their order's date, rep and state and the item's texts."""
    dated = in_period(orders, "dt_venda", start, end)
    texts = items.select("it_codigo", "descricao_1", "descricao_2")
    joined = order_items.join(dated, ["nr_pedcli", "nome_abrev"]).withColumn(
        "valor_total_venda", line_value("qt_pedida", "preco_venda")
    )
    # Filter before the outer join: it only adds texts.
    return (
        order_scope_filter(joined, scope)
        .join(texts, "it_codigo", "left")
        .select(
            "nome_abrev", "nr_pedcli", "cod_emitente", "nr_sequencia", "it_codigo",
            "descricao_1", "descricao_2", "qt_pedida", "preco_venda", "valor_total_venda",
            "dt_venda", "representante", "situacao_pedido",
        )
    )


def latest_row(df: DataFrame, column: str, *tie_break: str) -> DataFrame:
    order = [F.desc_nulls_last(column), *(F.desc_nulls_last(c) for c in tie_break)]
    return df.orderBy(*order).limit(1)
