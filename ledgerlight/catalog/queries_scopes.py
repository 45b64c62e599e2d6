"""Indicators of one seller, of two companies at once, and of a period that is no month, as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import orders as order_ops
from ..operators import portfolio, sales
from ..schemas import FIELD_APP_ORIGIN
from .registry import QUERIES, query
from .tables import AS_OF, END, SELLER, START

# ------------------------------------------------------------------------- one seller

# Views that a seller's indicators see only the seller's rows of. The portfolio is the customers that a seller owns,
# whoever sold to them; sales count for who sold.
_MINE = f"cod_vendedor = '{SELLER}'"
_SCOPE = {"seller": SELLER}


def _recency(t):
    return portfolio.customer_recency(t.customers, t.sales, AS_OF, **_SCOPE)


def _registered(t):
    return sales.registrations_by_seller(t.registered, START, END, FIELD_APP_ORIGIN, SELLER)


_OF_SELLER = {
    "previous_period": ("measured", lambda t: sales.previous_period(t.sales, START, END, **_SCOPE)),
    "today_totals": ("measured", lambda t: sales.today_totals(t.sales, AS_OF, **_SCOPE)),
    "customer_recency": ("customers", _recency),
    "portfolio_summary": (
        "customers signed", lambda t: portfolio.portfolio_summary(_recency(t), sales.sales_summary(t.sales, START, END, **_SCOPE)),
    ),
    "cooling_customers": ("customers", lambda t: portfolio.cooling_customers(_recency(t))),
    "by_channel": ("customers signed", lambda t: sales.by_channel(t.customers, t.sales, START, END, **_SCOPE)),
    "by_seller": ("signed", lambda t: sales.by_seller(t.sales, t.sellers, START, END, **_SCOPE)),
    "by_family": ("signed", lambda t: sales.by_family(t.sales, t.products, START, END, **_SCOPE)),
    "by_day": ("signed", lambda t: sales.by_day(t.sales, START, END, **_SCOPE)),
    "by_campaign": ("measured", lambda t: sales.by_campaign(t.campaigns, t.tagged_sales, START, END, SELLER)),
    "goals_vs_actuals": (
        "goals", lambda t: sales.goals_vs_actuals(t.goals, t.users, t.sales, t.visits, START, END, SELLER, _registered(t)),
    ),
    "registrations_by_seller": ("registration_counts", _registered),
    "visit_summary": ("visits", lambda t: sales.visit_summary(t.visits, t.agenda, START, END, SELLER)),
    "open_backlog": ("order_mart", lambda t: order_ops.open_backlog(t.orders, SELLER)),
    "fill_rate": ("order_mart", lambda t: order_ops.fill_rate(t.orders, START, END, SELLER)),
    "cuts_by_reason": ("order_mart", lambda t: order_ops.cuts_by_reason(t.orders, START, END, SELLER)),
    "backlog_by_seller": ("order_mart", lambda t: order_ops.backlog_by_seller(t.orders, t.sellers, SELLER)),
}

for _name, (_views, _build) in _OF_SELLER.items():
    _whole = QUERIES[_name]
    _columns = " ".join(f"{c}:{k}" for c, k in _whole.columns.items())
    query(f"{_name}_of_seller", _columns, _whole.oracle, {v: _MINE for v in _views.split()})(_build)


# --------------------------------------------------------------- a period that is no month

# The span before the period ends the day before it and has as many days.
_FIRST, _LAST = "1998-03-10", "1998-04-21"


@query(
    "previous_period_by_days",
    "faturamento_total:d caixas_total:d clientes_positivados:i",
    f"""select coalesce(sum(com_sinal), 0) as faturamento_total, coalesce(sum(movidas), 0) as caixas_total,
               count(distinct comprador) as clientes_positivados
        from measured where data_emissao < date '{_FIRST}' and data_emissao >= date '{_FIRST}' - cast(date '{_LAST}' - date '{_FIRST}' + 1 as integer)""",
)
def _(t):
    return sales.previous_period(t.sales, _FIRST, _LAST)


# ----------------------------------------------------------------------- two companies


def _other(df, **changes):
    """The table, and behind it the same rows as those of a second company, changed."""
    columns = {"empresa": F.lit("c2")} | {name: change(F.col(name)) for name, change in changes.items()}
    return df.unionByName(df.withColumns(columns))


def _sales(t):
    """The second company sells under the same numbers and codes, to fewer customers."""
    rows = _other(t.sales, valor=lambda c: (c + 1).cast("decimal(14,2)"))
    return rows.filter((F.col("empresa") == "c1") | ~F.col("cod_cliente").endswith("3"))


def _customers(t):
    return _other(t.customers, canal=lambda c: F.concat(F.lit("2 "), c), nome=lambda c: F.concat(F.lit("2 "), c))


_BOTH_SALES = "(select 'c1' as empresa, * from sales union all select 'c2', * replace (valor + 1 as valor) from sales where cod_cliente not like '%3')"
_BOTH_CUSTOMERS = "(select * from customers union all select * replace ('c2' as empresa, '2 ' || canal as canal, '2 ' || nome as nome) from customers)"
_PERIOD = "data_emissao between date '1998-01-01' and date '1998-01-31'"
_SIGNED = "coalesce(sum(case tipo when 'venda' then valor when 'devolucao' then -valor else 0 end), 0)"
_MOVED = "sum(case when tipo in ('venda', 'bonificacao') then qt_caixas end)"


@query(
    "two_companies_summary",
    "faturamento_total:d caixas_total:d pedidos:i notas:i clientes_positivados:i linhas_pedido:i",
    f"""select {_SIGNED} as faturamento_total, coalesce({_MOVED}, 0) as caixas_total,
               count(distinct empresa || '/' || nr_pedido) filter (where tipo = 'venda') as pedidos,
               count(distinct empresa || '/' || nr_nota) filter (where tipo = 'venda') as notas,
               count(distinct empresa || '/' || cod_cliente) filter (where tipo = 'venda' and valor > 0) as clientes_positivados,
               count(distinct empresa || '/' || nr_pedido || '/' || it_codigo) filter (where tipo = 'venda') as linhas_pedido
        from {_BOTH_SALES} where {_PERIOD}""",
)
def _(t):
    return sales.sales_summary(_sales(t), START, END)


@query(
    "two_companies_recency",
    "cod_cliente:s nome:s ultima_compra:s faturamento_6m:d",
    f"""select cod_cliente, nome, p.ultima_compra, coalesce(p.recente, 0) as faturamento_6m
        from {_BOTH_CUSTOMERS} left join (
            select empresa, cod_cliente, max(data_emissao) as ultima_compra,
                   sum(if(data_emissao >= date '1998-01-31' - 180, valor, 0)) as recente
            from {_BOTH_SALES} where tipo = 'venda' and data_emissao <= date '1998-01-31' group by 1, 2) p using (empresa, cod_cliente)""",
)
def _(t):
    return portfolio.customer_recency(_customers(t), _sales(t), AS_OF)


@query(
    "two_companies_channels",
    "canal:s qtd:i faturamento:d caixas:d",
    f"""select coalesce(canal, 'Sem canal') as canal, count(*) as qtd, coalesce(sum(f), 0) as faturamento, coalesce(sum(x), 0) as caixas
        from {_BOTH_CUSTOMERS} left join (
            select empresa, cod_cliente, {_SIGNED} as f, {_MOVED} as x from {_BOTH_SALES} where {_PERIOD} group by 1, 2) using (empresa, cod_cliente)
        group by 1""",
)
def _(t):
    return sales.by_channel(_customers(t), _sales(t), START, END)


@query(
    "two_companies_sellers",
    "cod_vendedor:s nome:s faturamento:d positivados:i",
    f"""select cod_vendedor, coalesce(if(empresa = 'c2', 'two ', '') || nome, cod_vendedor) as nome, f as faturamento, positivados
        from (select empresa, cod_vendedor, {_SIGNED} as f, count(distinct cod_cliente) filter (where tipo = 'venda' and valor > 0) as positivados
              from {_BOTH_SALES} where {_PERIOD} group by 1, 2) left join (select cod_vendedor, nome from sellers) using (cod_vendedor)""",
)
def _(t):
    sellers = _other(t.sellers, nome=lambda c: F.concat(F.lit("two "), c))
    return sales.by_seller(_sales(t), sellers, START, END)


@query(
    "two_companies_families",
    "familia:s faturamento:d pdvs:i",
    f"""select coalesce(if(empresa = 'c2', '2 ', '') || p.familia, 'SEM FAMILIA') as familia, {_SIGNED} as faturamento,
               count(distinct empresa || '/' || cod_cliente) filter (where tipo = 'venda') as pdvs
        from {_BOTH_SALES} s left join products p on p.it_codigo = s.it_codigo where {_PERIOD} group by 1""",
)
def _(t):
    products = _other(t.products, familia=lambda c: F.concat(F.lit("2 "), c))
    return sales.by_family(_sales(t), products, START, END)
