"""Every operator as a query over the given tables, with its checking SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as cln
from ..operators import field, filters, indicators, marts, monitoring, orders, portfolio, sales, scans
from ..sinks import tables as sinks
from ..sources.database import high_water_mark, read_window
from ..sources.exports import history_cutoff
from .oracle_views import VIEWS
from .registry import query
from .tables import AS_OF, COMPANY, END, SELLER, START, text

# ------------------------------------------------------------------ sources


@query(
    "history_cutoff",
    "nr:s data_emissao:s",
    """select nr, case when o_orderstatus <> 'P' then emissao end as data_emissao from order_lines
       where o_orderstatus = 'P' or emissao >= date '1998-01-01'""",
)
def _(t):
    dated = t.order_lines.select("nr", F.when(F.col("o_orderstatus") != "P", F.col("emissao")).alias("data_emissao"))
    return history_cutoff(dated, "data_emissao", START)


@query(
    "read_window",
    "nr_nota:s cod_cliente:s it_codigo:s data_emissao:s valor:d",
    "select * from sales where data_emissao >= date '1998-01-24'",
)
def _(t):
    return read_window(t.sales, "data_emissao", AS_OF, 7)


@query(
    "high_water_mark",
    "ult_valor:s",
    "select strftime(max(ts), '%Y-%m-%d %H:%M:%S') as ult_valor from events",
)
def _(t):
    latest = high_water_mark(t.raw("events"), "ts")
    return latest.select(F.date_format("ult_valor", "yyyy-MM-dd HH:mm:ss").alias("ult_valor"))


# ----------------------------------------------------------------- cleaning

_NUMBER_SQL = """
    select l_orderkey as nr, l_partkey as item, l_linenumber as seq, cast(l_quantity as bigint) as qt,
           cast(l_extendedprice as decimal(14,2)) as amount
    from lineitem"""


def _number_texts(t):
    """Amounts written in several ways, by line number: blank, wrong, grouped, plain."""
    lines = t.raw("lineitem").withColumn("amount", F.col("l_extendedprice").cast("decimal(14,2)").cast("string"))
    seq, amount = F.col("l_linenumber"), F.col("amount")
    comma = F.replace(amount, F.lit("."), F.lit(","))
    written = (
        F.when(seq == 1, " ")
        .when(seq == 2, F.concat(F.lit("x"), amount))
        .when(seq == 3, F.concat(F.lit(" -"), comma, F.lit(" ")))
        .when(seq == 4, F.concat(F.lit("1."), F.lpad(comma, 9, "0")))
        .when(seq == 5, F.concat(F.lit("1."), amount))
        .otherwise(amount)
    )
    return lines.select(
        F.col("l_orderkey").alias("nr"), F.col("l_partkey").alias("item"), F.col("l_linenumber").alias("seq"),
        written.alias("texto"),
    )


@query(
    "parse_decimal_br",
    "nr:i item:i seq:i valor:d",
    f"""select nr, item, seq, case seq when 1 then null when 2 then null when 3 then -amount
               when 4 then cast('1' || lpad(cast(amount as varchar), 9, '0') as decimal(16,2))
               when 5 then null else amount end as valor from ({_NUMBER_SQL}) x""",
)
def _(t):
    return _number_texts(t).select("nr", "item", "seq", cln.parse_decimal_br("texto").alias("valor"))


@query(
    "parse_int_br",
    "nr:i item:i seq:i valor:i",
    f"""select nr, item, seq, cast(trunc(case seq when 1 then null when 2 then null when 3 then -amount
               when 4 then cast('1' || lpad(cast(amount as varchar), 9, '0') as decimal(16,2))
               when 5 then null else amount end) as bigint) as valor from ({_NUMBER_SQL}) x""",
)
def _(t):
    return _number_texts(t).select("nr", "item", "seq", cln.parse_int_br("texto").alias("valor"))


@query(
    "parse_date_br",
    "nr:i dia:s",
    """select o_orderkey as nr,
              case when o_orderpriority in ('1-URGENT', '2-HIGH') then null else cast(o_orderdate as date) end as dia
       from orders""",
)
def _(t):
    day = F.col("o_orderdate")
    kind = F.col("o_orderpriority")
    texto = (
        F.when(kind == "1-URGENT", F.lit("//"))
        .when(kind == "2-HIGH", F.date_format(day, "yyyy-MM-dd"))
        .when(kind == "3-MEDIUM", F.date_format(day, "d/M/yyyy"))
        .when((kind == "4-NOT SPECIFIED") & (F.year(day) >= 2000), F.date_format(day, " dd/MM/yy "))
        .otherwise(F.date_format(day, "dd/M/yyyy"))
    )
    return t.raw("orders").select(F.col("o_orderkey").alias("nr"), cln.parse_date_br(texto).alias("dia"))


@query(
    "blank_to_null",
    "nr:i texto:s",
    """select event_id as nr, case event_type when 'view' then null when 'click' then null else props end as texto
       from events""",
)
def _(t):
    kind = F.col("event_type")
    padded = (
        F.when(kind == "view", F.lit(" \t ")).when(kind == "click", F.lit(""))
        .otherwise(F.concat(F.lit("\t "), F.col("props"), F.lit(" \r\n")))
    )
    return t.raw("events").select(F.col("event_id").alias("nr"), cln.blank_to_null(padded).alias("texto"))


@query(
    "parse_flag",
    "nr:i sim:b",
    """select event_id as nr, case event_type when 'view' then null else event_type in ('click', 'purchase') end as sim
       from events""",
)
def _(t):
    kind = F.col("event_type")
    answer = F.when(kind == "click", "SIM ").when(kind == "purchase", "t").when(kind == "error", "no").when(kind == "signup", "")
    return t.raw("events").select(F.col("event_id").alias("nr"), cln.parse_flag(answer).alias("sim"))


@query(
    "first_extent",
    "nr:i item:i seq:i qt:d",
    f"select nr, item, seq, case when seq = 7 then null else qt end as qt from ({_NUMBER_SQL}) x",
)
def _(t):
    amount = F.col("l_quantity").cast("bigint").cast("string")
    both = F.when(F.col("l_linenumber") == 7, F.concat(F.lit("x;"), amount)).otherwise(F.concat(amount, F.lit(".0;9")))
    return t.raw("lineitem").select(
        F.col("l_orderkey").alias("nr"), F.col("l_partkey").alias("item"), F.col("l_linenumber").alias("seq"),
        cln.first_extent(both).alias("qt"),
    )


@query("decode_trim", "nr:i texto:s", "select event_id as nr, 'ação ' || props as texto from events")
def _(t):
    stored = F.encode(F.concat(F.lit(" ação "), F.col("props"), F.lit("  ")), "ISO-8859-1")
    return t.raw("events").select(F.col("event_id").alias("nr"), cln.decode_trim(stored).alias("texto"))


@query(
    "safe_int",
    "nr:i n:i",
    """select event_id as nr, case event_type when 'view' then null when 'click' then null else user_id end as n
       from events""",
)
def _(t):
    kind, number = F.col("event_type"), text("user_id")
    written = F.when(kind == "view", F.concat(number, F.lit(".5"))).when(kind == "click", F.concat(F.lit("n"), number)).otherwise(
        F.concat(F.lit(" "), number)
    )
    return t.raw("events").select(F.col("event_id").alias("nr"), cln.safe_int(written).alias("n"))


@query(
    "zero_code_to_null",
    "cod_cliente:s canal:s dono:s",
    """select cast(c_custkey as varchar) as cod_cliente, case when c_nationkey = 0 then null else cast(c_nationkey as varchar) end as canal,
              case when c_acctbal < 0 then null else c_mktsegment end as dono from customer""",
)
def _(t):
    return t.raw("customer").select(
        text("c_custkey").alias("cod_cliente"),
        cln.zero_code_to_null(text("c_nationkey")).alias("canal"),
        cln.zero_code_to_null(F.when(F.col("c_acctbal") < 0, " 0 ").otherwise(F.col("c_mktsegment"))).alias("dono"),
    )


@query(
    "tax_id_check",
    "cod_cliente:s digitos:s valido:b",
    """select cast(c_custkey as varchar) as cod_cliente,
              lpad(cast(c_custkey as varchar), case when c_acctbal < 0 then 13 else 14 end, '0') as digitos,
              c_acctbal >= 0 as valido from customer""",
)
def _(t):
    digits = F.when(F.col("c_acctbal") < 0, F.lpad(text("c_custkey"), 13, "0")).otherwise(F.lpad(text("c_custkey"), 14, "0"))
    written = F.concat(F.substring(digits, 1, 2), F.lit("."), F.substring(digits, 3, 6), F.lit("/"), F.substring(digits, 9, 6))
    return t.raw("customer").select(
        text("c_custkey").alias("cod_cliente"), cln.digits_only(written).alias("digitos"), cln.is_tax_id(written).alias("valido")
    )


@query(
    "state_code",
    "cod_cliente:s uf:s",
    "select cast(c_custkey as varchar) as cod_cliente, left(c_mktsegment, 2) as uf from customer",
)
def _(t):
    return t.raw("customer").select(
        text("c_custkey").alias("cod_cliente"), cln.state_code(F.lower("c_mktsegment")).alias("uf")
    )


@query(
    "default_label",
    "it_codigo:s familia:s",
    """select cast(p_partkey as varchar) as it_codigo,
              case when p_type in ('PROMO', 'SMALL') then 'SEM FAMILIA' else p_type end as familia from part""",
)
def _(t):
    kind = F.col("p_type")
    label = F.when(kind == "PROMO", "  ").when(kind != "SMALL", F.concat(F.lit(" "), kind))
    return t.raw("part").select(text("p_partkey").alias("it_codigo"), cln.default_label(label).alias("familia"))


@query(
    "derived_columns",
    "empresa:s nr:i item:i seq:i total:d",
    f"select 'c1' as empresa, nr, item, seq, qt * amount as total from ({_NUMBER_SQL}) x",
)
def _(t):
    priced = t.raw("lineitem").select(
        F.lit(COMPANY).alias("empresa"), F.col("l_orderkey").alias("nr"), F.col("l_partkey").alias("item"),
        F.col("l_linenumber").alias("seq"), F.col("l_quantity").cast("decimal(16,4)").alias("qt"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("preco"),
    )
    return priced.withColumn("total", cln.line_value("qt", "preco"))


# ------------------------------------------------------------ filters and scans

_SALES_COLUMNS = "estabel:s nr_nota:s nr_pedido:s cod_cliente:s cod_vendedor:s it_codigo:s qt_caixas:d valor:d tipo:s familia:s data_emissao:s"


@query("in_period", _SALES_COLUMNS, "select * from period")
def _(t):
    return filters.in_period(t.sales, "data_emissao", START, END)


@query("for_seller", _SALES_COLUMNS, f"select * from sales where cod_vendedor = '{SELLER}'")
def _(t):
    return filters.for_seller(t.sales, SELLER)


@query(
    "for_listed_sellers",
    _SALES_COLUMNS,
    "select * from period where cod_vendedor in (select cod_vendedor from sellers where not ativo)",
)
def _(t):
    return filters.for_listed(
        filters.in_period(t.sales, "data_emissao", START, END), "cod_vendedor", t.sellers.filter(~F.col("ativo"))
    )


_SCAN_COLUMNS = (
    "nome_abrev:s nr_pedcli:s cod_emitente:s nr_sequencia:i it_codigo:s qt_pedida:d preco_venda:d "
    "valor_total_venda:d dt_venda:s representante:s situacao_pedido:i"
)
_SCOPE_SQL = """representante not in ('REMESSA POLP', 'TRANSFERENCI', 'LOGISTICA') and nome_abrev <> 'CLI 1'
    and it_codigo not like '60.%' and it_codigo not like '09.%' and it_codigo not like 'A%' and situacao_pedido <> 6
    and nr_pedcli >= '6003' and nr_pedcli < '6008'"""
SCOPE = filters.OrderScope(excluded_customers=("CLI 1",), rep_range=(6003, 6008))


@query("order_scope_filter", _SCAN_COLUMNS, f"select * from scan where {_SCOPE_SQL}")
def _(t):
    joined = t.scan_order_items.join(t.scan_orders, ["nome_abrev", "nr_pedcli"]).withColumn(
        "valor_total_venda", cln.line_value("qt_pedida", "preco_venda")
    )
    return filters.order_scope_filter(joined, SCOPE)


@query(
    "order_item_scan",
    _SCAN_COLUMNS + " descricao_1:s descricao_2:s",
    f"""select s.*, p.p_name as descricao_1, p.p_brand as descricao_2
        from (select * from scan where {_SCOPE_SQL}) s left join part p on cast(p.p_partkey as varchar) = s.it_codigo
        where dt_venda between date '1998-01-01' and date '1998-01-31'""",
)
def _(t):
    return scans.order_item_scan(t.scan_order_items, t.scan_orders, t.scan_items, START, END, SCOPE)


@query(
    "invoice_line_scan",
    "nr_nota_fis:s nr_seq_fat:i it_codigo:s vl_merc_liq:d cd_emitente:s",
    """select nr as nr_nota_fis, seq as nr_seq_fat, item as it_codigo, liquido as vl_merc_liq, cliente as cd_emitente
       from order_lines where data_pedido between date '1998-01-01' and date '1998-01-31'""",
)
def _(t):
    headers = t.raw("orders").select(
        F.lit("1").alias("cod_estabel"), F.lit("U").alias("serie"), text("o_orderkey").alias("nr_nota_fis"),
        F.to_date("o_orderdate").alias("dt_emis_nota"),
    )
    lines = t.invoice_lines.withColumn("cod_estabel", F.lit("1"))
    return scans.invoice_line_scan(headers, lines, START, END)


@query(
    "search_customers",
    "cod_cliente:s nome:s cnpj:s",
    "select * from customers where nome ilike '%MER_%01%' or cod_cliente ilike '%MER_%01%' or cnpj ilike '%MER_%01%'",
)
def _(t):
    return filters.search_customers(t.customers, " mer_%01 ")


@query(
    "spans_overlapping",
    "id:i nome:s data_inicio:s data_fim:s",
    "select * from campaigns where data_fim >= date '1998-01-01' and data_inicio <= date '1998-01-31'",
)
def _(t):
    return filters.spans_overlapping(t.campaigns, START, END)


@query(
    "rows_visible_to",
    _SALES_COLUMNS,
    """select p.* from period p, supplier u where u.s_suppkey = 7
       and (u.s_nationkey = 0 or p.cod_vendedor = cast(u.s_suppkey as varchar))""",
)
def _(t):
    return filters.rows_visible_to(
        filters.in_period(t.sales, "data_emissao", START, END), t.users, f"{SELLER}@example.com"
    )


@query(
    "latest_row",
    "nr:i cliente:i dia:s",
    """select o_orderkey as nr, o_custkey as cliente, cast(o_orderdate as date) as dia
       from orders order by o_orderdate desc, o_orderkey desc limit 1""",
)
def _(t):
    headers = t.raw("orders").select(
        F.col("o_orderkey").alias("nr"), F.col("o_custkey").alias("cliente"), F.to_date("o_orderdate").alias("dia")
    )
    return scans.latest_row(headers, "dia", "nr")


# ---------------------------------------------------------------------- marts


@query(
    "classify_operations",
    "empresa:s nat_operacao:s cfop:s tipo:s",
    """select 'c1' as empresa, cast(p_partkey as varchar) as nat_operacao,
              case when p_type = 'SMALL' then '' else '5.' || p_type end as cfop,
              case when p_brand = 'Brand#1' then 'bonificacao'
                   when p_size between 17 and 22 or p_size between 29 and 40 then 'bonificacao'
                   when p_size between 9 and 16 then 'devolucao'
                   when p_size <= 8 and p_type <> 'PROMO' then 'venda'
                   else 'ignorar' end as tipo
       from part""",
)
def _(t):
    return marts.classify_operations(t.part_operations)


@query(
    "movement_distribution",
    "tipo:s qtd:i",
    """select tipo, count(*) as qtd from (
         select case when p_brand = 'Brand#1' or p_size between 17 and 22 or p_size between 29 and 40 then 'bonificacao'
                     when p_size between 9 and 16 then 'devolucao'
                     when p_size <= 8 and p_type <> 'PROMO' then 'venda' else 'ignorar' end as tipo from part) x
       group by 1""",
)
def _(t):
    return marts.movement_distribution(marts.classify_operations(t.part_operations))


@query("build_products", "empresa:s it_codigo:s descricao:s familia:s", "select 'c1' as empresa, * from products")
def _(t):
    return t.build_products()


@query(
    "build_customers",
    "empresa:s cod_cliente:s nome:s cnpj:s canal:s cidade:s uf:s cod_vendedor:s limite_credito:d credito_suspenso:b",
    "select * from customers",
)
def _(t):
    return t.build_customers()


@query(
    "build_sellers",
    "empresa:s cod_vendedor:s nome:s ativo:b rep_indireto:s regiao:s",
    "select * from sellers",
)
def _(t):
    return t.build_sellers()


@query("build_sales", _SALES_COLUMNS + " carregado_em:s",
       "select * replace (strftime(carregado_em, '%Y-%m-%d %H:%M:%S') as carregado_em) from sales")
def _(t):
    return t.build_sales()


@query(
    "build_sales_without_cancelled",
    "tipo:s linhas:i valor:d qt_caixas:d",
    """select t.tipo, count(*) as linhas, sum(cast(abs(round(g.liquido, 2)) as decimal(14,2))) as valor, sum(g.qt) as qt_caixas
       from (select estabel, nr, item, cliente, max(operacao) as operacao, sum(qt) as qt, sum(liquido) as liquido
             from order_lines where not (o_orderstatus = 'P' and o_orderpriority = '5-LOW') and emissao >= date '1997-01-01'
             group by all) g
       join type_map t on t.nat_operacao = g.operacao group by 1""",
)
def _(t):
    built = marts.build_sales(
        t.cancellable_lines, t.type_map, t.customers, t.seller_map, t.products, since="1997-01-01",
        loaded_at=F.col("dt_emis_nota"),
    )
    return built.groupBy("tipo").agg(
        F.count(F.lit(1)).alias("linhas"), F.sum("valor").alias("valor"), F.sum("qt_caixas").alias("qt_caixas")
    )


@query(
    "unmapped_operations",
    "empresa:s nat_operacao:s qtd:i",
    """select 'c1' as empresa, operacao as nat_operacao, count(*) as qtd from order_lines
       where operacao = 'A' and emissao >= date '1997-01-01' and not (o_orderstatus = 'P' and o_orderpriority = '5-LOW')
       group by all order by qtd desc, operacao limit 20""",
)
def _(t):
    return marts.unmapped_operations(
        t.cancellable_lines, t.type_map.filter(F.col("tipo") != "bonificacao"), "1997-01-01"
    )


@query(
    "products_from_export",
    "empresa:s it_codigo:s descricao:s familia:s",
    """select 'c1' as empresa, p_brand as it_codigo, max(p_name) as descricao,
              coalesce(nullif(max(case when p_type = 'SMALL' then null else p_type end), ''), 'SEM FAMILIA') as familia
       from part where p_brand is not null group by p_brand""",
)
def _(t):
    raw = t.raw("part").select(
        F.col("p_brand").alias("it_codigo"),
        F.col("p_name").alias("descricao"),
        F.when(F.col("p_type") != "SMALL", F.concat(F.lit(" "), "p_type")).alias("familia"),
    )
    return marts.products_from_export(raw, COMPANY)


@query(
    "customers_from_export",
    "empresa:s cod_cliente:s nome:s cnpj:s canal:s cidade:s uf:s cod_vendedor:s limite_credito:d credito_suspenso:b",
    """select 'c1' as empresa, cast(o_custkey as varchar) as cod_cliente, max('NOME ' || o_orderpriority) as nome,
              max(lpad(cast(o_orderkey as varchar), 14, '0')) as cnpj,
              nullif(max(case when o_orderstatus = 'F' then '' else o_orderpriority end), '') as canal,
              null as cidade, null as uf,
              max(cast(o_orderkey % 10 as varchar)) as cod_vendedor,
              coalesce(max(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(14,2)) end), 0) as limite_credito,
              false as credito_suspenso
       from orders group by o_custkey""",
)
def _(t):
    delivered = F.col("o_orderstatus") == "F"
    raw = t.raw("orders").select(
        text("o_custkey").alias("cod_cliente"),
        F.concat((F.col("o_orderkey") % 10).cast("string"), F.lit(" ")).alias("cod_erc"),
        F.concat(F.lit("NOME "), "o_orderpriority").alias("nome"),
        F.when(delivered, " ").otherwise(F.col("o_orderpriority")).alias("canal"),
        F.lpad(text("o_orderkey"), 14, "0").alias("cnpj"),
        F.when(delivered, F.col("o_totalprice").cast("decimal(16,4)")).alias("limite_disp"),
    )
    return marts.customers_from_export(raw, COMPANY)


@query(
    "sales_from_export",
    _SALES_COLUMNS,
    """select max(l.estabel) as estabel, l.nr as nr_nota,
              max(case when l.estabel = 'O' then l.nr end) as nr_pedido, l.cliente as cod_cliente, max(l.rep) as cod_vendedor,
              l.item as it_codigo, cast(sum(l.qt) as decimal(12,2)) as qt_caixas,
              cast(abs(round(sum(case when l.operacao = 'R' then -l.liquido else l.liquido end), 2)) as decimal(14,2)) as valor,
              case when sum(case when l.operacao = 'R' then -l.liquido else l.liquido end) < 0 then 'devolucao' else 'venda' end as tipo,
              max(p.familia) as familia, max(l.emissao) as data_emissao
       from order_lines l join products p on p.it_codigo = l.item group by l.nr, l.item, l.cliente""",
)
def _(t):
    return marts.sales_from_export(t.invoice_export, t.products, COMPANY)


@query(
    "orders_from_export",
    "nr_pedido:s it_codigo:s cod_cliente:s cod_vendedor:s qt_caixas:d valor:d tipo:s status_item:s status_grupo:s "
    "motivo_corte:s familia:s data_pedido:s campanha:s",
    "select * from order_mart",
)
def _(t):
    return t.build_orders()


_GOAL_COLUMNS = (
    "cod_vendedor:s mes:s meta_visitas:i meta_positivados:i meta_cadastros:i fase:i meta_faturamento:d meta_caixas:d"
)


@query("build_goal_table", _GOAL_COLUMNS, "select * from goals")
def _(t):
    return t.goals


# ------------------------------------------------------------ sales indicators

_SUMMARY_COLUMNS = (
    "faturamento_total:d devolucoes:d caixas_total:d caixas_bonificadas:d pedidos:i notas:i clientes_positivados:i linhas_pedido:i"
)


@query("sales_summary", _SUMMARY_COLUMNS, "select * from summary")
def sales_summary(t):
    return sales.sales_summary(t.sales, START, END)


@query(
    "sales_summary_of_seller",
    _SUMMARY_COLUMNS,
    f"{VIEWS['summary']} where cod_vendedor = '{SELLER}'",
)
def _(t):
    return sales.sales_summary(t.sales, START, END, SELLER, COMPANY)


_RATIO_SQL = """
    select case when pedidos > 0 then round(cast(linhas_pedido / pedidos as decimal(38,10)), 1) else 0 end as media_skus_pedido,
           case when pedidos > 0 then round(cast(faturamento_total / pedidos as decimal(38,10)), 2) else 0 end as ticket_medio,
           case when caixas_total - caixas_bonificadas > 0
                then round(cast(faturamento_total / (caixas_total - caixas_bonificadas) as decimal(38,10)), 2) else 0 end as preco_medio_caixa,
           case when pedidos > 0 then round(cast(caixas_total / pedidos as decimal(38,10)), 1) else 0 end as drop_size
    from summary"""


@query("sales_ratios", "media_skus_pedido:d ticket_medio:d preco_medio_caixa:d drop_size:d", _RATIO_SQL)
def _(t):
    return sales.sales_ratios(sales_summary(t))


@query(
    "empty_period",
    "faturamento_total:d caixas_total:d pedidos:i media_skus_pedido:d ticket_medio:d",
    """select coalesce(sum(valor), 0) as faturamento_total, coalesce(sum(qt_caixas), 0) as caixas_total,
              count(distinct nr_pedido) as pedidos, 0 as media_skus_pedido, 0 as ticket_medio
       from sales where data_emissao between date '2010-01-01' and date '2010-01-31'""",
)
def _(t):
    empty = sales.sales_summary(t.sales, "2010-01-01", "2010-01-31")
    ratios = sales.sales_ratios(empty)
    return empty.select(
        "faturamento_total", "caixas_total", "pedidos",
        ratios.select("media_skus_pedido").scalar().alias("media_skus_pedido"),
        ratios.select("ticket_medio").scalar().alias("ticket_medio"),
    )


@query("previous_period", "faturamento_total:d caixas_total:d clientes_positivados:i", "select * from before")
def previous_period(t):
    return sales.previous_period(t.sales, START, END)


@query("today_totals", "faturamento_hoje:d caixas_hoje:d", "select * from today")
def today_totals(t):
    return sales.today_totals(t.sales, AS_OF)


@query(
    "data_freshness",
    "dados_ate:s",
    "select strftime(max(carregado_em), '%Y-%m-%d %H:%M:%S') as dados_ate from sales",
)
def _(t):
    return sales.data_freshness(t.sales)


@query(
    "customer_recency",
    "cod_cliente:s nome:s cod_vendedor:s limite_credito:d credito_suspenso:b ultima_compra:s dias_sem_compra:i faturamento_6m:d",
    "select * from recency",
)
def recency(t):
    return portfolio.customer_recency(t.customers, t.sales, AS_OF)


@query(
    "portfolio_summary",
    "total:i ativos:i inativos:i nunca_compraram:i pct_ativos:d pct_positivacao:d limite_credito_total:d suspensos:i limite_suspenso:d",
    "select * from portfolio",
)
def portfolio_summary(t):
    return portfolio.portfolio_summary(recency(t), sales_summary(t))


@query(
    "cooling_customers",
    "cod_cliente:s nome:s cod_vendedor:s dias_sem_compra:i faturamento_6m:d",
    "select * from recency where dias_sem_compra between 31 and 90 order by faturamento_6m desc, cod_cliente limit 10",
)
def _(t):
    return portfolio.cooling_customers(recency(t))


@query("by_channel", "canal:s qtd:i pct:d faturamento:d caixas:d", "select * from channels")
def by_channel(t):
    return sales.by_channel(t.customers, t.sales, START, END)


@query(
    "by_seller",
    "cod_vendedor:s nome:s faturamento:d caixas:d positivados:i pedidos:i",
    "select * from seller_totals",
)
def by_seller(t):
    return sales.by_seller(t.sales, t.sellers, START, END)


@query("by_family", "familia:s faturamento:d caixas:d pdvs:i", "select * from family_totals")
def by_family(t):
    return sales.by_family(t.sales, t.products, START, END)


@query("by_day", "dia:s faturamento:d caixas:d", "select * from day_totals")
def by_day(t):
    return sales.by_day(t.sales, START, END)


@query(
    "by_campaign",
    "id:i nome:s data_inicio:s data_fim:s mecanica:s faturamento:d caixas:d",
    "select * from campaign_totals",
)
def by_campaign(t):
    return sales.by_campaign(t.campaigns, t.tagged_sales, START, END)


@query("registrations_by_seller", "cod_vendedor:s qtd:i", "select * from registration_counts")
def registrations(t):
    return sales.registrations_by_seller(t.registered, START, END, "crm")


_ACTUAL_COLUMNS = (
    "cod_vendedor:s nome:s meta_visitas:i meta_positivados:i meta_cadastros:i meta_faturamento:d meta_caixas:d fase:i "
    "real_visitas:i real_positivados:i real_cadastros:i real_faturamento:d real_caixas:d"
)


@query("goals_vs_actuals", _ACTUAL_COLUMNS, "select * from goal_actuals")
def goals_vs_actuals(t):
    return sales.goals_vs_actuals(t.goals, t.users, t.sales, t.visits, START, END, registrations=registrations(t))


@query("visit_summary", "checkins:i realizadas:i agendadas:i pendentes:i", "select * from visit_totals")
def visit_summary(t):
    return sales.visit_summary(t.visits, t.agenda, START, END)


# ------------------------------------------------------------ order indicators


@query("open_backlog", "valor:d caixas:d pedidos:i itens:i", "select * from backlog")
def open_backlog(t):
    return orders.open_backlog(t.orders)


@query("fill_rate", "caixas_faturadas:d caixas_cortadas:d valor_cortado:d pct:d", "select * from filled")
def fill_rate(t):
    return orders.fill_rate(t.orders, START, END)


@query("cuts_by_reason", "motivo:s caixas:d valor:d", "select * from reasons")
def cuts_by_reason(t):
    return orders.cuts_by_reason(t.orders, START, END)


@query("backlog_by_seller", "cod_vendedor:s nome:s valor:d caixas:d pedidos:i", "select * from seller_backlog")
def backlog_by_seller(t):
    return orders.backlog_by_seller(t.orders, t.sellers)


# ---------------------------------------------------------------- field force


@query(
    "recent_visits",
    "id:s cod_cliente:s nome_cliente:s cod_vendedor:s status_visita:s observacao:s",
    f"""select * from visits where cod_vendedor = '{SELLER}' and dia_local between date '1998-01-01' and date '1998-01-31'
        order by hora_local desc, id limit 200""",
)
def _(t):
    return field.recent_visits(t.visits, START, END, SELLER)


@query("month_goals", _GOAL_COLUMNS, "select * from goals where mes = '1998-01'")
def _(t):
    return field.month_goals(t.goals, START)


@query(
    "visits_vs_goal",
    "cod_vendedor:s mes:s visitas:i meta_visitas:i",
    """select g.cod_vendedor, g.mes, count(v.id) as visitas, g.meta_visitas
       from goals g left join visits v on v.cod_vendedor = g.cod_vendedor
            and v.dia_local between date '1998-01-01' and date '1998-01-31'
       where g.mes = '1998-01' group by all""",
)
def _(t):
    return field.visits_vs_goal(t.visits, t.goals, START, END)


@query(
    "customer_list",
    "cod_cliente:s nome:s cnpj:s canal:s cidade:s uf:s cod_vendedor:s limite_credito:d credito_suspenso:b",
    "select * from customers where canal = 'MACHINERY' order by nome nulls last, cod_cliente limit 500",
)
def _(t):
    return portfolio.customer_list(t.customers, COMPANY, channel="MACHINERY")


_PILOT_COLUMNS = "pedidos_itens:i pedidos_valor:d cadastros:i checkins:i"


@query("pilot_comparison", "cod_rep:s nome:s " + _PILOT_COLUMNS, "select * from pilot_rows")
def pilot_comparison(t):
    pilot = t.reps.filter(F.col("nome_ab_reg") == "ASIA").select(
        "cod_rep", "nome", (F.col("cod_rep").cast("bigint") * 2).cast("string").alias("cod_vendedor_crm")
    )
    items = t.scan_order_items.join(t.scan_orders, ["nome_abrev", "nr_pedcli"]).withColumn(
        "valor_total_venda", cln.line_value("qt_pedida", "preco_venda")
    )
    registered = t.registered.select(F.col("cod_vendedor").alias("cod_rep"))
    return field.pilot_comparison(pilot, items, t.reps, registered, t.visits)


@query(
    "pilot_totals",
    _PILOT_COLUMNS,
    """select coalesce(sum(pedidos_itens), 0) as pedidos_itens, coalesce(sum(pedidos_valor), 0) as pedidos_valor,
              coalesce(sum(cadastros), 0) as cadastros, coalesce(sum(checkins), 0) as checkins from pilot_rows""",
)
def _(t):
    return field.pilot_totals(pilot_comparison(t))


def _requests(t):
    """Customers of the given table ask to be registered; some requests are faulty."""
    key = F.col("c_custkey")
    balance = F.col("c_acctbal")
    return t.raw("customer").select(
        F.when(F.col("c_mktsegment") == "MACHINERY", text("c_custkey"))
        .otherwise(F.concat(F.lit(" N"), text("c_nationkey"), F.lit("-"), text("c_mktsegment"))).alias("cod_cliente"),
        F.when(F.col("c_nationkey") != 3, F.col("c_name")).alias("nome"),
        F.when(balance < 0, "12.345/67").when(balance > 5000, F.lpad(text("c_custkey"), 14, "0")).alias("cnpj"),
        F.lower("c_mktsegment").alias("canal"),
        F.lit(None).cast("string").alias("cidade"),
        F.lit("spx").alias("uf"),
        F.when(balance > 8000, "9").alias("cod_vendedor"),
        balance.cast("decimal(14,2)").cast("string").alias("limite_credito"),
        key.alias("ordem"),
    )


_REQUEST_SQL = """
    select c_custkey as ordem, c_mktsegment, c_nationkey, c_name, c_acctbal,
           case when c_mktsegment = 'MACHINERY' then cast(c_custkey as varchar) else 'N' || c_nationkey || '-' || c_mktsegment end as chave,
           case when c_nationkey = 3 then 'campo obrigatorio' when c_acctbal < 0 then 'cnpj invalido' end as motivo
    from customer"""


@query(
    "register_customers",
    "cod_cliente:s nome:s cnpj:s canal:s uf:s cod_vendedor:s limite_credito:d",
    f"""select chave as cod_cliente, c_name as nome, case when c_acctbal > 5000 then lpad(cast(ordem as varchar), 14, '0') end as cnpj,
               lower(c_mktsegment) as canal, 'SP' as uf, case when c_acctbal > 8000 then '9' else '{SELLER}' end as cod_vendedor,
               cast(c_acctbal as decimal(14,2)) as limite_credito
        from ({_REQUEST_SQL}) r
        where motivo is null and c_mktsegment <> 'MACHINERY'
        qualify row_number() over (partition by chave order by ordem) = 1""",
)
def _(t):
    return field.register_customers(_requests(t), t.customers, COMPANY, SELLER)[0]


@query(
    "rejected_registrations",
    "ordem:i motivo:s",
    f"""select ordem, coalesce(motivo, 'codigo ja existe') as motivo from (
          select *, row_number() over (partition by chave, motivo is null order by ordem) as n from ({_REQUEST_SQL}) r) x
        where motivo is not null or c_mktsegment = 'MACHINERY' or n > 1""",
)
def _(t):
    return field.register_customers(_requests(t), t.customers, COMPANY, SELLER)[1]


def _changes(t):
    """Orders as changes of their customer's channel, limit or owner."""
    kind = F.col("o_orderpriority")
    known = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("X"), text("o_custkey"))).otherwise(text("o_custkey"))
    return t.raw("orders").select(
        F.when(kind != "5-LOW", known).alias("cod_cliente"),
        F.when(kind == "1-URGENT", F.concat(F.lit("CANAL "), text("o_orderkey"))).otherwise("").alias("canal"),
        F.when(kind == "2-HIGH", F.lit("0")).alias("limite_credito"),
        F.when(kind == "3-MEDIUM", text("o_orderkey")).alias("cod_vendedor"),
        F.col("o_orderkey").alias("ordem"),
    )


@query(
    "apply_customer_changes",
    "cod_cliente:s nome:s canal:s cod_vendedor:s limite_credito:d",
    """select c.cod_cliente, c.nome, coalesce(x.canal, c.canal) as canal, coalesce(x.dono, c.cod_vendedor) as cod_vendedor,
              case when x.zerado then 0 else c.limite_credito end as limite_credito
       from customers c left join (
         select cast(o_custkey as varchar) as cod_cliente,
                'CANAL ' || max(o_orderkey) filter (where o_orderpriority = '1-URGENT') as canal,
                cast(max(o_orderkey) filter (where o_orderpriority = '3-MEDIUM') as varchar) as dono,
                count(*) filter (where o_orderpriority = '2-HIGH') > 0 as zerado
         from orders where o_orderstatus <> 'P' group by 1) x on x.cod_cliente = c.cod_cliente""",
)
def _(t):
    return field.apply_customer_changes(_changes(t), t.customers, COMPANY)[0]


@query(
    "rejected_changes",
    "ordem:i motivo:s",
    """select o_orderkey as ordem, case when o_orderpriority = '5-LOW' then 'cod_cliente obrigatorio'
              when o_orderpriority = '4-NOT SPECIFIED' then 'nada para atualizar' else 'cliente nao encontrado' end as motivo
       from orders where o_orderpriority in ('5-LOW', '4-NOT SPECIFIED') or o_orderstatus = 'P'""",
)
def _(t):
    return field.apply_customer_changes(_changes(t), t.customers, COMPANY)[1]


# ------------------------------------------------------------ derived indicators

# Whole percent, halves up.
_WHOLE = "cast(floor(cast(100 * ({a}) / ({b}) as decimal(38,10)) + 0.5) as bigint)"


@query(
    "month_end_projection",
    "faturamento_total:d projecao:d",
    "select faturamento_total, round(cast(faturamento_total / 31 * 31 as decimal(38,10)), 2) as projecao from summary",
)
def _(t):
    return indicators.month_end_projection(sales_summary(t), START, AS_OF)


@query(
    "change_vs_previous",
    "atual:d anterior:d variacao_pct:d",
    """select s.caixas_total as atual, b.caixas_total as anterior, case when b.caixas_total > 0 then
              round(cast(100 * (s.caixas_total - b.caixas_total) / b.caixas_total as decimal(38,10)), 1) end as variacao_pct
       from summary s, before b""",
)
def _(t):
    return indicators.change_vs_previous(sales_summary(t), previous_period(t), "caixas_total")


@query(
    "credit_use",
    "faturamento_total:d limite_credito_total:d uso_limite_pct:i",
    f"""select s.faturamento_total, p.limite_credito_total,
               {_WHOLE.format(a="s.faturamento_total", b="p.limite_credito_total")} as uso_limite_pct
        from summary s, portfolio p""",
)
def _(t):
    return indicators.credit_use(sales_summary(t), portfolio_summary(t))


@query(
    "share_of_leader",
    "cod_vendedor:s faturamento:d pct_lider:i",
    f"""select cod_vendedor, faturamento,
               {_WHOLE.format(a="faturamento", b="(select greatest(max(faturamento), 1) from seller_totals)")} as pct_lider
        from seller_totals""",
)
def _(t):
    return indicators.share_of_leader(by_seller(t), "faturamento")


_GOAL_NAMES = ["visitas", "positivados", "cadastros", "faturamento", "caixas"]


@query(
    "goal_attainment",
    "cod_vendedor:s " + " ".join(f"pct_{n}:i faixa_{n}:s" for n in _GOAL_NAMES),
    "select *, "
    + ", ".join(
        f"case when pct_{n} >= 100 then 'good' when pct_{n} >= 70 then 'warning' when pct_{n} is not null then 'critical' end as faixa_{n}"
        for n in _GOAL_NAMES
    )
    + " from (select cod_vendedor, "
    + ", ".join(
        f"case when meta_{n} > 0 then {_WHOLE.format(a=f'real_{n}', b=f'meta_{n}')} end as pct_{n}" for n in _GOAL_NAMES
    )
    + " from goal_actuals) g",
)
def _(t):
    return indicators.goal_attainment(goals_vs_actuals(t))


@query(
    "fill_rate_band",
    "pct:d faixa:s",
    "select pct, case when pct >= 95 then 'good' when pct >= 85 then 'warning' when pct is not null then 'critical' end as faixa from filled",
)
def _(t):
    return indicators.fill_rate_band(fill_rate(t))


@query(
    "top_cut_reasons",
    "motivo:s caixas:d valor:d",
    "select * from reasons order by caixas desc, motivo limit 8",
)
def _(t):
    return indicators.top_cut_reasons(cuts_by_reason(t))


@query("inactive_share", "pct_ativos:d pct_inativos:d", "select pct_ativos, 100 - pct_ativos as pct_inativos from portfolio")
def _(t):
    return indicators.inactive_share(portfolio_summary(t))


@query(
    "month_range",
    "nr:i inicio:s fim:s",
    """select o_orderkey as nr, cast(date_trunc('month', o_orderdate) as date) as inicio, last_day(o_orderdate) as fim
       from orders""",
)
def _(t):
    dated = t.raw("orders").select(F.col("o_orderkey").alias("nr"), F.to_date("o_orderdate").alias("dia"))
    return indicators.month_range(dated, "dia")


# ------------------------------------------------------------------- monitoring

@query(
    "recent_runs",
    "id:i tarefa:s status:s registros:i mensagem:s inicio:s fim:s segundos:i",
    """select id, tarefa, status, registros, mensagem, strftime(iniciado_em, '%d/%m %H:%M:%S') as inicio,
              strftime(finalizado_em, '%H:%M:%S') as fim,
              cast(round(cast(epoch_us(coalesce(finalizado_em, timestamp '2024-02-01 00:00:00')) - epoch_us(iniciado_em) as decimal(20,0)) / 1000000) as bigint) as segundos
       from run_log order by iniciado_em desc, id desc limit 30""",
)
def _(t):
    return monitoring.recent_runs(t.run_log, F.to_timestamp(F.lit("2024-02-01 00:00:00")))


@query("running_now", "id:i tarefa:s registros:i", "select * from run_log where status = 'RODANDO'")
def _(t):
    return monitoring.running_now(t.run_log)


@query(
    "recent_failures",
    "id:i tarefa:s mensagem:s",
    "select * from run_log where status = 'ERRO' order by iniciado_em desc, id desc limit 20",
)
def _(t):
    return monitoring.recent_failures(t.run_log)


@query(
    "mart_volume",
    "tabela:s linhas:i ate:s",
    """select 'vendas' as tabela, count(*) as linhas, cast(max(data_emissao) as varchar) as ate from sales
       union all select 'pedidos', count(*), cast(max(data_pedido) as varchar) from order_mart
       union all select 'clientes', count(*), null from customers
       union all select 'produtos', count(*), null from products""",
)
def _(t):
    return monitoring.mart_volume(
        {
            "vendas": (t.sales, "data_emissao"),
            "pedidos": (t.orders, "data_pedido"),
            "clientes": (t.customers, None),
            "produtos": (t.products, None),
        }
    )


@query(
    "profile_source",
    "tabela:s linhas:i ate:s",
    """select 'headers' as tabela, count(*) as linhas, cast(cast(max(o_orderdate) as date) as varchar) as ate from orders
       union all select 'lines', count(*), null from lineitem
       union all select 'parties', count(*), null from customer
       union all select 'items', count(*), null from part
       union all select 'reps', count(*), null from supplier""",
)
def _(t):
    headers = t.raw("orders").select(F.to_date("o_orderdate").alias("dia"))
    others = {"lines": "lineitem", "parties": "customer", "items": "part", "reps": "supplier"}
    return monitoring.profile_source(headers, {n: t.raw(source) for n, source in others.items()}, "dia")


@query(
    "source_sample",
    "nr:i cliente:i",
    "select o_orderkey as nr, o_custkey as cliente from orders order by o_orderkey limit 5",
)
def _(t):
    headers = t.raw("orders").select(F.col("o_orderkey").alias("nr"), F.col("o_custkey").alias("cliente"))
    return monitoring.source_sample(headers, ["nr"])


@query("distinct_codes", "cod_estabel:s", "select distinct estabel as cod_estabel from order_lines")
def _(t):
    return monitoring.distinct_codes(t.invoice_lines, "cod_estabel")


@query(
    "contract_checks",
    "regra:s violacoes:i",
    """select 'not_null:cod_vendedor' as regra, count(*) filter (where cod_vendedor is null) as violacoes from sales
       union all select 'domain:tipo', count(*) filter (where tipo not in ('venda', 'devolucao')) from sales
       union all select 'not_negative:valor', count(*) filter (where valor < 0) from sales
       union all select 'unique:nr_nota+it_codigo', count(*) - count(distinct (nr_nota, it_codigo)) from sales""",
)
def _(t):
    return monitoring.contract_checks(t.sales, SALES_RULES)


SALES_RULES = monitoring.Contract(
    key=("nr_nota", "it_codigo"),
    filled=("cod_vendedor",),
    domains={"tipo": ("venda", "devolucao")},
    not_negative=("valor",),
)


@query(
    "quarantine",
    "nr_nota:s it_codigo:s estabel:s regras:s",
    "select nr_nota, it_codigo, estabel, 'domain:tipo' as regras from sales where tipo = 'bonificacao'",
)
def _(t):
    bad = monitoring.quarantine(t.sales, SALES_RULES)
    return bad.withColumn("regras", F.array_join("regras", ","))


@query(
    "reconcile_day",
    "dia:s nosso:d externo:d diferenca:d",
    """select d.dia, d.faturamento as nosso, x.faturamento as externo, d.faturamento - x.faturamento as diferenca
       from day_totals d join (select emissao as dia, sum(liquido) as faturamento from order_lines group by 1) x on x.dia = d.dia
       where d.dia = date '1998-01-31'""",
)
def _(t):
    outside = t.order_lines.groupBy(F.col("emissao").alias("dia")).agg(F.sum("liquido").alias("faturamento"))
    return monitoring.reconcile_day(by_day(t), outside, AS_OF)


# -------------------------------------------------------------- load strategies


def _halves(t):
    """Customers in two overlapping loads: the second is newer and has fewer channels."""
    base = t.customers.select("empresa", "cod_cliente", "nome", "canal", "limite_credito")
    old = base.filter(F.col("canal").isNull() | (F.col("canal") != "BUILDING"))
    new = base.filter(F.col("canal").isin("BUILDING", "MACHINERY")).withColumn("nome", F.concat(F.lit("NOVO "), "nome")).withColumn(
        "limite_credito", F.lit(1).cast("decimal(16,2)")
    )
    return old, new


_KEY = ["cod_cliente", "empresa"]
_HALF_COLUMNS = "cod_cliente:s nome:s canal:s limite_credito:d"


@query(
    "upsert",
    _HALF_COLUMNS,
    """select cod_cliente, case when canal in ('BUILDING', 'MACHINERY') then 'NOVO ' || nome else nome end as nome, canal,
              case when canal in ('BUILDING', 'MACHINERY') then 1 else limite_credito end as limite_credito from customers""",
)
def _(t):
    old, new = _halves(t)
    return sinks.upsert(old, new, _KEY)


@query(
    "upsert_columns",
    _HALF_COLUMNS,
    """select cod_cliente, case when canal in ('BUILDING', 'MACHINERY') then 'NOVO ' || nome else nome end as nome, canal,
              case when canal = 'BUILDING' then 1 else limite_credito end as limite_credito from customers""",
)
def _(t):
    old, new = _halves(t)
    return sinks.upsert_columns(old, new, _KEY, ["nome"])


@query(
    "insert_new",
    _HALF_COLUMNS,
    """select cod_cliente, case when canal = 'BUILDING' then 'NOVO ' || nome else nome end as nome, canal,
              case when canal = 'BUILDING' then 1 else limite_credito end as limite_credito from customers""",
)
def _(t):
    old, new = _halves(t)
    return sinks.insert_new(old, new, _KEY)


@query(
    "latest_per_key",
    "cod_cliente:s nr:i valor:d",
    """select cast(o_custkey as varchar) as cod_cliente, o_orderkey as nr, cast(o_totalprice as decimal(14,2)) as valor
       from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""",
)
def _(t):
    changes = t.raw("orders").select(
        text("o_custkey").alias("cod_cliente"), F.col("o_orderdate").alias("quando"), F.col("o_orderkey").alias("nr"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("valor"),
    )
    return sinks.latest_per_key(changes, ["cod_cliente"], "quando")
