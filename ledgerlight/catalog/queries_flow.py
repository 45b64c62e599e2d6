"""Boards, load strategies, refresh jobs and streams as queries.

The ones that write do so in a new folder under the session's shared folder and
return what they read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.measures import local_day
from ..plans.boards import SalesMarts, board_document, board_lines, board_measures, orders_board, sales_board
from ..plans.pipelines import Lake, refresh_from_exports, refresh_full, refresh_window
from ..schemas import LOCAL_ZONE, VISITS
from ..sinks import field_app
from ..sinks import tables as sinks
from ..sinks.shuffles import cleaned_shuffles
from ..sources.exports import EXPORTS, read_export
from ..sources.landing import read_field_app, read_seed_types
from ..streaming import visits as visit_stream
from .registry import query
from .stage import shared_folder
from .tables import AS_OF, COMPANY, END, START


def _new_folder(t, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex[:12]}"


# ---------------------------------------------------------------------- boards


def _sales_board(t):
    marts = SalesMarts(
        t.sales, t.customers, t.sellers, t.products, t.goals, t.users, t.visits, t.agenda, t.campaigns,
        t.tagged_sales, t.registered, t.rollups, t.campaign_days,
    )
    return sales_board(marts, START, END, AS_OF)


def _orders_board(t):
    return orders_board(t.orders, t.sellers, START, END)


_SALES_PARTS = {
    "anterior": ("before", "''", ["faturamento_total", "caixas_total", "clientes_positivados"]),
    "resumo": (
        "summary", "''",
        ["faturamento_total", "devolucoes", "caixas_total", "caixas_bonificadas", "pedidos", "notas", "clientes_positivados"],
    ),
    "hoje": ("today", "''", ["faturamento_hoje", "caixas_hoje"]),
    "carteira": (
        "portfolio", "''",
        ["total", "ativos", "inativos", "nunca_compraram", "pct_ativos", "pct_positivacao", "limite_credito_total",
         "suspensos", "limite_suspenso"],
    ),
    "esfriando": (
        "(select * from recency where dias_sem_compra between 31 and 90 order by faturamento_6m desc, cod_cliente limit 10)",
        "cod_cliente", ["dias_sem_compra", "faturamento_6m"],
    ),
    "por_canal": ("channels", "canal", ["qtd", "pct", "faturamento", "caixas"]),
    "por_vendedor": ("seller_totals", "cod_vendedor", ["faturamento", "caixas", "positivados", "pedidos"]),
    "por_familia": ("family_totals", "familia", ["faturamento", "caixas", "pdvs"]),
    "por_dia": ("day_totals", "cast(dia as varchar)", ["faturamento", "caixas"]),
    "por_campanha": ("campaign_totals", "nome", ["faturamento", "caixas"]),
    "cadastros": ("registration_counts", "cod_vendedor", ["qtd"]),
    "metas": (
        "goal_actuals", "cod_vendedor",
        ["meta_visitas", "meta_positivados", "meta_cadastros", "meta_faturamento", "meta_caixas", "fase", "real_visitas",
         "real_positivados", "real_cadastros", "real_faturamento", "real_caixas"],
    ),
    "visitas": ("visit_totals", "''", ["checkins", "realizadas", "agendadas", "pendentes"]),
}
_RATIOS = {
    "media_skus_pedido": "round(cast(linhas_pedido / pedidos as decimal(38,10)), 1)",
    "ticket_medio": "round(cast(faturamento_total / pedidos as decimal(38,10)), 2)",
    "preco_medio_caixa": "round(cast(faturamento_total / (caixas_total - caixas_bonificadas) as decimal(38,10)), 2)",
    "drop_size": "round(cast(caixas_total / pedidos as decimal(38,10)), 1)",
}
_ORDER_PARTS = {
    "carteira_aberta": ("backlog", "''", ["valor", "caixas", "pedidos", "itens"]),
    "fill_rate": ("filled", "''", ["caixas_faturadas", "caixas_cortadas", "valor_cortado", "pct"]),
    "corte_por_motivo": ("reasons", "motivo", ["caixas", "valor"]),
    "carteira_por_vendedor": ("seller_backlog", "cod_vendedor", ["valor", "caixas", "pedidos"]),
}


def _measure_sql(parts) -> str:
    selects = [
        f"select '{block}' as bloco, coalesce({item}, '') as item, '{m}' as medida, cast({m} as double) as valor from {source}"
        for block, (source, item, measures) in parts.items()
        for m in measures
    ]
    return "\nunion all ".join(selects)


_RATIO_PARTS = "\nunion all ".join(
    f"select 'resumo', '', '{name}', cast({expr} as double) from summary" for name, expr in _RATIOS.items()
)
_MEASURE_COLUMNS = "bloco:s item:s medida:s valor:d"


@query("sales_board", _MEASURE_COLUMNS, _measure_sql(_SALES_PARTS) + "\nunion all " + _RATIO_PARTS)
def _(t):
    return board_measures(_sales_board(t))


@query("orders_board", _MEASURE_COLUMNS, _measure_sql(_ORDER_PARTS))
def _(t):
    return board_measures(_orders_board(t))


@query(
    "board_lines",
    "bloco:s item:s",
    """select 'carteira_aberta' as bloco, null as item union all select 'fill_rate', null
       union all select 'corte_por_motivo', motivo from reasons
       union all select 'carteira_por_vendedor', cod_vendedor from seller_backlog""",
)
def _(t):
    return board_lines(_orders_board(t))


# Every block of the document: its path, whether it is a list, the view that holds it, its fields, and how a list is ordered.
_BY_REVENUE = "faturamento desc nulls last"
_DOCUMENT_BLOCKS = {
    "anterior": ("before", "faturamento_total caixas_total clientes_positivados", None),
    "resumo": (
        f"(select *, {', '.join(f'{expr} as {name}' for name, expr in _RATIOS.items())} from summary)",
        "faturamento_total devolucoes caixas_total caixas_bonificadas pedidos notas clientes_positivados " + " ".join(_RATIOS), None,
    ),
    "carteira": ("portfolio", "total ativos inativos nunca_compraram pct_ativos pct_positivacao limite_credito_total suspensos limite_suspenso", None),
    "esfriando": (
        "(select * from recency where dias_sem_compra between 31 and 90 order by faturamento_6m desc, cod_cliente limit 10)",
        "cod_cliente nome cod_vendedor dias_sem_compra faturamento_6m", "faturamento_6m desc, cod_cliente",
    ),
    "por_canal": ("channels", "canal qtd pct faturamento caixas", f"{_BY_REVENUE}, canal"),
    "por_vendedor": ("seller_totals", "cod_vendedor nome faturamento caixas positivados pedidos", f"{_BY_REVENUE}, cod_vendedor nulls first"),
    "por_familia": ("family_totals", "familia faturamento caixas pdvs", f"{_BY_REVENUE}, familia"),
    "por_dia": ("day_totals", "dia faturamento caixas", "dia"),
    "por_campanha": ("campaign_totals", "nome data_inicio data_fim mecanica faturamento caixas", f"{_BY_REVENUE}, nome"),
    "cadastros": ("registration_counts", "cod_vendedor qtd", "cod_vendedor"),
    "metas": (
        "goal_actuals",
        "cod_vendedor nome meta_visitas meta_positivados meta_cadastros meta_faturamento meta_caixas fase real_visitas real_positivados "
        "real_cadastros real_faturamento real_caixas",
        "cod_vendedor",
    ),
    "visitas": ("visit_totals", "checkins realizadas agendadas pendentes", None),
    "pedidos.carteira_aberta": ("backlog", "valor caixas pedidos itens", None),
    "pedidos.fill_rate": ("filled", "caixas_faturadas caixas_cortadas valor_cortado pct", None),
    "pedidos.corte_por_motivo": ("reasons", "motivo caixas valor", "caixas desc nulls last, motivo"),
    "pedidos.carteira_por_vendedor": ("seller_backlog", "cod_vendedor nome valor caixas pedidos", "valor desc nulls last, cod_vendedor nulls first"),
}
_DOCUMENT_TOP = {
    "dados_ate": "(select strftime(max(carregado_em), '%Y-%m-%dT%H:%M:%S.000Z') from sales)",
    "faturamento_hoje": "(select faturamento_hoje from today)", "caixas_hoje": "(select caixas_hoje from today)",
}


def _document_sql() -> str:
    """A row for each field of each item, at its place in its list."""
    parts = []
    for path, (view, fields, order) in _DOCUMENT_BLOCKS.items():
        place = f"row_number() over (order by {order}) - 1" if order else "0"
        pairs = ", ".join(f"{{'campo': '{f}', 'valor': cast({f} as varchar)}}" for f in fields.split())
        parts.append(f"select '{path}' as caminho, posicao, unnest(pares, recursive := true) from (select {place} as posicao, [{pairs}] as pares from {view})")
    parts += [f"select '', 0, '{name}', cast({sql} as varchar)" for name, sql in _DOCUMENT_TOP.items()]
    union = "\nunion all ".join(parts)
    return f"select caminho, posicao, campo, if(n is null, valor, null) as texto, n as numero from (select *, try_cast(valor as double) as n from ({union}))"


@query("dashboard_document", "caminho:s posicao:i campo:s texto:s numero:d", _document_sql())
def _(t):
    """The document taken apart: each field of each item, with the item's place in its list."""
    document = board_document({**_sales_board(t), **_orders_board(t)})
    blocks = []
    for path, (_, _, order) in _DOCUMENT_BLOCKS.items():
        text = F.get_json_object("documento", f"$.{path}")
        blocks.append((path, text if order else F.concat(F.lit("["), text, F.lit("]"))))
    top = F.to_json(F.array(F.struct(*(F.get_json_object("documento", f"$.{n}").alias(n) for n in _DOCUMENT_TOP))))
    blocks.append(("", top))
    listed = F.array(*(F.struct(F.lit(p).alias("caminho"), F.from_json(x, "array<map<string,string>>").alias("itens")) for p, x in blocks))
    items = document.select(F.inline(listed)).select("caminho", F.posexplode("itens").alias("posicao", "item"))
    fields = items.select("caminho", "posicao", F.explode("item").alias("campo", "valor"))
    number = F.col("valor").try_cast("double")
    return fields.select("caminho", "posicao", "campo", F.when(number.isNull(), F.col("valor")).alias("texto"), number.alias("numero"))


_DOCUMENT_VALUES = {
    "faturamento_hoje": "select faturamento_hoje from today",
    "caixas_hoje": "select caixas_hoje from today",
    "resumo.faturamento_total": "select faturamento_total from summary",
    "visitas.checkins": "select checkins from visit_totals",
    "pedidos.carteira_aberta.valor": "select valor from backlog",
    "pedidos.fill_rate.caixas_faturadas": "select caixas_faturadas from filled",
}
_DOCUMENT_LISTS = {
    "por_canal": "channels", "por_vendedor": "seller_totals", "por_dia": "day_totals", "metas": "goal_actuals",
    "pedidos.corte_por_motivo": "reasons", "pedidos.carteira_por_vendedor": "seller_backlog",
}


@query(
    "dashboard_values",
    "caminho:s valor:d",
    "\nunion all ".join(
        [f"select '{path}' as caminho, cast(({sql}) as double) as valor" for path, sql in _DOCUMENT_VALUES.items()]
        + [f"select '{path}', cast((select count(*) from {view}) as double)" for path, view in _DOCUMENT_LISTS.items()]
    ),
)
def _(t):
    """Numbers and list lengths of the document, by their paths in it."""
    document = board_document({**_sales_board(t), **_orders_board(t)})
    numbers = [(p, F.get_json_object("documento", f"$.{p}")) for p in _DOCUMENT_VALUES]
    lengths = [(p, F.json_array_length(F.get_json_object("documento", f"$.{p}"))) for p in _DOCUMENT_LISTS]
    pairs = F.array(*(F.struct(F.lit(p).alias("caminho"), v.cast("double").alias("valor")) for p, v in numbers + lengths))
    return document.select(F.inline(pairs))


# -------------------------------------------------------------- load strategies

_CUSTOMER_COLUMNS = "empresa:s cod_cliente:s nome:s canal:s limite_credito:d"


@query(
    "replace_table",
    _CUSTOMER_COLUMNS,
    "select * from customers where not credito_suspenso",
)
def _(t):
    path = _new_folder(t, "replace_table")
    sinks.replace_table(t.customers, path)
    # The new content is computed from the table it replaces.
    sinks.replace_table(sinks.read_table(t.spark, path).filter(~F.col("credito_suspenso")), path)
    return sinks.read_table(t.spark, path)


@query(
    "replace_company",
    _CUSTOMER_COLUMNS,
    """select * from customers where not credito_suspenso
       union all select 'c2', * exclude (empresa) from customers""",
)
def _(t):
    path = _new_folder(t, "replace_company")
    other = t.customers.withColumn("empresa", F.lit("c2"))
    sinks.replace_company(t.customers, path, COMPANY, ["uf"])
    sinks.replace_company(other, path, "c2", ["uf"])
    sinks.replace_company(t.customers.filter(~F.col("credito_suspenso")), path, COMPANY, ["uf"])
    return sinks.read_table(t.spark, path)


def _dated_visits(t):
    return t.visits.select(
        F.lit(COMPANY).alias("empresa"), "id", "cod_vendedor", "status_visita", local_day("timestamp").alias("dia")
    )


@query(
    "replace_window",
    "empresa:s id:s cod_vendedor:s status_visita:s dia:s",
    """select 'c1' as empresa, id, cod_vendedor, status_visita, dia_local as dia from visits
       where (dia_local < date '1998-01-20' and status_visita <> 'fechado')
          or (dia_local >= date '1998-01-20' and status_visita <> 'ausente' and dia_local <> date '1998-01-25')""",
)
def _(t):
    path = _new_folder(t, "replace_window")
    rows = _dated_visits(t)
    sinks.replace_fact(rows.filter(F.col("status_visita") != "fechado"), path, COMPANY, "dia")
    corrected = rows.filter((F.col("status_visita") != "ausente") & (F.col("dia") != F.lit("1998-01-25").cast("date")))
    # One day of the window is gone from the source; the load is run twice.
    sinks.replace_window(corrected, path, COMPANY, "dia", "1998-01-20")
    sinks.replace_window(corrected, path, COMPANY, "dia", "1998-01-20")
    return sinks.read_table(t.spark, path, schema=rows.schema)


@query(
    "sync_field_tables",
    "id:s cod_vendedor:s status_visita:s observacao:s",
    """select id, case when status_visita = 'realizada' then 'z' || cod_vendedor else cod_vendedor end as cod_vendedor,
              status_visita, case when status_visita <> 'fechado' then 'novo' else observacao end as observacao from visits""",
)
def _(t):
    path = _new_folder(t, "sync_field_tables")
    visits = t.visits
    none_done = visits.filter(F.col("status_visita") != "realizada")
    base = {"users": t.users, "goals": t.goals, "agenda": t.agenda}
    field_app.sync_field_tables(t.spark, {**base, "visits": none_done}, path)
    # Known visits get a new note but keep their seller; new ones come in whole.
    later = visits.filter(F.col("status_visita") != "fechado").withColumn("observacao", F.lit("novo")).withColumn(
        "cod_vendedor", F.concat(F.lit("z"), "cod_vendedor")
    )
    field_app.sync_field_tables(t.spark, {**base, "visits": later}, path)
    return sinks.read_table(t.spark, f"{path}/visits")


# ------------------------------------------------------------------ refresh jobs


# Landed texts are packed; one task reads a packed file, so none is long.
LANDED = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}


def _comma(column: str):
    return F.replace(F.col(column).cast("string"), F.lit("."), F.lit(","))


def _write_export(df, entity: str, landing: str) -> None:
    """Write a frame the way the ERP export job does."""
    export = EXPORTS[entity]
    columns = []
    for source, name, kind in export.columns:
        if name not in df.columns:
            continue
        value = _comma(name) if kind == "num" else F.date_format(name, "dd/MM/yyyy") if kind == "date" else F.col(name)
        columns.append(value.alias(source))
    writer = df.select(*columns).write.option("sep", ";").option("header", True).option("encoding", "ISO-8859-1")
    with cleaned_shuffles(df.sparkSession):
        writer.option("escape", '"').options(**LANDED).csv(f"{landing}/{export.file}")


@query(
    "read_export",
    "nr_pedido:s it_codigo:s cod_cliente:s qt_caixas:d valor:d status_item:s tipo:s data_pedido:s campanha:s",
    """select nr as nr_pedido, item as it_codigo, cliente as cod_cliente, qt as qt_caixas, liquido as valor,
              case o_orderstatus when 'F' then 'Faturado' when 'O' then 'Carteira' else o_orderpriority end as status_item,
              case when taxa = 0.08 then 'Dev' when taxa = 0.07 then 'Bonificacao' else 'Venda' end as tipo, data_pedido,
              case when estabel = 'O' then 'CAMP ' || operacao end as campanha from order_lines""",
)
def _(t):
    landing = _new_folder(t, "read_export")
    _write_export(t.order_export, "order_items", landing)
    return read_export(t.spark, f"{landing}/{EXPORTS['order_items'].file}", "order_items")


@query(
    "read_field_app",
    "id:s cod_cliente:s nome_cliente:s cod_vendedor:s status_visita:s observacao:s hora:s",
    "select *, strftime(hora_local, '%Y-%m-%d %H:%M:%S') as hora from visits",
)
def _(t):
    landing = _new_folder(t, "read_field_app")
    t.visits.write.json(f"{landing}/visits")
    visits = read_field_app(t.spark, landing, "visits")
    local = F.from_utc_timestamp("timestamp", LOCAL_ZONE)
    return visits.withColumn("hora", F.date_format(local, "yyyy-MM-dd HH:mm:ss"))


@query(
    "read_seed_types",
    "empresa:s nat_operacao:s cfop:s tipo:s",
    """select 'c1' as empresa, cast(p_partkey as varchar) as nat_operacao, p_type as cfop,
              case when p_size > 25 then 'venda' else 'ignorar' end as tipo from part""",
)
def _(t):
    path = f"{_new_folder(t, 'read_seed_types')}/seed"
    seed = t.raw("part").select(
        F.lit(COMPANY).alias("empresa"), F.col("p_partkey").cast("string").alias("nat_operacao"), F.col("p_type").alias("cfop"),
        F.when(F.col("p_size") > 25, "venda").otherwise("ignorar").alias("tipo"),
    )
    seed.write.option("header", True).csv(path)
    return read_seed_types(t.spark, path)


HISTORY = "1990-01-01"
_REFRESHED = "nr_nota:s cod_cliente:s cod_vendedor:s it_codigo:s qt_caixas:d valor:d tipo:s familia:s data_emissao:s"


@query(
    "refresh_from_exports",
    _REFRESHED,
    """select l.nr as nr_nota, l.cliente as cod_cliente, max(l.rep) as cod_vendedor, l.item as it_codigo,
               cast(sum(l.qt) as decimal(12,2)) as qt_caixas,
               cast(abs(round(sum(case when l.operacao = 'R' then -l.liquido else l.liquido end), 2)) as decimal(14,2)) as valor,
               case when sum(case when l.operacao = 'R' then -l.liquido else l.liquido end) < 0 then 'devolucao' else 'venda' end as tipo,
               max(p.familia) as familia, max(l.emissao) as data_emissao
        from order_lines l join products p on p.it_codigo = l.item
        group by l.nr, l.item, l.cliente""",
)
def _(t):
    root = _new_folder(t, "refresh_from_exports")
    landing, lake = f"{root}/landing", Lake(f"{root}/lake")
    _write_export(t.products, "products", landing)
    customers = t.customers.select(
        "cod_cliente", F.col("cod_vendedor").alias("cod_erc"), "nome", "canal", "cnpj",
        F.col("limite_credito").alias("limite_disp"),
    )
    _write_export(customers, "customers", landing)
    _write_export(t.invoice_export, "invoice_lines", landing)
    _write_export(t.order_export, "order_items", landing)
    refresh_from_exports(t.spark, lake, landing, COMPANY, HISTORY)
    return sinks.read_table(t.spark, lake.mart("sales"), COMPANY)


@query(
    "refresh_full_then_window",
    "tipo:s linhas:i valor:d qt_caixas:d ate:s",
    # Rows of the first load dated before the window, and the window's lines grouped anew.
    """select t.tipo, count(*) as linhas, sum(cast(abs(round(g.liquido, 2)) as decimal(14,2))) as valor,
              sum(g.qt) as qt_caixas, max(g.emissao) as ate
       from (select nr, item, cliente, estabel, max(operacao) as operacao, sum(qt) as qt, sum(liquido) as liquido,
                    max(emissao) as emissao from order_lines group by all having max(emissao) < date '2001-10-28'
             union all
             select nr, item, cliente, estabel, max(operacao), sum(qt), sum(liquido), max(emissao) from order_lines
             where emissao >= date '2001-10-28' and not (o_orderstatus = 'P' and o_orderpriority = '5-LOW') group by all) g
       join type_map t on t.nat_operacao = g.operacao group by 1""",
)
def _(t):
    lake = Lake(_new_folder(t, "refresh_full"))
    late = {
        "operations": t.operations, "families": t.families, "items": t.items, "parties": t.parties, "reps": t.reps,
        "registrations": t.registered.select(F.lit(COMPANY).alias("empresa"), F.col("cod_vendedor").alias("cod_rep")),
        "orders": t.scan_orders.withColumn("empresa", F.lit(COMPANY)),
        "invoice_lines": t.cancellable_lines,
    }

    def first_load(entity, span):
        """All lines, none of them cancelled yet."""
        if entity != "invoice_lines":
            return late[entity]
        return late[entity].withColumn("dt_cancela", F.lit(None).cast("date"))

    def later_load(entity, span):
        """The window again, now with cancellations."""
        return late[entity] if span is None else late[entity].filter(F.col(_DATES[entity]) >= F.lit(span[0]))

    refresh_full(t.spark, lake, first_load, COMPANY, cutoff=HISTORY)
    refresh_window(t.spark, lake, later_load, COMPANY, "2001-11-04", 7)
    sales = sinks.read_table(t.spark, lake.mart("sales"), COMPANY)
    return sales.groupBy("tipo").agg(
        F.count(F.lit(1)).alias("linhas"), F.sum("valor").alias("valor"), F.sum("qt_caixas").alias("qt_caixas"),
        F.max("data_emissao").alias("ate"),
    )


_DATES = {"invoice_lines": "dt_emis_nota", "orders": "dt_venda"}


# -------------------------------------------------------------------- streaming


def _landed_visits(t, folder: str) -> str:
    """Visits landed as files; those with a note of an odd length landed twice."""
    path = f"{folder}/landing"
    again = t.visits.filter(F.length("observacao") % 2 == 1)
    t.visits.select(*VISITS.names).unionByName(again.select(*VISITS.names)).write.parquet(path)
    return path


@query(
    "visits_stream_daily",
    "dia:s cod_vendedor:s visitas:i",
    "select dia_local as dia, cod_vendedor, count(*) as visitas from visits group by all",
)
def _(t):
    folder = _new_folder(t, "visits_stream_daily")
    stream = visit_stream.read_visit_stream(t.spark, _landed_visits(t, folder), "parquet", files_per_batch=4)
    visit_stream.store_visits(stream, f"{folder}/visits", f"{folder}/checkpoint").awaitTermination()
    return visit_stream.visits_by_day(t.spark, f"{folder}/visits")


@query(
    "visits_stream_closed_days",
    "dia:s cod_vendedor:s visitas:i",
    # By contract of this form, days are given out once: when the latest visit is seven days ahead.
    """select dia_local as dia, cod_vendedor, count(*) as visitas from visits
       where dia_local + 1 <= (select max(hora_local) from visits) - interval 7 day group by all""",
)
def _(t):
    folder = _new_folder(t, "visits_stream_closed_days")
    stream = visit_stream.read_visit_stream(t.spark, _landed_visits(t, folder), "parquet")
    counts = visit_stream.daily_counts(stream)
    visit_stream.write_daily_counts(counts, f"{folder}/counts", f"{folder}/checkpoint").awaitTermination()
    return t.spark.read.schema(counts.schema).parquet(f"{folder}/counts")


@query(
    "visits_stream_table",
    "id:s cod_vendedor:s status_visita:s dia:s",
    "select id, cod_vendedor, status_visita, dia_local as dia from visits",
)
def _(t):
    folder = _new_folder(t, "visits_stream_table")
    stream = visit_stream.read_visit_stream(t.spark, _landed_visits(t, folder), "parquet", files_per_batch=4)
    visit_stream.store_visits(stream, f"{folder}/visits", f"{folder}/checkpoint").awaitTermination()
    return sinks.read_table(t.spark, f"{folder}/visits")
