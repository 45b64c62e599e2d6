"""Loads that correct what is stored, conversions that fail, and rollups, as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import portfolio, rollups
from ..operators import sales as sales_ops
from ..operators.filters import spans_overlapping
from ..plans.app_feed import load_campaigns, load_registrations_of_app, stored_registered, stored_sales_marts
from ..plans.pipelines import Lake, follow_sales, load_export
from ..schemas import FIELD_APP_ORIGIN, KEYS, LOCAL_ZONE, MONTH_PARTITION
from ..sinks import rollups as stored_rollups
from ..sinks import tables as sinks
from ..sinks.shuffles import cleaned_shuffles
from ..sources.exports import EXPORTS
from ..streaming import visits as visit_stream
from .queries import _REQUEST_SQL, _requests
from .queries_flow import LANDED, _dated_visits, _landed_visits, _new_folder, _write_export
from .registry import query
from .tables import AS_OF, COMPANY, END, SELLER, START

# ------------------------------------------------------- lines that change their date

CUTOFF = "1998-06-01"
_BY_DAY = "dia:s linhas:i valor:d"
_KEY = [c for c in KEYS["invoice_lines"] if c != "empresa"]


def _day_totals(t, path: str):
    stored = sinks.read_table(t.spark, path, COMPANY)
    return stored.groupBy(F.col("dt_emis_nota").alias("dia")).agg(
        F.count(F.lit(1)).alias("linhas"), F.sum("vl_merc_liq").alias("valor")
    )


def _lines(t):
    """One line for each key, which the given lines repeat."""
    totals = [F.max("dt_emis_nota").alias("dt_emis_nota"), F.sum("vl_merc_liq").cast("decimal(16,4)").alias("vl_merc_liq")]
    return t.invoice_lines.groupBy("empresa", *_KEY).agg(*totals)


_LINES = "(select nr, seq, estabel, max(emissao) as emissao, sum(liquido) as liquido from order_lines group by 1, 2, 3)"


def _redated(t, wanted, days: int):
    """The lines, the wanted ones dated anew and worth one more."""
    lines = _lines(t)
    return lines.withColumns({
        "dt_emis_nota": F.when(wanted, F.date_add("dt_emis_nota", days)).otherwise(F.col("dt_emis_nota")),
        "vl_merc_liq": F.when(wanted, F.col("vl_merc_liq") + 1).otherwise(F.col("vl_merc_liq")).cast("decimal(16,4)"),
    })


def _corrected_window(t, name: str, later, refetch: bool):
    path = _new_folder(t, name)
    sinks.replace_fact(_lines(t), path, COMPANY, "dt_emis_nota")
    ask = (lambda keys: sinks.matching(later, keys, keys.columns, "left_semi")) if refetch else None
    for _ in range(2):  # the second load changes nothing
        sinks.replace_window(later, path, COMPANY, "dt_emis_nota", CUTOFF, _KEY, ask)
    return _day_totals(t, path)


@query(
    "window_redated",
    _BY_DAY,
    f"""select if(moved, emissao + 40, emissao) as dia, count(*) as linhas, sum(if(moved, liquido + 1, liquido)) as valor
        from (select *, emissao >= date '{CUTOFF}' - 40 and emissao < date '{CUTOFF}' and seq = 1 as moved from {_LINES}) group by 1""",
)
def _(t):
    """Lines of the forty days before the window move into it: each is counted once, where it is now."""
    day = F.col("dt_emis_nota")
    moved = (day >= F.date_sub(F.lit(CUTOFF).cast("date"), 40)) & (day < F.lit(CUTOFF).cast("date")) & (F.col("nr_seq_fat") == 1)
    return _corrected_window(t, "window_redated", _redated(t, moved, 40), refetch=False)


@query(
    "line_moved_out",
    _BY_DAY,
    f"""select if(moved, emissao - 30, emissao) as dia, count(*) as linhas, sum(if(moved, liquido + 1, liquido)) as valor
        from (select *, emissao between date '{CUTOFF}' and date '{CUTOFF}' + 20 and seq = 2 as moved from {_LINES})
        where not (emissao between date '{CUTOFF}' and date '{CUTOFF}' + 20 and seq = 3) group by 1""",
)
def _(t):
    """Lines of the window's first days move to before it, and others are gone at the source."""
    inside = F.col("dt_emis_nota").between(F.lit(CUTOFF).cast("date"), F.date_add(F.lit(CUTOFF).cast("date"), 20))
    later = _redated(t, inside & (F.col("nr_seq_fat") == 2), -30)
    gone = _lines(t).filter(inside & (F.col("nr_seq_fat") == 3)).select(*_KEY)
    later = later.join(gone, _KEY, "left_anti").select(*later.columns)
    return _corrected_window(t, "line_moved_out", later, refetch=True)


@query(
    "full_keeps_older_years",
    _BY_DAY,
    f"""select emissao as dia, count(*) as linhas, sum(liquido) as valor from {_LINES}
       where emissao < date '1996-01-01' or seq <> 4 group by 1""",
)
def _(t):
    """A source that holds the years from 1996 on, without some lines, replaces those years and no others."""
    path = _new_folder(t, "full_keeps_older_years")
    sinks.replace_fact(_lines(t), path, COMPANY, "dt_emis_nota")
    newer = _lines(t).filter((F.col("dt_emis_nota") >= F.lit("1996-01-01").cast("date")) & (F.col("nr_seq_fat") != 4))
    sinks.replace_window(newer, path, COMPANY, "dt_emis_nota", "1996-01-01", _KEY)
    return _day_totals(t, path)


# ------------------------------------------------------------ visits that change their day


@query(
    "visit_changes_day",
    "id:s status_visita:s dia:s",
    """select id, status_visita, dia_local + case status_visita when 'ausente' then 3 when 'fechado' then -2 else 0 end as dia from visits""",
)
def _(t):
    path = _new_folder(t, "visit_changes_day")
    visits = _dated_visits(t)
    sinks.upsert_days(visits, path, ["id"], "dia")
    days = F.when(F.col("status_visita") == "ausente", 3).otherwise(-2)
    moved = visits.filter(F.col("status_visita").isin("ausente", "fechado")).withColumn("dia", F.date_add("dia", days))
    sinks.upsert_days(moved, path, ["id"], "dia")
    return sinks.read_table(t.spark, path)


@query(
    "visits_stream_corrected",
    "dia:s cod_vendedor:s visitas:i",
    """select dia_local + if(status_visita = 'ausente', 3, 0) as dia, if(status_visita = 'fechado', 'x', cod_vendedor) as cod_vendedor,
              count(*) as visitas from visits group by 1, 2""",
)
def _(t):
    """Visits that come again, on another day or by another seller, leave the counts they were in."""
    folder = _new_folder(t, "visits_stream_corrected")
    landing = _landed_visits(t, folder)

    def run() -> None:
        stream = visit_stream.read_visit_stream(t.spark, landing, "parquet", files_per_batch=4)
        visit_stream.store_visits(stream, f"{folder}/visits", f"{folder}/checkpoint").awaitTermination()

    run()
    local = F.from_utc_timestamp("timestamp", LOCAL_ZONE) + F.make_dt_interval(F.lit(3))
    changed = t.visits.filter(F.col("status_visita").isin("ausente", "fechado")).withColumns({
        "timestamp": F.when(F.col("status_visita") == "ausente", F.to_utc_timestamp(local, LOCAL_ZONE)).otherwise(F.col("timestamp")),
        "cod_vendedor": F.when(F.col("status_visita") == "fechado", "x").otherwise(F.col("cod_vendedor")),
    })
    changed.write.mode("append").parquet(landing)
    run()
    return visit_stream.visits_by_day(t.spark, f"{folder}/visits")


# ------------------------------------------------------------------- failed conversions

# An amount too wide for its type, and a day that no month has.
_WIDE, _NO_DAY = "1.234.567.890.123,45", "31/02/1998"


@query(
    "conversion_failures",
    "coluna:s texto:s linhas:i",
    f"""select 'valor' as coluna, '{_WIDE}' as texto, count(*) as linhas from order_lines where item like '%7' having count(*) > 0
        union all
        select 'data_pedido', '{_NO_DAY}', count(*) from order_lines where cliente like '%3' having count(*) > 0""",
)
def _(t):
    root = _new_folder(t, "conversion_failures")
    export = EXPORTS["order_items"]
    name = {ours: file for file, ours, _ in export.columns}
    landing, lake = f"{root}/landing", Lake(f"{root}/lake")
    _write_export(t.order_export, "order_items", f"{root}/good")
    good = t.spark.read.option("sep", ";").option("header", True).option("encoding", "ISO-8859-1").csv(f"{root}/good/{export.file}")
    item, customer = F.col(f"`{name['it_codigo']}`"), F.col(f"`{name['cod_cliente']}`")
    bad = good.withColumns({
        name["valor"]: F.when(item.endswith("7"), _WIDE).otherwise(F.col(f"`{name['valor']}`")),
        name["data_pedido"]: F.when(customer.endswith("3"), _NO_DAY).otherwise(F.col(f"`{name['data_pedido']}`")),
    })
    bad.write.option("sep", ";").option("header", True).option("encoding", "ISO-8859-1").csv(f"{landing}/{export.file}")
    load_export(t.spark, lake, landing, "order_items", None)
    kept = sinks.read_table(t.spark, lake.quarantine("order_items"))
    return kept.groupBy("coluna", "texto").agg(F.count(F.lit(1)).alias("linhas"))


# ---------------------------------------------------------------------------- rollups


@query(
    "rollup_summary",
    "faturamento_total:d devolucoes:d caixas_total:d caixas_bonificadas:d pedidos:i notas:i clientes_positivados:i linhas_pedido:i",
    "select * from summary",
)
def _(t):
    return rollups.sales_summary(t.rollups, t.sales, START, END)


@query("rollup_previous_period", "faturamento_total:d caixas_total:d clientes_positivados:i", "select * from before")
def _(t):
    return rollups.previous_period(t.rollups, START, END)


@query("rollup_by_seller", "cod_vendedor:s nome:s faturamento:d caixas:d positivados:i pedidos:i", "select * from seller_totals")
def _(t):
    return rollups.by_seller(t.rollups, t.sellers, START, END)


@query("rollup_by_channel", "canal:s qtd:i pct:d faturamento:d caixas:d", "select * from channels")
def _(t):
    return rollups.by_channel(t.rollups, t.customers, START, END)


@query(
    "rollup_recency",
    "cod_cliente:s nome:s cod_vendedor:s limite_credito:d credito_suspenso:b ultima_compra:s dias_sem_compra:i faturamento_6m:d",
    "select * from recency",
)
def _(t):
    return rollups.customer_recency(t.rollups, t.customers, AS_OF)


@query(
    "rollup_portfolio",
    "total:i ativos:i inativos:i nunca_compraram:i pct_ativos:d pct_positivacao:d limite_credito_total:d suspensos:i limite_suspenso:d",
    "select * from portfolio",
)
def _(t):
    recency = rollups.customer_recency(t.rollups, t.customers, AS_OF)
    return portfolio.portfolio_summary(recency, rollups.sales_summary(t.rollups, t.sales, START, END))


@query(
    "rollups_after_window",
    "mes:s faturamento:d caixas:d pedidos:i notas:i positivados:i",
    f"""select strftime(data_emissao, '%Y-%m') as mes, sum(com_sinal) as faturamento, sum(movidas) as caixas, count(distinct pedido) as pedidos,
               count(distinct nota) as notas, count(distinct comprador) as positivados
        from measured where data_emissao < date '{CUTOFF}' or cod_cliente not like '%4' group by 1""",
)
def _(t):
    """Rollups of a first load, brought up after a window without some customers and with sellers' codes changed."""
    root = _new_folder(t, "rollups_after_window")
    sales_path, path = f"{root}/sales", f"{root}/rollups"
    sales = t.sales.drop(MONTH_PARTITION)
    early = sales.filter(F.col("data_emissao") < F.lit("2000-01-01").cast("date"))
    sinks.replace_fact(early, sales_path, COMPANY, "data_emissao")
    stored_rollups.refresh_rollups(t.spark, sales_path, path, COMPANY)
    later = sales.filter(~F.col("cod_cliente").endswith("4")).withColumn("cod_vendedor", F.concat(F.lit("n"), "cod_vendedor"))
    sinks.replace_window(later, sales_path, COMPANY, "data_emissao", CUTOFF, KEYS["sales"])
    stored_rollups.refresh_rollups(t.spark, sales_path, path, COMPANY)
    held = stored_rollups.read_rollups(t.spark, path, COMPANY)
    month = F.date_format("data_emissao", "yyyy-MM").alias("mes")
    sums = held.customers.groupBy(month).agg(
        F.sum("faturamento").alias("faturamento"), F.sum("caixas").alias("caixas"),
        F.count_distinct(F.when(F.col("compras") > 0, F.col("cod_cliente"))).alias("positivados"),
    )
    numbers = held.numbers.withColumn("mes", month)
    orders = rollups.distinct_numbers(numbers, "nr_pedido", "pedidos", ("mes",))
    invoices = rollups.distinct_numbers(numbers, "nr_nota", "notas", ("mes",))
    return sums.join(orders, "mes", "left").join(invoices, "mes", "left").fillna(0, ["pedidos", "notas"])


# ------------------------------------------------------- what the sales app keeps


def _land(df, landing: str, name: str) -> None:
    df.write.options(**LANDED).json(f"{landing}/{name}")


def _app_lake(t, name: str):
    root = _new_folder(t, name)
    return Lake(f"{root}/lake"), f"{root}/landing"


@query(
    "campaigns_of_app",
    "nome:s data_inicio:s data_fim:s mecanica:s faturamento:d caixas:d",
    f"""select c.nome, c.data_inicio, c.data_fim, c.mecanica, coalesce(f, 0) as faturamento, coalesce(x, 0) as caixas
        from campaigns c left join (
            select cast(it_codigo as bigint) % 30 as id, sum(com_sinal) as f, sum(movidas) as x from measured
            where data_emissao < date '{CUTOFF}' or cod_cliente not like '%4' group by 1) t using (id)
        where c.data_fim >= date '1998-01-01' and c.data_inicio <= date '1998-01-31'""",
)
def _(t):
    """Campaigns of the stored board: tags landed, corrected, and followed by a window of sales without some customers."""
    lake, landing = _app_lake(t, "campaigns_of_app")
    sales = t.sales.drop(MONTH_PARTITION)
    with cleaned_shuffles(t.spark):
        sinks.replace_fact(sales, lake.mart("sales"), COMPANY, "data_emissao")
    follow_sales(t.spark, lake, COMPANY)
    tagged = sales.select("nr_nota", "it_codigo", "cod_cliente", "estabel", (F.col("it_codigo").cast("bigint") % 30).alias("campanha_id"))
    # Every line was first tagged with another campaign.
    for number, change in (("1", 1), ("2", 0)):
        marked = tagged.withColumn("campanha_id", F.col("campanha_id") + change)
        at = F.lit(f"1998-01-0{number}T00:00:00Z").alias("alterado_em")
        _land(marked.select("*", at), f"{landing}/{number}", "sale_tags")
        _land(t.campaigns, f"{landing}/{number}", "campaigns")
        load_campaigns(t.spark, lake, f"{landing}/{number}", COMPANY)
    later = sales.filter(~F.col("cod_cliente").endswith("4"))
    with cleaned_shuffles(t.spark):
        sinks.replace_window(later, lake.mart("sales"), COMPANY, "data_emissao", CUTOFF, KEYS["sales"])
    follow_sales(t.spark, lake, COMPANY, CUTOFF)
    held = stored_sales_marts(t.spark, lake, COMPANY)
    wanted = spans_overlapping(held.campaigns, START, END)
    totals = held.campaign_days.groupBy(F.col("campanha_id").alias("id"))
    totals = totals.agg(F.sum("faturamento").alias("faturamento"), F.sum("caixas").alias("caixas"))
    return sales_ops.campaign_lines(wanted, totals)


@query(
    "registrations_of_app",
    "cod_vendedor:s qtd:i",
    f"""select dono as cod_vendedor, count(*) as qtd from (
            select case when c_acctbal > 8000 then '9' else '{SELLER}' end as dono, ordem
            from ({_REQUEST_SQL}) r where motivo is null and c_mktsegment <> 'MACHINERY'
            qualify row_number() over (partition by chave order by ordem) = 1) x
        where ordem % 60 <= 30 group by 1""",
)
def _(t):
    """Requests landed and loaded twice, the second time with later requests for the same codes."""
    lake, landing = _app_lake(t, "registrations_of_app")
    sinks.replace_table(t.customers, lake.mart("customers"))
    asked = _requests(t).withColumn("recebido_em", F.date_add(F.lit(START).cast("date"), (F.col("ordem") % 60).cast("int")).cast("timestamp"))
    _land(asked, f"{landing}/1", "requests")
    _land(asked.withColumn("ordem", F.col("ordem") + F.lit(1 << 40)), f"{landing}/2", "requests")
    for number in ("1", "1", "2"):
        load_registrations_of_app(t.spark, lake, f"{landing}/{number}", COMPANY, SELLER)
    held = stored_registered(t.spark, lake, COMPANY)
    return sales_ops.registrations_by_seller(held, START, END, FIELD_APP_ORIGIN)
