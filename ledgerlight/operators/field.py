"""Field force: visits, goals, the pilot comparison, batch customer changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import digits_only, is_tax_id, state_code
from ..functions.periods import Day, month_key
from ..schemas import MONEY
from .filters import for_listed, for_seller, local_period

VISITS_SHOWN = 200
PILOT_MEASURES = ["pedidos_itens", "pedidos_valor", "cadastros", "checkins"]


def recent_visits(
    visits: DataFrame,
    start: Day | None = None,
    end: Day | None = None,
    seller: str | None = None,
    size: int | None = VISITS_SHOWN,
) -> DataFrame:
    """The newest visits first; all of them where ``size`` is ``None``."""
    listed = (
        for_seller(local_period(visits, "timestamp", start, end), seller)
        .select("id", "cod_cliente", "nome_cliente", "cod_vendedor", "status_visita", "observacao", "timestamp")
        .orderBy(F.desc_nulls_last("timestamp"), "id")
    )
    return listed if size is None else listed.limit(size)


def month_goals(goals: DataFrame, day: Day, seller: str | None = None) -> DataFrame:
    return for_seller(goals.filter(F.col("mes") == month_key(day)), seller).select(
        "cod_vendedor", "mes", "meta_visitas", "meta_positivados", "meta_cadastros", "fase",
        "meta_faturamento", "meta_caixas",
    )


def visits_vs_goal(
    visits: DataFrame, goals: DataFrame, start: Day, end: Day, seller: str | None = None
) -> DataFrame:
    """All visits of the period, whatever their outcome, next to the month's goal."""
    counted = local_period(visits, "timestamp", start, end).groupBy("cod_vendedor").agg(
        F.count(F.lit(1)).alias("visitas")
    )
    wanted = month_goals(goals, start, seller).select("cod_vendedor", "mes", "meta_visitas")
    return wanted.join(counted, "cod_vendedor", "left").select(
        "cod_vendedor", "mes", F.coalesce("visitas", F.lit(0)).alias("visitas"), "meta_visitas"
    )


def pilot_comparison(
    pilot: DataFrame, order_items: DataFrame, reps: DataFrame, registrations: DataFrame, visits: DataFrame
) -> DataFrame:
    """Listed sellers side by side, zeros where a seller has nothing.

    ``pilot`` names the sellers (cod_rep, nome, cod_vendedor_crm): the field app
    knows them under another code. Rows of sellers that are not listed go before
    anything is grouped. Order rows carry the rep's short name, so they are added up
    by that name before the reps are joined.
    """
    listed_reps = reps.join(pilot.select("cod_rep"), "cod_rep", "left_semi").select(
        "cod_rep", F.col("nome_abrev").alias("representante")
    )
    crm_codes = pilot.select(F.col("cod_vendedor_crm").alias("cod_vendedor"))
    per_name = (
        for_listed(order_items, "representante", listed_reps)
        .groupBy("representante")
        .agg(F.count(F.lit(1)).alias("itens"), F.sum("valor_total_venda").alias("valor"))
    )
    ordered = (
        listed_reps.join(per_name, "representante")
        .groupBy("cod_rep")
        .agg(F.sum("itens").alias("pedidos_itens"), F.sum("valor").alias("pedidos_valor"))
    )
    registered = for_listed(registrations, "cod_rep", pilot).groupBy("cod_rep").agg(F.count(F.lit(1)).alias("cadastros"))
    visited = for_listed(visits, "cod_vendedor", crm_codes).groupBy(F.col("cod_vendedor").alias("cod_vendedor_crm"))
    visited = visited.agg(F.count(F.lit(1)).alias("checkins"))
    return (
        pilot.join(ordered, "cod_rep", "left")
        .join(registered, "cod_rep", "left")
        .join(visited, "cod_vendedor_crm", "left")
        .select("cod_rep", "nome", *(F.coalesce(c, F.lit(0)).alias(c) for c in PILOT_MEASURES))
    )


def pilot_totals(comparison: DataFrame) -> DataFrame:
    return comparison.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in PILOT_MEASURES))


def _text(name: str):
    return F.trim(F.col(name))


def _filled(name: str):
    return F.coalesce(F.col(name), F.lit("")) != ""


def register_customers(
    requests: DataFrame, customers: DataFrame, company: str, default_owner: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """New customers from a batch of requests: (accepted, rejected with ``motivo``).

    ``requests`` has cod_cliente, nome, cnpj, canal, cidade, uf, cod_vendedor,
    limite_credito (text or number) and ``ordem``, the order of arrival. Of several
    valid requests with one code the first is taken, the others are rejected as
    duplicates, like requests for a code that exists already.
    """
    checked = requests.withColumn(
        "motivo",
        F.when(~_filled("cod_cliente") | ~_filled("nome"), "campo obrigatorio")
        .when(_filled("cnpj") & ~is_tax_id("cnpj"), "cnpj invalido"),
    ).withColumn("chave", _text("cod_cliente"))
    valid = checked.filter(F.col("motivo").isNull())
    first = valid.groupBy("chave").agg(F.min("ordem").alias("ordem"))
    existing = customers.filter(F.col("empresa") == company).select(F.col("cod_cliente").alias("chave"))
    winners = first.join(existing, "chave", "left_anti")

    chosen = valid.join(winners, ["chave", "ordem"], "left_semi")
    limit = F.coalesce(F.col("limite_credito").try_cast(MONEY), F.lit(0)).cast(MONEY)
    owner = F.coalesce(F.nullif("cod_vendedor", F.lit("")), F.lit(default_owner).cast("string"))
    accepted = chosen.select(
        F.lit(company).alias("empresa"),
        F.col("chave").alias("cod_cliente"),
        _text("nome").alias("nome"),
        F.nullif(digits_only("cnpj"), F.lit("")).alias("cnpj"),
        F.nullif("canal", F.lit("")).alias("canal"),
        F.nullif("cidade", F.lit("")).alias("cidade"),
        F.nullif(state_code("uf"), F.lit("")).alias("uf"),
        owner.alias("cod_vendedor"),
        limit.alias("limite_credito"),
        F.lit(False).alias("credito_suspenso"),
        F.lit(None).cast("date").alias("dt_ult_venda"),
    )
    duplicates = valid.join(winners, ["chave", "ordem"], "left_anti").withColumn("motivo", F.lit("codigo ja existe"))
    rejected = checked.filter(F.col("motivo").isNotNull()).unionByName(duplicates).drop("chave")
    return accepted, rejected


def apply_customer_changes(
    changes: DataFrame, customers: DataFrame, company: str
) -> tuple[DataFrame, DataFrame]:
    """Customer table after a batch of changes, and the rejected changes.

    ``changes`` has cod_cliente, canal, limite_credito, cod_vendedor and ``ordem``.
    An empty channel or owner and a null limit leave the value as it is; a limit
    of 0 is a change. With several changes for one customer, each attribute takes
    its last given value.
    """
    checked = changes.withColumn(
        "motivo",
        F.when(~_filled("cod_cliente"), "cod_cliente obrigatorio").when(
            ~_filled("canal") & F.col("limite_credito").isNull() & ~_filled("cod_vendedor"), "nada para atualizar"
        ),
    )
    known = customers.filter(F.col("empresa") == company).select("cod_cliente")
    valid = checked.filter(F.col("motivo").isNull())
    latest = valid.groupBy("cod_cliente").agg(
        F.max_by(F.nullif("canal", F.lit("")), F.when(_filled("canal"), F.col("ordem"))).alias("novo_canal"),
        F.max_by(
            F.coalesce(F.col("limite_credito").try_cast(MONEY), F.lit(0)),
            F.when(F.col("limite_credito").isNotNull(), F.col("ordem")),
        ).cast(MONEY).alias("novo_limite"),
        F.max_by(F.nullif("cod_vendedor", F.lit("")), F.when(_filled("cod_vendedor"), F.col("ordem"))).alias("novo_dono"),
    )
    keyed = latest.withColumn("empresa", F.lit(company))
    updated = customers.join(keyed, ["cod_cliente", "empresa"], "left").select(
        *(
            F.coalesce({"canal": "novo_canal", "limite_credito": "novo_limite", "cod_vendedor": "novo_dono"}[c], c).alias(c)
            if c in ("canal", "limite_credito", "cod_vendedor")
            else F.col(c)
            for c in customers.columns
        )
    )
    unknown = valid.join(known, "cod_cliente", "left_anti").withColumn("motivo", F.lit("cliente nao encontrado"))
    rejected = checked.filter(F.col("motivo").isNotNull()).unionByName(unknown.select(checked.columns))
    return updated, rejected
