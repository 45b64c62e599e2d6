"""Mart builders: classification, grouping to the mart grain, dimensions.

Facts are grouped to their natural key before any dimension is joined: the
grouping combines on the map side, so a key that holds a large part of the rows
is reduced where it lies, and every later join sees one row per key.
Grouping and join keys start with the column of most values: sorts compare the
first key by a prefix, which is useless on a column that hardly varies.
Dimension joins carry no hint. Spark broadcasts a dimension when its measured
size allows it and otherwise shuffles, splitting skewed partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import default_label, trimmed_or_null, zero_code_to_null
from ..functions.periods import Day, as_day
from ..functions.rules import (
    cut_reason,
    movement_of_net_value,
    movement_of_operation,
    movement_of_order,
    status_group,
)
from ..schemas import BOXES, IGNORE, MONEY, NO_FAMILY, SALE

# --- fixed values: party kind of a pure supplier, state of suspended credit ---
SUPPLIER_ONLY = 2
CREDIT_SUSPENDED = 4
# --- fixed value: start of a full mart build ----------------------------------
FULL_SINCE = "2000-01-01"
UNMAPPED_TOP = 20


def _loaded(loaded_at: Column | None) -> Column:
    return (F.current_timestamp() if loaded_at is None else loaded_at).cast("timestamp").alias("carregado_em")


def classify_operations(operations: DataFrame) -> DataFrame:
    """One row per company and trimmed code: of codes that differ in blanks only, the one with the greatest values."""
    trimmed = operations.select(
        "empresa",
        F.trim("nat_operacao").alias("nat_operacao"),
        F.trim(F.coalesce("cfop", F.lit(""))).alias("cfop"),
        movement_of_operation(F.col("denominacao"), F.col("tipo"), F.col("log_bonif")).alias("tipo"),
    )
    one = trimmed.groupBy("empresa", "nat_operacao").agg(F.max(F.struct("cfop", "tipo")).alias("one"))
    return one.select("empresa", "nat_operacao", F.col("one.cfop").alias("cfop"), F.col("one.tipo").alias("tipo"))


def movement_distribution(type_map: DataFrame) -> DataFrame:
    return type_map.groupBy("tipo").agg(F.count(F.lit(1)).alias("qtd")).orderBy(F.desc("qtd"), "tipo")


def build_products(items: DataFrame, families: DataFrame) -> DataFrame:
    names = families.select("empresa", F.trim("fm_cod_com").alias("familia_chave"), F.col("descricao").alias("familia_nome"))
    keyed = items.withColumn("familia_chave", F.trim("fm_cod_com"))
    return keyed.join(names, ["familia_chave", "empresa"], "left").select(
        "empresa", "it_codigo", F.col("desc_item").alias("descricao"), default_label("familia_nome").alias("familia")
    )


def build_customers(parties: DataFrame) -> DataFrame:
    return parties.filter(F.col("identific") != SUPPLIER_ONLY).select(
        "empresa",
        F.col("cod_emitente").alias("cod_cliente"),
        F.col("nome_emit").alias("nome"),
        trimmed_or_null("cgc").alias("cnpj"),
        zero_code_to_null("cod_canal_venda").alias("canal"),
        "cidade",
        F.col("estado").alias("uf"),
        zero_code_to_null("cod_rep").alias("cod_vendedor"),
        F.coalesce("lim_credito", F.lit(0)).cast(MONEY).alias("limite_credito"),
        (F.col("ind_cre_cli") == CREDIT_SUSPENDED).alias("credito_suspenso"),
        "dt_ult_venda",
    )


def build_sellers(reps: DataFrame) -> DataFrame:
    return reps.select(
        "empresa",
        F.col("cod_rep").alias("cod_vendedor"),
        "nome",
        F.col("dt_deslig").isNull().alias("ativo"),
        zero_code_to_null("rep_indireto").alias("rep_indireto"),
        trimmed_or_null("nome_ab_reg").alias("regiao"),
    )


def _valid_since(lines: DataFrame, since: Day | None) -> DataFrame:
    """Lines that are not cancelled, dated ``since`` or later; all of those where it is ``None``."""
    valid = lines.filter(F.col("dt_cancela").isNull())
    return valid if since is None else valid.filter(F.col("dt_emis_nota") >= F.lit(as_day(since)))


def group_invoice_lines(lines: DataFrame, since: Day | None = FULL_SINCE) -> DataFrame:
    """One row per invoice, item and customer; cancelled invoices left out.

    An item may be on several lines of one invoice. Attributes take the greatest
    value in binary order.
    """
    return (
        _valid_since(lines, since)
        .groupBy("nr_nota_fis", "it_codigo", "cd_emitente", "cod_estabel", "empresa")
        .agg(
            F.max("nat_operacao").alias("nat_operacao"),
            F.max("cd_vendedor").alias("cd_vendedor"),
            F.max("nr_pedcli").alias("nr_pedcli"),
            F.max("dt_emis_nota").alias("dt_emis_nota"),
            F.sum(F.coalesce("qt_faturada", F.lit(0))).alias("qt_caixas"),
            F.sum(F.coalesce("vl_merc_liq", F.lit(0))).alias("vl_merc_liq"),
        )
    )


def build_sales(
    lines: DataFrame,
    type_map: DataFrame,
    customers: DataFrame,
    seller_map: DataFrame,
    products: DataFrame,
    since: Day | None = FULL_SINCE,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Sales rows from ERP invoice lines.

    The seller is the customer's owner, else the mapped rep, else the line's rep.
    An operation code without a type counts as a sale; ``ignorar`` is left out.
    """
    kinds = type_map.select("empresa", "nat_operacao", F.col("tipo").alias("tipo_mapeado"))
    owners = customers.select(
        "empresa", F.col("cod_cliente").alias("cd_emitente"), F.col("cod_vendedor").alias("dono")
    )
    mapped = seller_map.select(
        "empresa", F.col("cod_rep").alias("rep_chave"), F.col("cod_vendedor").alias("mapeado")
    )
    families = products.select("empresa", "it_codigo", "familia")
    return (
        group_invoice_lines(lines, since)
        .withColumn("rep_chave", F.coalesce("cd_vendedor", F.lit("")))
        .join(kinds, ["nat_operacao", "empresa"], "left")
        .withColumn("tipo", F.coalesce("tipo_mapeado", F.lit(SALE)))
        .filter(F.col("tipo") != IGNORE)
        .join(mapped, ["rep_chave", "empresa"], "left")
        # Only what the joins with the large dimensions have to move: sums in their final width, one seller code.
        .select(
            "empresa",
            F.col("cod_estabel").alias("estabel"),
            F.col("nr_nota_fis").alias("nr_nota"),
            "nr_pedcli",
            "cd_emitente",
            F.coalesce("mapeado", "cd_vendedor").alias("cd_vendedor"),
            "it_codigo",
            F.col("qt_caixas").cast(BOXES).alias("qt_caixas"),
            F.abs("vl_merc_liq").cast(MONEY).alias("valor"),
            "tipo",
            "dt_emis_nota",
        )
        .join(owners, ["cd_emitente", "empresa"], "left")
        .withColumn("cod_vendedor", F.coalesce("dono", "cd_vendedor"))
        .join(families, ["it_codigo", "empresa"], "left")
        .select(
            "empresa",
            "estabel",
            "nr_nota",
            F.nullif("nr_pedcli", F.lit("")).alias("nr_pedido"),
            F.col("cd_emitente").alias("cod_cliente"),
            "cod_vendedor",
            "it_codigo",
            "qt_caixas",
            "valor",
            "tipo",
            F.coalesce("familia", F.lit(NO_FAMILY)).alias("familia"),
            F.col("dt_emis_nota").alias("data_emissao"),
            _loaded(loaded_at),
        )
    )


def unmapped_operations(
    lines: DataFrame, type_map: DataFrame, since: Day | None = FULL_SINCE, top: int | None = UNMAPPED_TOP
) -> DataFrame:
    """Codes that fell back to "sale", most frequent first; all of them where ``top`` is ``None``."""
    counted = _valid_since(lines, since).groupBy("empresa", "nat_operacao").agg(F.count(F.lit(1)).alias("qtd"))
    known = type_map.select("empresa", "nat_operacao")
    listed = (
        counted.join(known, ["nat_operacao", "empresa"], "left_anti")
        .select("empresa", "nat_operacao", "qtd")
        .orderBy(F.desc("qtd"), F.asc_nulls_last("empresa"), F.asc_nulls_last("nat_operacao"))
    )
    return listed if top is None else listed.limit(top)


def products_from_export(raw: DataFrame, company: str) -> DataFrame:
    grouped = raw.filter(F.col("it_codigo").isNotNull()).groupBy("it_codigo").agg(
        F.max("descricao").alias("descricao"), F.max(F.trim("familia")).alias("familia")
    )
    return grouped.select(
        F.lit(company).alias("empresa"), "it_codigo", "descricao", default_label("familia").alias("familia")
    )


# Attributes that a customer export refreshes; the others keep their value.
CUSTOMER_EXPORT_COLUMNS = ["nome", "cnpj", "canal", "cod_vendedor", "limite_credito"]


def customers_from_export(raw: DataFrame, company: str) -> DataFrame:
    grouped = raw.filter(F.col("cod_cliente").isNotNull()).groupBy("cod_cliente").agg(
        F.max("nome").alias("nome"),
        F.max("cnpj").alias("cnpj"),
        F.max(F.trim("canal")).alias("canal"),
        F.max(F.trim("cod_erc")).alias("cod_erc"),
        F.max("limite_disp").alias("limite_disp"),
    )
    return grouped.select(
        F.lit(company).alias("empresa"),
        "cod_cliente",
        "nome",
        "cnpj",
        F.nullif("canal", F.lit("")).alias("canal"),
        F.lit(None).cast("string").alias("cidade"),
        F.lit(None).cast("string").alias("uf"),
        F.nullif("cod_erc", F.lit("")).alias("cod_vendedor"),
        F.coalesce("limite_disp", F.lit(0)).cast(MONEY).alias("limite_credito"),
        F.lit(False).alias("credito_suspenso"),
        F.lit(None).cast("date").alias("dt_ult_venda"),
    )


def sellers_from_export(raw: DataFrame, company: str) -> DataFrame:
    """Sellers named in the customer export, so that names need not fall back to codes."""
    code = trimmed_or_null("cod_erc")
    grouped = raw.filter(code.isNotNull()).groupBy(code.alias("cod_vendedor")).agg(
        F.max(trimmed_or_null("nome_erc")).alias("nome")
    )
    return grouped.select(
        F.lit(company).alias("empresa"),
        "cod_vendedor",
        "nome",
        F.lit(True).alias("ativo"),
        F.lit(None).cast("string").alias("rep_indireto"),
        F.lit(None).cast("string").alias("regiao"),
    )


def sales_from_export(raw: DataFrame, products: DataFrame, company: str, loaded_at: Column | None = None) -> DataFrame:
    """Sales rows from the invoice export; a net value below zero is a return."""
    families = products.filter(F.col("empresa") == company).select("it_codigo", "familia")
    grouped = (
        raw.filter(F.col("nr_nota").isNotNull() & F.col("it_codigo").isNotNull() & F.col("cod_cliente").isNotNull())
        .groupBy("nr_nota", "it_codigo", "cod_cliente")
        .agg(
            F.max("estabel").alias("estabel"),
            F.max("nr_pedido").alias("nr_pedido"),
            F.max("cod_vendedor").alias("cod_vendedor"),
            F.sum(F.coalesce("qt_caixas", F.lit(0))).alias("qt_caixas"),
            F.sum(F.coalesce("valor", F.lit(0))).alias("liquido"),
            F.max("data_emissao").alias("data_emissao"),
        )
    )
    # Sums move through the join in their final width.
    narrow = grouped.withColumns(
        {
            "qt_caixas": F.col("qt_caixas").cast(BOXES),
            "valor": F.abs("liquido").cast(MONEY),
            "tipo": movement_of_net_value(F.col("liquido")),
        }
    ).drop("liquido")
    return narrow.join(families, "it_codigo", "left").select(
        F.lit(company).alias("empresa"),
        "estabel",
        "nr_nota",
        F.nullif("nr_pedido", F.lit("")).alias("nr_pedido"),
        "cod_cliente",
        "cod_vendedor",
        "it_codigo",
        "qt_caixas",
        "valor",
        "tipo",
        F.coalesce("familia", F.lit(NO_FAMILY)).alias("familia"),
        "data_emissao",
        _loaded(loaded_at),
    )


def orders_from_export(
    raw: DataFrame, customers: DataFrame, products: DataFrame, company: str, loaded_at: Column | None = None
) -> DataFrame:
    """Order items with status group, cut reason, owner and family."""
    owners = customers.filter(F.col("empresa") == company).select("cod_cliente", "cod_vendedor")
    families = products.filter(F.col("empresa") == company).select("it_codigo", "familia")
    grouped = (
        raw.filter(F.col("nr_pedido").isNotNull() & F.col("it_codigo").isNotNull() & F.col("cod_cliente").isNotNull())
        .groupBy("nr_pedido", "it_codigo", "cod_cliente")
        .agg(
            F.sum(F.coalesce("qt_caixas", F.lit(0))).alias("qt_caixas"),
            F.sum(F.coalesce("valor", F.lit(0))).alias("liquido"),
            F.max("tipo").alias("tipo"),
            F.max("status_item").alias("status_item"),
            F.max("data_pedido").alias("data_pedido"),
            F.max(F.trim("campanha")).alias("campanha"),
        )
    )
    # Sums move through the joins in their final width.
    narrow = grouped.withColumns({"qt_caixas": F.col("qt_caixas").cast(MONEY), "liquido": F.abs("liquido").cast(MONEY)})
    return (
        narrow.join(owners, "cod_cliente", "left")
        .join(families, "it_codigo", "left")
        .select(
            F.lit(company).alias("empresa"),
            "nr_pedido",
            "it_codigo",
            "cod_cliente",
            "cod_vendedor",
            "qt_caixas",
            F.col("liquido").alias("valor"),
            movement_of_order(F.col("tipo")).alias("tipo"),
            "status_item",
            status_group(F.col("status_item")).alias("status_grupo"),
            cut_reason(F.col("status_item")).alias("motivo_corte"),
            F.coalesce("familia", F.lit(NO_FAMILY)).alias("familia"),
            "data_pedido",
            F.nullif("campanha", F.lit("")).alias("campanha"),
            _loaded(loaded_at),
        )
    )


def tag_sales(sales: DataFrame, tags: DataFrame) -> DataFrame:
    """The sales that are tagged, with their campaign. ``tags`` holds one row for each tagged line of the same company.

    An establishment that is not told, on either side, is the empty one.
    """
    line = ("nr_nota", "it_codigo", "cod_cliente")
    marks = tags.filter(F.col("campanha_id").isNotNull()).select(
        *line, F.coalesce("estabel", F.lit("")).alias("estabel_marcado"), "campanha_id"
    )
    marked = sales.withColumn("estabel_marcado", F.coalesce("estabel", F.lit("")))
    return marked.join(marks, [*line, "estabel_marcado"]).drop("estabel_marcado")


def build_goal_table(raw: DataFrame) -> DataFrame:
    """Monthly goals with their defaults, one row per seller and month."""
    zero = F.lit(0)
    return raw.filter(F.col("cod_vendedor").isNotNull() & F.col("mes").isNotNull()).select(
        "cod_vendedor",
        "mes",
        F.coalesce("meta_visitas", zero).cast("int").alias("meta_visitas"),
        F.coalesce("meta_positivados", zero).cast("int").alias("meta_positivados"),
        F.coalesce("meta_cadastros", zero).cast("int").alias("meta_cadastros"),
        F.coalesce("fase", F.lit(1)).cast("int").alias("fase"),
        F.coalesce("meta_faturamento", zero).cast(MONEY).alias("meta_faturamento"),
        F.coalesce("meta_caixas", zero).cast(BOXES).alias("meta_caixas"),
    )
