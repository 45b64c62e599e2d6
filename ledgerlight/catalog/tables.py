"""The given test tables seen as the tables this engine works on."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import local_day
from ..operators import marts
from ..operators.rollups import SalesRollups, campaign_days
from ..schemas import LOCAL_ZONE, MONTH_PARTITION
from ..sinks.manifest import part_name
from ..sinks.rollups import monthly_sales, rollups_in, store_rollups
from ..sinks.shuffles import cleaned_shuffles
from .stage import shared_folder, staged

COMPANY = "c1"
START, END, AS_OF = dt.date(1998, 1, 1), dt.date(1998, 1, 31), dt.date(1998, 1, 31)
SELLER = "7"
# Events are 26 years younger than the orders; their local days are moved back.
EVENT_SHIFT_MONTHS = -26 * 12
# Lines that one task sorts: some 200 bytes each.
LINES_PER_PART = 400_000


def text(column: str):
    return F.col(column).cast("string")


class Tables:
    """Lazy views over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str, state: str = ""):
        self.spark = spark
        self.folder = folder.rstrip("/")
        # What derived tables are kept by: the folder and the state of its files.
        self.source = f"{self.folder} {state}"

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def supplier_count(self):
        return self.raw("supplier").agg(F.count(F.lit(1))).scalar()

    @cached_property
    def line_count(self) -> int:
        return self.raw("lineitem").count()  # from the footers of the files

    @property
    def line_parts(self) -> int:
        """Partitions that the lines ask for."""
        return -(-self.line_count // LINES_PER_PART)

    @property
    def large(self) -> bool:
        return self.line_parts > self.spark.sparkContext.defaultParallelism

    # --- ERP side ------------------------------------------------------------
    def by_number(self, df: DataFrame, key: str) -> DataFrame:
        """The rows with their order number as text; a large table in as many partitions as the number of lines asks for."""
        keyed = df.withColumn("nr", text(key)).drop(key)
        return keyed.repartition(self.line_parts, "nr") if self.large else keyed

    @cached_property
    def order_lines(self) -> DataFrame:
        """Order lines with their order; amounts are cast before they are multiplied.

        Both sides are joined on the text that invoices and orders are grouped by, so no grouping shuffles the lines again.
        A partition holds about ``LINES_PER_PART`` lines at any size of the tables: its sorts stay in memory.
        """
        price = F.col("l_extendedprice").cast("decimal(14,2)")
        net = (price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(16,4)")
        orders = self.by_number(self.raw("orders"), "o_orderkey")
        return self.by_number(self.raw("lineitem"), "l_orderkey").join(orders, "nr").select(
            "nr",
            text("o_custkey").alias("cliente"),
            text("l_suppkey").alias("rep"),
            text("l_partkey").alias("item"),
            F.col("l_linenumber").alias("seq"),
            F.col("l_quantity").cast("decimal(16,4)").alias("qt"),
            net.alias("liquido"),
            price.cast("decimal(16,4)").alias("bruto"),
            F.col("l_returnflag").alias("operacao"),
            F.col("l_linestatus").alias("estabel"),
            F.to_date("l_shipdate").alias("emissao"),
            F.to_date("o_orderdate").alias("data_pedido"),
            F.col("l_tax").cast("decimal(4,2)").alias("taxa"),
            "o_orderstatus",
            "o_orderpriority",
        )

    @cached_property
    def invoice_lines(self) -> DataFrame:
        none = F.lit(None)
        return self.order_lines.select(
            F.lit(COMPANY).alias("empresa"),
            F.col("estabel").alias("cod_estabel"),
            F.lit("U").alias("serie"),
            F.col("nr").alias("nr_nota_fis"),
            F.col("seq").alias("nr_seq_fat"),
            F.col("item").alias("it_codigo"),
            F.col("operacao").alias("nat_operacao"),
            F.col("qt").alias("qt_faturada"),
            F.lit("CX").alias("un_fatur"),
            F.col("liquido").alias("vl_merc_liq"),
            F.col("bruto").alias("vl_tot_item"),
            F.lit(0).cast("decimal(16,4)").alias("qt_devolvida"),
            F.col("cliente").alias("cd_emitente"),
            F.col("rep").alias("cd_vendedor"),
            none.cast("string").alias("nome_ab_cli"),
            F.col("nr").alias("nr_pedcli"),
            F.col("emissao").alias("dt_emis_nota"),
            none.cast("date").alias("dt_cancela"),
            F.lit(2).alias("ind_sit_nota"),
        )

    @cached_property
    def cancellable_lines(self) -> DataFrame:
        """The same lines, with those of pending low-priority orders cancelled."""
        cancelled = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
        day = self.order_lines.select("nr", "seq", "item", "rep", "emissao", "estabel", "operacao", "cliente", "qt",
                                      "liquido", F.when(cancelled, F.col("emissao")).alias("dt_cancela"))
        return day.select(
            F.lit(COMPANY).alias("empresa"),
            F.col("estabel").alias("cod_estabel"),
            F.col("nr").alias("nr_nota_fis"),
            F.col("item").alias("it_codigo"),
            F.col("operacao").alias("nat_operacao"),
            F.col("qt").alias("qt_faturada"),
            F.col("liquido").alias("vl_merc_liq"),
            F.col("cliente").alias("cd_emitente"),
            F.col("rep").alias("cd_vendedor"),
            F.col("nr").alias("nr_pedcli"),
            F.col("emissao").alias("dt_emis_nota"),
            "dt_cancela",
        )

    @cached_property
    def operations(self) -> DataFrame:
        """One operation code per return flag of the lines."""
        flag = F.col("l_returnflag")
        codes = self.raw("lineitem").select(flag).distinct()
        name = F.when(flag == "N", "VENDA DE MERCADORIA").when(flag == "R", "DEVOLUCAO DE VENDA").otherwise("BONIFICACAO")
        return codes.select(
            F.lit(COMPANY).alias("empresa"),
            flag.alias("nat_operacao"),
            name.alias("denominacao"),
            F.when(flag == "R", 1).otherwise(2).alias("tipo"),
            F.lit("5102").alias("cfop"),
            F.lit(False).alias("log_bonif"),
        )

    @cached_property
    def type_map(self) -> DataFrame:
        """Staged, so that its size is known: a join must not shuffle the lines by their few operation codes."""
        return staged(self.spark, self.source, "type_map", marts.classify_operations(self.operations))

    @cached_property
    def part_operations(self) -> DataFrame:
        """Operation names of every kind, built from the parts."""
        size = F.col("p_size")
        name = (
            F.when(size <= 8, F.concat(F.lit("Venda de "), "p_name"))
            .when(size <= 16, F.concat(F.lit("DEV. DE VENDA "), "p_name"))
            .when(size <= 22, F.concat(F.lit("Amostra "), "p_name"))
            .when(size <= 28, F.concat(F.lit("DEVOLUCAO DE COMPRA "), "p_name"))
            .when(size <= 34, F.concat(F.lit("Dev bonificação venda "), "p_name"))
            .when(size <= 40, F.concat(F.lit("Doação "), "p_name"))
            .when(size <= 44, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("Remessa para "), "p_name"))
        )
        return self.raw("part").select(
            F.lit(COMPANY).alias("empresa"),
            F.concat(F.lit(" "), text("p_partkey")).alias("nat_operacao"),
            name.alias("denominacao"),
            F.when(F.col("p_type") == "PROMO", 1).otherwise(2).alias("tipo"),
            F.when(F.col("p_type") != "SMALL", F.concat(F.lit("5."), "p_type", F.lit(" "))).alias("cfop"),
            F.when(F.col("p_brand") == "Brand#1", True).when(F.col("p_brand") == "Brand#2", F.lit(None)).otherwise(False)
            .alias("log_bonif"),
        )

    @cached_property
    def items(self) -> DataFrame:
        return self.raw("part").select(
            F.lit(COMPANY).alias("empresa"),
            text("p_partkey").alias("it_codigo"),
            F.col("p_name").alias("desc_item"),
            F.col("p_brand").alias("fm_codigo"),
            F.concat("p_type", F.lit("  ")).alias("fm_cod_com"),
            text("p_size").alias("ge_codigo"),
            F.lit("CX").alias("un"),
        )

    @cached_property
    def families(self) -> DataFrame:
        """Families of the part types; one has a blank name, one is missing."""
        kind = F.col("p_type")
        return self.raw("part").select(kind).distinct().filter(kind != "LARGE").select(
            F.lit(COMPANY).alias("empresa"),
            F.concat(F.lit(" "), kind).alias("fm_cod_com"),
            F.when(kind == "PROMO", "  ").otherwise(F.concat(F.lit("FAM "), kind)).alias("descricao"),
        )

    def build_products(self) -> DataFrame:
        return marts.build_products(self.items, self.families)

    @cached_property
    def products(self) -> DataFrame:
        return staged(self.spark, self.source, "products", self.build_products())

    @cached_property
    def parties(self) -> DataFrame:
        """Customers, and the suppliers that a party table also holds."""
        balance = F.col("c_acctbal").cast("decimal(16,2)")
        nation = self.raw("nation").withColumnRenamed("n_nationkey", "c_nationkey")
        owner = F.when(balance < 0, "0").otherwise((F.col("c_custkey") % self.supplier_count).cast("string"))
        customers = self.raw("customer").join(nation, "c_nationkey").select(
            F.lit(COMPANY).alias("empresa"),
            text("c_custkey").alias("cod_emitente"),
            F.col("c_name").alias("nome_emit"),
            F.col("c_name").alias("nome_abrev"),
            F.when(F.col("c_mktsegment") == "BUILDING", " ").otherwise(F.lpad(text("c_custkey"), 14, "0")).alias("cgc"),
            F.col("n_name").alias("cidade"),
            text("n_regionkey").alias("estado"),
            F.concat(F.lit(" "), owner).alias("cod_rep"),
            F.when(F.col("c_mktsegment") == "FURNITURE", "0").otherwise(F.col("c_mktsegment")).alias("cod_canal_venda"),
            F.abs(balance).alias("lim_credito"),
            F.when(balance < 0, 4).otherwise(1).alias("ind_cre_cli"),
            F.lit(1).alias("ind_sit_emitente"),
            F.lit(None).cast("date").alias("dt_ult_venda"),
            F.lit(1).alias("identific"),
        )
        suppliers = self.raw("supplier").select(
            F.lit(COMPANY).alias("empresa"),
            F.concat(F.lit("S"), text("s_suppkey")).alias("cod_emitente"),
            F.col("s_name").alias("nome_emit"),
            F.lit(2).alias("identific"),
        )
        return customers.unionByName(suppliers, allowMissingColumns=True)

    def build_customers(self) -> DataFrame:
        return marts.build_customers(self.parties)

    @cached_property
    def customers(self) -> DataFrame:
        return staged(self.spark, self.source, "customers", self.build_customers())

    @cached_property
    def reps(self) -> DataFrame:
        nation = self.raw("nation").withColumnRenamed("n_nationkey", "s_nationkey")
        region = self.raw("region").withColumnRenamed("r_regionkey", "n_regionkey")
        active = F.col("s_acctbal") >= 0
        return self.raw("supplier").join(nation, "s_nationkey").join(region, "n_regionkey").select(
            F.lit(COMPANY).alias("empresa"),
            text("s_suppkey").alias("cod_rep"),
            F.col("s_name").alias("nome"),
            F.concat(F.lit("REP "), text("s_suppkey")).alias("nome_abrev"),
            F.col("r_name").alias("nome_ab_reg"),
            text("s_nationkey").alias("rep_indireto"),
            F.when(~active, F.lit(dt.date(1997, 12, 31))).alias("dt_deslig"),
            F.lit(1).alias("ind_situacao"),
        )

    def build_sellers(self) -> DataFrame:
        return marts.build_sellers(self.reps)

    @cached_property
    def sellers(self) -> DataFrame:
        return staged(self.spark, self.source, "sellers", self.build_sellers())

    @cached_property
    def seller_map(self) -> DataFrame:
        """Reps with a negative balance answer to another seller code."""
        return self.raw("supplier").filter(F.col("s_acctbal") < 0).select(
            F.lit(COMPANY).alias("empresa"),
            text("s_suppkey").alias("cod_rep"),
            text("s_nationkey").alias("cod_vendedor"),
        )

    # --- marts -----------------------------------------------------------------
    def build_sales(self, lines: DataFrame | None = None) -> DataFrame:
        return marts.build_sales(
            self.invoice_lines if lines is None else lines,
            self.type_map,
            self.customers,
            self.seller_map,
            self.products,
            since="1990-01-01",
            loaded_at=F.col("dt_emis_nota"),
        )

    @cached_property
    def sales(self) -> DataFrame:
        return staged(self.spark, self.source, "sales", self.build_sales(), "data_emissao", even=not self.large)

    @cached_property
    def rollups(self) -> SalesRollups:
        """The rollups of the sales, stored next to them."""
        path = f"{shared_folder(self.spark)}/rollups-{uuid.uuid4().hex[:12]}"
        months = [r[0] for r in self.sales.select(MONTH_PARTITION).distinct().collect()]  # one for each month
        source = {part_name(MONTH_PARTITION, month): "1" for month in months}
        with cleaned_shuffles(self.spark):
            store_rollups(self.spark, monthly_sales(self.sales.drop("empresa")), source, path)
        return rollups_in(self.spark, path, COMPANY)

    @cached_property
    def campaign_days(self) -> DataFrame:
        return staged(self.spark, self.source, "campaign_days", campaign_days(self.tagged_sales))

    @cached_property
    def order_export(self) -> DataFrame:
        """Order items as the order export would hold them."""
        status = (
            F.when(F.col("o_orderstatus") == "F", "Faturado")
            .when(F.col("o_orderstatus") == "O", "Carteira")
            .otherwise(F.col("o_orderpriority"))
        )
        kind = F.when(F.col("taxa") == F.lit("0.08").cast("decimal(4,2)"), "Dev").when(
            F.col("taxa") == F.lit("0.07").cast("decimal(4,2)"), "Bonificacao"
        ).otherwise("Venda")
        return self.order_lines.select(
            F.col("item").alias("it_codigo"),
            F.col("nr").alias("nr_pedido"),
            F.col("qt").alias("qt_caixas"),
            F.col("liquido").alias("valor"),
            F.col("cliente").alias("cod_cliente"),
            status.alias("status_item"),
            kind.alias("tipo"),
            "data_pedido",
            F.when(F.col("estabel") == "O", F.concat(F.lit("CAMP "), "operacao")).otherwise(" ").alias("campanha"),
        )

    def build_orders(self) -> DataFrame:
        return marts.orders_from_export(
            self.order_export, self.customers, self.products, COMPANY, loaded_at=F.col("data_pedido")
        )

    @cached_property
    def orders(self) -> DataFrame:
        return staged(self.spark, self.source, "orders", self.build_orders(), "data_pedido", even=not self.large)

    @cached_property
    def invoice_export(self) -> DataFrame:
        """Invoice lines as the invoice export would hold them: returns are negative."""
        sign = F.when(F.col("operacao") == "R", -F.col("liquido")).otherwise(F.col("liquido"))
        return self.order_lines.select(
            F.col("item").alias("it_codigo"),
            F.col("nr").alias("nr_nota"),
            F.col("qt").alias("qt_caixas"),
            sign.alias("valor"),
            F.col("cliente").alias("cod_cliente"),
            F.col("emissao").alias("data_emissao"),
            F.when(F.col("estabel") == "O", F.col("nr")).otherwise("").alias("nr_pedido"),
            "estabel",
            F.col("bruto").alias("vl_bruto"),
            F.col("rep").alias("cod_vendedor"),
            F.lit(0).cast("decimal(16,4)").alias("vl_desconto"),
        )

    # --- field app ----------------------------------------------------------------
    @cached_property
    def visits(self) -> DataFrame:
        """Events as visits. The local day is taken first and then moved back."""
        kind = F.col("event_type")
        status = (
            F.when(kind == "purchase", "realizada").when(kind == "view", "reagendada").when(kind == "click", "ausente")
            .when(kind == "error", "fechado").when(kind == "signup", "inexistente")
        )
        local = F.from_utc_timestamp(F.col("ts").cast("timestamp"), LOCAL_ZONE)
        moved = F.to_utc_timestamp(local + F.make_ym_interval(F.lit(0), F.lit(EVENT_SHIFT_MONTHS)), LOCAL_ZONE)
        return self.raw("events").select(
            text("event_id").alias("id"),
            text("user_id").alias("cod_cliente"),
            F.concat(F.lit("Cliente "), text("user_id")).alias("nome_cliente"),
            text("user_id").alias("cod_vendedor"),
            F.lit(None).cast("double").alias("lat_vendedor"),
            F.lit(None).cast("double").alias("lng_vendedor"),
            status.alias("status_visita"),
            F.col("props").alias("observacao"),
            moved.alias("timestamp"),
        )

    @cached_property
    def agenda(self) -> DataFrame:
        planned = self.visits.filter(F.col("status_visita").isin("reagendada", "inexistente"))
        return planned.select(
            "id", "cod_cliente", "nome_cliente", "cod_vendedor",
            local_day("timestamp").alias("data_visita"),
            F.when(F.col("status_visita") == "reagendada", "pendente").otherwise("feita").alias("status"),
            F.lit(None).cast("string").alias("checkin_id"),
        )

    @cached_property
    def users(self) -> DataFrame:
        return self.raw("supplier").select(
            text("s_suppkey").alias("cod_vendedor"),
            F.col("s_name").alias("nome"),
            F.when(F.col("s_nationkey") == 0, "master").otherwise("vendedor").alias("role"),
            F.concat(text("s_suppkey"), F.lit("@example.com")).alias("email"),
        )

    @cached_property
    def goal_input(self) -> DataFrame:
        key = F.col("s_suppkey")
        month = F.explode(F.array(F.lit("1997-12"), F.lit("1998-01"))).alias("mes")
        return self.raw("supplier").select(
            text("s_suppkey").alias("cod_vendedor"),
            month,
            (key % 40).alias("meta_visitas"),
            (key % 5).alias("meta_positivados"),
            F.when(key % 3 > 0, key % 3).alias("meta_cadastros"),
            F.lit(None).cast("int").alias("fase"),
            (key * 100).cast("decimal(14,2)").alias("meta_faturamento"),
            (key % 90).cast("decimal(12,2)").alias("meta_caixas"),
        )

    @cached_property
    def goals(self) -> DataFrame:
        return marts.build_goal_table(self.goal_input)

    @cached_property
    def campaigns(self) -> DataFrame:
        """One campaign per nation, 20 days long, starting every 4 days."""
        key = F.col("n_nationkey")
        first = F.date_add(F.lit(dt.date(1997, 12, 1)), (key * 4).cast("int"))
        return self.raw("nation").select(
            key.cast("bigint").alias("id"),
            F.col("n_name").alias("nome"),
            first.alias("data_inicio"),
            F.date_add(first, 20).alias("data_fim"),
            F.lit("desconto").alias("mecanica"),
        )

    @cached_property
    def tagged_sales(self) -> DataFrame:
        """Sales with the campaign of their item."""
        return self.sales.withColumn("campanha_id", F.col("it_codigo").cast("bigint") % 30)

    @cached_property
    def registered(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            text("c_custkey").alias("cod_cliente"),
            (key % self.supplier_count).cast("string").alias("cod_vendedor"),
            F.when(key % 2 == 0, "crm").otherwise("totvs").alias("origem"),
            F.date_add(F.lit(dt.date(1998, 1, 1)), (key % 60).cast("int")).alias("data_cadastro"),
        )

    @cached_property
    def run_log(self) -> DataFrame:
        """Events as runs: errors failed, sign-ups still run, the rest ended well."""
        kind = F.col("event_type")
        begun = F.col("ts").cast("timestamp")
        micros = (F.col("value") * 1_000_000).cast("bigint")
        return self.raw("events").select(
            F.col("event_id").alias("id"),
            F.concat(F.lit("carga:"), kind).alias("tarefa"),
            begun.alias("iniciado_em"),
            F.when(kind != "signup", F.timestamp_micros(F.unix_micros(begun) + micros)).alias("finalizado_em"),
            F.when(kind == "error", "ERRO").when(kind == "signup", "RODANDO").otherwise("OK").alias("status"),
            F.col("user_id").alias("registros"),
            F.col("props").alias("mensagem"),
        )

    # --- order scan and pilot -----------------------------------------------------
    @cached_property
    def scan_order_items(self) -> DataFrame:
        """Order items keyed by customer name and order number, as the ERP holds them."""
        lines = self.raw("lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
        named = self.raw("orders").select("o_orderkey", "o_custkey")
        item = F.when(F.col("l_tax").cast("decimal(4,2)") == F.lit("0.08").cast("decimal(4,2)"), F.concat(F.lit("60."), text("l_partkey")))
        return lines.join(named, "o_orderkey").select(
            F.concat(F.lit("CLI "), text("o_custkey")).alias("nome_abrev"),
            order_number().alias("nr_pedcli"),
            F.col("l_linenumber").alias("nr_sequencia"),
            F.coalesce(item, text("l_partkey")).alias("it_codigo"),
            F.col("l_quantity").cast("decimal(16,4)").alias("qt_pedida"),
            F.col("l_extendedprice").cast("decimal(14,2)").cast("decimal(16,4)").alias("preco_venda"),
        )

    @cached_property
    def scan_orders(self) -> DataFrame:
        priority = F.col("o_orderpriority")
        rep = F.when(priority == "5-LOW", "LOGISTICA").otherwise(
            F.concat(F.lit("REP "), (F.col("o_custkey") % self.supplier_count).cast("string"))
        )
        return self.raw("orders").select(
            F.concat(F.lit("CLI "), text("o_custkey")).alias("nome_abrev"),
            order_number().alias("nr_pedcli"),
            text("o_custkey").alias("cod_emitente"),
            F.to_date("o_orderdate").alias("dt_venda"),
            rep.alias("representante"),
            F.when(F.col("o_orderstatus") == "P", 6).otherwise(1).alias("situacao_pedido"),
        )

    @cached_property
    def scan_items(self) -> DataFrame:
        return self.raw("part").select(
            text("p_partkey").alias("it_codigo"), F.col("p_name").alias("descricao_1"), F.col("p_brand").alias("descricao_2")
        )


def order_number():
    """Order number after the rep code, as in ``6003.207033``."""
    return F.concat((F.col("o_orderkey") % 10 + 6000).cast("string"), F.lit("."), F.col("o_orderkey").cast("string"))
