"""Table contracts.

Column names and codes below are fixed values: they are the data contract of
the exports, of the ERP columns and of the dashboard that reads the marts.
Nothing is ever inferred from files.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_AMOUNT = T.DecimalType(16, 4)
MONEY = T.DecimalType(14, 2)
BOXES = T.DecimalType(12, 2)

# --- fixed values: movement types of a sales row ---------------------------
SALE = "venda"
RETURN = "devolucao"
BONUS = "bonificacao"
IGNORE = "ignorar"

# --- fixed values: status groups of an order item --------------------------
OPEN = "aberto"
INVOICED = "faturado"
CUT = "corte"

# --- fixed values: labels for missing attributes ---------------------------
NO_FAMILY = "SEM FAMILIA"
NO_CHANNEL = "Sem canal"
NO_REASON = "OUTRO"

# --- fixed values: visit outcomes, roles, run states ------------------------
VISIT_DONE = "realizada"
VISIT_STATUSES = ["realizada", "reagendada", "ausente", "fechado", "inexistente"]
AGENDA_PENDING = "pendente"
MANAGER = "master"
ROLES = ["vendedor", "master"]
RUNNING = "RODANDO"
DONE = "OK"
FAILED = "ERRO"
FIELD_APP_ORIGIN = "crm"

LOCAL_ZONE = "America/Sao_Paulo"

# Month of a fact's date, ``yyyy-MM``: the column stored facts are partitioned by.
MONTH_PARTITION = "mes_particao"


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "decimal(12,2)": BOXES,
    "decimal(14,2)": MONEY,
    "decimal(16,2)": T.DecimalType(16, 2),
    "decimal(16,4)": RAW_AMOUNT,
    "decimal(22,2)": T.DecimalType(22, 2),
    "decimal(24,2)": T.DecimalType(24, 2),
}


def _struct(spec: str) -> T.StructType:
    """Schema from ``"name type [not null], ..."``; needs no session."""
    fields = []
    for item in spec.split(", "):
        name, kind, *rest = item.split(" ")
        fields.append(T.StructField(name, _TYPES[kind], nullable=not rest))
    return T.StructType(fields)


INVOICE_LINES = _struct(
    "empresa string not null, cod_estabel string not null, serie string not null, "
    "nr_nota_fis string not null, nr_seq_fat int not null, it_codigo string, "
    "nat_operacao string, qt_faturada decimal(16,4), un_fatur string, "
    "vl_merc_liq decimal(16,4), vl_tot_item decimal(16,4), qt_devolvida decimal(16,4), "
    "cd_emitente string, cd_vendedor string, nome_ab_cli string, nr_pedcli string, "
    "dt_emis_nota date, dt_cancela date, ind_sit_nota int"
)
OPERATIONS = _struct(
    "empresa string not null, nat_operacao string not null, denominacao string, "
    "tipo int, cfop string, log_bonif boolean"
)
ITEMS = _struct(
    "empresa string not null, it_codigo string not null, desc_item string, "
    "fm_codigo string, fm_cod_com string, ge_codigo string, un string"
)
FAMILIES = _struct("empresa string not null, fm_cod_com string not null, descricao string")
PARTIES = _struct(
    "empresa string not null, cod_emitente string not null, nome_emit string, "
    "nome_abrev string, cgc string, cidade string, estado string, cod_rep string, "
    "cod_canal_venda string, lim_credito decimal(16,2), ind_cre_cli int, "
    "ind_sit_emitente int, dt_ult_venda date, identific int"
)
REPS = _struct(
    "empresa string not null, cod_rep string not null, nome string, nome_abrev string, "
    "nome_ab_reg string, rep_indireto string, dt_deslig date, ind_situacao int"
)
ORDER_ITEMS = _struct(
    "empresa string not null, nome_abrev string not null, nr_pedcli string not null, "
    "cod_emitente string, nr_sequencia int not null, it_codigo string, "
    "descricao_1 string, descricao_2 string, qt_pedida decimal(16,4), "
    "preco_venda decimal(16,4), valor_total_venda decimal(16,4), dt_venda date, "
    "representante string, situacao_pedido int"
)
REGISTRATIONS = _struct(
    "empresa string not null, tmp_emitente bigint, cod_emitente string, nome_emit string, "
    "cidade string, estado string, cgc_cpf string, telefone string, email string, "
    "cod_rep string, nome_abrev string, id_status int, desc_status string, "
    "canal_distribuicao string, dt_implantacao date, dt_impl_web date, "
    "dt_efetiva_coml date, lim_credito decimal(16,2), vlr_credito_sugerido decimal(16,2)"
)

TYPE_MAP = _struct("empresa string, nat_operacao string, cfop string, tipo string")
SELLER_MAP = _struct("empresa string, cod_rep string, cod_vendedor string")
RUN_LOG = _struct(
    "id string, tarefa string, iniciado_em timestamp, finalizado_em timestamp, "
    "status string, registros bigint, mensagem string"
)

SALES = _struct(
    "empresa string, estabel string, nr_nota string, nr_pedido string, "
    "cod_cliente string, cod_vendedor string, it_codigo string, "
    "qt_caixas decimal(12,2), valor decimal(14,2), tipo string, familia string, "
    "data_emissao date, carregado_em timestamp"
)
ORDERS = _struct(
    "empresa string, nr_pedido string, it_codigo string, cod_cliente string, "
    "cod_vendedor string, qt_caixas decimal(14,2), valor decimal(14,2), tipo string, "
    "status_item string, status_grupo string, motivo_corte string, familia string, "
    "data_pedido date, campanha string, carregado_em timestamp"
)
CUSTOMERS = _struct(
    "empresa string, cod_cliente string, nome string, cnpj string, canal string, "
    "cidade string, uf string, cod_vendedor string, limite_credito decimal(14,2), "
    "credito_suspenso boolean, dt_ult_venda date"
)
SELLERS = _struct(
    "empresa string, cod_vendedor string, nome string, ativo boolean, "
    "rep_indireto string, regiao string"
)
PRODUCTS = _struct("empresa string, it_codigo string, descricao string, familia string")

USERS = _struct("cod_vendedor string, nome string, role string, email string")
GOALS = _struct(
    "cod_vendedor string, mes string, meta_visitas int, meta_positivados int, "
    "meta_cadastros int, fase int, meta_faturamento decimal(14,2), meta_caixas decimal(12,2)"
)
VISITS = _struct(
    "id string, cod_cliente string, nome_cliente string, cod_vendedor string, "
    "lat_vendedor double, lng_vendedor double, status_visita string, "
    "observacao string, timestamp timestamp"
)
AGENDA = _struct(
    "id string, cod_cliente string, nome_cliente string, cod_vendedor string, "
    "data_visita date, status string, checkin_id string"
)
CAMPAIGNS = _struct(
    "id bigint, nome string, data_inicio date, data_fim date, mecanica string, "
    "parametros string, ativa boolean"
)

# Campaign of a sales line, as the sales app tells it.
SALE_TAGS = _struct(
    "nr_nota string, it_codigo string, cod_cliente string, estabel string, campanha_id bigint, alterado_em timestamp"
)
CAMPAIGN_DAYS = _struct(
    "empresa string, campanha_id bigint, cod_vendedor string, data_emissao date, "
    "faturamento decimal(24,2), caixas decimal(22,2)"
)
# Requests of the field to register a customer, in their order of arrival, and what came of them.
REQUESTS = _struct(
    "cod_cliente string, nome string, cnpj string, canal string, cidade string, uf string, "
    "cod_vendedor string, limite_credito string, ordem bigint, recebido_em timestamp"
)
REGISTERED = _struct("empresa string, cod_cliente string, cod_vendedor string, origem string, data_cadastro date")

# Natural keys, the column of most values first (see operators/marts.py). The
# sales key carries the establishment: two establishments may use the same
# invoice number.
KEYS = {
    "sales": ["nr_nota", "it_codigo", "cod_cliente", "estabel", "empresa"],
    "orders": ["nr_pedido", "it_codigo", "cod_cliente", "empresa"],
    "customers": ["cod_cliente", "empresa"],
    "sellers": ["cod_vendedor", "empresa"],
    "products": ["it_codigo", "empresa"],
    "type_map": ["nat_operacao", "empresa"],
    "users": ["cod_vendedor"],
    "goals": ["cod_vendedor", "mes"],
    "visits": ["id"],
    "agenda": ["id"],
    "campaigns": ["id"],
    "registered": ["cod_cliente", "empresa"],
    "invoice_lines": ["nr_nota_fis", "nr_seq_fat", "serie", "cod_estabel", "empresa"],
    "order_lines": ["nr_pedcli", "nr_sequencia", "nome_abrev", "empresa"],
}
