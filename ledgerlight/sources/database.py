"""ERP tables over JDBC: pruned, read-only, split by date."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.cleaning import decode_trim, first_extent, parse_flag, safe_int, strip
from ..functions.periods import Day, as_day, last_days, month_slices
from ..operators.filters import OrderScope

# --- fixed values: rows per fetch, window and far end of the open window -----
FETCH_SIZE = 5000
WINDOW_DAYS = 7
OPEN_END = "2999-12-31"
# --- bounds of a fetch by number ----------------------------------------------
LISTED_NUMBERS = 5000
NUMBERS_PER_STATEMENT = 500


@dataclass(frozen=True)
class SourceTable:
    """What to select from the ERP and how the columns are converted."""

    columns: dict[str, str]
    from_clause: str
    schema: object
    date_column: str | None = None
    # Our name of the number that the source finds a row of a fact by.
    number: str | None = None
    where: tuple[str, ...] = ()
    flags: frozenset[str] = field(default_factory=frozenset)
    extents: frozenset[str] = field(default_factory=frozenset)


# --- fixed values: ERP table and column names ---------------------------------
SOURCES = {
    "invoice_lines": SourceTable(
        {
            "cod_estabel": 'i."cod-estabel"',
            "serie": 'i."serie"',
            "nr_nota_fis": 'i."nr-nota-fis"',
            "nr_seq_fat": 'i."nr-seq-fat"',
            "it_codigo": 'i."it-codigo"',
            "nat_operacao": 'i."nat-operacao"',
            "qt_faturada": 'i."qt-faturada"',
            "un_fatur": 'i."un-fatur"',
            "vl_merc_liq": 'i."vl-merc-liq"',
            "vl_tot_item": 'i."vl-tot-item"',
            "qt_devolvida": 'i."qt-devolvida"',
            "cd_emitente": 'i."cd-emitente"',
            "cd_vendedor": 'i."cd-vendedor"',
            "nome_ab_cli": 'i."nome-ab-cli"',
            "nr_pedcli": 'i."nr-pedcli"',
            "dt_emis_nota": 'i."dt-emis-nota"',
            "dt_cancela": 'i."dt-cancela"',
            "ind_sit_nota": 'i."ind-sit-nota"',
        },
        'PUB."nota-fiscal" n JOIN PUB."it-nota-fisc" i ON i."cod-estabel" = n."cod-estabel" '
        'AND i."serie" = n."serie" AND i."nr-nota-fis" = n."nr-nota-fis"',
        schemas.INVOICE_LINES,
        date_column='n."dt-emis-nota"',
        number="nr_nota_fis",
        extents=frozenset({"qt_faturada", "qt_devolvida"}),
    ),
    "operations": SourceTable(
        {
            "nat_operacao": '"nat-operacao"',
            "denominacao": '"denominacao"',
            "tipo": '"tipo"',
            "cfop": '"cod-cfop"',
            "log_bonif": '"log-natureza-bonif"',
        },
        'PUB."natur-oper"',
        schemas.OPERATIONS,
        flags=frozenset({"log_bonif"}),
    ),
    "items": SourceTable(
        {
            "it_codigo": '"it-codigo"',
            "desc_item": '"desc-item"',
            "fm_codigo": '"fm-codigo"',
            "fm_cod_com": '"fm-cod-com"',
            "ge_codigo": '"ge-codigo"',
            "un": '"un"',
        },
        'PUB."item"',
        schemas.ITEMS,
    ),
    "families": SourceTable(
        {"fm_cod_com": '"fm-cod-com"', "descricao": '"descricao"'},
        'PUB."fam-comerc"',
        schemas.FAMILIES,
    ),
    "parties": SourceTable(
        {
            "cod_emitente": '"cod-emitente"',
            "nome_emit": '"nome-emit"',
            "nome_abrev": '"nome-abrev"',
            "cgc": '"cgc"',
            "cidade": '"cidade"',
            "estado": '"estado"',
            "cod_rep": '"cod-rep"',
            "cod_canal_venda": '"cod-canal-venda"',
            "lim_credito": '"lim-credito"',
            "ind_cre_cli": '"ind-cre-cli"',
            "ind_sit_emitente": '"ind-sit-emitente"',
            "dt_ult_venda": '"dt-ult-venda"',
            "identific": '"identific"',
        },
        'PUB."emitente"',
        schemas.PARTIES,
        where=('"identific" <> 2',),
    ),
    "reps": SourceTable(
        {
            "cod_rep": '"cod-rep"',
            "nome": '"nome"',
            "nome_abrev": '"nome-abrev"',
            "nome_ab_reg": '"nome-ab-reg"',
            "rep_indireto": '"rep-indireto"',
            "dt_deslig": '"dt-deslig"',
            "ind_situacao": '"ind-situacao"',
        },
        'PUB."repres"',
        schemas.REPS,
    ),
    "orders": SourceTable(
        {
            "nome_abrev": 'i."nome-abrev"',
            "nr_pedcli": 'i."nr-pedcli"',
            "cod_emitente": 'v."cod-emitente"',
            "nr_sequencia": 'i."nr-sequencia"',
            "it_codigo": 'i."it-codigo"',
            "descricao_1": 'it."descricao-1"',
            "descricao_2": 'it."descricao-2"',
            "qt_pedida": 'i."qt-pedida"',
            "preco_venda": 'i."vl-preori"',
            "valor_total_venda": 'i."qt-pedida" * i."vl-preori"',
            "dt_venda": 'v."dt-implant"',
            "representante": 'v."no-ab-reppri"',
            "situacao_pedido": 'v."cod-sit-ped"',
        },
        'PUB."ped-item" i INNER JOIN PUB."ped-venda" v ON i."nome-abrev" = v."nome-abrev" '
        'AND i."nr-pedcli" = v."nr-pedcli" LEFT JOIN PUB."item" it ON i."it-codigo" = it."it-codigo"',
        schemas.ORDER_ITEMS,
        date_column='v."dt-implant"',
        number="nr_pedcli",
    ),
    "registrations": SourceTable(
        {
            "tmp_emitente": 'w."tmp-emitente"',
            "cod_emitente": 'w."cod-emitente"',
            "nome_emit": 'w."nome-emit"',
            "cidade": 'w."cidade"',
            "estado": 'w."estado"',
            "cgc_cpf": 'w."cgc_cpf"',
            "telefone": 'w."telefone"',
            "email": 'w."e-mail"',
            "cod_rep": 'w."cod-rep"',
            "nome_abrev": 'w."nome-abrev"',
            "id_status": 'w."id_status"',
            "desc_status": 'w."desc_status"',
            "canal_distribuicao": 'w."canal-distribuicao"',
            "dt_implantacao": 'w."dt_implantacao"',
            "dt_impl_web": 'w."dt_impl_web"',
            "dt_efetiva_coml": 'w."dt_efetiva_coml"',
            "lim_credito": 'w."lim_credito"',
            "vlr_credito_sugerido": 'w."vlr_credito_sugerido"',
        },
        'PUB."wt_cliente_repres" w',
        schemas.REGISTRATIONS,
    ),
}


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _ranges(column: str, low: int, high: int) -> list[str]:
    return [f"{column} >= {low}", f"{column} < {high}"]


def order_scope_sql(scope: OrderScope) -> list[str]:
    """The order scope as conditions the source evaluates itself."""
    conditions = []
    if scope.excluded_sellers:
        listed = ", ".join(_quoted(s) for s in scope.excluded_sellers)
        conditions.append(f'v."no-ab-reppri" NOT IN ({listed})')
    conditions += [f'i."nome-abrev" <> {_quoted(c)}' for c in scope.excluded_customers]
    conditions += [f'i."it-codigo" NOT LIKE {_quoted(p + "%")}' for p in scope.excluded_item_prefixes]
    if scope.cancelled_state is not None:
        conditions.append(f'v."cod-sit-ped" <> {int(scope.cancelled_state)}')
    if scope.rep_range:
        conditions += _ranges('i."nr-pedcli"', *scope.rep_range)
    return conditions


def source_query(
    entity: str,
    span: tuple[Day, Day] | None = None,
    scope: OrderScope | None = None,
    rep_range: tuple[int, int] | None = None,
    numbers: Sequence[str] = (),
) -> str:
    """Select statement for an entity: listed columns only, filters at the source."""
    table = SOURCES[entity]
    conditions = list(table.where)
    if numbers:
        conditions.append(f"{table.columns[table.number]} IN ({', '.join(_quoted(n) for n in numbers)})")
    if span and table.date_column:
        low, high = (as_day(d).isoformat() for d in span)
        conditions.append(f"{table.date_column} BETWEEN {{d '{low}'}} AND {{d '{high}'}}")
    if entity == "orders":
        conditions += order_scope_sql(scope or OrderScope())
    if entity == "registrations" and rep_range:
        conditions += _ranges('w."cod-rep"', *rep_range)
    selected = ", ".join(f"{expr} AS {name}" for name, expr in table.columns.items())
    where = f" WHERE {' AND '.join(conditions)}" if conditions else ""
    return f"SELECT {selected} FROM {table.from_clause}{where}"


def convert_source(raw: DataFrame, entity: str, company: str) -> DataFrame:
    """Bring fetched columns to the contract types and stamp the company."""
    table = SOURCES[entity]
    found = dict(raw.dtypes)
    columns = [F.lit(company).alias("empresa")]
    for target in table.schema.fields:
        name, kind = target.name, target.dataType.simpleString()
        if name == "empresa":
            continue
        if name in table.flags:
            value = parse_flag(name)
        elif name in table.extents and found[name] == "string":
            value = first_extent(name)
        elif kind == "string":
            value = decode_trim(name) if found[name] == "binary" else strip(F.col(name).cast("string"))
        elif kind in ("int", "bigint"):
            value = F.col(name).try_cast(kind) if kind == "bigint" else safe_int(name)
        else:
            value = F.col(name).try_cast(kind)
        columns.append(value.alias(name))
    return raw.select(*columns)


def read_source_table(
    spark: SparkSession,
    options: dict[str, str],
    entity: str,
    company: str,
    span: tuple[Day, Day] | None = None,
    scope: OrderScope | None = None,
    rep_range: tuple[int, int] | None = None,
    numbers: Sequence[str] = (),
) -> DataFrame:
    """One statement, one partition: for the dimensions and for short windows.

    ``options`` are Spark's JDBC options (url, driver, user, password); put the
    statement that makes the session read-only and lock-free for your database
    into ``sessionInitStatement``.
    """
    query = source_query(entity, span, scope, rep_range, numbers)
    settings = {"fetchsize": str(FETCH_SIZE), **options, "query": query}
    return convert_source(spark.read.format("jdbc").options(**settings).load(), entity, company)


def read_by_year(
    spark: SparkSession,
    options: dict[str, str],
    entity: str,
    company: str,
    first_year: int,
    last_year: int,
    slices_per_year: int = 12,
    scope: OrderScope | None = None,
) -> DataFrame:
    """Whole history, read as date slices in parallel; a slice is one partition."""
    spans = month_slices(first_year, last_year, slices_per_year)
    return read_spans(spark, options, entity, company, spans, scope)


def read_spans(
    spark: SparkSession,
    options: dict[str, str],
    entity: str,
    company: str,
    spans: Iterable[tuple[Day, Day]],
    scope: OrderScope | None = None,
) -> DataFrame:
    """Read date slices of a fact in parallel, each with its own source filter.

    Each slice is its own statement with the date condition inside, on the column
    the source indexes, and becomes one partition of the union.
    """
    if not SOURCES[entity].date_column:
        raise ValueError(f"{entity} has no date to split by")
    parts = [read_source_table(spark, options, entity, company, span, scope) for span in spans]
    return reduce(DataFrame.unionByName, parts)


def read_by_key(
    spark: SparkSession,
    options: dict[str, str],
    entity: str,
    company: str,
    keys: DataFrame,
    spans: Iterable[tuple[Day, Day]],
    scope: OrderScope | None = None,
) -> DataFrame:
    """The rows of a fact that have one of ``keys``, whenever they are dated.

    A few numbers are asked for by name. More than ``LISTED_NUMBERS`` would make endless statements: then ``spans``
    are read like the history, and the rows picked here.
    """
    number = SOURCES[entity].number
    listed = [r[0] for r in keys.select(number).filter(F.col(number).isNotNull()).distinct().limit(LISTED_NUMBERS + 1).collect()]
    if len(listed) > LISTED_NUMBERS:
        rows = read_spans(spark, options, entity, company, spans, scope)
    elif listed:
        groups = [listed[k : k + NUMBERS_PER_STATEMENT] for k in range(0, len(listed), NUMBERS_PER_STATEMENT)]
        parts = [read_source_table(spark, options, entity, company, scope=scope, numbers=group) for group in groups]
        rows = reduce(DataFrame.unionByName, parts)
    else:
        return spark.createDataFrame([], SOURCES[entity].schema)
    return rows.join(keys, keys.columns, "left_semi")


def default_first_year(as_of: Day) -> int:
    """History starts two years before the current year unless told otherwise."""
    return as_day(as_of).year - 2


def read_window(df: DataFrame, column: str, as_of: Day, days: int = WINDOW_DAYS) -> DataFrame:
    """Rows of the last ``days`` days, with no upper end."""
    first, _ = last_days(as_of, days)
    return df.filter(F.col(column) >= F.lit(first))


def high_water_mark(df: DataFrame, column: str) -> DataFrame:
    """Latest date or time already loaded, one row: where an incremental read may start."""
    return df.agg(F.max(column).alias("ult_valor"))
