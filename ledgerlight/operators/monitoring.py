"""Run monitoring, source profiling and contract checks."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.periods import Day, as_day
from ..schemas import FAILED, RUNNING

RUNS_SHOWN = 30
FAILURES_SHOWN = 20
SAMPLE_ROWS = 5


def _newest_first():
    return F.desc_nulls_last("iniciado_em"), F.desc_nulls_last("id")


def recent_runs(log: DataFrame, as_of: Column, size: int = RUNS_SHOWN) -> DataFrame:
    """Latest runs with their duration; a running one counts up to ``as_of``."""
    micros = F.unix_micros(F.coalesce("finalizado_em", as_of)) - F.unix_micros("iniciado_em")
    return (
        log.orderBy(*_newest_first())
        .limit(size)
        .select(
            "id", "tarefa", "status", "registros", "mensagem",
            F.date_format("iniciado_em", "dd/MM HH:mm:ss").alias("inicio"),
            F.date_format("finalizado_em", "HH:mm:ss").alias("fim"),
            F.round(micros.cast("decimal(20,0)") / 1_000_000).cast("bigint").alias("segundos"),
        )
    )


def running_now(log: DataFrame) -> DataFrame:
    return log.filter(F.col("status") == RUNNING).orderBy(*_newest_first())


def recent_failures(log: DataFrame, size: int = FAILURES_SHOWN) -> DataFrame:
    return (
        log.filter(F.col("status") == FAILED)
        .orderBy(*_newest_first())
        .limit(size)
        .select("id", "tarefa", "mensagem", "iniciado_em")
    )


def _volume(df: DataFrame, name: str, date_column: str | None) -> DataFrame:
    counted = [F.count(F.lit(1)).alias("linhas")]
    if date_column:
        counted.append(F.max(date_column).alias("ultima"))
    latest = F.col("ultima") if date_column else F.lit(None)
    return df.agg(*counted).select(F.lit(name).alias("tabela"), "linhas", latest.cast("string").alias("ate"))


def mart_volume(tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Rows and latest date per table; ``tables`` maps a name to (table, date column)."""
    return reduce(DataFrame.unionByName, (_volume(df, name, column) for name, (df, column) in tables.items()))


def profile_source(headers: DataFrame, tables: dict[str, DataFrame], date_column: str) -> DataFrame:
    """Row counts of the source tables, latest date of the headers."""
    return mart_volume({"headers": (headers, date_column), **{n: (df, None) for n, df in tables.items()}})


def source_sample(df: DataFrame, order: list[str], size: int = SAMPLE_ROWS) -> DataFrame:
    """A few rows to look at; ordered, so that a second look shows the same rows."""
    return df.orderBy(*order).limit(size)


def distinct_codes(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(F.asc_nulls_last(column))


def operation_codes(operations: DataFrame) -> DataFrame:
    return operations.select("nat_operacao", "denominacao", "tipo", "cfop").orderBy("nat_operacao")


@dataclass(frozen=True)
class Contract:
    """Rules a table must keep: filled columns, value domains, a unique key."""

    key: tuple[str, ...]
    filled: tuple[str, ...] = ()
    domains: dict[str, tuple[str, ...]] | None = None
    not_negative: tuple[str, ...] = ()

    def row_rules(self) -> dict[str, Column]:
        """Rule name to a condition that is true for a violating row."""
        rules = {f"not_null:{c}": F.col(c).isNull() for c in self.filled}
        for column, values in (self.domains or {}).items():
            rules[f"domain:{column}"] = ~F.coalesce(F.col(column).isin(list(values)), F.lit(True))
        for column in self.not_negative:
            rules[f"not_negative:{column}"] = F.coalesce(F.col(column) < 0, F.lit(False))
        return rules


# The rules of each table, to be checked after a load.
CONTRACTS = {
    "type_map": Contract(
        ("empresa", "nat_operacao"),
        ("empresa", "nat_operacao", "tipo"),
        {"tipo": (schemas.SALE, schemas.RETURN, schemas.BONUS, schemas.IGNORE)},
    ),
    "sales": Contract(
        tuple(schemas.KEYS["sales"]),
        ("empresa", "nr_nota", "cod_cliente", "qt_caixas", "valor", "tipo", "data_emissao", "carregado_em"),
        {"tipo": (schemas.SALE, schemas.RETURN, schemas.BONUS)},
        ("valor",),
    ),
    "orders": Contract(
        tuple(schemas.KEYS["orders"]),
        ("empresa", "nr_pedido", "it_codigo", "cod_cliente", "carregado_em"),
        {"tipo": (schemas.SALE, schemas.RETURN), "status_grupo": (schemas.OPEN, schemas.INVOICED, schemas.CUT)},
        ("valor",),
    ),
    "customers": Contract(tuple(schemas.KEYS["customers"]), ("empresa", "cod_cliente")),
    "sellers": Contract(tuple(schemas.KEYS["sellers"]), ("empresa", "cod_vendedor")),
    "products": Contract(tuple(schemas.KEYS["products"]), ("empresa", "it_codigo")),
    "users": Contract(tuple(schemas.KEYS["users"]), ("cod_vendedor",), {"role": tuple(schemas.ROLES)}),
    "visits": Contract(tuple(schemas.KEYS["visits"]), ("id",), {"status_visita": tuple(schemas.VISIT_STATUSES)}),
}


def contract_checks(df: DataFrame, contract: Contract) -> DataFrame:
    """Violations per rule: (regra, violacoes). Row rules take one pass."""
    rules = contract.row_rules()
    counted = df.agg(*(F.count(F.when(cond, 1)).alias(name) for name, cond in rules.items()))
    rows = counted.select(
        F.explode(
            F.array(*(F.struct(F.lit(n).alias("regra"), F.col(f"`{n}`").alias("violacoes")) for n in rules))
        ).alias("r")
    ).select("r.regra", "r.violacoes")
    repeated = (
        df.groupBy(*contract.key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violacoes"))
        .select(F.lit("unique:" + "+".join(contract.key)).alias("regra"), "violacoes")
    )
    return rows.unionByName(repeated)


def quarantine(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows that break a row rule, with the names of the rules they break."""
    broken = F.filter(
        F.array(*(F.when(cond, F.lit(name)) for name, cond in contract.row_rules().items())),
        lambda name: name.isNotNull(),
    )
    return df.withColumn("regras", broken).filter(F.size("regras") > 0)


def reconcile_day(sales_by_day: DataFrame, outside: DataFrame, day: Day) -> DataFrame:
    """One day's revenue here and in an outside report (dia, faturamento), and the difference."""
    when = F.lit(as_day(day))
    ours = sales_by_day.filter(F.col("dia") == when).select("dia", F.col("faturamento").alias("nosso"))
    theirs = outside.filter(F.col("dia") == when).select("dia", F.col("faturamento").alias("externo"))
    zero = F.lit(0).cast("decimal(24,2)")
    return ours.join(theirs, "dia", "full").select(
        "dia",
        "nosso",
        "externo",
        (F.coalesce("nosso", zero) - F.coalesce("externo", zero)).alias("diferenca"),
    )
