"""Indicators derived from other indicators: shares, bands, projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import Day, as_day, last_days, month_span

# --- fixed values: band limits and sizes --------------------------------------
FILL_GOOD, FILL_WARNING = 95, 85
GOAL_GOOD, GOAL_WARNING = 100, 70
REASONS_SHOWN = 8
DEFAULT_RANGE_DAYS = 7
GOOD, WARNING, CRITICAL = "good", "warning", "critical"


def _whole_percent(part: Column, whole: Column) -> Column:
    """Whole-number percentage, rounded half up; negative halves go up too."""
    exact = part.cast("decimal(22,2)") * 100 / whole.cast("decimal(20,2)")
    return F.floor(exact + F.lit("0.5").cast("decimal(2,1)")).cast("bigint")


def _band(value: Column, good: int, warning: int) -> Column:
    return F.when(value >= good, GOOD).when(value >= warning, WARNING).when(value.isNotNull(), CRITICAL)


def month_end_projection(summary: DataFrame, month: Day, as_of: Day) -> DataFrame:
    """Run-rate revenue at the end of the month; only for the month of ``as_of``."""
    today = as_day(as_of)
    if month_span(month) == month_span(today):
        days = month_span(today)[1].day
        per_day = F.col("faturamento_total").cast("decimal(22,2)") / F.lit(today.day)
        value = F.round(per_day * F.lit(days), 2).cast("double")
    else:
        value = F.lit(None).cast("double")
    return summary.withColumn("projecao", value)


def change_vs_previous(now: DataFrame, before: DataFrame, column: str) -> DataFrame:
    """Change against the previous period in percent (1 decimal), null without a base."""
    base = before.select(column).scalar().cast("decimal(20,2)")
    current = F.col(column).cast("decimal(20,2)")
    change = F.round((current - base) * 100 / base, 1).cast("double")
    return now.select(
        F.col(column).alias("atual"), base.alias("anterior"), F.when(base > 0, change).alias("variacao_pct")
    )


def credit_use(summary: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Revenue as a whole percentage of the portfolio's credit limit."""
    limit = portfolio.select("limite_credito_total").scalar()
    return summary.select(
        "faturamento_total",
        limit.alias("limite_credito_total"),
        F.when(limit > 0, _whole_percent(F.col("faturamento_total"), limit)).alias("uso_limite_pct"),
    )


def share_of_leader(rows: DataFrame, column: str) -> DataFrame:
    """Each row as a whole percentage of the greatest value (at least 1)."""
    leader = F.greatest(rows.agg(F.max(column)).scalar(), F.lit(1))
    return rows.withColumn("pct_lider", _whole_percent(F.col(column), leader))


GOAL_PAIRS = {
    "visitas": ("real_visitas", "meta_visitas"),
    "positivados": ("real_positivados", "meta_positivados"),
    "cadastros": ("real_cadastros", "meta_cadastros"),
    "faturamento": ("real_faturamento", "meta_faturamento"),
    "caixas": ("real_caixas", "meta_caixas"),
}


def goal_attainment(rows: DataFrame) -> DataFrame:
    """Attainment in whole percent and its band, per goal; null without a goal."""
    for name, (actual, goal) in GOAL_PAIRS.items():
        pct = F.when(F.col(goal) > 0, _whole_percent(F.col(actual), F.col(goal)))
        rows = rows.withColumn(f"pct_{name}", pct).withColumn(
            f"faixa_{name}", _band(F.col(f"pct_{name}"), GOAL_GOOD, GOAL_WARNING)
        )
    return rows


def fill_rate_band(rate: DataFrame) -> DataFrame:
    return rate.withColumn("faixa", _band(F.col("pct"), FILL_GOOD, FILL_WARNING))


def top_cut_reasons(reasons: DataFrame, top: int = REASONS_SHOWN) -> DataFrame:
    return reasons.orderBy(F.desc_nulls_last("caixas"), "motivo").limit(top)


def inactive_share(portfolio: DataFrame) -> DataFrame:
    """What is not active, in percent: customers that never bought count here."""
    rest = F.lit(100) - F.col("pct_ativos").cast("decimal(5,1)")
    return portfolio.withColumn("pct_inativos", rest.cast("double"))


def month_range(rows: DataFrame, column: str) -> DataFrame:
    """First and last day of the month of a date."""
    return rows.withColumn("inicio", F.trunc(column, "month")).withColumn("fim", F.last_day(column))


def default_range(spark: SparkSession, as_of: Day) -> DataFrame:
    first, last = last_days(as_of, DEFAULT_RANGE_DAYS)
    return spark.range(1).select(F.lit(first).alias("inicio"), F.lit(last).alias("fim"))
