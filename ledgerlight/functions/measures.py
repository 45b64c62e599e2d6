"""Measures shared by the indicators: signed revenue, boxes, ratios, local days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import BONUS, LOCAL_ZONE, RETURN, SALE


def is_sale() -> Column:
    return F.col("tipo") == SALE


def is_buying_line() -> Column:
    """Only a sale with a value makes the customer a buying one."""
    return is_sale() & (F.col("valor") > 0)


def signed_value() -> Column:
    """Amounts are stored positive; the movement type carries the sign."""
    kind = F.col("tipo")
    amount = F.col("valor")
    return F.when(kind == SALE, amount).when(kind == RETURN, -amount).otherwise(F.lit(0).cast("decimal(14,2)"))


def moved_boxes() -> Column:
    """Boxes count for sales and bonus goods; returned boxes are left out."""
    return F.when(F.col("tipo").isin(SALE, BONUS), F.col("qt_caixas"))


def sum_where(value: Column | str, condition: Column) -> Column:
    """Conditional sum that gives 0, not null, when no row qualifies."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def distinct_where(value: Column | str, condition: Column) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.count_distinct(F.when(condition, value))


def ratio(numerator: Column, denominator: Column, places: int, otherwise: float | None = 0.0) -> Column:
    """``numerator / denominator`` in exact decimals, rounded half up, as double.

    Both sides are brought to ``decimal(24,2)`` first, which leaves the quotient
    enough digits that it is rounded only once.
    """
    top = numerator.cast("decimal(24,2)")
    bottom = denominator.cast("decimal(20,2)")
    fallback = F.lit(otherwise).cast("double")
    return F.when(bottom > 0, F.round(top / bottom, places).cast("double")).otherwise(fallback)


def percent(part: Column, whole: Column, places: int = 1, otherwise: float | None = 0.0) -> Column:
    return ratio(part.cast("decimal(22,2)") * 100, whole, places, otherwise)


def local_day(ts: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """Calendar day of a UTC instant in the local zone (session zone is UTC)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(F.from_utc_timestamp(ts, zone))
