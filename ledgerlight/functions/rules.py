"""Classification rules as column expressions (first matching rule wins)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import BONUS, CUT, IGNORE, INVOICED, OPEN, RETURN, SALE

# --- fixed values: words of an operation name and type codes ----------------
BONUS_WORDS = ["BONIFICA", "AMOSTRA", "BRINDE", "DOA"]
RETURN_PREFIX = "DEV"
SALE_WORD = "VENDA"
OUTGOING = 2
# --- fixed values: status texts of an order item ----------------------------
STATUS_INVOICED = "faturado"
STATUS_OPEN = "carteira"
ORDER_RETURN_PREFIX = "dev"


def movement_of_operation(name: Column, kind: Column, bonus_flag: Column) -> Column:
    text = F.upper(F.coalesce(name, F.lit("")))
    named_bonus = reduce(lambda a, b: a | b, [text.contains(word) for word in BONUS_WORDS])
    about_sale = text.contains(SALE_WORD)
    return (
        F.when(bonus_flag.eqNullSafe(True) | named_bonus, BONUS)
        .when(text.startswith(RETURN_PREFIX) & about_sale, RETURN)
        .when((kind == OUTGOING) & about_sale, SALE)
        .otherwise(IGNORE)
    )


def movement_of_net_value(value: Column) -> Column:
    """Exports carry no operation code: only the sign tells a return."""
    return F.when(value < 0, RETURN).otherwise(SALE)


def movement_of_order(kind: Column) -> Column:
    return F.when(F.lower(F.coalesce(kind, F.lit(""))).startswith(ORDER_RETURN_PREFIX), RETURN).otherwise(SALE)


def _status_key(status: Column) -> Column:
    """The form in which a status is compared, for its group and its cut reason alike."""
    return F.lower(F.trim(F.coalesce(status, F.lit(""))))


def status_group(status: Column) -> Column:
    text = _status_key(status)
    return F.when(text == STATUS_INVOICED, INVOICED).when(text.isin(STATUS_OPEN, ""), OPEN).otherwise(CUT)


def cut_reason(status: Column) -> Column:
    """Text before the first dash, for items that were neither invoiced nor open."""
    settled = _status_key(status).isin(STATUS_INVOICED, STATUS_OPEN, "")
    return F.when(~settled, F.split_part(status, F.lit("-"), F.lit(1)))
