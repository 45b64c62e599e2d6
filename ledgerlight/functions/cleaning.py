"""Column cleaning: text, number, date and code conversion.

Every function takes a column (or its name) and returns a column; all of them
are Spark built-ins, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import NO_FAMILY, RAW_AMOUNT

# Blank characters that latin-1 text can carry around a value.
_BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"

# --- fixed values: texts that mean "true" ----------------------------------
TRUE_TEXTS = ["1", "true", "yes", "sim", "y", "t"]
# --- fixed values: texts that mean "no date" --------------------------------
NO_DATE_TEXTS = ["", "//", "0"]

_DATE_SHAPE = r"^\d{1,2}/\d{1,2}/\d{1,4}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove blanks (not only spaces) at both ends."""
    return F.btrim(_col(c), F.lit(_BLANKS))


def blank_to_null(c: Column | str) -> Column:
    """Stripped text, null when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def _plain_number(c: Column | str) -> Column:
    text = blank_to_null(c)
    grouped = F.contains(text, F.lit(","))
    no_points = F.when(grouped, F.replace(text, F.lit("."), F.lit(""))).otherwise(text)
    return F.replace(no_points, F.lit(","), F.lit("."))


def parse_decimal_br(c: Column | str) -> Column:
    """``5.336,44`` -> 5336.44; a dot without any comma is a decimal point."""
    return _plain_number(c).try_cast(RAW_AMOUNT)


def parse_int_br(c: Column | str) -> Column:
    """Number text cut towards zero."""
    return _plain_number(c).try_cast("decimal(38,18)").try_cast("bigint")


def parse_date_br(c: Column | str) -> Column:
    """``D/M/Y`` text; a two-digit year means 20YY; anything else is null."""
    text = strip(c)
    day, month, year = (F.split_part(text, F.lit("/"), F.lit(i)) for i in (1, 2, 3))
    full_year = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(F.lpad(year, 4, "0"))
    iso = F.concat_ws("-", full_year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.when(text.rlike(_DATE_SHAPE), iso).try_cast("date")


def unread(text: Column | str, converted: Column, kind: str) -> Column:
    """Does a text say something that its conversion has lost? Blanks, and texts that mean "no date", say nothing."""
    said = blank_to_null(text)
    meant = said.isNotNull() & ~said.isin(NO_DATE_TEXTS) if kind == "date" else said.isNotNull()
    return F.coalesce(meant, F.lit(False)) & converted.isNull()


def decode_trim(c: Column | str) -> Column:
    """Latin-1 bytes to stripped text."""
    return strip(F.decode(_col(c), "ISO-8859-1"))


def safe_int(c: Column | str) -> Column:
    return _col(c).try_cast("int")


def parse_flag(c: Column | str) -> Column:
    """True for a yes-like text, false for any other text, null stays null."""
    return F.lower(strip(_col(c).cast("string"))).isin(TRUE_TEXTS)


def first_extent(c: Column | str) -> Column:
    """First number of an array delivered as ``v;v`` text."""
    return strip(F.split_part(_col(c), F.lit(";"), F.lit(1))).try_cast(RAW_AMOUNT)


def zero_code_to_null(c: Column | str) -> Column:
    """Code ``0`` stands for "none"."""
    return F.nullif(F.trim(_col(c)), F.lit("0"))


def trimmed_or_null(c: Column | str) -> Column:
    """Text without surrounding spaces, null when empty."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def digits_only(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "[^0-9]", "")


def is_tax_id(c: Column | str) -> Column:
    """A company tax id has 14 digits, whatever the punctuation."""
    return digits_only(c).rlike(r"^\d{14}$")


def state_code(c: Column | str) -> Column:
    return F.substring(F.upper(_col(c)), 1, 2)


def default_label(c: Column | str, label: str = NO_FAMILY) -> Column:
    return F.coalesce(trimmed_or_null(c), F.lit(label))


def line_value(quantity: Column | str, price: Column | str) -> Column:
    return (_col(quantity) * _col(price)).cast(RAW_AMOUNT)
