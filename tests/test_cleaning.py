"""Edge values of the cleaning columns."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlight.functions import cleaning as cln


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function("v")).collect()]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("5.336,44", "5336.4400"),
        ("1.234", "1.2340"),
        ("-7,5", "-7.5000"),
        (" 12 ", "12.0000"),
        ("\t3,1\xa0", "3.1000"),
        ("1.234.567,8", "1234567.8000"),
        ("5,00-", None),
        (" ", None),
        ("", None),
        (None, None),
        ("abc", None),
        ("1.2.3", None),
        ("1,2,3", None),
        ("nan", None),
        ("inf", None),
    ],
)
def test_decimal(spark, text, expected):
    assert apply(spark, cln.parse_decimal_br, [text]) == [None if expected is None else Decimal(expected)]


def test_int_cuts_towards_zero(spark):
    values = ["3,9", "-3,9", "3,99999", " ", None, "1.234,5", "x"]
    assert apply(spark, cln.parse_int_br, values) == [3, -3, 3, None, None, 1234, None]


def test_date(spark):
    values = ["05/03/24", "5/3/2024", " 5/3/24 ", "//", "0", " ", None, "2024-03-05", "31/02/24", "5/3", "a/b/c", "1/2/3/4"]
    march = dt.date(2024, 3, 5)
    assert apply(spark, cln.parse_date_br, values) == [march, march, march] + [None] * 9


def test_text(spark):
    assert apply(spark, cln.blank_to_null, ["  ", " x ", "\t", None, "a b"]) == [None, "x", None, None, "a b"]


def test_flag(spark):
    values = ["1", "TRUE", "Sim", "y", " t ", "yes", "0", "no", "", None]
    assert apply(spark, cln.parse_flag, values) == [True] * 6 + [False] * 3 + [None]


def test_flag_of_boolean(spark):
    assert apply(spark, cln.parse_flag, [True, False, None], "boolean") == [True, False, None]


def test_extent(spark):
    assert apply(spark, cln.first_extent, ["12.5;12.5", "x;1", "3", None, " 4 ;5"]) == [
        Decimal("12.5000"), None, Decimal("3.0000"), None, Decimal("4.0000"),
    ]


def test_zero_code(spark):
    assert apply(spark, cln.zero_code_to_null, ["0", " 0 ", "07", "7", "", None]) == [None, None, "07", "7", "", None]


def test_tax_id(spark):
    values = ["12.345.678/0001-95", "1234567890123", "12345678901234", "x"]
    assert apply(spark, cln.is_tax_id, values) == [True, False, True, False]
    assert apply(spark, cln.digits_only, values[:1]) == ["12345678000195"]


def test_state_label_int_decode(spark):
    assert apply(spark, cln.state_code, ["spx", "r", None]) == ["SP", "R", None]
    assert apply(spark, cln.default_label, [" ", None, " a "]) == ["SEM FAMILIA", "SEM FAMILIA", "a"]
    assert apply(spark, cln.safe_int, ["12", "1.5", "x", None]) == [12, None, None, None]
    df = spark.createDataFrame([(bytearray("  ação ", "latin-1"),)], "v binary")
    assert df.select(cln.decode_trim("v")).first()[0] == "ação"


def test_line_value(spark):
    df = spark.createDataFrame([(Decimal("2.5"), Decimal("3.2"))], "q decimal(16,4), p decimal(16,4)")
    assert df.select(cln.line_value("q", "p")).first()[0] == Decimal("8.0000")


def test_cleaning_needs_no_python(spark):
    df = spark.createDataFrame([("1",)], "v string").select(
        cln.parse_decimal_br("v").alias("a"), cln.parse_date_br("v").alias("b"), cln.parse_flag("v").alias("c")
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("PythonRDD", "")
    assert F is not None
