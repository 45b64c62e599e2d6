"""Exports, source statements and landed files."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Observation

from ledgerlight import schemas
from ledgerlight.operators.filters import OrderScope
from ledgerlight.sources import database, exports, landing
from tests.conftest import rows

D = Decimal


def write(path, text):
    with open(path, "w", encoding="latin-1", newline="") as handle:
        handle.write(text)
    return str(path)


def test_read_export(spark, tmp_path):
    path = write(
        tmp_path / "p.csv",
        'extra;cod-item;familia-comercial;descricao-item\n'
        '1; 60.1 ;MOLHOS;"Molho; ""forte"" de maçã"\n'
        '2;07;;Ação\n',
    )
    got = rows(exports.read_export(spark, path, "products"))
    assert got == [("07", "Ação", None), ("60.1", 'Molho; "forte" de maçã', "MOLHOS")]


def test_line_breaks_inside_quotes(spark, tmp_path):
    header = "cod-item;descricao-item;familia-comercial\n"
    write(tmp_path / "a b.csv", header + '1;"duas\nlinhas; ""aqui""";F\n2;y;G\n')
    write(tmp_path / "c.csv", header + "3;z;H\n")
    whole, split = exports.files_with_line_breaks(spark, str(tmp_path))
    assert [f.rsplit("/", 1)[1] for f in whole] == ["a b.csv"] and len(split) == 1
    got = rows(exports.read_export(spark, str(tmp_path), "products"))
    assert got == [("1", 'duas\nlinhas; "aqui"', "F"), ("2", "y", "G"), ("3", "z", "H")]


def test_missing_column_is_null(spark, tmp_path):
    path = write(tmp_path / "nf.csv", "nr-nota-fiscal;valor-item-nf;data-emissao\n9;-1.234,5;05/03/24\n")
    got = exports.read_export(spark, path, "invoice_lines").first()
    assert (got.nr_nota, got.valor, got.data_emissao, got.qt_caixas, got.cod_cliente) == ("9", D("-1234.5000"), dt.date(2024, 3, 5), None, None)
    assert [f.name for f in exports.read_export(spark, path, "invoice_lines").schema] == [c[1] for c in exports.EXPORTS["invoice_lines"].columns]


def test_history_cutoff(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),), (None,)], "d date")
    seen = Observation()
    kept = exports.history_cutoff(df, "d", skipped=seen)
    assert kept.count() == 2
    assert seen.get == {"skipped": 1, "read": 3}


def test_source_statements():
    sql = database.source_query("invoice_lines", ("2024-01-01", "2024-01-31"))
    assert "SELECT i.\"cod-estabel\" AS cod_estabel" in sql and "*" not in sql.replace("* i.", "")
    assert "WHERE n.\"dt-emis-nota\" BETWEEN {d '2024-01-01'} AND {d '2024-01-31'}" in sql
    assert database.source_query("parties").endswith('WHERE "identific" <> 2')
    scope = OrderScope(excluded_customers=("O'BRIEN",), rep_range=(6003, 6008))
    sql = database.source_query("orders", ("2024-01-01", "2024-01-31"), scope)
    for part in ("NOT IN ('REMESSA POLP', 'TRANSFERENCI', 'LOGISTICA')", "<> 'O''BRIEN'", "NOT LIKE '60.%'", "<> 6",
                 'i."nr-pedcli" >= 6003', 'i."nr-pedcli" < 6008', 'i."qt-pedida" * i."vl-preori" AS valor_total_venda'):
        assert part in sql
    sql = database.source_query("invoice_lines", numbers=["1", "O'2"])
    assert sql.endswith("IN ('1', 'O''2')") and "BETWEEN" not in sql
    for entity in ("invoice_lines", "orders"):
        assert database.SOURCES[entity].number in database.SOURCES[entity].columns
    assert "6003" in database.source_query("registrations", rep_range=(6003, 6008))
    for entity, table in database.SOURCES.items():
        assert ["empresa", *table.columns] == table.schema.names, entity
    assert database.default_first_year("2024-05-01") == 2022


def test_dimension_cannot_be_sliced(spark):
    with pytest.raises(ValueError):
        database.read_by_year(spark, {}, "items", "c1", 2022, 2024)


def test_convert_source(spark):
    raw = spark.createDataFrame(
        [(bytearray(" maçã ", "latin-1"), " 5101 ", "2", "5.101", "sim")],
        "nat_operacao binary, denominacao string, tipo string, cfop string, log_bonif string",
    )
    got = database.convert_source(raw, "operations", "c1")
    assert tuple(got.first()) == ("c1", "maçã", "5101", 2, "5.101", True)
    assert [f.dataType for f in got.schema] == [f.dataType for f in schemas.OPERATIONS]


def test_window(spark):
    df = spark.createDataFrame([(dt.date(2024, 5, n),) for n in (2, 3, 10, 20)], "d date")
    assert {r.d.day for r in database.read_window(df, "d", "2024-05-10").collect()} == {3, 10, 20}


def test_landing_and_seed(spark, tmp_path):
    (tmp_path / "users").mkdir()
    write(tmp_path / "users" / "a.json", '{"cod_vendedor":"V1","nome":"Ana","extra":1}\n')
    assert rows(landing.read_field_app(spark, str(tmp_path), "users")) == [("V1", "Ana", None, None)]
    path = write(tmp_path / "seed.csv", "empresa,nat_operacao,cfop,tipo\n# nota\nc1,5102,5102,venda\n")
    assert rows(landing.read_seed_types(spark, path)) == [("c1", "5102", "5102", "venda")]
