"""Classification rules and mart builders on hand-written rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.functions import rules
from ledgerlight.operators import marts
from tests.conftest import rows

D = Decimal
DAY = dt.date(2024, 5, 10)


def test_operation_types(spark):
    cases = [
        ("a", "VENDA", 2, True, "bonificacao"),
        ("b", "Bonificação", 2, False, "bonificacao"),
        ("c", "AMOSTRA GRATIS", 2, None, "bonificacao"),
        ("d", "DOAÇÃO", 1, False, "bonificacao"),
        ("e", "DEV BONIFICACAO VENDA", 1, False, "bonificacao"),
        ("f", "DEVOLUCAO DE VENDA", 1, False, "devolucao"),
        ("g", "DEVOLUCAO COMPRA", 1, False, "ignorar"),
        ("h", "venda mercadoria", 2, False, "venda"),
        ("i", "VENDA", 1, False, "ignorar"),
        ("j", None, 2, False, "ignorar"),
        ("k", "BRINDE", None, False, "bonificacao"),
        ("l", "VENDA", None, None, "ignorar"),
    ]
    df = spark.createDataFrame([("c1", f" {c} ", n, k, None, b) for c, n, k, b, _ in cases], schemas.OPERATIONS)
    result = marts.classify_operations(df)
    assert rows(result, "nat_operacao", "tipo") == [(c, t) for c, _, _, _, t in cases]
    assert {r.cfop for r in result.collect()} == {""}
    counts = [tuple(r) for r in marts.movement_distribution(result).collect()]
    assert counts[0] == ("bonificacao", 6) and counts[1] == ("ignorar", 4)


def test_order_status_and_type(spark):
    cases = [
        ("Faturado", "faturado", None), ("FATURADO", "faturado", None), ("Carteira", "aberto", None), (None, "aberto", None),
        ("  ", "aberto", None), ("QUALI-FALTA", "corte", "QUALI"), ("LOG", "corte", "LOG"), ("COML-X-Y", "corte", "COML"),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, s string")
    got = df.orderBy("i").select(rules.status_group(F.col("s")), rules.cut_reason(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [c[1:] for c in cases]
    kinds = [("Dev", "devolucao"), ("devolução", "devolucao"), ("Bonificacao", "venda"), (None, "venda")]
    df = spark.createDataFrame([(i, k[0]) for i, k in enumerate(kinds)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(rules.movement_of_order(F.col("s"))).collect()]
    assert got == [k[1] for k in kinds]


def line(note, item, client, qty, value, oper="1", rep="", day=DAY, cancelled=None, estab="1", seq=1, order=""):
    return ("c1", estab, "U", note, seq, item, oper, D(qty), "CX", D(value), D(value), D(0), client, rep, None, order, day, cancelled, 1)


def make_sales(spark, lines, since="2024-01-01"):
    kinds = spark.createDataFrame(
        [("c1", "1", "", "venda"), ("c1", "2", "", "devolucao"), ("c1", "3", "", "bonificacao"), ("c1", "9", "", "ignorar")],
        schemas.TYPE_MAP,
    )
    customers = spark.createDataFrame([("c1", "own", "V1"), ("c1", "none", None)], "empresa string, cod_cliente string, cod_vendedor string")
    seller_map = spark.createDataFrame([("c1", "R1", "M1"), ("c1", "", "M0")], schemas.SELLER_MAP)
    products = spark.createDataFrame([("c1", "p1", "d", "FAM")], schemas.PRODUCTS)
    return marts.build_sales(spark.createDataFrame(lines, schemas.INVOICE_LINES), kinds, customers, seller_map, products, since)


def test_sales_seller_choice(spark):
    built = make_sales(
        spark,
        [
            line("1", "p1", "own", "1", "10", rep="R1"),
            line("2", "p1", "none", "1", "10", rep="R1"),
            line("3", "p1", "none", "1", "10", rep="R9"),
            line("4", "px", "unknown", "1", "10", rep=None),
        ],
    )
    assert rows(built, "nr_nota", "cod_vendedor", "familia") == [
        ("1", "V1", "FAM"), ("2", "M1", "FAM"), ("3", "R9", "FAM"), ("4", "M0", "SEM FAMILIA"),
    ]


def test_sales_grouping_rounding_and_filters(spark):
    built = make_sales(
        spark,
        [
            line("1", "p1", "own", "1", "10.004", seq=1, order="77"),
            line("1", "p1", "own", "2", "10.004", seq=2),
            line("2", "p1", "own", "1", "-5.5", oper="2"),
            line("3", "p1", "own", "1", "5", oper="9"),
            line("4", "p1", "own", "1", "5", cancelled=DAY),
            line("5", "p1", "own", "1", "5", oper="55"),
            line("6", "p1", "own", "1", "5", day=dt.date(2023, 12, 31)),
            line("7", "p1", "own", "1", "5", day=dt.date(2024, 1, 1)),
        ],
    )
    assert rows(built, "nr_nota", "nr_pedido", "qt_caixas", "valor", "tipo") == [
        ("1", "77", D("3.00"), D("20.01"), "venda"),
        ("2", None, D("1.00"), D("5.50"), "devolucao"),
        ("5", None, D("1.00"), D("5.00"), "venda"),
        ("7", None, D("1.00"), D("5.00"), "venda"),
    ]
    assert built.filter("carregado_em is null").count() == 0


def test_same_invoice_number_in_two_establishments(spark):
    built = make_sales(spark, [line("1", "p1", "own", "1", "10", estab="1"), line("1", "p1", "own", "1", "7", estab="2")])
    assert rows(built, "estabel", "valor") == [("1", D("10.00")), ("2", D("7.00"))]


def test_greatest_operation_code_wins_and_value_is_netted(spark):
    built = make_sales(spark, [line("1", "p1", "own", "1", "10", oper="1", seq=1), line("1", "p1", "own", "1", "-30", oper="2", seq=2)])
    assert rows(built, "tipo", "valor") == [("devolucao", D("20.00"))]


def test_unmapped(spark):
    lines = [line("1", "p", "c", "1", "1", oper=o, seq=i) for i, o in enumerate(["7", "7", "8", "1"])]
    lines.append(line("9", "p", "c", "1", "1", oper="8", cancelled=DAY))
    df = spark.createDataFrame(lines, schemas.INVOICE_LINES)
    kinds = spark.createDataFrame([("c1", "1", "", "venda")], schemas.TYPE_MAP)
    assert [tuple(r) for r in marts.unmapped_operations(df, kinds, "2024-01-01").collect()] == [("c1", "7", 2), ("c1", "8", 1)]
    assert marts.unmapped_operations(df, kinds, "2024-01-01", top=1).count() == 1


def export_rows(spark, data):
    spec = (
        "it_codigo string, nr_nota string, qt_caixas decimal(16,4), valor decimal(16,4), cod_cliente string, data_emissao date, "
        "nr_pedido string, estabel string, vl_bruto decimal(16,4), cod_vendedor string, vl_desconto decimal(16,4)"
    )
    return spark.createDataFrame(
        [(i, n, D(1), None if v is None else D(v), c, DAY, p, "1", None, "V", None) for i, n, v, c, p in data], spec
    )


def test_sales_from_export_sign(spark):
    raw = export_rows(
        spark,
        [
            ("a", "1", "10", "c", "5"), ("a", "1", "-30", "c", ""), ("b", "1", "30", "c", ""), ("b", "1", "-10", "c", ""),
            ("c", "1", "0", "c", ""), ("d", "1", None, "c", ""), (None, "1", "1", "c", ""), ("e", None, "1", "c", ""),
        ],
    )
    products = spark.createDataFrame([("c1", "a", "d", "FAM"), ("c2", "b", "d", "OUTRA")], schemas.PRODUCTS)
    built = marts.sales_from_export(raw, products, "c1")
    assert rows(built, "it_codigo", "tipo", "valor", "nr_pedido", "familia") == [
        ("a", "devolucao", D("20.00"), "5", "FAM"),
        ("b", "venda", D("20.00"), None, "SEM FAMILIA"),
        ("c", "venda", D("0.00"), None, "SEM FAMILIA"),
        ("d", "venda", D("0.00"), None, "SEM FAMILIA"),
    ]


def test_dimensions(spark):
    parties = spark.createDataFrame(
        [
            ("c1", "1", "A", None, " ", "X", "SP", "0", " 0", None, 4, None, None, 1),
            ("c1", "2", "B", None, "99", "X", "SP", "7", "3", D("5"), 1, None, None, 3),
            ("c1", "3", "S", None, None, None, None, None, None, None, None, None, None, 2),
            ("c1", "4", "N", None, None, None, None, None, None, None, None, None, None, None),
        ],
        schemas.PARTIES,
    )
    built = marts.build_customers(parties)
    assert rows(built, "cod_cliente", "cnpj", "canal", "cod_vendedor", "limite_credito", "credito_suspenso") == [
        ("1", None, None, None, D("0.00"), True), ("2", "99", "3", "7", D("5.00"), False),
    ]
    reps = spark.createDataFrame([("c1", "7", "R", "r", " ", "0", None, 1), ("c1", "8", "Q", "q", "SUL", "7", DAY, 1)], schemas.REPS)
    assert rows(marts.build_sellers(reps), "cod_vendedor", "ativo", "rep_indireto", "regiao") == [
        ("7", True, None, None), ("8", False, "7", "SUL"),
    ]
    items = spark.createDataFrame([("c1", "a", "A", None, "10 ", None, None), ("c1", "b", "B", None, "11", None, None),
                                   ("c1", "c", "C", None, None, None, None)], schemas.ITEMS)
    families = spark.createDataFrame([("c1", " 10", "  MOLHOS "), ("c1", "11", "  ")], schemas.FAMILIES)
    assert rows(marts.build_products(items, families), "it_codigo", "familia") == [
        ("a", "MOLHOS"), ("b", "SEM FAMILIA"), ("c", "SEM FAMILIA"),
    ]


def test_export_dimensions(spark):
    raw = spark.createDataFrame(
        [("1", "7", "A", "Ativo", " ", None, D("3"), "Rep"), ("1", None, "B", "Ativo", "VAREJO ", "9", D("5"), None), (None,) * 8],
        "cod_cliente string, cod_erc string, nome string, status string, canal string, cnpj string, limite_disp decimal(16,4), nome_erc string",
    )
    assert rows(marts.customers_from_export(raw, "c1"), "cod_cliente", "nome", "cnpj", "canal", "cod_vendedor", "limite_credito") == [
        ("1", "B", "9", "VAREJO", "7", D("5.00"))
    ]
    assert rows(marts.sellers_from_export(raw, "c1"), "cod_vendedor", "nome") == [("7", "Rep")]


def test_goal_defaults(spark):
    raw = spark.createDataFrame([("7", "2024-05", 3, None, None, None, None, None)], schemas.GOALS)
    assert rows(marts.build_goal_table(raw)) == [("7", "2024-05", 3, 0, 0, 1, D("0.00"), D("0.00"))]
