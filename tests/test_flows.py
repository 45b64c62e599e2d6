"""Boards, refresh jobs and the visit stream end to end."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.operators import marts
from ledgerlight.plans import boards, pipelines
from ledgerlight.sinks import run_log
from ledgerlight.sinks import tables as sinks
from ledgerlight.streaming import visits as stream
from tests.conftest import rows

D = Decimal


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="latin-1")


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    write(root / "totvs_produto.csv", "cod-item;descricao-item;familia-comercial\np1;Molho;MOLHOS\n")
    write(root / "totvs_cliente.csv", "cod-cliente;cod-erc;nome-cliente;canal;limite-disp;NomERC\nc;7;Casa;VAREJO;1.000,50;Rui\n")
    write(
        root / "totvs_itensnotafiscal.csv",
        "cod-item;nr-nota-fiscal;qt-cxs-nf;valor-item-nf;cod-cliente;data-emissao;nr-ped;cod-rep\n"
        "p1;1;2,5;1.000,10;c;05/03/24;50;7\np1;2;1;-10;c;06/03/24;;7\np1;3;1;5;c;31/12/23;;7\n",
    )
    write(
        root / "totvs_itenspedido.csv",
        "cod-item;nr-pedido;qt-cxs-pedido;valor-item-pedido;cod-cliente;status-item;tipo;data-pedido;campanha\n"
        "p1;50;3;30;c;QUALI-X;Venda;05/03/24; \np1;51;3;30;c;Carteira;Dev;05/03/24;VERAO\n",
    )
    field = tmp_path / "field"
    for name in ("users", "goals", "visits", "agenda"):
        (field / name).mkdir(parents=True)
    write(field / "users" / "u.json", '{"cod_vendedor":"7","nome":"Rui","role":"vendedor","email":"r@x"}\n')
    return str(root), str(field)


def test_refresh_from_exports(spark, tmp_path, landing):
    lake = pipelines.Lake(str(tmp_path / "lake"))
    pipelines.refresh_from_exports(spark, lake, landing[0], "c1", field_landing=landing[1])
    sales = sinks.read_table(spark, lake.mart("sales"), "c1")
    assert rows(sales, "nr_nota", "tipo", "valor", "qt_caixas", "familia") == [
        ("1", "venda", D("1000.10"), D("2.50"), "MOLHOS"), ("2", "devolucao", D("10.00"), D("1.00"), "MOLHOS"),
    ]
    orders = sinks.read_table(spark, lake.mart("orders"), "c1")
    assert rows(orders, "nr_pedido", "status_grupo", "motivo_corte", "tipo", "cod_vendedor", "campanha") == [
        ("50", "corte", "QUALI", "venda", "7", None), ("51", "aberto", None, "devolucao", "7", "VERAO"),
    ]
    assert rows(sinks.read_table(spark, lake.mart("sellers")), "cod_vendedor", "nome") == [("7", "Rui")]
    assert rows(sinks.read_table(spark, f"{lake.field}/users"), "nome") == [("Rui",)]
    log = run_log.read_run_log(spark, lake.log)
    assert {r.status for r in log.collect()} == {"OK"}
    lines = log.filter("tarefa = 'csv:invoice_lines'").first()
    assert lines.registros == 2 and lines.mensagem.startswith("1 linhas")


def test_customer_attributes_outside_the_export_are_kept(spark, tmp_path, landing):
    lake = pipelines.Lake(str(tmp_path / "lake"))
    known = spark.createDataFrame([("c1", "c", "Antiga", None, None, "Recife", "PE", None, D(1), True, None)], schemas.CUSTOMERS)
    sinks.replace_table(known, lake.mart("customers"))
    pipelines.refresh_from_exports(spark, lake, landing[0], "c1")
    got = sinks.read_table(spark, lake.mart("customers")).first()
    assert (got.nome, got.cidade, got.credito_suspenso, got.limite_credito) == ("Casa", "Recife", True, D("1000.50"))


def test_first_failure_stops_the_job(spark, tmp_path, landing):
    lake = pipelines.Lake(str(tmp_path / "lake"))
    pipelines.refresh_from_exports(spark, lake, landing[0], "c1")
    with pytest.raises(Exception):
        pipelines.refresh_from_exports(spark, lake, str(tmp_path / "nowhere"), "c1")
    assert sinks.read_table(spark, lake.mart("sales"), "c1").count() == 2
    failed = run_log.read_run_log(spark, lake.log).filter("status = 'ERRO'")
    assert [r.tarefa for r in failed.collect()] == ["csv:products"]


def erp(spark, lines):
    tables = {
        "operations": spark.createDataFrame([("c1", "1", "VENDA", 2, None, False)], schemas.OPERATIONS),
        "families": spark.createDataFrame([("c1", "10", "MOLHOS")], schemas.FAMILIES),
        "items": spark.createDataFrame([("c1", "p1", "Molho", None, "10", None, None)], schemas.ITEMS),
        "parties": spark.createDataFrame([("c1", "c", "Casa", None, None, None, None, "7", "1", None, 1, None, None, 1)], schemas.PARTIES),
        "reps": spark.createDataFrame([("c1", "7", "Rui", "R", None, None, None, 1)], schemas.REPS),
        "orders": spark.createDataFrame([], schemas.ORDER_ITEMS),
        "registrations": spark.createDataFrame([], schemas.REGISTRATIONS),
        "invoice_lines": spark.createDataFrame(
            [("c1", "1", "U", n, 1, "p1", o, D(1), "CX", D(v), D(v), D(0), "c", "", None, "", d, x, 1) for n, o, v, d, x in lines],
            schemas.INVOICE_LINES,
        ),
    }

    def read(entity, span):
        df = tables[entity]
        return df if span is None or entity != "invoice_lines" else df.filter(F.col("dt_emis_nota") >= F.lit(span[0]))

    return read


def test_full_then_window_equals_full(spark, tmp_path):
    def d(n):
        return dt.date(2024, 5, n)

    before = [("1", "1", 10, d(1), None), ("2", "1", 20, d(9), None), ("3", "1", 30, d(10), None)]
    after = [("1", "1", 10, d(1), None), ("2", "1", 25, d(9), None), ("3", "1", 30, d(10), d(11)), ("4", "9", 40, d(11), None)]
    lake = pipelines.Lake(str(tmp_path / "lake"))
    pipelines.refresh_full(spark, lake, erp(spark, before), "c1")
    pipelines.refresh_window(spark, lake, erp(spark, after), "c1", d(11))
    other = pipelines.Lake(str(tmp_path / "other"))
    pipelines.refresh_full(spark, other, erp(spark, after), "c1")
    columns = ["nr_nota", "valor", "tipo", "cod_vendedor", "familia", "data_emissao"]
    got = rows(sinks.read_table(spark, lake.mart("sales"), "c1"), *columns)
    assert got == rows(sinks.read_table(spark, other.mart("sales"), "c1"), *columns)
    assert [(g[0], g[1]) for g in got] == [("1", D("10.00")), ("2", D("25.00")), ("4", D("40.00"))]
    messages = [r.mensagem for r in run_log.read_run_log(spark, lake.log).filter("tarefa = 'mart:sales'").collect()]
    assert any(m.endswith(": 9") for m in messages)


def test_a_line_that_changes_its_date_is_counted_once(spark, tmp_path):
    def d(month, n):
        return dt.date(2024, month, n)

    before = [("1", "1", 10, d(4, 2), None), ("2", "1", 20, d(5, 1), None), ("3", "1", 30, d(5, 2), None), ("5", "1", 50, d(3, 3), None)]
    after = [("1", "1", 10, d(5, 20), None), ("2", "1", 20, d(5, 20), None), ("3", "1", 30, d(5, 2), None), ("5", "1", 50, d(3, 3), None)]
    lake = pipelines.Lake(str(tmp_path / "lake"))
    pipelines.refresh_full(spark, lake, erp(spark, before), "c1")
    for _ in range(2):
        pipelines.refresh_window(spark, lake, erp(spark, after), "c1", d(5, 21))
        expected = [("1", d(5, 20)), ("2", d(5, 20)), ("3", d(5, 2)), ("5", d(3, 3))]
        assert rows(sinks.read_table(spark, lake.mart("sales"), "c1"), "nr_nota", "data_emissao") == expected
        assert rows(sinks.read_table(spark, lake.raw("invoice_lines"), "c1"), "nr_nota_fis", "dt_emis_nota") == expected


def test_full_load_leaves_what_is_older_than_the_source(spark, tmp_path):
    lines = [("1", "1", 10, dt.date(2020, 4, 2), None), ("2", "1", 20, dt.date(2024, 5, 1), None)]
    lake = pipelines.Lake(str(tmp_path / "lake"))
    pipelines.refresh_full(spark, lake, erp(spark, lines), "c1", cutoff="2019-01-01")
    source = erp(spark, lines[1:])
    source.history_start = "2022-01-01"
    pipelines.refresh_full(spark, lake, source, "c1", cutoff="2019-01-01")
    assert rows(sinks.read_table(spark, lake.mart("sales"), "c1"), "nr_nota") == [("1",), ("2",)]


def test_operation_codes_that_differ_in_blanks_are_one(spark):
    two = spark.createDataFrame([("c1", "510", "VENDA", 2, "1", False), ("c1", "510 ", "VENDA", 2, "2", False)], schemas.OPERATIONS)
    assert rows(marts.classify_operations(two), "nat_operacao", "cfop") == [("510", "2")]


def board(spark):
    totals = spark.createDataFrame([(D("1.50"), None)], "valor decimal(14,2), pct double")
    reasons = spark.createDataFrame([("A", D("1.00")), ("B", D("5.00")), ("C", None)], "motivo string, caixas decimal(14,2)")
    return {"carteira_aberta": totals, "corte_por_motivo": reasons}


def test_document(spark):
    today = spark.createDataFrame([(D("3.00"), D("2.00"))], "faturamento_hoje decimal(14,2), caixas_hoje decimal(14,2)")
    until = spark.createDataFrame([("2024-05-01",)], "dados_ate string")
    document = json.loads(boards.board_document({"dados_ate": until, "hoje": today, **board(spark)}).first().documento)
    assert document == {
        "dados_ate": "2024-05-01", "faturamento_hoje": 3.0, "caixas_hoje": 2.0,
        "pedidos": {
            "carteira_aberta": {"valor": 1.5, "pct": None},
            "corte_por_motivo": [{"motivo": "B", "caixas": 5.0}, {"motivo": "A", "caixas": 1.0}, {"motivo": "C", "caixas": None}],
        },
    }
    empty = {name: df.filter("false") if name == "corte_por_motivo" else df for name, df in board(spark).items()}
    assert json.loads(boards.board_document(empty).first().documento)["pedidos"]["corte_por_motivo"] == []


def test_board_lines_hold_every_item(spark):
    lines = boards.board_lines(board(spark))
    assert lines.count() == 4
    assert json.loads(lines.filter("item = 'C'").first().conteudo) == {"motivo": "C", "caixas": None}


def visit(i, ts, seller="V1", note=None):
    return (str(i), None, None, seller, None, None, "realizada", note, ts)


def test_stream_counts_each_visit_once_by_local_day(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def land(name, data):
        spark.createDataFrame(data, schemas.VISITS).coalesce(1).write.json(f"{source}/{name}")

    def run():
        counts = stream.daily_counts(stream.read_visit_stream(spark, f"{source}/*"))
        stream.write_daily_counts(counts, out, check).awaitTermination()

    land("a", [visit(1, dt.datetime(2024, 5, 2, 2, 0)), visit(2, dt.datetime(2024, 5, 2, 12)), visit(2, dt.datetime(2024, 5, 2, 12))])
    run()
    # A repeated visit, a late one, and one that moves time on past the lateness.
    land("b", [visit(1, dt.datetime(2024, 5, 2, 2, 0)), visit(3, dt.datetime(2024, 5, 1, 12)), visit(4, dt.datetime(2024, 5, 20, 12))])
    run()
    got = rows(spark.read.parquet(out))
    assert got == [(dt.date(2024, 5, 1), "V1", 2), (dt.date(2024, 5, 2), "V1", 1)]


def test_stream_table(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    noon = dt.datetime(2024, 5, 2, 12)
    spark.createDataFrame([visit(1, noon, note="a"), visit(2, noon)], schemas.VISITS).write.json(f"{source}/a")
    stream.store_visits(stream.read_visit_stream(spark, f"{source}/*"), out, check).awaitTermination()
    spark.createDataFrame([visit(1, noon, note="b"), visit(3, dt.datetime(2024, 5, 9, 12))], schemas.VISITS).write.json(f"{source}/b")
    stream.store_visits(stream.read_visit_stream(spark, f"{source}/*"), out, check).awaitTermination()
    assert rows(sinks.read_table(spark, out), "id", "observacao") == [("1", "b"), ("2", None), ("3", None)]
