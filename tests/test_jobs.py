"""Refresh jobs: what they correct, what they keep beside the marts, what they clear away."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.plans import app_feed, boards, pipelines
from ledgerlight.sinks import manifest, run_log
from ledgerlight.sinks import rollups as stored_rollups
from ledgerlight.sinks import tables as sinks
from ledgerlight.streaming import visits as stream
from tests.conftest import rows
from tests.test_flows import erp, landing, visit, write  # noqa: F401  (landing is a fixture)

D = Decimal


def d(month, n):
    return dt.date(2024, month, n)


def messages(spark, lake, task):
    log = run_log.read_run_log(spark, lake.log).filter(F.col("tarefa") == task).orderBy("iniciado_em")
    return [r.mensagem for r in log.collect()]


def test_unread_values_are_counted_and_kept(spark, tmp_path, landing):  # noqa: F811
    root, _ = landing
    write(
        tmp_path / "landing" / "totvs_itensnotafiscal.csv",
        "cod-item;nr-nota-fiscal;qt-cxs-nf;valor-item-nf;cod-cliente;data-emissao;nr-ped;cod-rep\n"
        "p1;1;2,5;1.234.567.890.123,45;c;05/03/24;50;7\np1;2;x;-10;c;31/02/24;;7\np1;3;1;5;c;//;;7\np1;4; ;5;c;06/03/24;;7\n",
    )
    lake = pipelines.Lake(str(tmp_path / "lake"))
    pipelines.refresh_from_exports(spark, lake, root, "c1")
    kept = sinks.read_table(spark, lake.quarantine("invoice_lines"))
    assert rows(kept, "coluna", "texto") == [("data_emissao", "31/02/24"), ("qt_caixas", "x"), ("valor", "1.234.567.890.123,45")]
    line = json.loads(kept.filter("coluna = 'valor'").first().linha)
    assert line["nr_nota"] == "1" and line["valor"] is None and line["qt_caixas"] == 2.5
    assert messages(spark, lake, "csv:invoice_lines")[-1].endswith("3 valores ilegiveis em 2 linhas, em quarentena")
    assert not sinks.table_exists(spark, lake.quarantine("products"))
    # The next load is clean, and so is the quarantine.
    write(
        tmp_path / "landing" / "totvs_itensnotafiscal.csv",
        "cod-item;nr-nota-fiscal;qt-cxs-nf;valor-item-nf;cod-cliente;data-emissao;nr-ped;cod-rep\np1;1;2,5;1;c;05/03/24;50;7\n",
    )
    pipelines.refresh_from_exports(spark, lake, root, "c1")
    assert sinks.read_table(spark, lake.quarantine("invoice_lines")).count() == 0
    assert "ilegiveis" not in messages(spark, lake, "csv:invoice_lines")[-1]


def test_a_line_that_leaves_the_window_stays_at_its_new_day(spark, tmp_path):
    before = [("1", "1", 10, d(5, 20), None), ("2", "1", 20, d(5, 19), None), ("3", "1", 30, d(4, 2), None), ("4", "1", 40, d(5, 18), None)]
    after = [("1", "1", 10, d(4, 28), None), ("2", "1", 25, d(5, 3), None), ("3", "1", 30, d(4, 2), None)]
    lake = pipelines.Lake(str(tmp_path / "lake"))
    pipelines.refresh_full(spark, lake, erp(spark, before), "c1")
    source = erp(spark, after)
    source.by_key = lambda entity, keys: source(entity, None).join(keys, keys.columns, "left_semi")
    for _ in range(2):
        pipelines.refresh_window(spark, lake, source, "c1", d(5, 21))
        expected = [("1", d(4, 28)), ("2", d(5, 3)), ("3", d(4, 2))]
        assert rows(sinks.read_table(spark, lake.raw("invoice_lines"), "c1"), "nr_nota_fis", "dt_emis_nota") == expected
        assert rows(sinks.read_table(spark, lake.mart("sales"), "c1"), "nr_nota", "data_emissao") == expected
    # Without being asked by key, a source cannot tell; what it no longer has in the window is gone.
    other = pipelines.Lake(str(tmp_path / "other"))
    pipelines.refresh_full(spark, other, erp(spark, before), "c1")
    pipelines.refresh_window(spark, other, erp(spark, after), "c1", d(5, 21))
    assert rows(sinks.read_table(spark, other.mart("sales"), "c1"), "nr_nota") == [("3",)]
    held = stored_rollups.read_rollups(spark, lake.mart("sales_rollups"), "c1")
    assert rows(held.days, "data_emissao", "faturamento") == [(d(4, 2), D("30.00")), (d(4, 28), D("10.00")), (d(5, 3), D("25.00"))]
    # Two states of each table are left after each job.
    assert len(manifest.children(spark, f"{lake.mart('sales')}/empresa=c1/manifests")) == 2


def test_all_unmapped_codes_are_kept(spark, tmp_path):
    lines = [(str(k), f"x{k:02d}", 10, d(5, 1), None) for k in range(30)]
    lake = pipelines.Lake(str(tmp_path / "lake"))
    pipelines.refresh_full(spark, lake, erp(spark, lines), "c1")
    assert sinks.read_table(spark, lake.stage("unmapped_operations")).count() == 30
    said = messages(spark, lake, "mart:sales")[-1]
    assert said.startswith("30 codigos") and said.count("x") >= 20


def test_broken_rules_are_logged_and_their_rows_kept(spark, tmp_path):
    lake = pipelines.Lake(str(tmp_path / "lake"))
    mart = spark.createDataFrame(
        [
            ("c1", "e", "1", None, "k", "7", "p", D(1), D(1), "venda", None, d(5, 1), dt.datetime(2024, 5, 2)),
            ("c1", "e", "1", None, "k", "7", "p", D(1), D(2), "outro", None, d(5, 1), dt.datetime(2024, 5, 2)),
            ("c1", "e", None, None, "k", "7", "p", D(1), D(-1), "venda", None, d(4, 1), dt.datetime(2024, 5, 2)),
        ],
        schemas.SALES,
    )
    sinks.replace_fact(mart, lake.mart("sales"), "c1", "data_emissao")
    pipelines.check_mart(spark, lake, "c1", "sales")
    said = messages(spark, lake, "check:sales")[-1]
    assert all(part in said for part in ("not_null:nr_nota: 1", "domain:tipo: 1", "not_negative:valor: 1", "unique:")) and "not_null:valor" not in said
    assert sinks.read_table(spark, lake.quarantine("sales")).count() == 2
    pipelines.check_mart(spark, lake, "c1", "sales", ("data_emissao", d(5, 1)))
    assert rows(sinks.read_table(spark, lake.quarantine("sales")), "tipo") == [("outro",)]


def test_streamed_counts_follow_corrections(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def land(name, data):
        spark.createDataFrame(data, schemas.VISITS).coalesce(1).write.json(f"{source}/{name}")
        stream.store_visits(stream.read_visit_stream(spark, f"{source}/*"), out, check).awaitTermination()

    def counts():
        return {(r.dia.day, r.cod_vendedor): r.visitas for r in stream.visits_by_day(spark, out).collect()}

    noon = lambda n: dt.datetime(2024, 5, n, 12)
    land("a", [visit(1, noon(2)), visit(2, noon(2)), visit(3, noon(28))])
    assert counts() == {(2, "V1"): 2, (28, "V1"): 1}
    # Late by weeks, moved to another day, to another seller, and twice in a batch.
    land("b", [visit(4, noon(1)), visit(1, noon(9)), visit(2, noon(2), "V2"), visit(5, noon(3)), visit(5, noon(4))])
    assert counts() == {(1, "V1"): 1, (2, "V2"): 1, (4, "V1"): 1, (9, "V1"): 1, (28, "V1"): 1}
    assert sinks.read_table(spark, out).count() == 5


def test_board_of_what_the_app_landed(spark, tmp_path, monkeypatch):
    lake, root = pipelines.Lake(str(tmp_path / "lake")), str(tmp_path / "app")

    def land(name, data, schema):
        spark.createDataFrame(data, schema).write.mode("overwrite").json(f"{root}/{name}")

    def sold(number, day, value):
        return ("c1", None, number, None, "k", "7", "p", D(1), D(value), "venda", None, day, dt.datetime(2024, 5, 2))

    def load_sales(data):
        sinks.replace_fact(spark.createDataFrame(data, schemas.SALES), lake.mart("sales"), "c1", "data_emissao")
        pipelines.follow_sales(spark, lake, "c1")

    def blocks():
        marts = app_feed.stored_sales_marts(spark, lake, "c1")
        return boards.sales_board(marts, d(5, 1), d(5, 20), d(5, 20))

    load_sales([sold("1", d(4, 30), 10), sold("2", d(5, 2), 20)])
    assert "por_campanha" not in blocks() and not blocks()["cadastros"].collect()
    noon = dt.datetime(2024, 5, 3, 12)
    land("campaigns", [(1, "Junho", d(5, 1), d(5, 9), "x", None, True), (2, "Velha", d(1, 1), d(1, 9), "x", None, True)], schemas.CAMPAIGNS)
    land("sale_tags", [(n, "p", "k", None, c, at) for n, c, at in [("1", 1, noon), ("2", 2, noon), ("2", 1, dt.datetime(2024, 5, 4)), ("9", 1, noon)]], schemas.SALE_TAGS)
    for _ in range(2):
        app_feed.load_campaigns(spark, lake, root, "c1")
        assert rows(blocks()["por_campanha"], "nome", "faturamento") == [("Junho", D(30))]
    load_sales([sold("1", d(4, 30), 10), sold("2", d(5, 2), 25), sold("3", d(5, 3), 99)])
    assert rows(blocks()["por_campanha"], "nome", "faturamento", "caixas") == [("Junho", D(35), D(2))]

    ask = lambda n, code, name, tax=None: (code, name, tax, None, None, "sp", None, "x", n, noon)
    land("requests", [ask(1, " n1", "A"), ask(2, "n1 ", "B"), ask(3, "n2", None), ask(4, "n3", "C", "12"), ask(5, "n4", "D")], schemas.REQUESTS)
    # A run that dies between its two tables is made good by the next one.
    whole = sinks.replace_table
    monkeypatch.setattr(sinks, "replace_table", lambda df, path, *a: None if path == lake.mart("customers") else whole(df, path, *a))
    app_feed.load_registrations_of_app(spark, lake, root, "c1", "7")
    monkeypatch.undo()
    for refused in (3, 5):
        app_feed.load_registrations_of_app(spark, lake, root, "c1", "7")
        assert rows(sinks.read_table(spark, lake.mart("customers")), "cod_cliente", "nome", "cod_vendedor") == [("n1", "A", "7"), ("n4", "D", "7")]
        assert rows(blocks()["cadastros"], "cod_vendedor", "qtd") == [("7", 2)]
        assert sinks.read_table(spark, lake.quarantine("requests")).count() == refused
    pipelines.tidy(spark, lake, "c1")
    assert rows(blocks()["por_campanha"], "nome") == [("Junho",)]
