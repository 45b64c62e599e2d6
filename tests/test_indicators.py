"""Sales, portfolio, order and field indicators on small hand-written marts."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.functions.periods import last_days, month_slices, month_span, previous_span
from ledgerlight.operators import field, filters, indicators, monitoring, orders, portfolio, sales
from tests.conftest import rows

D = Decimal
START, END = dt.date(2024, 5, 1), dt.date(2024, 5, 31)
NOW = dt.datetime(2024, 6, 1, 3, 0)


def sale(note, client, value, kind="venda", boxes="1", item="p1", seller="V1", order="same", day=dt.date(2024, 5, 10)):
    order = note if order == "same" else order
    return ("c1", "1", note, order, client, seller, item, None if boxes is None else D(boxes), D(value), kind, "F", day, NOW)


@pytest.fixture(scope="module")
def mart(spark):
    return spark.createDataFrame(
        [
            sale("1", "a", "100", boxes="10", item="p1"),
            sale("1", "a", "50", boxes="5", item="p2"),
            sale("2", "b", "0", boxes="2"),
            sale("3", "b", "30", kind="bonificacao", boxes="3"),
            sale("4", "a", "40", kind="devolucao", boxes="4", seller="V2"),
            sale("5", "c", "10", order=None, item=None, seller="V2"),
            sale("6", "d", "500", day=dt.date(2024, 4, 30)),
            sale("7", "d", "70", day=dt.date(2024, 5, 31), seller=None),
            sale("8", "e", "900", day=dt.date(2024, 6, 1)),
        ],
        schemas.SALES,
    )


@pytest.fixture(scope="module")
def clients(spark):
    data = [("a", "V1", "VAREJO", "100", False), ("b", "V1", None, "50", True), ("c", "V2", "VAREJO", "0", False),
            ("d", "V2", "ATACADO", "10", False), ("z", "V2", "ATACADO", "5", True)]
    return spark.createDataFrame(
        [("c1", c, f"N{c}", None, ch, None, None, s, D(l), x, None) for c, s, ch, l, x in data], schemas.CUSTOMERS
    )


@pytest.fixture(scope="module")
def sellers(spark):
    return spark.createDataFrame([("c1", "V1", "Ana", True, None, None)], schemas.SELLERS)


def test_summary(mart):
    got = sales.sales_summary(mart, START, END).first()
    assert got.faturamento_total == D("190.00") and got.devolucoes == D("40.00")
    assert got.caixas_total == D("22.00") and got.caixas_bonificadas == D("3.00")
    # Customer b bought for nothing and got a bonus: not a buying customer.
    assert (got.pedidos, got.notas, got.clientes_positivados, got.linhas_pedido) == (3, 4, 3, 4)


def test_pair_with_missing_item_counts(spark):
    df = spark.createDataFrame([sale("1", "a", "1", item=None), sale("1", "a", "1", item="p")], schemas.SALES)
    assert sales.sales_summary(df, START, END).first().linhas_pedido == 2


def test_ratios_and_empty_period(mart):
    got = sales.sales_ratios(sales.sales_summary(mart, START, END)).first()
    assert tuple(got) == (1.3, 63.33, 10.0, 7.3)
    none = sales.sales_summary(mart, "2010-01-01", "2010-01-31")
    assert tuple(sales.sales_ratios(none).first()) == (0.0, 0.0, 0.0, 0.0)
    assert tuple(none.first()) == (0, 0, 0, 0, 0, 0, 0, 0)


def test_seller_filter_is_the_same_as_filtering_first(mart, clients, sellers):
    only = mart.filter("cod_vendedor = 'V2'")
    for build in (
        lambda m, s: sales.sales_summary(m, START, END, s),
        lambda m, s: sales.by_day(m, START, END, s),
        lambda m, s: sales.previous_period(m, START, END, s),
        lambda m, s: sales.by_seller(m, sellers, START, END, s),
    ):
        assert rows(build(mart, "V2")) == rows(build(only, None))


def test_previous_today_freshness(mart):
    assert previous_span("1998-01-01", "1998-01-31") == (dt.date(1997, 12, 1), dt.date(1997, 12, 31))
    assert previous_span("2024-05-10", "2024-05-10") == (dt.date(2024, 5, 9), dt.date(2024, 5, 9))
    assert tuple(sales.previous_period(mart, START, END).first()) == (D("500.00"), D("1.00"), 1)
    assert tuple(sales.today_totals(mart, END).first()) == (D("70.00"), D("1.00"))
    assert sales.data_freshness(mart).first()[0] == NOW


def test_splits_add_up_to_net_revenue(spark, mart, sellers):
    net = sales.sales_summary(mart, START, END).first().faturamento_total
    products = spark.createDataFrame([("c1", "p1", "x", "F1")], schemas.PRODUCTS)
    for split in (
        sales.by_day(mart, START, END),
        sales.by_seller(mart, sellers, START, END),
        sales.by_family(mart, products, START, END),
    ):
        assert split.agg(F.sum("faturamento")).first()[0] == net


def test_by_seller(mart, sellers):
    assert [tuple(r) for r in sales.by_seller(mart, sellers, START, END).collect()] == [
        ("V1", "Ana", D("150.00"), D("20.00"), 1, 2),
        (None, None, D("70.00"), D("1.00"), 1, 1),
        ("V2", "V2", D("-30.00"), D("1.00"), 1, 0),
    ]


def test_boxes_stay_null_for_returns_only(spark):
    df = spark.createDataFrame([sale("1", "a", "5", kind="devolucao")], schemas.SALES)
    assert sales.by_day(df, START, END).first().caixas is None


def test_by_family_counts_customers_with_a_sale_line(spark, mart):
    products = spark.createDataFrame([("c1", "p1", "x", "F1"), ("c1", "p2", "x", "F1")], schemas.PRODUCTS)
    got = {r.familia: (r.faturamento, r.pdvs) for r in sales.by_family(mart, products, START, END).collect()}
    # a (two items), b (sale of value 0) and d; c bought an item without code.
    assert got == {"F1": (D("180.00"), 3), "SEM FAMILIA": (D("10.00"), 1)}


def test_by_channel(mart, clients):
    got = rows(sales.by_channel(clients, mart, START, END))
    assert got == [
        ("ATACADO", 2, 40.0, D("70.00"), D("1.00")),
        ("Sem canal", 1, 20.0, D("0.00"), D("5.00")),
        ("VAREJO", 2, 40.0, D("120.00"), D("16.00")),
    ]
    empty = rows(sales.by_channel(clients, mart, "2010-01-01", "2010-01-31"), "canal", "faturamento", "caixas")
    assert empty == [("ATACADO", D("0.00"), D("0.00")), ("Sem canal", D("0.00"), D("0.00")), ("VAREJO", D("0.00"), D("0.00"))]


def test_recency_edges(spark):
    as_of = dt.date(2024, 5, 31)
    ages = [0, 30, 31, 90, 91, 180, 181]
    lines = [sale(str(n), f"k{n}", "10", day=as_of - dt.timedelta(days=n)) for n in ages]
    lines += [sale("x", "future", "10", day=as_of + dt.timedelta(days=1)), sale("y", "gift", "10", kind="bonificacao"),
              sale("z", "zero", "0", day=as_of)]
    names = [f"k{n}" for n in ages] + ["future", "gift", "zero", "never"]
    people = spark.createDataFrame(
        [("c1", n, n, None, None, None, None, None, D(1), n == "never", None) for n in names], schemas.CUSTOMERS
    )
    mart = spark.createDataFrame(lines, schemas.SALES)
    recency = portfolio.customer_recency(people, mart, as_of)
    value = {r.cod_cliente: (r.dias_sem_compra, r.faturamento_6m) for r in recency.collect()}
    assert value["k180"] == (180, D("10.00")) and value["k181"] == (181, D("0.00"))
    assert value["future"] == (None, D("0.00")) and value["gift"][0] is None and value["zero"] == (0, D("0.00"))
    got = portfolio.portfolio_summary(recency, sales.sales_summary(mart, START, END)).first()
    assert (got.total, got.ativos, got.inativos, got.nunca_compraram) == (11, 5, 3, 3)
    assert got.total == got.ativos + got.inativos + got.nunca_compraram
    assert (got.pct_ativos, got.pct_positivacao) == (45.5, 40.0)
    assert (got.suspensos, got.limite_suspenso, got.limite_credito_total) == (1, D("1.00"), D("11.00"))
    assert [r.cod_cliente for r in portfolio.cooling_customers(recency).collect()] == ["k31", "k90"]


def test_portfolio_of_nobody(clients, mart):
    recency = portfolio.customer_recency(clients, mart, END, seller="none")
    got = portfolio.portfolio_summary(recency, sales.sales_summary(mart, START, END, "none")).first()
    assert (got.total, got.pct_ativos, got.pct_positivacao) == (0, 0.0, 0.0)


def test_campaigns(spark, mart):
    campaigns = spark.createDataFrame(
        [(1, "dentro", dt.date(2024, 5, 5), dt.date(2024, 5, 9), "m", None, True),
         (2, "toca", dt.date(2024, 3, 1), dt.date(2024, 5, 1), "m", None, True),
         (3, "fora", dt.date(2024, 6, 1), dt.date(2024, 6, 9), "m", None, True)],
        schemas.CAMPAIGNS,
    )
    tagged = mart.withColumn("campanha_id", F.when(F.col("nr_nota").isin("1", "4", "8"), F.lit(1)).cast("bigint"))
    got = rows(sales.by_campaign(campaigns, tagged, START, END), "nome", "faturamento", "caixas")
    assert got == [("dentro", D("1010.00"), D("16.00")), ("toca", D("0.00"), D("0.00"))]
    cut = rows(sales.by_campaign(campaigns, tagged, START, END, cut_to_period=True), "nome", "faturamento")
    assert cut == [("dentro", D("110.00")), ("toca", D("0.00"))]


@pytest.fixture(scope="module")
def visits(spark):
    data = [
        ("1", "V1", "realizada", dt.datetime(2024, 5, 1, 2, 30)),   # still 30 April there
        ("2", "V1", "realizada", dt.datetime(2024, 5, 1, 3, 0)),
        ("3", "V1", "ausente", dt.datetime(2024, 6, 1, 2, 59)),     # still 31 May there
        ("4", "V9", "realizada", dt.datetime(2024, 5, 15, 12, 0)),
        ("5", "V1", "realizada", dt.datetime(2024, 6, 1, 3, 0)),
    ]
    return spark.createDataFrame([(i, None, None, s, None, None, st, None, ts) for i, s, st, ts in data], schemas.VISITS)


def test_visits_and_goals(spark, mart, visits):
    agenda = spark.createDataFrame(
        [("1", None, None, "V1", dt.date(2024, 5, 1), "pendente", None), ("2", None, None, "V1", dt.date(2024, 5, 31), "feita", None),
         ("3", None, None, "V1", dt.date(2024, 6, 1), "pendente", None)],
        schemas.AGENDA,
    )
    assert tuple(sales.visit_summary(visits, agenda, START, END).first()) == (3, 2, 2, 1)
    assert tuple(sales.visit_summary(visits, agenda, START, END, "V1").first()) == (2, 1, 2, 1)
    assert tuple(sales.visit_summary(visits, agenda, "2010-01-01", "2010-01-02").first()) == (0, 0, 0, 0)
    assert [r.id for r in field.recent_visits(visits, START, END).collect()] == ["3", "4", "2"]
    assert [r.id for r in field.recent_visits(visits, size=2).collect()] == ["5", "3"]

    goals = spark.createDataFrame(
        [("V1", "2024-05", 10, 1, 0, 1, D(100), D(0)), ("V9", "2024-05", 1, 0, 2, 1, D(0), D(0)), ("V1", "2024-04", 9, 9, 9, 1, D(9), D(9))],
        schemas.GOALS,
    )
    users = spark.createDataFrame([("V1", "Ana", "vendedor", "a@x")], schemas.USERS)
    registered = spark.createDataFrame(
        [("x", "V9", "crm", START), ("y", "V9", "totvs", START), ("w", "V9", "crm", END), ("q", "V9", "crm", dt.date(2024, 6, 1))],
        "cod_cliente string, cod_vendedor string, origem string, data_cadastro date",
    )
    counted = sales.registrations_by_seller(registered, START, END, "crm")
    result = sales.goals_vs_actuals(goals, users, mart, visits, START, END, registrations=counted)
    names = ["cod_vendedor", "nome", "real_visitas", "real_positivados", "real_cadastros", "real_faturamento", "real_caixas"]
    assert rows(result, *names) == [("V1", "Ana", 1, 1, 0, D("150.00"), D("20.00")), ("V9", "V9", 1, 0, 2, D("0.00"), D("0.00"))]
    without = sales.goals_vs_actuals(goals, users, mart, visits, START, END)
    assert {r.real_cadastros for r in without.collect()} == {0}
    pct = indicators.goal_attainment(result)
    assert rows(pct, "cod_vendedor", "pct_visitas", "faixa_visitas", "pct_faturamento", "faixa_faturamento", "pct_caixas", "faixa_caixas") == [
        ("V1", 10, "critical", 150, "good", None, None), ("V9", 100, "good", None, None, None, None),
    ]
    assert rows(field.visits_vs_goal(visits, goals, START, END), "cod_vendedor", "visitas", "meta_visitas") == [("V1", 2, 10), ("V9", 1, 1)]


def order(nr, status, boxes, value, kind="venda", reason=None, seller="V1", day=dt.date(2024, 5, 10)):
    return ("c1", nr, "p", "a", seller, D(boxes), D(value), kind, None, status, reason, "F", day, None, NOW)


def test_orders(spark, sellers):
    df = spark.createDataFrame(
        [
            order("1", "aberto", "5", "50", day=dt.date(2020, 1, 1)), order("1", "aberto", "1", "10"),
            order("2", "aberto", "7", "70", kind="devolucao"), order("3", "faturado", "19", "1"),
            order("4", "corte", "1", "8", reason="LOG"), order("5", "corte", "4", "9", day=dt.date(2024, 6, 1)),
            order("6", "aberto", "2", "20", seller="V7"),
        ],
        schemas.ORDERS,
    )
    assert tuple(orders.open_backlog(df).first()) == (D("80.00"), D("8.00"), 2, 3)
    rate = orders.fill_rate(df, START, END)
    assert tuple(rate.first()) == (D("19.00"), D("1.00"), D("8.00"), 95.0)
    assert indicators.fill_rate_band(rate).first().faixa == "good"
    assert orders.fill_rate(df, "2010-01-01", "2010-01-02").first().pct is None
    assert rows(orders.cuts_by_reason(df, START, dt.date(2024, 6, 30))) == [("LOG", D("1.00"), D("8.00")), ("OUTRO", D("4.00"), D("9.00"))]
    assert [tuple(r) for r in orders.backlog_by_seller(df, sellers).collect()] == [
        ("V1", "Ana", D("60.00"), D("6.00"), 1), ("V7", "V7", D("20.00"), D("2.00"), 1),
    ]
    # Only cut items: nothing was invoiced, so there is no rate.
    assert orders.fill_rate(df, dt.date(2024, 6, 1), dt.date(2024, 6, 1)).first().pct is None


def test_bands_and_shares(spark):
    rates = spark.createDataFrame([(95.0,), (94.9,), (85.0,), (84.9,), (None,)], "pct double")
    assert [r.faixa for r in indicators.fill_rate_band(rates).collect()] == ["good", "warning", "warning", "critical", None]
    shares = spark.createDataFrame([("a", D("200")), ("b", D("1")), ("c", D("-50"))], "k string, v decimal(14,2)")
    assert rows(indicators.share_of_leader(shares, "v"), "k", "pct_lider") == [("a", 100), ("b", 1), ("c", -25)]
    negative = spark.createDataFrame([("a", D("-3"))], "k string, v decimal(14,2)")
    assert indicators.share_of_leader(negative, "v").first().pct_lider == -300


def test_projection_change_credit(spark, mart, clients):
    summary = sales.sales_summary(mart, START, END)
    assert indicators.month_end_projection(summary, START, "2024-05-10").first().projecao == 589.0
    assert indicators.month_end_projection(summary, START, "2024-06-10").first().projecao is None
    change = indicators.change_vs_previous(summary, sales.previous_period(mart, START, END), "faturamento_total").first()
    assert change.variacao_pct == -62.0
    none = sales.previous_period(mart, "2010-01-01", "2010-01-31")
    assert indicators.change_vs_previous(summary, none, "faturamento_total").first().variacao_pct is None
    health = portfolio.portfolio_summary(portfolio.customer_recency(clients, mart, END), summary)
    assert indicators.credit_use(summary, health).first().uso_limite_pct == 115
    assert indicators.inactive_share(health).first().pct_inativos == 20.0


def test_periods(spark):
    assert month_span("2024-02-10") == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert last_days("2024-05-10", 7) == (dt.date(2024, 5, 3), dt.date(2024, 5, 10))
    assert tuple(indicators.default_range(spark, "2024-05-10").first()) == last_days("2024-05-10", 7)
    slices = month_slices(2023, 2024, 4)
    assert len(slices) == 8 and slices[0] == (dt.date(2023, 1, 1), dt.date(2023, 3, 31)) and slices[-1][1] == dt.date(2024, 12, 31)
    with pytest.raises(ValueError):
        month_slices(2023, 2024, 5)


def test_visibility_and_search(spark, mart, clients):
    users = spark.createDataFrame([("V1", "Ana", "vendedor", "a@x"), ("M", "Rui", "master", "m@x")], schemas.USERS)
    assert filters.rows_visible_to(mart, users, "m@x").count() == mart.count()
    assert filters.rows_visible_to(mart, users, "a@x").count() == mart.filter("cod_vendedor = 'V1'").count()
    assert filters.rows_visible_to(mart, users, "nobody@x").count() == 0
    assert rows(portfolio.customer_list(clients, "c1", "V2", "ATACADO"), "cod_cliente") == [("d",), ("z",)]
    assert rows(portfolio.customer_list(clients, text=" nA "), "cod_cliente") == [("a",)]
    assert portfolio.customer_list(clients, text="  ", size=3).count() == 3
    assert filters.for_listed(clients, "cod_cliente", ["a", "z"]).count() == 2


def test_order_scope(spark):
    base = ["REP", "CLI", "100", 1, "6003.1"]
    cases = [base, ["LOGISTICA", *base[1:]], ["REP", "MATRIZ", *base[2:]], ["REP", "CLI", "60.1", 1, "6003.1"],
             ["REP", "CLI", "A1", 1, "6003.1"], ["REP", "CLI", "09.1", 1, "6003.1"], ["REP", "CLI", "100", 6, "6003.1"],
             ["REP", "CLI", "100", 1, "6008"], ["REP", "CLI", "100", 1, "6007.9999"], ["REP", "CLI", "100", 1, "x"]]
    df = spark.createDataFrame(cases, "representante string, nome_abrev string, it_codigo string, situacao_pedido int, nr_pedcli string")
    scope = filters.OrderScope(excluded_customers=("MATRIZ",), rep_range=(6003, 6008))
    assert rows(filters.order_scope_filter(df, scope), "nr_pedcli") == [("6003.1",), ("6007.9999",)]


def test_register_and_change_customers(spark, clients):
    spec = "cod_cliente string, nome string, cnpj string, canal string, cidade string, uf string, cod_vendedor string, limite_credito string, ordem int"
    asked = spark.createDataFrame(
        [
            (" n1 ", " Novo ", "12.345.678/0001-95", "", None, "spx", None, "x", 1), ("n1", "Outro", None, None, None, None, None, None, 2),
            ("a", "Velho", None, None, None, None, None, None, 3), (None, "S", None, None, None, None, None, None, 4),
            ("n2", "", None, None, None, None, None, None, 5), ("n3", "T", "123", None, None, None, None, None, 6),
            ("n4", "U", "", "VAREJO", "X", None, "V9", "12.5", 7),
        ],
        spec,
    )
    accepted, rejected = field.register_customers(asked, clients, "c1", "V1")
    assert rows(accepted, "cod_cliente", "nome", "cnpj", "canal", "uf", "cod_vendedor", "limite_credito") == [
        ("n1", "Novo", "12345678000195", None, "SP", "V1", D("0.00")), ("n4", "U", None, "VAREJO", None, "V9", D("12.50")),
    ]
    assert rows(rejected, "ordem", "motivo") == [
        (2, "codigo ja existe"), (3, "codigo ja existe"), (4, "campo obrigatorio"), (5, "campo obrigatorio"), (6, "cnpj invalido"),
    ]
    changes = spark.createDataFrame(
        [("a", "NOVO", None, "", 1), ("a", "", "0", None, 2), ("a", "MAIS", None, None, 3), ("b", "", None, "", 4), ("q", "X", None, None, 5), (None, "X", None, None, 6)],
        "cod_cliente string, canal string, limite_credito string, cod_vendedor string, ordem int",
    )
    updated, refused = field.apply_customer_changes(changes, clients, "c1")
    assert rows(updated.filter("cod_cliente = 'a'"), "canal", "limite_credito", "cod_vendedor") == [("MAIS", D("0.00"), "V1")]
    assert updated.count() == clients.count()
    assert rows(refused, "ordem", "motivo") == [(4, "nada para atualizar"), (5, "cliente nao encontrado"), (6, "cod_cliente obrigatorio")]


def test_monitoring(spark, mart):
    begun = dt.datetime(2024, 5, 1, 10, 0, 0)
    log = spark.createDataFrame(
        [("1", "a", begun, begun + dt.timedelta(seconds=90, milliseconds=500), "OK", 5, "m"),
         ("2", "b", begun + dt.timedelta(hours=1), None, "RODANDO", None, None),
         ("3", "c", begun + dt.timedelta(hours=2), begun + dt.timedelta(hours=2, seconds=1), "ERRO", 0, "falhou")],
        schemas.RUN_LOG,
    )
    now = F.lit(dt.datetime(2024, 5, 1, 11, 0, 30))
    got = [(r.id, r.inicio, r.fim, r.segundos) for r in monitoring.recent_runs(log, now).collect()]
    assert got == [("3", "01/05 12:00:00", "12:00:01", 1), ("2", "01/05 11:00:00", None, 30), ("1", "01/05 10:00:00", "10:01:30", 91)]
    assert [r.id for r in monitoring.running_now(log).collect()] == ["2"]
    assert [r.mensagem for r in monitoring.recent_failures(log).collect()] == ["falhou"]
    clean = {r.regra: r.violacoes for r in monitoring.contract_checks(mart, monitoring.CONTRACTS["sales"]).collect()}
    assert set(clean.values()) == {0}
    bad = mart.unionByName(mart.filter("nr_nota = '2'")).withColumn("tipo", F.when(F.col("nr_nota") == "5", "x").otherwise(F.col("tipo")))
    found = {r.regra: r.violacoes for r in monitoring.contract_checks(bad, monitoring.CONTRACTS["sales"]).collect()}
    assert found["domain:tipo"] == 1 and found["unique:" + "+".join(schemas.KEYS["sales"])] == 1
    assert rows(monitoring.quarantine(bad, monitoring.CONTRACTS["sales"]), "nr_nota", "regras") == [("5", ["domain:tipo"])]
    outside = spark.createDataFrame([(END, D("75.00"))], "dia date, faturamento decimal(24,2)")
    assert rows(monitoring.reconcile_day(sales.by_day(mart, START, END), outside, END), "diferenca") == [(D("-5.00"),)]


def test_pilot(spark, visits):
    pilot = spark.createDataFrame([("6003", "Um", "V1"), ("6004", "Dois", "V2")], "cod_rep string, nome string, cod_vendedor_crm string")
    reps = spark.createDataFrame([("c1", "6003", "Um", "UM", None, None, None, 1), ("c1", "9", "X", "X", None, None, None, 1)], schemas.REPS)
    items = spark.createDataFrame([("UM", D("5")), ("UM", D("7")), ("X", D("9"))], "representante string, valor_total_venda decimal(16,4)")
    registered = spark.createDataFrame([("6003",), ("6004",), ("6004",)], "cod_rep string")
    got = field.pilot_comparison(pilot, items, reps, registered, visits)
    assert rows(got) == [("6003", "Um", 2, D("12.0000"), 1, 4), ("6004", "Dois", 0, D("0.0000"), 2, 0)]
    assert tuple(field.pilot_totals(got).first()) == (2, D("12.0000"), 3, 4)
