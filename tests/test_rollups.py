"""Rollups against the indicators over the sales themselves, and what they read and rewrite."""

import datetime as dt
import random
import re
from decimal import Decimal

import pytest

from ledgerlight import schemas
from ledgerlight.catalog import queries_flow
from ledgerlight.catalog.registry import tables_of
from ledgerlight.operators import portfolio, rollups, sales
from ledgerlight.sinks import manifest, tables
from ledgerlight.sinks import rollups as stored
from tests.conftest import rows

D = Decimal
FOLDER = "/root/testdata/sf0.001"


def random_sales(seed, number, first=dt.date(2024, 1, 1), days=150):
    r = random.Random(seed)
    out = []
    for k in range(number):
        kind = r.choice([schemas.SALE] * 4 + [schemas.RETURN, schemas.BONUS])
        out.append((
            "c1", "e", f"n{r.randrange(number // 2)}", r.choice([None, f"o{r.randrange(number // 3)}"]), r.choice([None, f"k{r.randrange(20)}"]),
            r.choice([None, "7", "8", "9"]), f"i{r.randrange(9)}", r.choice([None, D(r.randrange(500)) / 100]), r.choice([D(0), D(r.randrange(9000)) / 100]),
            kind, None, r.choice([None] + [first + dt.timedelta(days=r.randrange(days))] * 30), dt.datetime(2024, 6, 1, 12, 0, k % 60),
        ))
    return out


@pytest.fixture(scope="module")
def held(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("rollups"))
    mart = spark.createDataFrame(random_sales(1, 900), schemas.SALES)
    tables.replace_fact(mart, f"{folder}/sales", "c1", "data_emissao")
    stored.refresh_rollups(spark, f"{folder}/sales", f"{folder}/rollups", "c1")
    return mart, stored.read_rollups(spark, f"{folder}/rollups", "c1")


def plain(df):
    return [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in df.collect()]


@pytest.mark.parametrize("span", [("2024-02-01", "2024-02-29"), ("2024-01-10", "2024-04-20"), ("2030-01-01", "2030-01-02")])
@pytest.mark.parametrize("seller", [None, "8"])
def test_rollups_equal_the_lines(spark, held, span, seller):
    mart, of = held
    scope = {"seller": seller, "company": "c1"}
    assert plain(rollups.sales_summary(of, mart, *span, **scope)) == plain(sales.sales_summary(mart, *span, **scope))
    assert plain(rollups.previous_period(of, *span, **scope)) == plain(sales.previous_period(mart, *span, **scope))
    assert plain(rollups.today_totals(of, span[0], **scope)) == plain(sales.today_totals(mart, span[0], **scope))
    assert plain(rollups.data_freshness(of)) == plain(sales.data_freshness(mart))
    assert plain(rollups.by_day(of, *span, **scope)) == plain(sales.by_day(mart, *span, **scope))
    names = spark.createDataFrame([("c1", "8", "Ana", True, None, None)], schemas.SELLERS)
    assert plain(rollups.by_seller(of, names, *span, **scope)) == plain(sales.by_seller(mart, names, *span, **scope))
    owned = spark.createDataFrame([("c1", f"k{n}", "x", None, f"ch{n % 3}", None, None, str(7 + n % 3), D(n), False, None) for n in range(25)], schemas.CUSTOMERS)
    assert plain(rollups.by_channel(of, owned, *span, **scope)) == plain(sales.by_channel(owned, mart, *span, **scope))
    assert sorted(plain(rollups.customer_recency(of, owned, span[1], **scope)), key=repr) == sorted(plain(portfolio.customer_recency(owned, mart, span[1], **scope)), key=repr)


def test_bitmaps_merge_over_days_and_sellers(spark, held):
    mart, of = held
    sold = mart.filter("tipo = 'venda'")
    for column in rollups.COUNTED_NUMBERS:
        counted = rollups.distinct_numbers(of.numbers, column, "n").first().n
        assert counted == sold.select(column).dropna().distinct().count() > 0
    plan = rollups.distinct_numbers(of.numbers, "nr_nota", "n", ("cod_vendedor",))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_many_ids_in_several_bitmaps(spark):
    numbers = spark.range(100_000).selectExpr("'nr_nota' as coluna", "date'2024-01-01' + cast(id % 40 as int) as data_emissao", "'7' as cod_vendedor", "cast(id as string) as numero")
    numbers = numbers.unionByName(numbers.selectExpr("coluna", "date_add(data_emissao, 1) as data_emissao", "'8' as cod_vendedor", "numero"))
    ids = spark.createDataFrame(rollups.new_ids(numbers, None, 1).toPandas())
    maps = rollups.number_bitmaps(numbers, ids)
    assert rollups.distinct_numbers(maps, "nr_nota", "n").first().n == 100_000
    assert {r.n for r in rollups.distinct_numbers(maps, "nr_nota", "n", ("cod_vendedor",)).collect()} == {100_000}
    # Dense ids: few bitmaps for many numbers, not one for each.
    assert maps.count() < 2 * 41 * 16


def test_only_touched_months_are_computed_again(spark, folder):
    path, to = f"{folder}/sales", f"{folder}/rollups"
    tables.replace_fact(spark.createDataFrame(random_sales(2, 400), schemas.SALES), path, "c1", "data_emissao")
    assert len(stored.refresh_rollups(spark, path, to, "c1")) >= 5
    assert stored.refresh_rollups(spark, path, to, "c1") == set()
    before = manifest.current(spark, f"{to}/empresa=c1")
    tables.replace_window(spark.createDataFrame(random_sales(3, 300), schemas.SALES), path, "c1", "data_emissao", "2024-05-01")
    changed = stored.refresh_rollups(spark, path, to, "c1")
    assert changed == {"mes_particao=2024-05"}
    after = manifest.current(spark, f"{to}/empresa=c1")
    for name in ("days", "customers", "numbers"):
        assert {m for m, g in after.parts(name).items() if before.parts(name).get(m) != g} <= changed
    # As computed from nothing.
    stored.refresh_rollups(spark, path, f"{folder}/other", "c1")
    kept, fresh = stored.read_rollups(spark, to, "c1"), stored.read_rollups(spark, f"{folder}/other", "c1")
    assert rows(kept.days) == rows(fresh.days) and rows(kept.customers) == rows(fresh.customers)
    for column in rollups.COUNTED_NUMBERS:
        by = ("data_emissao", "cod_vendedor")
        assert rows(rollups.distinct_numbers(kept.numbers, column, "n", by)) == rows(rollups.distinct_numbers(fresh.numbers, column, "n", by))
    # Months that the mart no longer has go from the rollups too.
    tables.replace_window(spark.createDataFrame([], schemas.SALES), path, "c1", "data_emissao", "2024-03-01")
    stored.refresh_rollups(spark, path, to, "c1")
    assert not [m for m in manifest.current(spark, f"{to}/empresa=c1").parts("days") if m >= "mes_particao=2024-03" and "HIVE" not in m]


def formatted(df):
    return df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_the_board_reads_the_sales_twice(spark):
    from ledgerlight.plans.boards import board_measures

    t = tables_of(spark, FOLDER)
    text = formatted(board_measures(queries_flow._sales_board(t)))
    scans = re.findall(r"Location: [^\n]*/sales\]", text)
    assert 1 <= len(scans) <= 3, len(scans)


def test_rollup_summary_copies_no_rows(spark):
    t = tables_of(spark, FOLDER)
    for df in (rollups.sales_summary(t.rollups, t.sales, "1998-01-01", "1998-01-31"), rollups.by_seller(t.rollups, t.sellers, "1998-01-01", "1998-01-31")):
        assert "Expand" not in formatted(df)


def test_listed_sellers_reduce_before_grouping(spark):
    from __spark_entry__ import queries

    plan = queries()["pilot_comparison"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") >= 4
