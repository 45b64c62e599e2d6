"""The shuffles of the marts must not grow faster than their input."""

import re

import pytest

from ledgerlight.catalog import tables
from ledgerlight.catalog.registry import tables_of
from ledgerlight.operators import marts, rollups
from ledgerlight.sinks import manifest
from ledgerlight.sinks.rollups import monthly_sales, store_rollups
from tests.conftest import rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def broadcast_up_to(spark):
    """Sets the size up to which tables are broadcast; the old one comes back."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, size)
    spark.conf.set(name, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grouping_does_not_shuffle_the_lines_again(spark, broadcast_up_to):
    t = tables_of(spark, FOLDER)
    broadcast_up_to("-1")
    grouped = plan(marts.group_invoice_lines(t.invoice_lines, "1990-01-01"))
    assert "SortMergeJoin" in grouped and grouped.count("Exchange hashpartitioning") == 2


def test_lines_are_not_shuffled_by_operation(spark, broadcast_up_to):
    t = tables_of(spark, FOLDER)
    t.type_map, t.customers, t.products  # written with the usual size
    broadcast_up_to("2k")
    assert "SortMergeJoin [nat_operacao" not in plan(t.build_sales())


def test_large_tables_get_partitions_by_their_number_of_lines(spark, monkeypatch):
    from ledgerlight.catalog import tables as catalog

    t = tables_of(spark, FOLDER)
    lines = t.raw("lineitem").count()
    monkeypatch.setattr(catalog, "LINES_PER_PART", lines // 40)
    parts = t.by_number(t.raw("lineitem"), "l_orderkey")
    assert 40 <= parts.rdd.getNumPartitions() <= 42
    assert parts.count() == lines


def test_rollups_shuffle_the_sales_once(spark, broadcast_up_to):
    t = tables_of(spark, FOLDER)
    sales = t.sales.drop("empresa")
    numbers = rollups.number_days(sales)
    ids = spark.createDataFrame(rollups.new_ids(numbers, None, 1).toPandas())
    broadcast_up_to("-1")
    for df in (rollups.seller_days(sales), rollups.customer_days(sales)):
        assert re.findall(r"Exchange (\w+)", plan(df)) == ["rangepartitioning"]
    # The numbers and their ids meet, and then the bitmaps.
    assert re.findall(r"Exchange (\w+)", plan(rollups.number_bitmaps(numbers, ids))) == ["rangepartitioning"] + ["hashpartitioning"] * 2


def test_rollups_are_written_without_another_shuffle(spark, folder, monkeypatch):
    t = tables_of(spark, FOLDER)
    hints = []
    kind = type(t.sales)
    hint = kind.hint
    monkeypatch.setattr(kind, "hint", lambda df, *of: (hints.append(of), hint(df, *of))[1])
    months = {manifest.part_name("mes_particao", r[0]): "1" for r in t.sales.select("mes_particao").distinct().collect()}
    store_rollups(spark, monthly_sales(t.sales.drop("empresa")), months, folder)
    assert not hints and manifest.current(spark, folder).parts("days").keys() == months.keys()


def test_a_large_fact_is_not_shuffled_by_month(spark, monkeypatch):
    even = tables_of(spark, FOLDER)
    monkeypatch.setattr(tables, "LINES_PER_PART", 500)
    large = tables.Tables(spark, FOLDER, "large")
    hints = []
    hint = type(even.sales).hint
    monkeypatch.setattr(type(even.sales), "hint", lambda df, *of: (hints.append(of), hint(df, *of))[1])
    sales, orders = large.sales, large.orders
    assert large.large and not hints
    assert rows(sales) == rows(even.sales) and rows(orders) == rows(even.orders)


def test_facts_meet_large_dimensions_with_their_sums_in_final_width(spark, broadcast_up_to):
    t = tables_of(spark, FOLDER)
    t.type_map, t.customers, t.products  # written with the usual size
    broadcast_up_to("-1")
    for df in (t.build_sales(), t.build_orders()):
        node = df._jdf.queryExecution().optimizedPlan()
        while "Join" not in node.nodeName():
            node = node.children().head()
        facts = node.children().head().schema().toDDL()
        assert "(2" not in facts and "decimal(14,2)" in facts.lower(), facts
