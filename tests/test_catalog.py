"""Every registered query against its SQL, and what its plan must not hold."""

import pytest

import __spark_entry__ as entry_module
from ledgerlight.catalog.registry import oracle_statements, spark_queries
from tests.check_oracles import compare, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES = spark_queries()  # filled by the entry module
ORACLES = oracle_statements()
# These write or stream when they are built; their plans are reads of what they wrote.
WRITERS = {
    "refresh_from_exports", "refresh_full_then_window", "visits_stream_daily", "visits_stream_table", "replace_table",
    "replace_company", "replace_window", "sync_field_tables", "read_export", "read_field_app", "read_seed_types",
    "window_redated", "line_moved_out", "full_keeps_older_years", "visit_changes_day", "visits_stream_corrected",
    "visits_stream_closed_days", "conversion_failures", "rollups_after_window",
}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    message, same = compare(spark, con, FOLDER, name, QUERIES[name], ORACLES.get(name))
    assert same, message


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITERS])
def test_plan(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "Window "):
        assert unwanted not in plan, f"{name}: {unwanted}"


def test_period_filter_prunes_partitions_and_columns(spark):
    plan = QUERIES["by_day"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(mes_particao" in plan
    assert "nr_nota" not in plan and "cod_cliente" not in plan


def test_entry(spark):
    assert entry_module.entry(spark).count() == 1


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
