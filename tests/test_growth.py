"""Rollups must not grow faster than their input."""

import datetime as dt
import json
import time
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from ledgerlight import schemas
from ledgerlight.operators import rollups
from ledgerlight.plans.pipelines import Lake, logged
from ledgerlight.sinks import manifest, tables
from ledgerlight.sinks import rollups as stored
from ledgerlight.sinks.shuffles import CLEANUP


def test_bitmaps_of_few_numbers_are_small(spark):
    """A thousand sellers with one number each, and one with all of them."""
    numbers = spark.range(1000).selectExpr(
        "'nr_nota' as coluna", "date'2024-01-01' as data_emissao", "cast(id as string) as cod_vendedor", "cast(id as string) as numero"
    )
    numbers = numbers.unionByName(numbers.selectExpr("coluna", "data_emissao", "'all' as cod_vendedor", "numero"))
    ids = spark.createDataFrame(rollups.new_ids(numbers, None, 1).toPandas())
    maps = rollups.number_bitmaps(numbers, ids)
    held = [c for c in maps.columns if c.startswith("bits")]
    width = {c: 8 if kind == "bigint" else 4096 for c, kind in maps.dtypes if c in held}
    assert 0 < sum(width.values()) <= 64
    counted = {r.cod_vendedor: r.n for r in rollups.distinct_numbers(maps, "nr_nota", "n", ("cod_vendedor",)).collect()}
    assert counted.pop("all") == 1000
    assert len(counted) == 1000 and set(counted.values()) == {1}


@pytest.mark.parametrize("again", [1, 3])
def test_lines_with_the_same_number_count_once(spark, again):
    numbers = spark.range(300 * again).selectExpr(
        "'nr_pedido' as coluna", "date'2024-01-01' as data_emissao", "'7' as cod_vendedor", "cast(id % 300 as string) as numero"
    )
    ids = spark.createDataFrame(rollups.new_ids(numbers, None, 1).toPandas())
    assert len(ids.collect()) == 300
    maps = rollups.number_bitmaps(numbers, ids)
    assert rollups.distinct_numbers(maps, "nr_pedido", "n").first().n == 300
    assert rollups.distinct_numbers(maps, "nr_nota", "n").first().n == 0


def test_rollups_of_an_earlier_layout_are_computed_again(spark, folder):
    lines = [("c1", "e", f"n{k}", f"o{k % 7}", "k1", "7", "i1", None, Decimal(5), schemas.SALE, None, dt.date(2024, 1 + k % 3, 1), None) for k in range(30)]
    tables.replace_fact(spark.createDataFrame(lines, schemas.SALES), f"{folder}/sales", "c1", "data_emissao")
    refresh = (spark, f"{folder}/sales", f"{folder}/rollups", "c1")
    assert len(stored.refresh_rollups(*refresh)) == 3 and not stored.refresh_rollups(*refresh)
    # The state as an earlier release names it: one binary column of bits.
    of = f"{folder}/rollups/empresa=c1"
    state = manifest.current(spark, of)
    fields = [f for f in T.StructType.fromJson(json.loads(state.sets["numbers"].schema)).fields if not f.name.startswith("bits")]
    old = replace(state.sets["numbers"], schema=T.StructType([T.StructField("bits", T.BinaryType()), *fields]).json())
    manifest.commit(spark, of, replace(state, number=state.number + 1, sets={**state.sets, "numbers": old}))
    assert len(stored.refresh_rollups(*refresh)) == 3
    numbers = stored.read_rollups(spark, f"{folder}/rollups", "c1").numbers
    assert rollups.distinct_numbers(numbers, "nr_nota", "n").first().n == 30
    assert rollups.distinct_numbers(numbers, "nr_pedido", "n").first().n == 7


def shuffle_files(spark):
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(held.size()) if (name := held.apply(k).getName()).startswith("shuffle_")}


def test_a_step_leaves_no_shuffle_files(spark, folder):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP)
    grouped = spark.range(1000).selectExpr("id % 10 as k", "id").groupBy("k").sum("id")
    with logged(spark, Lake(folder), "step"):
        tables.replace_table(grouped, f"{folder}/t")
        assert tables.read_table(spark, f"{folder}/t").count() == 10
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)  # files go in the background
    assert not left and spark.conf.get(CLEANUP) == setting
    with pytest.raises(ValueError), logged(spark, Lake(folder), "step"):
        raise ValueError
    assert spark.conf.get(CLEANUP) == setting
