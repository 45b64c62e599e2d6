"""Load strategies: what is replaced, what stays, and that a second run changes nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.sinks import field_app, manifest, run_log
from ledgerlight.sinks import tables as sinks
from tests.conftest import rows

SPEC = "empresa string, k string, v int, dia date"


def day(n):
    return dt.date(2024, 5, n)


def frame(spark, *data):
    return spark.createDataFrame([("c1", k, v, day(d)) for k, v, d in data], SPEC)


def test_replace_table_reads_itself_and_survives_a_failed_load(spark, folder):
    path = f"{folder}/t"
    assert not sinks.table_exists(spark, path)
    sinks.replace_table(frame(spark, ("a", 1, 1), ("b", 2, 1)), path)
    sinks.replace_table(sinks.read_table(spark, path).filter("v > 1"), path)
    assert rows(sinks.read_table(spark, path), "k") == [("b",)]
    failing = sinks.read_table(spark, path).withColumn("v", F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(Exception, match="stop"):
        sinks.replace_table(failing, path)
    assert rows(sinks.read_table(spark, path), "k") == [("b",)]
    sinks.replace_table(frame(spark, ("c", 3, 1)), path)
    sinks.replace_table(frame(spark, ("d", 3, 1)), path)
    sinks.drop_old_versions(spark, path, keep=1)
    assert rows(sinks.read_table(spark, path), "k") == [("d",)]


def test_replace_company_leaves_the_others(spark, folder):
    path = f"{folder}/t"
    one = frame(spark, ("a", 1, 1), ("b", 2, 2))
    two = one.withColumn("empresa", F.lit("c2"))
    sinks.replace_company(one.unionByName(two), path, "c1", ["dia"])
    sinks.replace_company(one.unionByName(two), path, "c2", ["dia"])
    sinks.replace_company(frame(spark, ("x", 9, 3)), path, "c1", ["dia"])
    assert rows(sinks.read_table(spark, path), "empresa", "k", "dia") == [
        ("c1", "x", day(3)), ("c2", "a", day(1)), ("c2", "b", day(2)),
    ]
    assert rows(sinks.read_table(spark, path, "c1"), "k") == [("x",)]
    with pytest.raises(ValueError):
        sinks.replace_company(one, path, "../x")
    with pytest.raises(FileNotFoundError):
        sinks.read_table(spark, path, "c3")


def dated(spark, *data):
    return spark.createDataFrame([("c1", k, v, dt.date(2024, m, d)) for k, v, m, d in data], SPEC)


def test_replace_window(spark, folder):
    path = f"{folder}/t"
    first = dated(spark, ("a", 1, 4, 1), ("b", 1, 5, 1), ("c", 1, 5, 5), ("d", 1, 5, 6), ("e", 1, 6, 7), ("f", 1, 7, 1))
    sinks.replace_window(first, path, "c1", "dia", "2024-01-01")
    # d and all of June vanished, c was corrected, a new day came; rows before the cutoff are ignored.
    second = dated(spark, ("a", 99, 4, 1), ("b", 99, 5, 1), ("c", 2, 5, 5), ("f", 1, 7, 1), ("g", 1, 8, 9))
    expected = [("a", 1), ("b", 1), ("c", 2), ("f", 1), ("g", 1)]
    for _ in range(2):
        sinks.replace_window(second, path, "c1", "dia", "2024-05-05")
        assert rows(sinks.read_table(spark, path, schema=first.schema), "k", "v") == expected
    # Everything in the window vanished.
    sinks.replace_window(second.limit(0), path, "c1", "dia", "2024-05-05")
    assert rows(sinks.read_table(spark, path, schema=first.schema), "k") == [("a",), ("b",)]


def fail_before_the_switch(monkeypatch):
    def die(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(manifest, "commit", die)


def test_window_that_dies_before_the_switch_changes_nothing(spark, folder, monkeypatch):
    path = f"{folder}/t"
    first = dated(spark, ("a", 1, 5, 1), ("b", 1, 5, 9), ("c", 1, 6, 1))
    sinks.replace_fact(first, path, "c1", "dia")
    with monkeypatch.context() as broken:
        fail_before_the_switch(broken)
        with pytest.raises(RuntimeError):
            sinks.replace_window(dated(spark, ("b", 2, 5, 9)), path, "c1", "dia", "2024-05-05")
    assert rows(sinks.read_table(spark, path), "k", "v") == [("a", 1), ("b", 1), ("c", 1)]
    sinks.replace_window(dated(spark, ("d", 3, 6, 3)), path, "c1", "dia", "2024-06-02")
    assert rows(sinks.read_table(spark, path), "k", "v") == [("a", 1), ("b", 1), ("c", 1), ("d", 3)]
    # What the dead load has written goes with the old states.
    data = f"{path}/empresa=c1/data/rows"
    assert len(manifest.children(spark, data)) == 3
    sinks.drop_old_versions(spark, path, "c1", keep=1)
    assert len(manifest.children(spark, data)) == 2 and len(manifest.children(spark, f"{path}/empresa=c1/manifests")) == 1
    assert rows(sinks.read_table(spark, path), "k", "v") == [("a", 1), ("b", 1), ("c", 1), ("d", 3)]


def test_a_reader_keeps_the_state_it_has_read(spark, folder):
    path = f"{folder}/t"
    sinks.replace_fact(dated(spark, ("a", 1, 4, 1), ("b", 1, 5, 1), ("c", 1, 6, 1)), path, "c1", "dia")
    reader = sinks.read_table(spark, path)
    sinks.replace_window(dated(spark, ("d", 2, 5, 9)), path, "c1", "dia", "2024-05-01")
    sinks.drop_old_versions(spark, path, "c1", keep=2)
    assert rows(reader, "k") == [("a",), ("b",), ("c",)]
    assert rows(sinks.read_table(spark, path), "k") == [("a",), ("d",)]
    # The month that nothing touched is the same file in both states.
    files = [{f for f in df.inputFiles() if "2024-04" in f} for df in (reader, sinks.read_table(spark, path))]
    assert files[0] == files[1] and files[0]


def test_two_loads_at_once_do_not_mix(spark, folder):
    path = f"{folder}/t"
    sinks.replace_fact(dated(spark, ("a", 1, 5, 1)), path, "c1", "dia")
    slow = manifest.Load(spark, f"{path}/empresa=c1")
    month = sinks.with_month(dated(spark, ("slow", 1, 5, 1)).drop("empresa"), "dia")
    slow.write(month, schemas.MONTH_PARTITION)
    slow.put(month.schema, schemas.MONTH_PARTITION, ())
    sinks.replace_window(dated(spark, ("b", 1, 6, 1)), path, "c1", "dia", "2024-06-01")
    with pytest.raises(manifest.ConcurrentLoad):
        slow.commit()
    assert rows(sinks.read_table(spark, path), "k") == [("a",), ("b",)]


def test_null_in_a_key_moves_like_any_other(spark, folder):
    path = f"{folder}/t"
    spec = "empresa string, k string, n int, dia date"
    first = spark.createDataFrame([("c1", "a", None, day(1)), ("c1", "a", 1, day(1)), ("c1", "b", None, None)], spec)
    sinks.replace_fact(first, path, "c1", "dia")
    moved = spark.createDataFrame([("c1", "a", None, day(20)), ("c1", "b", None, day(21))], spec)
    sinks.replace_window(moved, path, "c1", "dia", day(15), ["k", "n"])
    assert rows(sinks.read_table(spark, path), "k", "n", "dia") == [("a", 1, day(1)), ("a", None, day(20)), ("b", None, day(21))]


def test_the_source_is_read_once(spark, folder):
    path = f"{folder}/t"
    read = spark.sparkContext.accumulator(0)
    first = dated(spark, ("a", 1, 4, 2), ("b", 1, 5, 2), ("c", 1, 5, 20))
    sinks.replace_fact(first, path, "c1", "dia")

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = dated(spark, ("a", 2, 5, 18), ("c", 2, 5, 20), ("d", 2, 5, 21)).mapInArrow(seen, first.schema)
    sinks.replace_window(source, path, "c1", "dia", "2024-05-15", ["k"])
    assert read.value == 3
    assert rows(sinks.read_table(spark, path), "k", "v") == [("a", 2), ("b", 1), ("c", 2), ("d", 2)]


def test_rows_that_left_the_window_are_fetched_again(spark, folder):
    path = f"{folder}/t"
    sinks.replace_fact(dated(spark, ("a", 1, 4, 2), ("b", 1, 5, 20), ("c", 1, 5, 20), ("d", 1, 5, 21), ("e", 1, 5, 22)), path, "c1", "dia")
    # At the source b went to March, c to the window's own month, d is gone.
    source = dated(spark, ("a", 1, 4, 2), ("b", 2, 3, 9), ("c", 2, 5, 3), ("e", 2, 5, 22))
    asked = []

    def refetch(keys):
        asked.extend(rows(keys, "k"))
        return source.join(keys, ["empresa", "k"], "left_semi")

    for _ in range(2):
        sinks.replace_window(source, path, "c1", "dia", "2024-05-15", ["k"], refetch)
        assert rows(sinks.read_table(spark, path), "k", "v") == [("a", 1), ("b", 2), ("c", 2), ("e", 2)]
    assert asked == [("b",), ("c",), ("d",)]


def test_tables_of_an_earlier_release_are_taken_over(spark, folder):
    path = f"{folder}/t"
    old = sinks.with_month(dated(spark, ("a", 1, 3, 1), ("b", 1, 5, 1), ("c", 1, 5, 20)), "dia")
    sinks.replace_company(old, path, "c1", [schemas.MONTH_PARTITION])
    assert rows(sinks.read_table(spark, path), "k") == [("a",), ("b",), ("c",)]
    sinks.replace_window(dated(spark, ("d", 2, 5, 21)), path, "c1", "dia", "2024-05-15", ["k"])
    assert rows(sinks.read_table(spark, path), "k") == [("a",), ("b",), ("d",)]
    sinks.drop_old_versions(spark, path, "c1", keep=1)
    assert rows(sinks.read_table(spark, path), "k") == [("a",), ("b",), ("d",)]
    visits = f"{folder}/v"
    sinks.replace_table(frame(spark, ("a", 1, 1), ("b", 1, 2)), visits, ["dia"])
    sinks.upsert_days(frame(spark, ("a", 2, 3)), visits, ["k"], "dia")
    assert rows(sinks.read_table(spark, visits), "k", "v", "dia") == [("a", 2, day(3)), ("b", 1, day(2))]


def test_window_that_failed_while_staging_leaves_the_table(spark, folder):
    path = f"{folder}/t"
    first = dated(spark, ("a", 1, 5, 1), ("b", 1, 5, 9))
    sinks.replace_fact(first, path, "c1", "dia")
    failing = first.withColumn("v", F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(Exception, match="stop"):
        sinks.replace_window(failing, path, "c1", "dia", "2024-05-05")
    assert rows(sinks.read_table(spark, path, schema=first.schema), "k", "v") == [("a", 1), ("b", 1)]
    sinks.replace_window(dated(spark, ("b", 2, 5, 9)), path, "c1", "dia", "2024-05-05")
    assert rows(sinks.read_table(spark, path, schema=first.schema), "k", "v") == [("a", 1), ("b", 2)]


def test_window_reload_equals_full_reload(spark, folder):
    source = dated(spark, *[(f"k{i}", i, 4 + i % 3, 1 + i % 9) for i in range(40)])
    inside = F.col("dia") >= F.lit(dt.date(2024, 5, 4))
    changed = source.filter(~inside | (F.col("v") % 7 != 0)).withColumn("v", F.when(inside, F.col("v") + 100).otherwise(F.col("v")))
    sinks.replace_fact(source, f"{folder}/w", "c1", "dia")
    sinks.replace_window(changed, f"{folder}/w", "c1", "dia", "2024-05-04")
    sinks.replace_fact(changed, f"{folder}/f", "c1", "dia")
    assert rows(sinks.read_table(spark, f"{folder}/w"), "k", "v", "dia") == rows(sinks.read_table(spark, f"{folder}/f"), "k", "v", "dia")


def test_empty_fact(spark, folder):
    path = f"{folder}/t"
    empty = frame(spark, ("a", 1, 1)).limit(0)
    sinks.replace_fact(empty, path, "c1", "dia")
    assert sinks.read_table(spark, path, "c1", empty.schema).count() == 0
    sinks.replace_window(frame(spark, ("a", 1, 1)), path, "c1", "dia", day(1))
    assert sinks.read_table(spark, path, "c1", empty.schema).count() == 1


def test_rows_without_a_date_survive_a_window(spark, folder):
    path = f"{folder}/t"
    first = spark.createDataFrame([("c1", "a", 1, None), ("c1", "b", 1, day(9))], SPEC)
    sinks.replace_fact(first, path, "c1", "dia")
    sinks.replace_window(frame(spark, ("b", 2, 9)), path, "c1", "dia", day(5))
    assert rows(sinks.read_table(spark, path, schema=first.schema), "k", "v") == [("a", 1), ("b", 2)]


def test_interrupted_day_upsert_loses_nothing(spark, folder, monkeypatch):
    path = f"{folder}/t"
    sinks.upsert_days(frame(spark, ("a", 1, 1), ("b", 1, 1), ("c", 1, 2)), path, ["k"], "dia")
    batch = frame(spark, ("b", 2, 1), ("d", 1, 1))
    with monkeypatch.context() as broken:
        fail_before_the_switch(broken)
        with pytest.raises(RuntimeError):
            sinks.upsert_days(batch, path, ["k"], "dia")
    assert rows(sinks.read_table(spark, path), "k", "v") == [("a", 1), ("b", 1), ("c", 1)]
    for _ in range(2):
        sinks.upsert_days(batch, path, ["k"], "dia")
        assert rows(sinks.read_table(spark, path), "k", "v") == [("a", 1), ("b", 2), ("c", 1), ("d", 1)]


def test_a_row_that_changes_its_day_is_kept_once(spark, folder):
    path = f"{folder}/t"
    sinks.upsert_days(frame(spark, *[(f"k{n}", n, 1 + n % 5) for n in range(40)]), path, ["k"], "dia", counted=["empresa"], buckets=8)
    untouched = {f for f in sinks.read_table(spark, path).inputFiles() if "2024-05-03" in f}
    # k0 moves to a later day and k6 to an earlier one; of two rows for k1 the one with the greater v counts.
    batch = frame(spark, ("k0", 100, 9), ("k6", 101, 1), ("k1", 102, 5), ("k1", 103, 4), ("new", 1, 2))
    for _ in range(2):
        sinks.upsert_days(batch, path, ["k"], "dia", "v", counted=["empresa"], buckets=8)
        moved = {"k0": (100, 9), "k6": (101, 1), "k1": (103, 4), "new": (1, 2)}
        expected = {f"k{n}": (n, 1 + n % 5) for n in range(40)} | moved
        stored = sinks.read_table(spark, path)
        assert rows(stored, "k", "v", "dia") == sorted((k, v, day(d)) for k, (v, d) in expected.items())
        counts = {}
        for _, d in expected.values():
            counts[day(d)] = counts.get(day(d), 0) + 1
        assert rows(sinks.read_day_counts(spark, path), "dia", "linhas") == sorted(counts.items(), key=repr)
    assert {f for f in stored.inputFiles() if "2024-05-03" in f} == untouched


def test_upserts(spark):
    target = frame(spark, ("a", 1, 1), ("b", 2, 1))
    source = frame(spark, ("b", 20, 2), ("b", 30, 1), ("c", 40, 1))
    key = ["empresa", "k"]
    # The last by day wins, whatever the other values.
    assert rows(sinks.upsert(target, source, key, "dia"), "k", "v", "dia") == [("a", 1, day(1)), ("b", 20, day(2)), ("c", 40, day(1))]
    assert rows(sinks.upsert(target, source, key), "k", "v") == [("a", 1), ("b", 30), ("c", 40)]
    assert rows(sinks.upsert_columns(target, source, key, ["v"], "dia"), "k", "v", "dia") == [
        ("a", 1, day(1)), ("b", 20, day(1)), ("c", 40, day(1)),
    ]
    assert rows(sinks.insert_new(target, source, key, "dia"), "k", "v") == [("a", 1), ("b", 2), ("c", 40)]
    once = sinks.upsert(target, source, key)
    assert rows(sinks.upsert(once, source, key)) == rows(once)


def test_upsert_sets_nulls(spark):
    target = frame(spark, ("a", 1, 1))
    source = frame(spark, ("a", None, 2))
    assert rows(sinks.upsert_columns(target, source, ["empresa", "k"], ["v"]), "v", "dia") == [(None, day(1))]


def test_stored_upsert(spark, folder):
    path = f"{folder}/t"
    sinks.store_upsert(spark, frame(spark, ("a", 1, 1), ("a", 3, 1)), path, ["empresa", "k"])
    sinks.store_upsert(spark, frame(spark, ("a", 9, 4), ("b", 1, 1)), path, ["empresa", "k"], ["v"])
    assert rows(sinks.read_table(spark, path), "k", "v", "dia") == [("a", 9, day(1)), ("b", 1, day(1))]


def test_one_key_with_a_third_of_the_rows(spark):
    many = spark.range(30_000).select(
        F.lit("c1").alias("empresa"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        F.col("id").cast("int").alias("v"),
        F.lit(day(1)).alias("dia"),
    )
    latest = sinks.latest_per_key(many, ["empresa", "k"], "v")
    assert latest.count() == 20_001
    assert latest.filter("k = 'hot'").first().v == 29_997
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_field_app_mirror(spark, folder):
    def landed(note, seller, ids):
        visits = spark.createDataFrame([(i, None, None, seller, None, None, "realizada", note, None) for i in ids], schemas.VISITS)
        return {
            "users": spark.createDataFrame([("V1", note, "vendedor", None)], schemas.USERS),
            "goals": spark.createDataFrame([("V1", "2024-05", len(ids), 0, 0, 1, None, None)], schemas.GOALS),
            "visits": visits,
            "agenda": spark.createDataFrame([], schemas.AGENDA),
        }

    field_app.sync_field_tables(spark, landed("um", "V1", ["1", "2"]), folder)
    field_app.sync_field_tables(spark, landed("dois", "V2", ["2", "3", "4"]), folder)
    visits = sinks.read_table(spark, f"{folder}/visits")
    # Gone at the source but kept; a known visit keeps its seller.
    assert rows(visits, "id", "cod_vendedor", "observacao") == [("1", "V1", "um"), ("2", "V1", "dois"), ("3", "V2", "dois"), ("4", "V2", "dois")]
    # A mirror of an earlier release, which was written as a whole, is taken over.
    older = landed("um", "V1", ["1", "2"])["visits"]
    sinks.replace_table(older, f"{folder}/old/visits")
    field_app.sync_visits(spark, landed("dois", "V2", ["2", "3"])["visits"], f"{folder}/old/visits")
    taken = sinks.read_table(spark, f"{folder}/old/visits")
    assert rows(taken, "id", "cod_vendedor", "observacao") == [("1", "V1", "um"), ("2", "V1", "dois"), ("3", "V2", "dois")]
    # A sync that changes nothing writes nothing; one that changes a visit's day moves it.
    state = manifest.current(spark, f"{folder}/visits")
    again = landed("dois", "V3", ["2", "3", "4"])
    field_app.sync_field_tables(spark, again, folder)
    assert manifest.current(spark, f"{folder}/visits") == state
    moved = again["visits"].withColumn("timestamp", F.lit(dt.datetime(2024, 5, 2, 1)))
    field_app.sync_field_tables(spark, {**again, "visits": moved.filter("id = '3'")}, folder)
    visits = sinks.read_table(spark, f"{folder}/visits")
    assert rows(visits, "id", "cod_vendedor", "dia") == [("1", "V1", None), ("2", "V1", None), ("3", "V2", day(1)), ("4", "V2", None)]
    assert rows(sinks.read_table(spark, f"{folder}/users"), "nome") == [("dois",)]
    assert rows(sinks.read_table(spark, f"{folder}/goals"), "meta_visitas") == [(3,)]


def test_run_log(spark, folder):
    path = f"{folder}/log"
    good = run_log.log_start(spark, path, "a")
    run_log.log_end(spark, path, good, ok=True, rows=5, message="m" * 3000)
    bad = run_log.log_start(spark, path, "b")
    run_log.log_end(spark, path, bad, ok=False, message="x")
    run_log.log_start(spark, path, "c")
    view = run_log.read_run_log(spark, path)
    assert rows(view, "tarefa", "status", "registros") == [("a", "OK", 5), ("b", "ERRO", None), ("c", "RODANDO", None)]
    assert view.filter("tarefa = 'a'").first().mensagem == "m" * 3000
