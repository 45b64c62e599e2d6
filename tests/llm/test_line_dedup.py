"""Line dedup against a plain version and its SQL, on given, odd and hot rows."""

from __future__ import annotations

import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import line_dedup
from ledgerlight.llm.queries import ORACLES, QUERIES

from .plain import sha
from .test_operators import ODD, SF, rows

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = re.compile(r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z")
COMMON = "  The Same Line Of Text\x0b"
MORE = ODD + [
    (20, f"{COMMON}\nmine alone, twenty\n{COMMON}"), (21, f"the same line of text\n\n{COMMON}\nlast of twenty-one"), (21, COMMON),
    (22, " ÀÉ same line x\n àé same line x"), (23, " ÀÉ same line x"), (24, "short one\nshort one"), (25, "short one"),
    (26, "\n".join(f"line number {i % 700} of many" for i in range(900))), (27, "\n".join(f"LINE number {i} of many" for i in range(650, 1400))),
    (28, "ten chars!\n\n"), (29, "TEN CHARS!"), (None, "ten chars!\nonly the null document has this"), (None, "only the null document has this"),
]


def plain(docs):
    order = lambda d: (d is None, d or 0)
    holders = defaultdict(set)
    split = [(d, (t or "").split("\n")) for d, t in docs]
    key = lambda line: BLANK.sub("", line).translate(LOW)
    for d, lines in split:
        for line in lines:
            holders[key(line)].add(d)
    out = []
    for d, lines in split:
        kept = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)], key=order) == d]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=repr)


def digest(docs):
    marked = line_dedup.with_bitmaps(docs)
    names = marked.columns[-3:]
    text = line_dedup.kept_text(F.col("text"), F.col(names[2]))
    return rows(marked, "doc_id", names[0], names[1], F.sha2(text.cast("binary"), 256))


@pytest.fixture(scope="module")
def odd(spark):
    clash = "row bigint, pos int, h1 bigint, h2 bigint, first bigint, keep string, lost int, kept_bits int, word int, key string, line string"
    return spark.createDataFrame([(*r, 0, 0, 0, 0, 0, "", 0, 0, 0, "", "") for r in MORE], f"doc_id bigint, text string, {clash}").repartition(3)


def test_given_rows(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = rows(QUERIES["op12_line_bitmaps"](spark, SF))
    assert got == plain(given) and any(r[2] for r in got)


def test_sql_agrees(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    assert sorted(con.execute(ORACLES["op12_line_bitmaps"]).fetchall(), key=repr) == rows(QUERIES["op12_line_bitmaps"](spark, SF))


def test_odd_rows(odd):
    assert digest(odd) == plain(MORE)
    kept = line_dedup.with_bitmaps(odd)
    assert kept.columns == [*odd.columns, "n_lines", "n_dropped", "_keep"]
    assert kept.select(*odd.columns).exceptAll(odd).count() == 0


def test_empty_table_and_repeated_rows(odd, spark):
    assert line_dedup.with_bitmaps(odd.where("doc_id < 0")).collect() == []
    twice = [(5, COMMON), (4, f"{COMMON}\nx"), (4, f"{COMMON}\nx"), (6, f"{COMMON}\ny"), (6, f"{COMMON}\ny"), (6, "another text of six\n" + COMMON)]
    assert digest(spark.createDataFrame(twice, "doc_id bigint, text string")) == plain(twice)


def test_hot_lines_are_decided_where_they_lie(spark, monkeypatch):
    """A line in a third of all rows, and one that a single document repeats."""
    monkeypatch.setattr(line_dedup, "HOT_ROWS", 8)
    docs = [(i, f"{COMMON}\nline {i % 50} of some documents\nalone in document {i}") for i in range(3, 600)]
    docs.append((1, "again and again\n" * 500))
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    hot = line_dedup.hot_lines(line_dedup.lines_of(table)).collect()
    assert sorted(r["first"]["id"] for r in hot) == [1, 3]
    assert digest(table) == plain(docs)


def test_plan_is_native(spark):
    plan = QUERIES["op12_line_bitmaps"](spark, SF)._jdf.queryExecution().toString()
    lines = line_dedup.repeated_lines(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"):
        assert word not in plan and word not in lines
    # The stream of first occurrences reads the range partitions as they are.
    assert "rangepartitioning(h1" in lines and "hashpartitioning(h1" not in lines
