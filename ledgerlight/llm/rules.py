"""Quality rules: statistics of whole texts, and an ordered list of threshold rules learned from labelled documents.

Sequential covering: a rule is grown condition by condition on two thirds of the labelled rows still uncovered, taking the
threshold with the best information gain, then pruned on the last third, and the rows that it covers are taken out; this
goes on until no rule is precise enough. The list becomes one Spark expression: rule 1, else rule 2, ..., else keep.

The list is fitted on at most ``MAX_LABELLED`` labelled rows (those with the smallest hashes of their ids; the statistics
themselves are computed for all documents). Without labels of both classes it is empty, and the base rule alone decides.

Cases: null and empty texts have no words (and fail the base rule); repeated rows each get a result; other columns are
ignored; rows with null label or id do not teach; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, staged, table
from .words import PLAIN, mix, text_slices

MAX_LABELLED = 30_000
REPEAT_WINDOW = 5
THRESHOLDS = 64
"""Thresholds tried for each feature."""
MAX_CONDITIONS = 3
MIN_PRECISION = 0.9
MIN_COVERED = 10
MAX_RULES = 16

# The symbols that count.
SYMBOLS = b"#*$%&|<>"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_lines"]


def _flags(of: bytes) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[list(of)] = True
    return flags


_SYMBOL, _UPPER, _MARK = _flags(SYMBOLS), _flags(bytes(range(65, 91))), _flags(b"!?")


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every text; no row meets another."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for s in text_slices(batch.column("text"), PLAIN):
                yield pa.record_batch({"doc_id": ids.slice(s.rows.start, len(s.rows))} | _counts(s))

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS))


def _counts(s) -> dict[str, pa.Array]:
    def per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[at])

    n = len(s.rows)
    begins_character = (s.data & 0xC0) != 0x80
    # A window counts as repeated if its hash occurs again in the same text.
    at, windows = s.window_hashes(s.hashes(), REPEAT_WINDOW)
    own = mix(windows + s.owner()[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(own)
    same = own[order][1:] == own[order][:-1]
    again = np.zeros(len(own), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    cover = np.zeros(len(s.starts) + 1, dtype=np.int64)
    cover[at[again]] += 1
    cover[at[again] + REPEAT_WINDOW] -= 1
    dup_lines, lines = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    text = s.data.tobytes()
    for k in range(n):
        parts = [x for x in text[s.begin[k] : s.begin[k + 1]].split(b"\n") if x.strip()]
        lines[k], dup_lines[k] = len(parts), len(parts) - len(set(parts))
    values = [
        s.counts, per_text(PLAIN[s.data] & begins_character, s.begin), per_text(_SYMBOL[s.data], s.begin), dup_lines,
        per_text(np.cumsum(cover[:-1]) > 0, s.first_word), per_text(_UPPER[s.data], s.begin), per_text(_MARK[s.data], s.begin), lines,
    ]
    return {name: pa.array(v.astype(np.int64)) for name, v in zip(COUNTS, values, strict=True)}


def features() -> dict[str, Column]:
    """What conditions are about: shares, and the length."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "chars_per_word": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
        "upper_share": F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
        "marks_per_word": F.col("n_marks") / words,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, column: np.ndarray) -> np.ndarray:
        return column > self.threshold if self.above else column <= self.threshold

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.feature] > self.threshold if self.above else of[self.feature] <= self.threshold


Rule = list[Condition]


def _covers(rule: Rule, names: list[str], x: np.ndarray) -> np.ndarray:
    held = np.ones(len(x), dtype=bool)
    for c in rule:
        held &= c.holds(x[:, names.index(c.feature)])
    return held


def _grow(names: list[str], x: np.ndarray, bad: np.ndarray) -> Rule:
    rule, held = [], np.ones(len(x), dtype=bool)
    while len(rule) < MAX_CONDITIONS and (held & ~bad).any() and (held & bad).any():
        p0, n0 = (held & bad).sum(), (held & ~bad).sum()
        best = (0.0, None)
        for k, name in enumerate(names):
            values = np.unique(np.quantile(x[held, k], np.linspace(0, 1, THRESHOLDS), method="lower"))
            ordered_bad, ordered_good = np.sort(x[held & bad, k]), np.sort(x[held & ~bad, k])
            for value in values[:-1]:
                p_low, n_low = np.searchsorted(ordered_bad, value, "right"), np.searchsorted(ordered_good, value, "right")
                for above, p, n in ((False, p_low, n_low), (True, p0 - p_low, n0 - n_low)):
                    if p >= MIN_COVERED:
                        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                        if gain > best[0] + 1e-9:
                            # Half way to the next value seen, not at the last row's own value.
                            after = np.min(x[held & (x[:, k] > value), k])
                            best = (gain, Condition(name, above, float((value + after) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        held &= best[1].holds(x[:, names.index(best[1].feature)])
    return rule


def learn(names: list[str], x: np.ndarray, bad: np.ndarray, prune_part: np.ndarray) -> list[Rule]:
    """Rules for the bad rows, in the order in which they apply."""
    rules: list[Rule] = []
    while len(rules) < MAX_RULES and (bad & ~prune_part).sum() >= MIN_COVERED:
        rule = _grow(names, x[~prune_part], bad[~prune_part])
        if not rule:
            break

        def worth(r: Rule) -> float:
            held = _covers(r, names, x) & prune_part
            return ((held & bad).sum() + 1) / (held.sum() + 2)

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)
        held = _covers(rule, names, x)
        if (held & bad).sum() < MIN_COVERED or (held & bad).sum() < MIN_PRECISION * held.sum():
            break
        rules.append(rule)
        x, bad, prune_part = x[~held], bad[~held], prune_part[~held]
    return rules


def fit(counts: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Rules from ``counts`` joined with ``labels`` (doc_id, quality 1 or 0)."""
    taught = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").alias("label_id"), "quality")
    order = F.xxhash64("label_id")
    taught = taught.orderBy(order, "label_id", "quality").limit(max_labelled)
    rows = counts.join(taught, F.col("doc_id") == F.col("label_id"))
    rows = rows.select(*(f.alias(n) for n, f in features().items()), "quality", (F.pmod(order, F.lit(3)) == 0).alias("prune"), "doc_id")
    # Ids may repeat in the documents; the bound holds for what is fetched too.
    got = rows.orderBy(F.xxhash64("doc_id"), *features()).limit(max_labelled).collect()
    names = list(features())
    x = np.array([[r[n] for n in names] for r in got], dtype=float).reshape(len(got), len(names))
    return learn(names, x, np.array([r["quality"] == 0 for r in got], dtype=bool), np.array([r["prune"] for r in got], dtype=bool))


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects a row of counts, 0 if none does."""
    of, result = features(), F.lit(0)
    for number in range(len(rules), 0, -1):
        held = F.lit(True)
        for c in rules[number - 1]:
            held = held & c.column(of)
        result = F.when(held, number).otherwise(result)
    return result


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[DataFrame, list[Rule]]:
    """All counts with base_failed, rule (the rejecting one, 0 if none) and kept; and the rules."""
    counts = staged(text_counts(docs), shared_folder(docs.sparkSession), "counts")
    rules = fit(counts, labels, max_labelled)
    judged = counts.withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)), rules


# ---------------------------------------------------------------- the query


def op9_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged, _ = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )
