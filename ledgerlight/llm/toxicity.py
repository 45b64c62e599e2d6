"""Toxicity by two class-conditional Kneser-Ney models.

A word bigram model is learned from toxic and one from ordinary texts. Counts of bigrams are discounted; what is taken off
goes to a class's continuation counts (before how many different words a word was seen), and what is taken off there goes
to continuation counts that both classes share: different words before a word in all documents. A word that neither class knows well thus has
the same probability in both, up to the classes' back-off weights. A text's score comes from the difference of its two
log-likelihoods by word, so only the ratios are kept: of bigrams, of the back-off weights of contexts, and of words.

Bounds: at most ``MAX_PER_CLASS`` labelled texts of each class teach (those with the smallest hashes of their ids), a fifth
of them only the final logistic step. The tables sent to tasks hold every word, context and bigram of those texts, 12 bytes
each, so they are bounded by the texts. The shared counts and the scores cover all documents, all words and whole texts.

Cases: null and empty texts have no words and get the score of no evidence; repeated rows are scored alike; a document
with several labels is toxic if one says so; rows with null label or id do not teach; without labels of both classes every
score is the share of toxic labels (0.5 without labels); other columns are kept by ``with_score`` (names given here get
leading underscores on a clash); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, fields
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .common import discard, prefixed, shared_folder, staged, table
from .words import ALNUM, mix, text_slices

MAX_PER_CLASS = 10_000
PAIR_SLICE = 8 << 20
"""Bytes of text whose pairs of words are sent to the shared counts once."""
PAIR_BLOCKS = 4
"""The pairs are counted in so many blocks by word, one after the other: only one block of them is on disk at a time."""
FIRST_WORD = np.uint64(0x5851F42D4C957F2D)
STRONG = 1.5
RARE = 6
"""Words before which the classes saw fewer words than this, and bigrams that they saw less often, have features of their own."""

N_FEATURES = 7
_BIGRAM = np.uint64(0xD6E8FEB86659FD93)


def held_out(id_column: Column) -> Column:
    """Rows that never teach: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _words(s) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a slice and of the words before them."""
    words = s.hashes()
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[s.first_word[:-1][s.counts > 0]] = FIRST_WORD
    return before, words


def _pair(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(before * _BIGRAM + words)


class Finder:
    """Places of hashes among ascending ``keys``. Hashes are spread evenly, so a key's first bits tell nearly where it is."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(1, len(keys).bit_length() - 2)
        self.shift = np.uint64(64 - bits)
        self.keys, last = keys, max(len(keys) - 1, 0)
        self.starts = np.minimum(np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift), last).astype(np.int32)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the first key that is not below each wanted one, the last place where there is none; and which are held."""
        at = self.starts[wanted >> self.shift]
        if not len(self.keys):
            return at, np.zeros(len(wanted), dtype=bool)
        last = len(self.keys) - 1
        open_ = np.flatnonzero((self.keys[at] < wanted) & (at < last))
        while len(open_):
            at[open_] += 1
            open_ = open_[(self.keys[at[open_]] < wanted[open_]) & (at[open_] < last)]
        return at, self.keys[at] == wanted


def _values(values: np.ndarray, at: np.ndarray, held: np.ndarray, other: float | bool) -> np.ndarray:
    """The values of found keys, ``other`` for those not held."""
    return np.where(held, values[at], other) if len(values) else np.full(len(at), other)


@dataclass
class Model:
    """Log ratios, toxic to ordinary. Keys are ascending."""

    words: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.uint64))
    word_ratio: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.float32))
    word_rare: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=bool))
    other_word: float = 0.0
    contexts: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.uint64))
    context_ratio: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.float32))
    bigrams: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.uint64))
    bigram_ratio: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.float32))
    bigram_rare: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=bool))
    weights: tuple[float, ...] = (0.0,) * N_FEATURES
    intercept: float = 0.0

    @cached_property
    def finders(self) -> tuple[Finder, Finder, Finder]:
        return Finder(self.words), Finder(self.contexts), Finder(self.bigrams)

    def sent(self) -> dict:
        """What is broadcast: the fields, as each worker makes its finders itself."""
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def features(self, s) -> np.ndarray:
        """By text: mean log ratio; what strong words have above ``STRONG`` (roots of the means over all words and over the
        different ones); number (as a logarithm) and share of strong ones among the different words; what rare words and
        what words in rare bigrams have above ``STRONG`` (roots of the means over the different words).

        Rare bigrams count with their lower order in the strong words' features, and rare words not at all: those have
        features of their own, as single sightings are weaker evidence.
        """
        before, words = _words(s)
        word, context, bigram = self.finders
        at, held = word.find(words)
        lower, rare_word = _values(self.word_ratio, at, held, self.other_word), _values(self.word_rare, at, held, True)
        lower = lower + _values(self.context_ratio, *context.find(before), 0.0)
        at, held = bigram.find(_pair(before, words))
        ratio = np.where(held, _values(self.bigram_ratio, at, held, 0.0), lower)
        rare_pair = _values(self.bigram_rare, at, held, False)
        counts = np.maximum(s.counts, 1)

        def mean(x: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0.0], np.cumsum(x)])[s.first_word]) / counts

        # A word that a text repeats is one piece of evidence among its different words.
        _, first = np.unique(words + mix(s.owner().astype(np.uint64) + FIRST_WORD), return_index=True)
        once = np.zeros(len(words))
        once[first] = 1.0
        distinct = np.maximum(mean(once) * counts, 1)

        def root(x: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(mean(x), 0))  # differences of sums can fall below zero by rounding

        above = np.where(rare_word, 0.0, np.maximum(np.where(rare_pair, lower, ratio) - STRONG, 0))
        number = mean(once * (above > 0)) * counts
        of_distinct = np.sqrt(counts / distinct)
        rare = [root(np.where(x, np.maximum(ratio - STRONG, 0), 0.0) * once) * of_distinct for x in (rare_word, rare_pair & ~rare_word)]
        return np.stack([mean(ratio), root(above), root(above * once) * of_distinct, np.log1p(np.maximum(number, 0)), number / distinct, *rare], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights) + self.intercept, -30, 30)))


# ---------------------------------------------------------------- learning


def _teachers(labels: DataFrame, max_per_class: int) -> DataFrame:
    """label_id, toxic, sampled rows of each class (at most ``max_per_class``)."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out(F.col("label_id")))
    parts = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("label_id"), "label_id").limit(max_per_class) for c in (0, 1)]
    return parts[0].unionByName(parts[1])


def _bigram_counts(texts: DataFrame) -> DataFrame:
    """before, word, class counts n0 and n1 over ``texts`` (text, toxic)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.asarray(batch.column("toxic")).astype(bool)
            for s in text_slices(batch.column("text"), ALNUM, lower=True):
                before, words = _words(s)
                of = toxic[s.rows.start : s.rows.stop][s.owner()]
                _, first, same = np.unique(_pair(before, words), return_index=True, return_inverse=True)
                n1 = np.bincount(same, weights=of, minlength=len(first)).astype(np.int64)
                n = np.bincount(same, minlength=len(first)).astype(np.int64)
                yield pa.record_batch(
                    {
                        "before": pa.array(before[first].view(np.int64)), "word": pa.array(words[first].view(np.int64)),
                        "n0": pa.array(n - n1), "n1": pa.array(n1),
                    }
                )

    counted = texts.select("text", "toxic").mapInArrow(count, "before bigint, word bigint, n0 bigint, n1 bigint")
    return counted.groupBy("before", "word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _shared_counts(docs: DataFrame) -> DataFrame:
    """word and shared: before how many different words each word was seen in all documents.

    A task sends each pair of words once for each slice of texts, and the pairs are counted over all documents, so copies
    count once. The texts are read again for each block of words; what is kept of a block are its counts.
    """
    folder = shared_folder(docs.sparkSession)

    def pairs_of(block: int) -> DataFrame:
        def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for s in text_slices(batch.column("text"), ALNUM, lower=True, slice_bytes=PAIR_SLICE):
                    before, words = _words(s)
                    mine = words % np.uint64(PAIR_BLOCKS) == block
                    before, words = before[mine], words[mine]
                    _, first = np.unique(_pair(before, words), return_index=True)
                    yield pa.record_batch({"before": pa.array(before[first].view(np.int64)), "word": pa.array(words[first].view(np.int64))})

        return docs.select("text").mapInArrow(pairs, "before bigint, word bigint").distinct()

    counted = [staged(pairs_of(b).groupBy("word").agg(F.count("*").alias("shared")), folder, f"block{b}") for b in range(PAIR_BLOCKS)]
    return reduce(DataFrame.unionByName, counted)


def _discount(ones: int, twos: int) -> float:
    return ones / (ones + 2 * twos) if ones and twos else 0.5


def _fetch(df: DataFrame, keys: list[str], folder: str, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ``keys`` (a word, or a word and the one before it), ascending, log ratios, and which are rare: all rows.

    They are written first, so that the shuffles that they come from are dropped before the next ones begin.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = [np.asarray(batch.column(k)).view(np.uint64) for k in keys]
            of = _pair(*of) if len(of) == 2 else of[0]
            yield pa.record_batch({"key": pa.array(of.view(np.int64)), "ratio": pa.array(np.asarray(batch.column("ratio")).astype(np.float32)), "rare": batch.column("rare")})

    hashes = df.select(*keys, "ratio", "rare").mapInArrow(hashed, "key bigint, ratio float, rare boolean")
    got = staged(hashes, folder, name).toArrow()
    discard(df.sparkSession, folder, name)
    key, ratio, rare = (got.column(c).to_numpy() for c in ("key", "ratio", "rare"))
    order = np.argsort(key.view(np.uint64))
    return key.view(np.uint64)[order], ratio[order], rare.astype(bool)[order]


def fit(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> Model:
    """The model of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); held-out rows never teach."""
    folder = shared_folder(docs.sparkSession)
    teachers = staged(_teachers(labels, max_per_class), folder, "teachers")
    # At most 2 * max_per_class ids, so the broadcast has a fixed bound.
    texts = docs.select("doc_id", "text").join(F.broadcast(teachers), F.col("doc_id") == F.col("label_id"))
    texts = texts.select("text", "toxic", (F.pmod(F.xxhash64("label_id", F.lit(1)), F.lit(5)) == 0).alias("calibrates"))
    texts = staged(texts, folder, "texts")
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        share = {0: 0.0, 1: 1.0}[next(iter(sizes))] if sizes else 0.5
        return Model(intercept=float(np.log((share + 1e-6) / (1 - share + 1e-6))))

    counted = staged(_bigram_counts(texts.where("not calibrates")), folder, "bigrams")
    of_word = staged(
        counted.groupBy("word").agg(F.sum((F.col("n0") > 0).cast("long")).alias("c0"), F.sum((F.col("n1") > 0).cast("long")).alias("c1")), folder, "words"
    )
    one_two = [F.sum((F.col(c) == k).cast("long")).alias(f"{c}_{k}") for c in ("c0", "c1") for k in (1, 2)]
    lower = of_word.agg(
        *(F.sum(c).alias(c) for c in ("c0", "c1")), *(F.sum((F.col(c) > 0).cast("long")).alias(f"types_{c}") for c in ("c0", "c1")), *one_two
    ).first()
    upper = counted.agg(*(F.sum((F.col(c) == k).cast("long")).alias(f"{c}_{k}") for c in ("n0", "n1") for k in (1, 2))).first()
    d_lower = [_discount(lower[f"{c}_1"], lower[f"{c}_2"]) for c in ("c0", "c1")]
    d_upper = [_discount(upper[f"{c}_1"], upper[f"{c}_2"]) for c in ("n0", "n1")]

    # Words: continuation counts of the class, backed off to the shared ones. All words of the teaching texts are among
    # those of all documents; a word that neither class knows has the ratio of the back-off weights, its shared part cancels.
    shared = _shared_counts(docs)
    total = shared.agg(F.sum("shared")).first()[0] or 1
    back = [d_lower[c] * lower[f"types_c{c}"] / max(lower[f"c{c}"], 1) for c in (0, 1)]
    p = [F.greatest(F.col(f"c{c}") - d_lower[c], F.lit(0.0)) / max(lower[f"c{c}"], 1) + back[c] * F.col("shared") / total for c in (0, 1)]
    words = of_word.join(shared, "word").select("word", p[0].alias("p0"), p[1].alias("p1"), (F.col("c0") + F.col("c1") < RARE).alias("rare"))
    words = staged(words, folder, "word_terms")
    model = Model(other_word=float(np.log(back[1] / back[0])))
    model.words, model.word_ratio, model.word_rare = _fetch(words.select("word", F.log(F.col("p1") / F.col("p0")).alias("ratio"), "rare"), ["word"], folder, "word_ratios")

    # Contexts and bigrams: bigrams are discounted, what is taken off a context goes to its words' lower order.
    left = [F.greatest(F.col(f"n{c}") - d_upper[c], F.lit(0.0)) for c in (0, 1)]
    contexts = counted.groupBy("before").agg(*(F.sum(f"n{c}").alias(f"t{c}") for c in (0, 1)), *(F.sum(left[c]).alias(f"k{c}") for c in (0, 1)))
    weight = [F.when(F.col(f"t{c}") > 0, F.greatest(1 - F.col(f"k{c}") / F.col(f"t{c}"), F.lit(1e-3))).otherwise(1.0) for c in (0, 1)]
    contexts = staged(contexts.select("before", "t0", "t1", weight[0].alias("w0"), weight[1].alias("w1")), folder, "context_terms")
    ratio = F.log(F.col("w1") / F.col("w0")).alias("ratio")
    model.contexts, model.context_ratio, _ = _fetch(contexts.select("before", ratio, F.lit(False).alias("rare")), ["before"], folder, "context_ratios")
    both = [left[c] / F.greatest(F.col(f"t{c}"), F.lit(1)) + F.col(f"w{c}") * F.col(f"p{c}") for c in (0, 1)]
    rare = (F.col("n0") + F.col("n1") < RARE).alias("rare")
    bigrams = counted.join(words.drop("rare"), "word").join(contexts, "before").select("before", "word", F.log(both[1] / both[0]).alias("ratio"), rare)
    model.bigrams, model.bigram_ratio, model.bigram_rare = _fetch(bigrams, ["before", "word"], folder, "bigram_ratios")
    for name in ("bigrams", "words", "word_terms", "context_terms"):
        discard(docs.sparkSession, folder, name)

    # Score: logistic regression on texts that taught no counts, weighted to the classes' true shares.
    names = [f"f{k}" for k in range(N_FEATURES)]
    rows = with_features(texts.where("calibrates"), model, names).select("toxic", *names).toArrow()
    true = {r["toxic"]: r["n"] for r in labels.where("toxic in (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    x = np.stack([rows.column(n).to_numpy() for n in names], axis=1) if len(rows) else np.empty((0, N_FEATURES))
    y = rows.column("toxic").to_numpy().astype(float)
    weight_of = np.array([true[c] / sizes[c] for c in (0, 1)])
    model.weights, model.intercept = _logistic(x, y, (weight_of / weight_of.mean())[y.astype(int)])
    return model


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01) -> tuple[tuple[float, ...], float]:
    """Newton's method; columns are scaled first."""
    if not len(x) or y.min() == y.max():
        return (1.0, *[0.0] * (N_FEATURES - 1)), 0.0
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.concatenate([(x - mean) / spread, np.ones((len(x), 1))], axis=1)
    beta = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        penalty = ridge * np.append(np.ones(x.shape[1]), 0)
        gradient = z.T @ (weight * (y - p)) - penalty * beta
        curve = (z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    scaled = beta[:-1] / spread
    return tuple(float(v) for v in scaled), float(beta[-1] - scaled @ mean)


# ---------------------------------------------------------------- scoring


def with_features(docs: DataFrame, model: Model, names: list[str], text_column: str = "text") -> DataFrame:
    """``docs`` with the model's features as further columns; rows stay where they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model.sent())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Model(**sent.value)
        for batch in batches:
            parts = [of.features(s) for s in text_slices(batch.column(text_column), ALNUM, lower=True)]
            x = np.concatenate(parts) if parts else np.empty((0, len(names)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x[:, k]) for k in range(len(names)))], [*batch.schema.names, *names])

    schema = StructType([*docs.schema.fields])
    for name in names:
        schema = schema.add(name, DoubleType())
    return docs.mapInArrow(run, schema)


def with_score(docs: DataFrame, model: Model, name: str = "score", text_column: str = "text") -> DataFrame:
    """``docs`` with the score (0 to 1) as column ``name``."""
    name = prefixed(docs, [], name)
    sent = docs.sparkSession.sparkContext.broadcast(model.sent())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Model(**sent.value)
        for batch in batches:
            parts = [of.score(of.features(s)) for s in text_slices(batch.column(text_column), ALNUM, lower=True)]
            scores = np.concatenate(parts) if parts else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(name, DoubleType()))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` (with all columns) without those scored ``threshold`` or more."""
    model = fit(docs, labels)
    name = prefixed(docs, [], "score")
    return with_score(docs, model, name).where(F.col(name) < threshold).drop(name)


# ---------------------------------------------------------------- the query


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = with_score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
