"""Toxicity by two class-conditional Kneser-Ney models.

One model is of toxic texts, the other of ordinary ones. A word after another backs off to the word, the
word to its stem, the first letters, and the stem to a distribution shared by both classes. As Kneser-Ney
has it, words and stems are counted by the different words that they follow, so that a copied text counts
once, and every level gives an absolute discount of its counts to the next one. The discount of an expression
is the count that a class with ``ODDS`` times its odds would likely reach by chance, and one. So rare
expressions, and those that both classes use, get the same probability in both models, by way of the shared
counts, and a rare word still has what is known of its stem.

The evidence for a text is the difference of its two log-likelihoods, each divided by the number of words.
Both models end in the same shared distribution, which therefore cancels: probabilities are computed over
it. A logistic curve turns the evidence into a score. Few texts have very much evidence, so it is a curve over
the logarithm of the distance from the usual evidence. It is fitted on a third of the labelled texts, with models
that have counted the others; the models that score have counted all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ordermill.llm.common import replace_columns, written
from ordermill.llm.words import PUNCTUATED, Words, combine, words

MOST_TRAINING_ROWS = 10_000
#: One in so many training texts fits the logistic curve.
FITTING_SHARE = 3
#: The discount: the expected count at so many times the odds, so many deviations above it, and a count.
ODDS, DEVIATIONS, DISCOUNT = 4.0, 2.0, 1.0
START = np.uint64(0x5851F42D4C957F2D)
SIDES = ("ordinary", "toxic")
COUNTS = "head long, word long, stem long, ordinary long, toxic long"


class Level(NamedTuple):
    """Expressions that a class has of its own; all others get the ``rest`` of the next level."""

    key: np.ndarray  # sorted
    extra: np.ndarray  # by key and class: probability over that of both classes together
    rest: np.ndarray  # by class


class Model(NamedTuple):
    stems: Level
    words: Level
    pairs: Level
    heads: np.ndarray  # words before the pairs of that level
    head_rest: np.ndarray  # and what they leave to the next level, by class
    curve: np.ndarray  # usual evidence, its spread, weight, and constant
    prior: float  # share of toxic texts

    @property
    def tells_apart(self) -> bool:
        """Whether there were texts of both kinds to learn from."""
        return bool(self.curve[2])


def held_out(key: Column, parts: int) -> Column:
    """One in ``parts`` rows, by the key as text. A null key is never held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == 0, F.lit(False))


def contexts(found: Words) -> np.ndarray:
    """The word before each word, or a start mark."""
    before = np.empty_like(found.hash)
    if len(before):
        before[1:] = found.hash[:-1]
        before[np.flatnonzero(np.diff(found.text, prepend=-1))] = START
    return before


def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of pairs of words in the two classes, summed for some texts at a time."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        for found in words(batch.column("text"), separators=PUNCTUATED):
            before, label = contexts(found), toxic[found.text]
            _, first, inverse = np.unique(combine(before, found.hash), return_index=True, return_inverse=True)
            columns = [before[first], found.hash[first], found.stem[first]]
            counts = [np.bincount(inverse, label == side, len(first)).astype(np.int64) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(column.view(np.int64)) for column in columns], *map(pa.array, counts)],
                ["head", "word", "stem", *SIDES],
            )


def lookup(keys: np.ndarray, sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def with_level(below: np.ndarray, keys: np.ndarray, level: Level, rest: np.ndarray | None = None) -> np.ndarray:
    """Probability over the shared one, by class, from that of the next level."""
    at, known = lookup(keys, level.key)
    out = below * (level.rest if rest is None else rest)
    if len(level.key):
        out += np.where(known[:, None], level.extra[at], 0.0)
    return out


def evidence(model: Model, found: Words) -> np.ndarray:
    """Log-likelihood as toxic minus as ordinary, word by word."""
    before = contexts(found)
    ratio = with_level(np.ones((len(found.hash), 2)), found.stem, model.stems)
    ratio = with_level(ratio, found.hash, model.words)
    at, known = lookup(before, model.heads)
    rest = np.where(known[:, None], model.head_rest[at], 1.0) if len(model.heads) else np.ones_like(ratio)
    ratio = with_level(ratio, combine(before, found.hash), model.pairs, rest)
    return np.log(ratio[:, 1] / ratio[:, 0])


def evidences(model: Model, column: pa.Array) -> np.ndarray:
    """Per text: difference of the two log-likelihoods per word, and words."""
    out = [np.zeros((0, 2))]
    for found in words(column, separators=PUNCTUATED):
        at = found.text - found.first
        n = np.bincount(at, minlength=found.texts)
        total = np.bincount(at, evidence(model, found), found.texts)
        out.append(np.stack([total / np.maximum(n, 1), n], axis=1))
    return np.concatenate(out)


def compressed(found: np.ndarray, usual: float, spread: float) -> np.ndarray:
    away = found - usual
    return np.sign(away) * np.log1p(np.abs(away) / spread)


def fit_curve(found: np.ndarray, toxic: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic regression on the compressed evidence by Newton's method with a weak ridge."""
    usual = float(np.median(found))
    # Where most texts have the very same evidence, a share of the deviation of all.
    spread = max(float(np.median(np.abs(found - usual))), float(found.std()) / 20, 1e-9)
    feature = compressed(found, usual, spread)
    scale = max(float(feature.std()), 1e-9)
    x = np.column_stack([feature / scale, np.ones(len(feature))])
    ridge = np.diag([0.1, 1e-6])
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + ridge, x.T @ (toxic - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return np.array([usual, spread, w[0] / scale, w[1]])


def own_counts(df: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Rows where a class has more than the discount, with ``extra`` and ``own`` count of each class.

    ``totals`` are the counts of all expressions, by class, among which those of a row are shared out. A class
    that is alone, or has nothing, has no expression of its own.
    """
    both = F.col("ordinary") + F.col("toxic")
    whole = totals["ordinary"] + totals["toxic"]
    for side in SIDES:
        # The share that the class would have at the higher odds.
        likely = F.try_divide(ODDS * totals[side], whole + (ODDS - 1) * totals[side])
        deviation = F.sqrt(F.greatest(both * likely * (1 - likely), F.lit(0.0)))
        own = F.col(side) - both * likely - DEVIATIONS * deviation - DISCOUNT
        df = df.withColumn(f"own_{side}", F.coalesce(F.greatest(own, F.lit(0.0)), F.lit(0.0)))
    df = df.where("own_ordinary > 0 OR own_toxic > 0")
    for side in SIDES:
        share = F.try_divide(F.col(f"own_{side}") * whole, totals[side] * both)
        df = df.withColumn(f"extra_{side}", F.coalesce(share, F.lit(0.0)))
    return df


def as_level(df: DataFrame, key: str, totals: tuple[float, float]) -> Level:
    got = df.select(F.col(key).alias("key"), *[f"{what}_{side}" for what in ("own", "extra") for side in SIDES]).toArrow()
    keys = got.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    own, extra = (
        np.stack([got.column(f"{what}_{side}").to_numpy() for side in SIDES], axis=1)[order] for what in ("own", "extra")
    )
    return Level(keys[order], extra, 1 - own.sum(axis=0) / np.maximum(totals, 1))


def count_levels(sample: DataFrame) -> Model:
    """The model of a sample (``text``, ``toxic``), its curve left open.

    What is collected are the expressions that a class has of its own.
    """
    sums = [F.sum(side).alias(side) for side in SIDES]
    kinds = [F.sum((F.col(side) > 0).cast("long")).alias(side) for side in SIDES]
    counted = sample.mapInArrow(count_pairs, COUNTS).groupBy("head", "word").agg(F.first("stem").alias("stem"), *sums)
    pairs = written(counted, "toxicity-pairs")
    by_word = written(pairs.groupBy("word").agg(F.first("stem").alias("stem"), *kinds), "toxicity-words")
    got = by_word.agg(*sums).first()
    totals = (got["ordinary"] or 0, got["toxic"] or 0)
    fixed = {side: F.lit(float(total)) for side, total in zip(SIDES, totals)}
    stems = as_level(own_counts(by_word.groupBy("stem").agg(*sums), fixed), "stem", totals)
    single = as_level(own_counts(by_word, fixed), "word", totals)
    heads = written(pairs.groupBy("head").agg(*[F.sum(side).alias(f"head_{side}") for side in SIDES]), "toxicity-heads")
    before = {side: F.col(f"head_{side}") for side in SIDES}
    following = own_counts(pairs.join(heads, "head"), before).toArrow()
    head, word = (following.column(name).to_numpy().view(np.uint64) for name in ("head", "word"))
    key = combine(head, word)
    order = np.argsort(key)
    extra = np.stack([following.column(f"extra_{side}").to_numpy() for side in SIDES], axis=1)[order]
    left, at = np.unique(head, return_inverse=True)
    share = [
        following.column(f"own_{side}").to_numpy() / np.maximum(following.column(f"head_{side}").to_numpy(), 1) for side in SIDES
    ]
    rest = np.stack([1 - np.bincount(at, part, len(left)) for part in share], axis=1)
    return Model(stems, single, Level(key[order], extra, np.ones(2)), left, rest, np.array([0.0, 1.0, 0.0, 0.0]), 0.5)


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    folds: int = 5,
    most_rows: int = MOST_TRAINING_ROWS,
) -> Model:
    """Learn from labelled rows that are not held out, from about ``most_rows`` of them at the most.

    Beyond that number, rows are taken by a hash of the key. Rows whose label is null are not labelled;
    if labels of a key contradict each other, it counts as toxic. Without labelled texts of both kinds
    all texts get the share of toxic ones as score (0.5 without any).
    """
    usable = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("toxic"))
    usable = usable.where(F.col("key").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("key"), folds))
    total = usable.count()
    spread = 1 << 30
    share = spread if total <= most_rows else int(spread * most_rows / total)
    place = F.pmod(F.xxhash64(F.lit("sample"), "key"), F.lit(spread))
    chosen = usable.where(place < share).groupBy("key").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    # The chosen labels are bounded by most_rows, so they can be broadcast.
    sample = written(
        texts.join(F.broadcast(chosen), "key").select(
            "text", "toxic", (F.pmod(F.xxhash64(F.lit("part"), "key"), F.lit(FITTING_SHARE)) == 0).alias("fits")
        ),
        "toxicity-sample",
    )
    both = sample.agg(F.sum("toxic"), F.count("toxic")).first()
    prior = both[0] / both[1] if both[1] else 0.5
    final = count_levels(sample.select("text", "toxic"))._replace(prior=prior)
    labelled = sample.where("fits").toArrow()  # a part of the sample, which most_rows bounds
    toxic = labelled.column("toxic").to_numpy()
    if len(np.unique(toxic)) < 2:
        return final._replace(curve=np.array([0.0, 1.0, 0.0, np.log((prior + 1e-9) / (1 - prior + 1e-9))]))
    model = count_levels(sample.where("not fits").select("text", "toxic"))
    found, n = evidences(model, labelled.column("text").combine_chunks()).T
    if len(np.unique(toxic[n > 0])) < 2:
        return final._replace(curve=np.array([0.0, 1.0, 0.0, np.log((prior + 1e-9) / (1 - prior + 1e-9))]))
    curve = fit_curve(found[n > 0], toxic[n > 0])
    # What is usual is another value under the models that score.
    again, _ = evidences(final, labelled.column("text").combine_chunks()).T
    curve[0] = np.median(again[n > 0])
    return final._replace(curve=curve)


def score_texts(df: DataFrame, model: Model, text: str = "text", score: str = "toxicity") -> DataFrame:
    """``df`` with a score from 0 to 1 of every whole text in a new last column.

    A text without words, also null, gets the share of toxic texts in training. Equal texts get equal
    scores, an empty table stays empty, an input column named like the new one is replaced.
    """
    kept = replace_columns(df, score)
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample
    schema = StructType([*kept.schema.fields, StructField(score, DoubleType())])
    names = [*kept.columns, score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            *others, bodies = batch.columns
            found, n = evidences(known, bodies).T
            usual, spread, weight, constant = known.curve
            raw = weight * compressed(found, usual, spread) + constant
            scores = np.where(n > 0, 1 / (1 + np.exp(-np.clip(raw, -500, 500))), known.prior)
            yield pa.RecordBatch.from_arrays([*others, pa.array(scores)], names)

    columns = [F.col(f"`{name}`") for name in kept.columns]
    return df.select(*columns, F.col(f"`{text}`").cast("string").alias("__text")).mapInArrow(run, schema)
