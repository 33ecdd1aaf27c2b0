"""Quality scores learned from preference pairs (Bradley-Terry).

A document's strength is a linear function of text features. Every pair of a
document labelled 1 and one labelled 0 says that the first is preferred; the
weights minimise the logistic loss of the feature differences. The strength is
then placed against a quantile of the training strengths: the cut that parts
the labels best, whose score is 0.3, so ``score >= 0.3`` keeps what lies above.

Only the text is an input of a score. Labels, language, source and ids are not.
At most ``MOST_LABELLED`` labelled documents are learned from, those with the
smallest id hashes, so the choice is the same on every run. Every document is
scored, over its whole text. Empty and null texts get the score of the empty
text, repeated rows the same score, and without both labels every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from mercadal.llm.tables import text_or_empty, utf8_values

MOST_LABELLED = 20_000
PAIRS = 40_000
KEEP_SCORE = 0.3

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
OTHER = len(PUNCTUATION)  # then: digit, lower, upper, beyond ASCII, space, line end, control
CLASSES = OTHER + 7


def _class_table() -> np.ndarray:
    table = np.full(256, OTHER + 6, dtype=np.uint8)
    table[np.frombuffer(PUNCTUATION, dtype=np.uint8)] = np.arange(OTHER)
    table[ord("0") : ord("9") + 1] = OTHER
    table[ord("a") : ord("z") + 1] = OTHER + 1
    table[ord("A") : ord("Z") + 1] = OTHER + 2
    table[128:] = OTHER + 3
    table[ord(" ")] = OTHER + 4
    table[ord("\n")] = OTHER + 5
    return table


CLASS_OF = _class_table()
FEATURES = 2 * CLASSES + 10


def features_of(text: bytes) -> np.ndarray:
    """Shares of character classes (plain and as square roots, so that rare
    signs count) and the shape of words and lines."""
    out = np.zeros(FEATURES)
    if not text:
        return out
    shares = np.bincount(CLASS_OF[np.frombuffer(text, dtype=np.uint8)], minlength=CLASSES) / len(text)
    words, lines = text.split(), [x for x in text.split(b"\n") if x]
    n = max(len(words), 1)
    distinct = set(words)
    letters = max(shares[OTHER + 1] + shares[OTHER + 2], 1e-9)
    out[:CLASSES] = shares
    out[CLASSES : 2 * CLASSES] = np.sqrt(shares)
    out[2 * CLASSES :] = (
        np.log1p(len(words)),
        len(distinct) / n,
        np.log1p(len(distinct)) / np.log1p(n),
        sum(map(bytes.__eq__, words, words[1:])) / n,
        np.log1p(len(text) / n),
        len(set(lines)) / max(len(lines), 1),
        np.log1p(len(lines)),
        np.log1p(len(text) / max(len(lines), 1)),
        shares[OTHER + 2] / letters,
        np.log1p(max(map(len, words), default=0)),
    )
    return out


def feature_rows(texts: list[bytes]) -> np.ndarray:
    return np.array([features_of(t) for t in texts]).reshape(len(texts), FEATURES)


@dataclass(frozen=True)
class Strength:
    """Linear strengths and the cut that the score is measured from."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float | None

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -8, 8) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Chance to be preferred to a document at the cut, moved so that the
        cut itself has KEEP_SCORE."""
        if self.cut is None:
            return np.full(len(rows), 0.5)
        level = np.log(KEEP_SCORE / (1 - KEEP_SCORE))
        return 1 / (1 + np.exp(-np.clip(self.raw(rows) - self.cut + level, -40, 40)))


def fit_pairs(rows: np.ndarray, labels: np.ndarray, pairs: int = PAIRS, steps: int = 250) -> Strength:
    """Weights from preference pairs by accelerated descent on the mean of
    log(1 + exp(-(strength difference))) with a small ridge."""
    mean = rows.mean(axis=0) if len(rows) else np.zeros(FEATURES)
    scale = rows.std(axis=0) if len(rows) else np.ones(FEATURES)
    scale = np.where(scale > 1e-9, scale, 1.0)
    better, worse = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(better) or not len(worse):
        return Strength(mean, scale, np.zeros(FEATURES), None)
    z = np.clip((rows - mean) / scale, -8, 8)
    count = max(pairs, len(better), len(worse))
    dice = np.random.default_rng(42)
    up = np.resize(dice.permutation(better), count)
    down = dice.permutation(np.resize(dice.permutation(worse), count))
    gaps = (z[up] - z[down]).astype(np.float32)
    ridge = np.float32(1e-4)
    rate = np.float32(1 / (0.25 * np.linalg.norm(gaps.T @ gaps / count, 2) + ridge))
    w = previous = np.zeros(FEATURES, dtype=np.float32)
    for step in range(1, steps + 1):
        ahead = w + np.float32((step - 1) / (step + 2)) * (w - previous)
        slope = gaps.T @ (-1 / (1 + np.exp(gaps @ ahead))) / count + ridge * ahead
        previous, w = w, (ahead - rate * slope).astype(np.float32)
    weights = w.astype(np.float64)
    return Strength(mean, scale, weights, best_cut(z @ weights, labels))


def best_cut(strengths: np.ndarray, labels: np.ndarray) -> float:
    """The quantile of the strengths at which the labels part with the fewest
    errors; half way between its neighbours, in the middle of equal choices."""
    order = np.argsort(strengths, kind="stable")
    ranked, ones = strengths[order], (labels[order] == 1).astype(np.int64)
    # errors when the k lowest are rejected: ones among them, zeros above
    errors = np.r_[0, np.cumsum(ones)] + (1 - ones).sum() - np.r_[0, np.cumsum(1 - ones)]
    errors = errors.astype(float)
    errors[1:-1][ranked[1:] == ranked[:-1]] = np.inf
    best = np.flatnonzero(errors == errors.min())
    k = int(best[len(best) // 2])
    low = ranked[k - 1] if k else ranked[0] - 1.0
    high = ranked[k] if k < len(ranked) else ranked[-1] + 1.0
    return float((low + high) / 2)


def learning_labels(labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """(doc_id, label) of the learning side: ids whose CRC-32 is not divisible
    by five. Repeated labels of an id are averaged; a draw counts as 1."""
    usable = labels.where(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    one = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.when(F.avg("quality") >= 0.5, 1).otherwise(0).alias("label")
    )
    return lowest_hashes(one, most)


def lowest_hashes(ids: DataFrame, most: int) -> DataFrame:
    """The ``most`` rows of ``ids`` (unique in ``doc_id``) with the smallest
    hashes. A threshold worked out from their number keeps all but about 1.2
    times as many rows from the ordered scan, which else sends ``most`` rows per
    task to the driver; it is doubled should too few stay below."""
    place = F.xxhash64("doc_id")
    n, share = ids.count(), 1.2
    few = ids
    while n and most * share < n:
        few = ids.where(place < F.lit(int(-(2**63) + most * share / n * 2**64)))
        if few.count() >= most:
            break
        share, few = share * 2, ids
    return few.orderBy(place, "doc_id").limit(most)


def held_out(doc_id: Column) -> Column:
    """Ids kept away from learning; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Strength:
    """Strengths learned from at most ``most`` labelled documents. Only their
    feature rows (``most`` times FEATURES numbers) reach the driver."""

    def run(batches):
        for batch in batches:
            rows = feature_rows(utf8_values(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(rows), type=pa.list_(pa.float64()))],
                names=["doc_id", "label", "row"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # at most ``most`` pairs of numbers
    chosen = texts.join(F.broadcast(learning_labels(labels, most)), "doc_id").select("doc_id", "label", "text")
    rows = chosen.mapInArrow(run, "doc_id long, label int, row array<double>")
    # a repeated document counts once, so that no more than ``most`` rows remain
    one = rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("row").alias("row"))
    got = one.orderBy("doc_id").toArrow()
    values = got["row"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return fit_pairs(values.reshape(got.num_rows, FEATURES), got["label"].to_numpy())


def score_column(model: Strength, text: Column) -> Column:
    """The score of a text under ``model``."""

    @F.arrow_udf(DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(feature_rows(utf8_values(texts))))

    return score(text)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = learn(docs, labels)
    doc_id = F.col("doc_id").cast("long")
    scored = docs.select(
        doc_id.alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        score_column(model, text_or_empty()).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= KEEP_SCORE).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches the cut, with all their columns."""
    model = learn(docs, labels)
    return docs.where(score_column(model, text_or_empty()) >= KEEP_SCORE)
