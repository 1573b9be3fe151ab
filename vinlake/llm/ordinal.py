"""Quality by ordinal regression: one score per text, cut by ordered thresholds into grades.

A text's features are its distinct hashed words, the hashed shapes of its words (``Aa``, ``AA!``, ``a0``)
by their share, and the share of repeated lines. All grades share one weight vector; the probability that
the grade exceeds k is logistic in score minus threshold k, and the thresholds rise. The model is trained by
steps with a learning rate per coordinate on a bounded sample of rated documents, ``ROWS`` at most,
dealt into shards of about ``SHARD`` that are trained beside each other and averaged.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinlake.llm.common import remainder, short_batches, stored, unit_hash, words

SPACE = 1 << 18
ROWS = 32_768
SHARD = 8_192
PASSES = 5
RATE, DECAY = 0.3, 1e-6
SELECT = 0.5  # least probability of a grade from ``TAIL`` on
TAIL = 1
SEED = 5
_SHAPES = [(re.compile(r"[^\W\d_a-z]+"), "A"), (re.compile(r"[^\W\d_A]+"), "a"), (re.compile(r"\d+"), "0"), (re.compile(r"(\W)\1+"), r"\1")]


@lru_cache(1 << 17)
def _word(word: str) -> tuple[int, int]:
    """Coordinates of a word and of its shape."""
    shape = word
    for pattern, mark in _SHAPES:
        shape = pattern.sub(mark, shape)
    plain = re.sub(r"\W+", "", word.lower())
    return tuple(xxhash.xxh32_intdigest((m + x).encode(), SEED) % SPACE for m, x in (("w", plain), ("s", shape)))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and values of a text; the last coordinate is the share of repeated lines."""
    found = words(text)
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    pairs = [_word(word) for word in found]
    plain, shapes = {a for a, _ in pairs}, Counter(b for _, b in pairs)
    lines = [line for line in text.split("\n") if line.strip()]
    at = [*plain, *shapes, SPACE]
    values = [len(plain) ** -0.5] * len(plain) + [(n / len(found)) ** 0.5 for n in shapes.values()]
    return np.array(at), np.array([*values, 1 - len(set(lines)) / max(len(lines), 1)])


@dataclass
class Model:
    """Weights by coordinate, and the rising thresholds between the grades."""

    weights: np.ndarray
    cuts: np.ndarray

    def above(self, text: str | None) -> np.ndarray:
        """Probability that the grade exceeds 0, 1, …"""
        at, values = features(text)
        return 1 / (1 + np.exp(-np.clip(self.weights[at] @ values - self.cuts, -35, 35)))


def train(texts: list[str | None], grades: list[int], top: int) -> Model:
    """Fit weights and thresholds to grades 0 to ``top``."""
    weights, squares = np.zeros(SPACE + 1), np.full(SPACE + 1, 1e-2)
    shares = np.array([(np.array(grades) > k).mean() for k in range(top)]).clip(0.01, 0.99)
    cuts, cut_squares = -np.log(shares / (1 - shares)), np.full(top, 1.0)
    known, order = [features(text) for text in texts], np.random.default_rng(SEED)
    for _ in range(PASSES):
        for row in order.permutation(len(texts)):
            (at, values), grade = known[row], grades[row]
            above = 1 / (1 + np.exp(-np.clip(weights[at] @ values - cuts, -35, 35)))
            upper = above[grade - 1] if grade else 1.0
            lower = above[grade] if grade < top else 0.0
            slope = (upper + lower - 1) * values + DECAY * weights[at]
            np.add.at(squares, at, slope * slope)
            np.subtract.at(weights, at, RATE * slope / np.sqrt(squares[at]))
            chance = max(upper - lower, 1e-9)
            for cut, change in ((grade - 1, upper * (1 - upper) / chance), (grade, -lower * (1 - lower) / chance)):
                if 0 <= cut < top:
                    cut_squares[cut] += change * change
                    cuts[cut] -= RATE * change / cut_squares[cut] ** 0.5
            cuts = np.maximum.accumulate(cuts)
    return Model(weights, cuts)


def grade(quality: Column, toxic: Column) -> Column:
    """Ratings as grades: 0 poor, 1 good but toxic, 2 good; NULL without a quality rating."""
    return F.when(quality == 0, 0).when((quality == 1) & (toxic == 1), 1).when(quality == 1, 2)


def fit(docs: DataFrame, ratings: DataFrame, top: int = 2, rows: int = ROWS) -> Model:
    """Learn from ``docs`` (doc_id, text) and ``ratings`` (doc_id, grade), outside the held-out quarter of the ids."""
    known = ratings.filter(F.col("grade").isNotNull() & (remainder(F.col("doc_id"), 4) != 2))
    known = known.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    drawn = stored(known.orderBy(unit_hash(F.lit(SEED), "doc_id"), "doc_id").limit(rows), "drawn")
    shards = max(1, -(-drawn.count() // SHARD))
    drawn = drawn.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
    # The sample is bounded by ``rows``, so it may be broadcast and no text is shuffled but its own. Of rows that
    # repeat an id one text is learned, so that repeats don't undo the bound.
    found = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    texts = found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("grade").alias("grade"), F.max("shard").alias("shard"))

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "text"])
        model = train(part["text"].tolist(), part["grade"].tolist(), top)
        places = np.flatnonzero(model.weights)
        at = np.concatenate((places, SPACE + 1 + np.arange(top)))
        return pd.DataFrame({"at": at, "value": np.concatenate((model.weights[places], model.cuts))})

    learned = texts.groupBy("shard").applyInPandas(learn, "at long, value double")
    # At most SPACE + 1 + top rows, whatever the input. Every shard has the thresholds, so their rows count the shards.
    found = learned.groupBy("at").agg(F.sum("value").alias("value"), F.count("*").alias("n")).toPandas()
    flat = np.zeros(SPACE + 1 + top)
    if len(found):
        flat[found["at"]] = found["value"] / found["n"].max()
    return Model(flat[: SPACE + 1], np.maximum.accumulate(flat[SPACE + 1 :]))


def grades(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, expected_grade, tail_probability, kept`` of every document.

    NULL and empty texts have the score of a text without features. Repeated rows get equal results. Without
    ratings every threshold is 0, so every grade is as likely to be exceeded as not. Other columns are not read.
    """
    short_batches()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("expected_grade double, tail_probability double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            above = np.array([shared.value.above(text) for text in texts]).reshape(len(texts), -1)
            yield pd.DataFrame({"expected_grade": above.sum(axis=1), "tail_probability": above[:, TAIL - 1]})

    rated = docs.select("doc_id", rate(F.col("text")).alias("_rated")).select("doc_id", "_rated.*")
    return rated.withColumn("kept", F.col("tail_probability") >= SELECT)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Grades of all ``docs`` (doc_id, text) by a model of the ``labels`` (doc_id, quality, toxic), with ``held_out``."""
    ratings = labels.select("doc_id", grade(F.col("quality"), F.col("toxic")).alias("grade"))
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return grades(docs, fit(docs, ratings)).withColumn("held_out", held_out)
