"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hashed single words, neighbouring pairs and pairs with one word
between. Training keeps for every coordinate its own sum of gradients and of squared gradients, so
that each has its own learning rate, and an L1 term that holds coordinates at exactly zero until the evidence
exceeds it. So the weights that come out are few: they are a short list to broadcast.

Labels are learned from a bounded sample, ``ROWS`` rows at most, drawn by a seeded hash; it is dealt
into shards of about ``SHARD`` rows that are trained beside each other, and the weights are their mean.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinlake.llm.common import remainder, short_batches, stored, unit_hash

SPACE = 1 << 20  # hashed coordinates; the one after them is the constant
ROWS = 32_768
SHARD = 8_192
STEPS, EPOCHS = 32_000, (4, 16)  # passes over a shard: as many as make so many steps, within these limits
# L1 is per pass: a document moves a coordinate by one a pass at most, so a feature of one document stays at zero.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1.25, 0.1
THRESHOLD = 0.3
SEED = 9
_WORD = re.compile(r"\w+")
_REMEMBERED = 1 << 17


class _Hashes(dict):
    """32-bit numbers of words; forgets all when it has grown too large."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        number = xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass"), SEED)
        if len(word) <= 64:
            self[word] = number
        return number


_hashes = _Hashes()


def coordinates(text: str | None) -> np.ndarray:
    """The hashed features of a text, repeats included."""
    found = _WORD.findall(text.lower()) if text else []
    one = np.fromiter(map(_hashes.__getitem__, found), dtype=np.uint64, count=len(found))
    two = one[:-1] * np.uint64(0x9E3779B1) + one[1:] * np.uint64(0x85EBCA77)
    over = one[:-2] * np.uint64(0xC2B2AE3D) + one[2:] * np.uint64(0x27D4EB2F)
    mixed = [part ^ (part >> np.uint64(17)) for part in (one, two, over)]
    return (np.concatenate(mixed) & np.uint64(SPACE - 1)).astype(np.int64)


def train(texts: list[str | None], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the weights that are not zero; the last place is the constant's."""
    z, n = np.zeros(SPACE + 1), np.zeros(SPACE + 1)
    passes = min(max(STEPS // max(len(texts), 1), EPOCHS[0]), EPOCHS[1])

    def weights(at: np.ndarray | slice) -> np.ndarray:
        over = np.abs(z[at]) - L1 * passes
        return np.where(over > 0, -np.sign(z[at]) * over / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

    features = [np.append(np.unique(coordinates(text)), SPACE).astype(np.int32) for text in texts]
    for _ in range(passes):
        for at, label in zip(features, labels, strict=True):
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = weights(slice(None))
    places = np.union1d(np.flatnonzero(w), [SPACE])
    return places, w[places]


def sample(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """``doc_id, text, toxic, shard`` of at most ``rows`` labelled documents outside the held-out quarter."""
    known = labels.filter(F.col("toxic").isNotNull() & (remainder(F.col("doc_id"), 4) != 2))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chance = unit_hash(F.lit(SEED), F.col("doc_id"))
    drawn = stored(known.orderBy(chance, "doc_id").limit(rows), "drawn")
    shards = max(1, -(-drawn.count() // SHARD))
    drawn = drawn.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
    # The sample is bounded by ``rows``, so it may be broadcast and no text is shuffled but its own. Of rows that
    # repeat an id one text is learned, so that repeats don't undo the bound.
    found = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"), F.max("shard").alias("shard"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> tuple[np.ndarray, np.ndarray]:
    """The mean of the shards' weights, as places and values; none without labelled rows."""

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "text"])
        places, values = train(part["text"].tolist(), part["toxic"].tolist())
        return pd.DataFrame({"place": places, "value": values})

    shards = sample(docs, labels, rows).groupBy("shard").applyInPandas(learn, "place long, value double")
    # At most SPACE + 1 rows, whatever the input. Every shard learns a constant, so its rows count the shards.
    found = shards.groupBy("place").agg(F.sum("value").alias("value"), F.count("*").alias("n")).toPandas().sort_values("place")
    return found["place"].to_numpy(np.int64), found["value"].to_numpy(np.float64) / found["n"].max()


def scorer(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]):
    """A function of a text column that gives the probability of label 1."""
    short_batches()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        places, values = shared.value
        weights = np.zeros(SPACE + 1)
        weights[places] = values
        live = weights != 0
        for texts in batches:
            sums = np.full(len(texts), weights[SPACE])
            for row, text in enumerate(texts):
                at = coordinates(text)
                sums[row] += weights[np.unique(at[live[at]])].sum()
            yield pd.Series(1 / (1 + np.exp(-np.clip(sums, -35, 35))))

    return score


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic; other columns are not read. NULL and empty
    texts get the score of a text without features. Without labelled rows every score is one half. A
    document with several labels counts as toxic if one says so. A NULL id is not held out.
    """
    score = scorer(docs, fit(docs, labels, rows))
    scored = docs.select("doc_id", score(F.col("text")).alias("score"))
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted(F.col("score")).alias("predicted"))


def predicted(score: Column) -> Column:
    """1 if the score reaches the threshold."""
    return (score >= THRESHOLD).cast("int")
