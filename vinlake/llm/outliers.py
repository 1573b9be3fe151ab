"""Quality rules and robust multivariate outliers of text statistics.

Texts that break a fixed rule fail. Of the others, the vector of transformed statistics is held against
those of its language and source. Location and scatter are minimum-covariance-determinant estimates: the
mean and covariance of the ``SHARE`` of rows that lie closest, found by concentration steps (distances,
the closest rows, their mean and covariance, again). Each step is two aggregates over all rows of all
groups; sums and quantile sketches are made before the shuffle, so a hot source costs no more.
Texts of a small source are held against all texts of their language, those of a small language against all:
these estimates are made from the large sources too, whose own texts do not meet them.

A text is rejected when its squared Mahalanobis distance exceeds what one in ``1 / (1 - SURE)`` rows of a
normal distribution has, on the scale that makes the group's median distance right, but never a smaller one.
"""

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vinlake.llm.common import short_batches, stored, words

SYMBOLS = "#*$%&|<>"  # fixed value
FEWEST = 50  # words of a text that does not fail
STEPS = 4
SHARE = 0.75
SURE = 0.999_999
GROUP = 200  # fewest rows of a group; smaller ones take the estimates of their language, or of all
# The statistics, with the smallest standard deviation that counts: most texts have no symbol and no repeat
# at all, and the first few must not be infinitely far from that.
FLOORS = {"word_length": 0.05, "symbols": 0.05, "dup_lines": 0.15, "repeats": 0.15, "capitals": 0.06, "others": 0.05}
STATISTICS = list(FLOORS)
_CAPITALS = re.compile(r"[^\W\d_a-z]")

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = [*BASE, "n_lines", "n_capitals", "n_others"]


def count(text: str | None) -> tuple[int, ...]:
    """The base counts of a text, then lines with a word, capitals and characters that are no word characters."""
    found = words(text)
    if not found:
        return (0, 0, sum(map((text or "").count, SYMBOLS)), 0, 0, 0, 0, 0)
    lines = [line for line in text.split("\n") if words(line)]
    windows = list(zip(found, found[1:], found[2:], strict=False))
    times, repeated = Counter(windows), 0
    if len(times) < len(windows):
        covered = bytearray(len(found))
        for place, window in enumerate(windows):
            if times[window] > 1:
                covered[place : place + 3] = b"\1\1\1"
        repeated = sum(covered)
    joined = "".join(found)
    capitals = sum(map(str.isupper, joined))
    others = len(joined) - len(re.findall(r"\w", joined)) if not joined.isalnum() else 0
    symbols = sum(map(text.count, SYMBOLS))
    return len(found), len(joined), symbols, len(lines) - len(set(lines)), repeated, len(lines), capitals, others


@F.pandas_udf(StructType([StructField(name, LongType()) for name in COUNTS]))
def counts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """The counts of ``count`` as a struct."""
    for texts in batches:
        yield pd.DataFrame([count(text) for text in texts], columns=COUNTS, dtype="int64")


def statistics() -> list[Column]:
    """Transformed statistics: ratios by their roots, which evens out small counts, and the log of the word length."""
    def root(part: str, whole: str) -> Column:
        return F.sqrt(F.col(part) / F.greatest(F.col(whole), F.lit(1)))

    length = F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1)))
    parts = [length, root("n_symbols", "word_chars"), root("n_dup_lines", "n_lines"), root("n_repeat_words", "n_words")]
    parts += [root("n_capitals", "word_chars"), root("n_others", "word_chars")]
    return [part.alias(f"x_{name}") for part, name in zip(parts, STATISTICS, strict=True)]


def chi_square(sure: float, degrees: int = len(STATISTICS)) -> float:
    """Quantile of the chi-square distribution, by the cube-root approximation."""
    spread = 2 / (9 * degrees)
    return degrees * (1 - spread + NormalDist().inv_cdf(sure) * spread**0.5) ** 3


def _key(level: Column) -> Column:
    """The group of a row at a level: 2 its language and source, 1 its language, 0 all."""
    key = F.struct(
        level.alias("level"),
        F.when(level >= 1, F.col("lang")).alias("lang"),
        F.when(level >= 2, F.col("source")).alias("source"),
    )
    return F.to_json(key)


def _grouped(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with ``group``, whose estimates a row is held against, and the passing rows of every group.

    A row that passes is in its own group and in each wider one that some row is held against.
    """
    fit = rows.filter(~F.col("base_failed"))
    sizes = fit.groupBy("lang", "source").agg(F.count("*").alias("n"))
    by_lang = sizes.groupBy(F.col("lang").alias("_lang")).agg(F.sum("n").alias("n_lang"))
    levels = sizes.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang"))).select(
        F.col("lang").alias("_lang"),
        F.col("source").alias("_source"),
        F.when(F.col("n") >= GROUP, 2).when(F.col("n_lang") >= GROUP, 1).otherwise(0).alias("level"),
    )
    levels = stored(levels, "levels")
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    with_level = rows.join(levels, same, "left").withColumn("level", F.coalesce("level", F.lit(0)))
    with_level = stored(with_level.withColumn("group", _key(F.col("level"))).drop("_lang", "_source"), "grouped")
    passing = with_level.filter(~F.col("base_failed"))
    wide = levels.filter("level = 1").select("_lang").distinct()
    wider = passing.join(wide, F.col("lang").eqNullSafe(F.col("_lang")), "left_semi")
    members = [passing.filter("level = 2"), wider.withColumn("group", _key(F.lit(1)))]
    if not with_level.filter("level = 0").isEmpty():
        members.append(passing.withColumn("group", _key(F.lit(0))))
    return with_level.drop("level"), reduce(DataFrame.unionAll, [one.drop("level") for one in members])


def _distance() -> Column:
    """Squared Mahalanobis distance by the group's ``mean`` and ``inverse`` (row by row)."""
    size = len(STATISTICS)
    off = [F.col(f"x_{name}") - F.col("mean")[place] for place, name in enumerate(STATISTICS)]
    terms = [
        off[a] * off[b] * F.col("inverse")[a * size + b] * (1.0 if a == b else 2.0) for a in range(size) for b in range(a, size)
    ]
    return sum(terms[1:], terms[0])


def _invert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From the moments of each group its mean and the inverse of its covariance."""
    size = len(STATISTICS)
    for batch in batches:
        out = []
        for row in batch.itertuples():
            mean = np.array([getattr(row, f"s_{a}") for a in range(size)]) / row.n
            scatter = np.zeros((size, size))
            for a in range(size):
                for b in range(a, size):
                    scatter[a, b] = scatter[b, a] = getattr(row, f"s_{a}_{b}") / row.n - mean[a] * mean[b]
            scatter += np.diag([floor**2 for floor in FLOORS.values()])
            out.append((row.group, mean.tolist(), np.linalg.inv(scatter).ravel().tolist()))
        yield pd.DataFrame(out, columns=["group", "mean", "inverse"])


def _moments(rows: DataFrame) -> DataFrame:
    size, x = len(STATISTICS), [F.col(f"x_{name}") for name in STATISTICS]
    sums = [F.sum(x[a]).alias(f"s_{a}") for a in range(size)]
    sums += [F.sum(x[a] * x[b]).alias(f"s_{a}_{b}") for a in range(size) for b in range(a, size)]
    found = rows.groupBy("group").agg(F.count("*").alias("n"), *sums)
    return found.mapInPandas(_invert, "group string, mean array<double>, inverse array<double>")


def estimates(rows: DataFrame) -> DataFrame:
    """``group, mean, inverse, scale`` from rows with ``group`` and the statistics: one row per group."""
    names = [f"x_{name}" for name in STATISTICS]
    middle = rows.groupBy("group").agg(*[F.percentile_approx(x, 0.5, 1000).alias(x) for x in names])
    middle = middle.select("group", F.array(*names).alias("mean"))
    spread = _with_group(rows, stored(middle, "middle"))
    off = [F.percentile_approx(F.abs(F.col(x) - F.col("mean")[a]), 0.5, 1000).alias(x) for a, x in enumerate(names)]
    spread = spread.groupBy("group").agg(F.first("mean").alias("mean"), *off)
    zero, size = F.lit(0.0), len(names)
    wide = [1 / (F.pow(F.col(f"x_{x}") * 1.4826, F.lit(2.0)) + floor**2) for x, floor in FLOORS.items()]
    cells = [wide[a] if a == b else zero for a in range(size) for b in range(size)]
    now = stored(spread.select("group", "mean", F.array(*cells).alias("inverse")), "start")
    for _ in range(STEPS):
        far = _with_group(rows, now).withColumn("far", _distance())
        limit = far.groupBy("group").agg(F.percentile_approx("far", SHARE, 1000).alias("limit"))
        near = _with_group(far.drop("mean", "inverse"), stored(limit, "limit")).filter(F.col("far") <= F.col("limit"))
        now = stored(_moments(near), "estimates")
    far = _with_group(rows, now).withColumn("far", _distance())
    scale = far.groupBy("group").agg(F.greatest(F.percentile_approx("far", 0.5, 1000) / chi_square(0.5), F.lit(1.0)).alias("scale"))
    return stored(_with_group(now, scale), "scaled")


def _with_group(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Join one stored row per group to the rows; Spark broadcasts it if small, else splits hot groups."""
    return rows.join(facts.withColumnRenamed("group", "_group"), F.col("group") == F.col("_group"), "inner").drop("_group")


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``distance`` and ``kept`` of every document.

    ``docs`` has doc_id, text, lang and source; other columns are not read. A NULL text has no words, so
    it fails the rule. NULL languages and sources form groups. Groups with few rows are held against their
    language, or against all rows. Repeated rows get equal results. ``distance`` is NULL where no row passed
    the rules, and nothing is rejected by it then.
    """
    short_batches()
    counted = docs.select("doc_id", "lang", "source", counts(F.col("text")).alias("_found"))
    failed = (F.col("n_words") < FEWEST) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    flat = counted.select("doc_id", "lang", "source", "_found.*").withColumn("base_failed", failed)
    rows = stored(flat.select("*", *statistics()), "statistics")
    rows, members = _grouped(rows)
    found = estimates(members)
    other = found.withColumnRenamed("group", "_group")
    far = rows.join(other, F.col("group") == F.col("_group"), "left").withColumn("distance", _distance() / F.col("scale"))
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("distance") > chi_square(SURE), F.lit(False))
    return far.select("doc_id", *BASE, "base_failed", "distance", kept.alias("kept"))
