import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from vinlake.llm import toxicity
from vinlake.llm.common import table


def test_held_out_accuracy_and_scores_against_the_plain_sum(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    places, values = model = toxicity.fit(docs, labels)
    weights = dict(zip(places.tolist(), values.tolist(), strict=True))
    assert toxicity.SPACE in weights and len(weights) < 5_000
    score = toxicity.scorer(docs, model)
    rows = docs.join(labels, "doc_id").select("doc_id", "text", "toxic", score("text").alias("score")).collect()
    for row in rows[:200]:
        at = {toxicity.SPACE, *toxicity.coordinates(row.text).tolist()}
        assert math.isclose(row.score, 1 / (1 + math.exp(-sum(weights.get(x, 0.0) for x in at))), rel_tol=1e-9)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    hit = sum(r.score >= 0.3 and r.toxic == 1 for r in held)
    assert hit >= 0.75 * sum(r.toxic == 1 for r in held)
    assert hit >= 0.95 * sum(r.score >= 0.3 for r in held)


def test_training_leaves_out_held_out_rows(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    for one, other in zip(toxicity.fit(docs, labels), toxicity.fit(docs, turned), strict=True):
        assert np.array_equal(one, other)


def test_sample_is_bounded(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    assert 0 < toxicity.sample(docs, labels, 10).count() <= 10
    assert toxicity.sample(docs.unionAll(docs).unionAll(docs), labels, 10).count() <= 10


def test_null_empty_long_repeated_and_clashing(spark):
    long = "word other " * 100_000
    rows = [(1, None, 0.5), (2, "", 0.5), (3, long, 0.1), (3, long, 0.1), (None, "you idiot", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(2, 0, "x"), (3, None, "x"), (None, 1, "x"), (2, 0, "y")], "doc_id long, toxic int, text string")
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 and r.held_out is not None for r in out)
    assert len({r.score for r in out if r.doc_id in (1, 2)}) == 1
    assert len({r.score for r in out if r.doc_id == 3}) == 1
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
