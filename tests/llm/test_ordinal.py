import zlib

import numpy as np

from vinlake.llm import ordinal
from vinlake.llm.common import table


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rows = ordinal.quality(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert all(0 <= r.tail_probability <= 1 and r.tail_probability <= r.expected_grade <= 2 for r in rows)
    good, poor = ([r for r in held if r.quality == q] for q in (1, 0))
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in poor) >= 0.6 * len(poor)
    mean = {t: np.mean([r.expected_grade for r in good if r.toxic == t]) for t in (0, 1)}
    assert mean[0] > mean[1] > np.mean([r.expected_grade for r in poor])


def test_slopes_against_differences():
    texts = ["a b C", "a A!! b2", "c c c\nc c c", "", None]
    model = ordinal.train(texts * 20, [2, 0, 1, 2, 2] * 20, 2)
    assert model.cuts[0] <= model.cuts[1]
    order = [model.above(text)[0] for text in texts]
    assert order[1] < min(order[0], order[2])

    def chance(score, grade):
        above = [1.0, *(1 / (1 + np.exp(-(score - cut))) for cut in (-0.5, 0.7)), 0.0]
        return above[grade] - above[grade + 1], above[grade] + above[grade + 1] - 1

    for grade in range(3):
        step = 1e-6
        slope = (np.log(chance(0.3 + step, grade)[0]) - np.log(chance(0.3, grade)[0])) / step
        assert np.isclose(-slope, chance(0.3, grade)[1], atol=1e-4)


def test_null_empty_long_repeated_and_clashing(spark):
    rows = [(1, None, True), (2, "", True), (3, "word other " * 100_000, None), (3, "word other " * 100_000, None), (None, "a b", False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept boolean")
    labels = spark.createDataFrame([(2, 1, 0), (3, 0, None), (3, 1, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    out = ordinal.quality(docs, labels).collect()
    assert len(out) == 5 and len({r.expected_grade for r in out if r.doc_id == 3}) == 1
    assert {r.tail_probability for r in ordinal.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert ordinal.quality(docs.limit(0), labels).count() == 0
