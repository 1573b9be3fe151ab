import re
from collections import defaultdict

import pytest

from vinlake.llm import mixing
from vinlake.llm.common import table


def plain_targets(sizes):
    """By raising the water level a source at a time, from the first to be full to the last."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    rest, open_weight, out = sum(sizes.values()), sum(weight.values()), {}
    for s in sorted(names, key=lambda s: 3 * sizes[s] / weight[s]):
        out[s] = min(3 * sizes[s], rest * weight[s] / open_weight)
        rest, open_weight = rest - out[s], open_weight - weight[s]
    return out


def test_whole_table_against_water_filling_by_hand(spark, folder):
    docs = table(spark, folder, "documents")
    texts = {r.doc_id: (r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in docs.collect()}
    sizes = defaultdict(int)
    for source, size in texts.values():
        sizes[source] += size
    expected, out = plain_targets(sizes), mixing.mix(docs).collect()
    assert {r.doc_id: (r.source, r.size) for r in out} == texts
    taken = defaultdict(int)
    for r in out:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
        assert r.taken == r.times * r.size <= 3 * r.size
        taken[r.source] += r.taken
    for source in sizes:
        largest = max(size for s, size in texts.values() if s == source)
        assert abs(taken[source] - expected[source]) <= largest
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in out)


def test_small_sources_are_clamped_and_the_excess_is_shared(spark):
    rows = [(1, "a " * 10, "a", 0), (2, "b " * 10, "b", 0), (3, "c " * 1000, "c", 0), (4, "n " * 500, None, 0), (5, None, "c", 0)]
    rows += [(6, "", "d", 0), (3, "c " * 1000, "c", 0), (None, "x y 　", "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, target int")
    sizes = {"a": 10, "b": 12, "c": 2000, "d": 0, None: 500}
    expected = plain_targets(sizes)
    for r in mixing.mix(docs).collect():
        assert (r.source_size, r.target) == (sizes[r.source], pytest.approx(expected[r.source]))
        assert r.doc_id not in (5, 6) or r.taken == 0
    assert expected["a"] == 30 and expected["d"] == 0


def test_empty_table_and_tables_without_words(spark):
    docs = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert mixing.mix(docs.limit(0)).count() == 0
    assert {(r.doc_id, r.target, r.taken) for r in mixing.mix(docs).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}


def test_fractional_part_is_met_for_many_documents(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 7 as int)) as text", "if(id % 3 = 0, 'a', 'b') as source")
    sums = mixing.mix(docs).groupBy("source", "target").agg({"taken": "sum"}).collect()
    for source, target, taken in sums:
        assert abs(taken - target) <= 7 + 0.001 * target, source


def test_small_documents_settle_what_large_ones_leave(spark):
    """Sources of ten documents of 1,000 words and 990 small ones, enough to settle with, end within a word of their targets."""
    size = "if(id % 400 < 4, 1000, cast(1 + id % 9 as int))"
    docs = spark.range(4_000).selectExpr("id as doc_id", f"repeat('w ', {size}) as text", "concat('s', id % 4) as source")
    sums = mixing.mix(docs).groupBy("source", "target").agg({"taken": "sum"}).collect()
    assert len(sums) == 4
    for source, target, taken in sums:
        assert abs(taken - target) <= 1, source
    times = mixing.mix(docs).groupBy("doc_id").agg({"times": "max"}).collect()
    rows = mixing.repeated(docs).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in rows} == {doc_id: n for doc_id, n in times if n}
