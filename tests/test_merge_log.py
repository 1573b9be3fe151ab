"""Logs of upserts: the last setting of a key counts, whatever is merged, repeated or dies meanwhile."""

import os
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vinlake.sources import merge_log
from vinlake.sources.merge_log import Conflict, compact, live, read, retire, upsert

SCHEMA = StructType([StructField("name", StringType()), StructField("n", LongType())])


def put(spark, folder, **values):
    """Set keys to lists of numbers; the key `none` stands for NULL."""
    sets = " UNION ALL ".join(
        f"SELECT nullif('{key}', 'none') AS name, cast(array({', '.join(map(str, numbers))}) AS array<bigint>) AS ns" for key, numbers in values.items()
    )
    given = spark.sql(sets)
    return upsert(given.selectExpr("name", "explode(ns) AS n"), given.select("name"), folder)


def table(spark, folder):
    found = {}
    for name, n in read(spark, folder, SCHEMA, "name").collect():
        found.setdefault(name or "none", []).append(n)
    return {name: sorted(numbers) for name, numbers in found.items()}


def test_the_last_setting_of_a_key_counts(spark, tmp_path):
    folder = str(tmp_path / "table")
    assert table(spark, folder) == {} and read(spark, folder, SCHEMA, "name").schema == SCHEMA
    put(spark, folder, a=[1, 1, 2], b=[3], none=[9])
    put(spark, folder, a=[4], none=[8, 8])
    put(spark, folder, b=[], c=[5])
    assert table(spark, folder) == {"a": [4], "none": [8, 8], "c": [5]}
    put(spark, folder, b=[6])
    put(spark, folder, b=[6])
    assert table(spark, folder) == {"a": [4], "none": [8, 8], "c": [5], "b": [6]}


def test_any_order_of_loads_merges_and_removals_gives_the_table_of_a_dictionary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge_log, "FAN", 3)
    folder, draw, expected = str(tmp_path / "table"), random.Random(1), {}
    for step in range(14):
        values = {key: [step] * draw.randrange(3) for key in draw.sample("abcdefg", 2)}
        expected.update(values)
        put(spark, folder, **values)
        if draw.random() < 0.4:
            list(compact(spark, folder, SCHEMA, "name"))
        if draw.random() < 0.3:
            retire(spark, folder, age=-1)
        if step % 5 == 4:
            assert table(spark, folder) == {key: numbers for key, numbers in expected.items() if numbers}
    list(compact(spark, folder, SCHEMA, "name"))
    assert len(live(spark, folder)) <= 2 * 3  # two of each of the three levels of 14 loads
    assert table(spark, folder) == {key: numbers for key, numbers in expected.items() if numbers}


def test_folders_and_entries_grow_with_the_logarithm_of_the_loads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge_log, "FAN", 2)
    folder = str(tmp_path / "table")
    for n in range(8):
        put(spark, folder, **{f"key{n}": [n]})
        list(compact(spark, folder, SCHEMA, "name"))
        assert len(live(spark, folder)) == (n + 1).bit_count()
    assert len(retire(spark, folder, age=3600)) == 0  # readers may still use what was merged just now
    retire(spark, folder, age=-1)
    assert [part.level for part in live(spark, folder)] == [3]
    assert len([name for name in os.listdir(folder) if name.startswith("run-")]) == 1
    assert len([name for name in os.listdir(f"{folder}/_versions") if name.isdigit()]) == 1
    assert table(spark, folder) == {f"key{n}": [n] for n in range(8)}
    assert put(spark, folder, key3=[99]) > 8 and table(spark, folder)["key3"] == [99]


def test_a_load_or_merge_that_dies_changes_nothing_and_its_folder_goes_later(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge_log, "FAN", 2)
    folder = str(tmp_path / "table")
    put(spark, folder, a=[1])
    put(spark, folder, a=[2], b=[3])

    def die(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(merge_log, "commit", die)
        with pytest.raises(KeyboardInterrupt):
            put(spark, folder, a=[7])
        with pytest.raises(KeyboardInterrupt):
            list(compact(spark, folder, SCHEMA, "name"))
    assert table(spark, folder) == {"a": [2], "b": [3]}
    assert len(retire(spark, folder, age=-1)) == 2
    assert table(spark, folder) == {"a": [2], "b": [3]}


def test_loads_and_merges_at_once_lose_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge_log, "FAN", 4)
    folder = str(tmp_path / "table")
    for n in range(4):
        put(spark, folder, hot=[n], **{f"key{n}": [n]})

    def work(n):
        if n % 3 == 0:
            list(compact(spark, folder, SCHEMA, "name"))
        else:
            put(spark, folder, **{f"key{n}": [n, n]})

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(work, range(12)))
    expected = {f"key{n}": [n] for n in range(4)} | {f"key{n}": [n, n] for n in range(12) if n % 3} | {"hot": [3]}
    assert table(spark, folder) == expected
    covered = [load for part in live(spark, folder) for load in range(part.first, part.last + 1)]
    assert len(covered) == len(set(covered))


def test_a_merge_of_folders_that_were_merged_already_is_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge_log, "FAN", 2)
    folder = str(tmp_path / "table")
    for n in range(2):
        put(spark, folder, a=[n])
    parts = live(spark, folder)
    assert len(list(compact(spark, folder, SCHEMA, "name"))) == 2
    with pytest.raises(Conflict):
        merge_log._commit_merge(spark, folder, parts, "run-other")
    assert table(spark, folder) == {"a": [1]}


def test_a_plan_made_before_a_merge_still_reads_its_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge_log, "FAN", 2)
    folder = str(tmp_path / "table")
    put(spark, folder, a=[1])
    put(spark, folder, a=[2], b=[3])
    before = read(spark, folder, SCHEMA, "name")
    put(spark, folder, b=[4])
    list(compact(spark, folder, SCHEMA, "name"))
    retire(spark, folder)
    assert sorted(map(tuple, before.collect())) == [("a", 2), ("b", 3)]
