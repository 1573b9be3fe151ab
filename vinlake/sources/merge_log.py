"""Tables kept as a log of upserts: a load adds one small folder, the last setting of a key counts, and merges keep the log short.

A load writes its rows, and the keys that it sets, to a folder of its own and publishes it under the next number of the table's log
(``sources/versions.py``). A key set again hides its earlier rows, also where it has none any more. Nothing is rewritten, so a
load that is repeated or dies changes nothing for readers, and its cost does not grow with the table.

``compact`` puts ``FAN`` neighbouring folders of one level together into one of the next level. So a row is rewritten once
per level, and a table of n loads has at most ``FAN`` folders for each of its log(n) levels. A merge stands for the numbers
from its first to its last load, so loads that end meanwhile come after it, and a second merge of the same folders is refused.
"""

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import reduce
from itertools import chain, groupby
from operator import and_
from time import time
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vinlake.session import remove_folder
from vinlake.sources.versions import IN_THE_MAKING, Conflict, commit, entries, forget, latest, runs_in

FAN = 8  # folders of one level that are put together
RUN = StructField("_run", StringType())  # the folder a row was written to


@dataclass(frozen=True)
class Part:
    """A folder of the table and the loads it stands for."""

    run: str
    first: int
    last: int
    level: int = 0
    number: int = 0

    def covers(self, other: "Part") -> bool:
        """Whether readers take this instead of the other."""
        return self.level > other.level and self.first <= other.first and other.last <= self.last


def _parts(spark: SparkSession, folder: str) -> list[Part]:
    found = []
    for number, text in entries(spark, folder).items():
        known = json.loads(text)
        found.append(Part(**{"first": number, "last": number, **known, "number": number}))
    return found


def live(spark: SparkSession, folder: str) -> list[Part]:
    """The folders that make up the table now, oldest loads first."""
    parts = _parts(spark, folder)
    kept = [part for part in parts if not any(other.covers(part) for other in parts)]
    return sorted(kept, key=lambda part: part.last)


def _paths(folder: str, parts: list[Part], kind: str) -> list[str]:
    return [f"{folder}/{part.run}/{kind}" for part in parts]


def _write(rows: DataFrame, keys: DataFrame, folder: str) -> str:
    """Write a folder of rows and keys and return its name; it is removed again if that fails."""
    run, spark = f"run-{uuid4().hex}", rows.sparkSession
    try:
        rows.withColumn(RUN.name, F.lit(run)).write.parquet(f"{folder}/{run}/rows")
        keys.withColumn(RUN.name, F.lit(run)).write.parquet(f"{folder}/{run}/keys")
    except BaseException:
        remove_folder(spark, f"{folder}/{run}")
        raise
    return run


def upsert(rows: DataFrame, keys: DataFrame, folder: str) -> int:
    """Let these rows be all rows of these keys, and return the number of the load.

    ``keys`` has the key columns only and every key of ``rows``; a key without rows loses those it had. Keys may repeat.
    """
    return commit(rows.sparkSession, folder, json.dumps({"run": _write(rows, keys.distinct(), folder)}))


def _settings(spark: SparkSession, folder: str, parts: list[Part], schema: StructType, key: tuple[str, ...]) -> DataFrame:
    """Which folders set which keys."""
    return spark.read.schema(StructType([*(schema[name] for name in key), RUN])).parquet(*_paths(folder, parts, "keys"))


def _current(spark: SparkSession, folder: str, parts: list[Part], schema: StructType, key: tuple[str, ...]) -> DataFrame:
    """The rows of some folders without those whose key was set again in a later one.

    Only keys that were set more than once meet the rows: few, as a rule, so that adaptive execution can broadcast them.
    """
    rows = spark.read.schema(StructType([*schema.fields, RUN])).parquet(*_paths(folder, parts, "rows"))
    if len(parts) < 2:
        return rows.select(*schema.names)
    last = F.create_map(*chain.from_iterable((F.lit(part.run), F.lit(part.last)) for part in parts))[F.col(RUN.name)]
    settings = _settings(spark, folder, parts, schema, key).groupBy(*key)
    again = settings.agg(F.count(F.lit(1)).alias("_settings"), F.max_by(RUN.name, last).alias("_last_run"))
    again = again.where("_settings > 1").drop("_settings")
    hidden = [rows[name].eqNullSafe(again[name]) for name in key]
    return rows.join(again, reduce(and_, hidden, rows[RUN.name] != again["_last_run"]), "left_anti").select(*schema.names)


def read(spark: SparkSession, folder: str, schema: StructType, *key: str) -> DataFrame:
    """The table as it is now: for each key the rows of its last setting. A table without loads is empty."""
    parts = live(spark, folder)
    return _current(spark, folder, parts, schema, key) if parts else spark.createDataFrame([], schema)


def _full_level(parts: list[Part]) -> list[Part]:
    """The oldest ``FAN`` neighbours of one level; none if no level has so many."""
    for _, alike in groupby(parts, key=lambda part: part.level):
        neighbours = list(alike)
        if len(neighbours) >= FAN:
            return neighbours[:FAN]
    return []


def _commit_merge(spark: SparkSession, folder: str, merged: list[Part], run: str) -> None:
    """Publish a merge if all its folders are still live; whatever else was published meanwhile does not matter."""
    known = {"run": run, "first": merged[0].first, "last": merged[-1].last, "level": merged[0].level + 1}
    while True:
        number, _ = latest(spark, folder)
        if not set(merged) <= set(live(spark, folder)):
            raise Conflict("another merge came first")
        try:
            commit(spark, folder, json.dumps(known), based_on=number)
            return
        except Conflict:
            continue


def compact(spark: SparkSession, folder: str, schema: StructType, *key: str) -> Iterator[Part]:
    """Merge full levels until there is none, and yield the folders that were put together.

    The scan packs small files into tasks by size, so a merge writes files of a scan's usual size.
    """
    while merged := _full_level(live(spark, folder)):
        rows = _current(spark, folder, merged, schema, key)
        run = _write(rows, _settings(spark, folder, merged, schema, key).select(*key).distinct(), folder)
        try:
            _commit_merge(spark, folder, merged, run)
        except Conflict:
            remove_folder(spark, f"{folder}/{run}")
            continue
        yield from merged


def retire(spark: SparkSession, folder: str, age: float = IN_THE_MAKING) -> list[str]:
    """Remove folders that were merged, or never published, at least ``age`` seconds ago, and return their names.

    Plans made until then still find their files. Entries leave the log before their folders go.
    """
    parts, changed = _parts(spark, folder), runs_in(spark, folder)
    old = {name for name, at in changed.items() if at <= time() - age}
    for part in parts:
        if any(other.covers(part) and other.run in old for other in parts):
            forget(spark, folder, part.number)
    named = {part.run for part in _parts(spark, folder)}
    merged = {part.run for part in parts} - named
    gone = sorted(name for name in changed if name in merged or name in old - named)
    for name in gone:
        remove_folder(spark, f"{folder}/{name}")
    return gone
