"""Whole-table reads from the operational database, in parallel.

Rows go from the database to the executors; none pass through the driver.
"""

from pyspark.sql import DataFrame, SparkSession

# Stream rows in batches; a DATETIME has no zone and stays without one.
OPTIONS = {"fetchsize": "10000", "preferTimestampNTZ": "true"}


def hash_predicates(key: str, parts: int, digest: str = "CRC32") -> list[str]:
    """Conditions that split a table evenly by a hash of its key, whatever the key looks like.

    ``digest`` is the database's own checksum function. NULL keys go to the first part.
    """
    conditions = [f"MOD({digest}({key}), {parts}) = {part}" for part in range(parts)]
    conditions[0] += f" OR {key} IS NULL"
    return conditions


def read_table_by_text_key(
    spark: SparkSession, url: str, table: str, key: str, parts: int = 16, properties: dict[str, str] | None = None
) -> DataFrame:
    """A table with a text key. Each part scans the table, so keep ``parts`` moderate."""
    options = {**OPTIONS, **(properties or {})}
    return spark.read.jdbc(url, table, predicates=hash_predicates(key, parts), properties=options)


def read_table_by_number_key(
    spark: SparkSession, url: str, table: str, key: str, parts: int = 64, properties: dict[str, str] | None = None
) -> DataFrame:
    """A table with an indexed number key, in ranges that hold about as many rows each.

    The database measures the bounds, so dense runs of numbers and gaps between them do not end up in one range.
    """
    options = {**OPTIONS, **(properties or {})}
    bounds = [row.low for row in spark.read.jdbc(url, measured_bounds(table, key, parts), properties=options).orderBy("low").collect()]
    return spark.read.jdbc(url, table, predicates=range_predicates(key, bounds), properties=options)


def measured_bounds(table: str, key: str, parts: int) -> str:
    """A query for the least key of each of so many equally large parts of a table: at most ``parts`` rows."""
    tiles = f"SELECT {key} AS k, NTILE({parts}) OVER (ORDER BY {key}) AS tile FROM {table} WHERE {key} IS NOT NULL"
    return f"(SELECT MIN(k) AS low FROM ({tiles}) AS tiles GROUP BY tile) AS bounds"


def range_predicates(key: str, bounds: list[int]) -> list[str]:
    """Conditions that cut a table at the given keys; the first part has what lies below, and NULL."""
    cuts = sorted(set(bounds))[1:]
    if not cuts:
        return ["1 = 1"]
    between = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(cuts, cuts[1:], strict=False)]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *between, f"{key} >= {cuts[-1]}"]
