from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def free_name(wanted: str, *tables: DataFrame) -> str:
    """The wanted column name, made longer until none of the tables has it."""
    taken = {name.lower() for rows in tables for name in rows.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def left_join_splittable(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Left, semi or anti join on ``key`` whose left side adaptive execution can split when hot.

    A side that an earlier aggregate or join already left partitioned by ``key`` is joined without
    an exchange, and then a hot key cannot be split. Joining on the key and its hash makes both
    sides exchange just before the join.
    """
    right_key, right_hash = (free_name(name, left, right) for name in ("_right_key", "_right_hash"))
    keyed = right.withColumnRenamed(key, right_key).withColumn(right_hash, F.xxhash64(right_key))
    matches = (F.col(key) == F.col(right_key)) & (F.xxhash64(key) == F.col(right_hash))
    return left.join(keyed, matches, how).drop(right_key, right_hash)
