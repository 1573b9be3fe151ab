from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, where NULL is least.

    An aggregate, not a window: each task keeps one candidate per key before the shuffle, so a key
    with very many rows arrives as one row per map task.
    """
    ordered = [*order, *[name for name in rows.columns if name not in order]]
    best = rows.groupBy(F.col(key).alias("_key")).agg(F.max(F.struct(*ordered)).alias("_row"))
    return best.select(*[F.col(f"_row.{name}").alias(name) for name in rows.columns])


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str], rows_as: str) -> DataFrame:
    """One row per combination of keys, the least by ``order`` (NULL is least), and the group's size."""
    rest = [name for name in rows.columns if name not in (*keys, *order)]
    best = rows.groupBy(*keys).agg(
        F.min(F.struct(*order, *rest)).alias("_row"), F.count(F.lit(1)).alias(rows_as)
    )
    return best.select(
        *[F.col(name) if name in keys else F.col(f"_row.{name}").alias(name) for name in rows.columns], rows_as
    )
