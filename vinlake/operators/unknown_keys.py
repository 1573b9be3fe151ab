from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinlake.operators.hot_groups import Keep, as_planned, attach, per_slice, slices_used, with_slice


def flag_unknown(
    rows: DataFrame, key: str, known: DataFrame, identity: Sequence[str], flag: str, keep: Keep = as_planned
) -> DataFrame:
    """Add a flag for rows whose key is NULL or missing from ``known``.

    Both sides are first reduced to one row per key, where no key can be hot, and compared there.
    The unknown keys, normally few, are then attached to the rows; the wide rows are never joined
    with the whole of ``known``.
    """
    sliced = with_slice(rows, *identity)
    present = sliced.where(F.col(key).isNotNull()).groupBy(key).agg(slices_used())
    unknown = present.join(known.select(key).distinct(), key, "left_anti").withColumn("_unknown", F.lit(True))
    flagged = attach(sliced, keep(flag, per_slice(unknown)), [key])
    return flagged.withColumn(flag, F.col(key).isNull() | F.col("_unknown").isNotNull()).drop("_unknown")
