from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinlake.operators.hot_groups import Keep, as_planned, attach, per_slice, slices_used, with_slice


def flag_repeats(
    rows: DataFrame,
    keys: Sequence[str],
    identity: Sequence[str],
    repeated: str | None = None,
    first: str | None = None,
    first_by: Sequence[str] = (),
    keep: Keep = as_planned,
) -> DataFrame:
    """Add a flag for rows whose key occurs more than once, and one for the first row of each key.

    ``repeated`` names the first flag, ``first`` the second; the first row is the least one by
    ``first_by`` (NULL is least), and that order has to be total within a key. Only keys that do
    repeat are joined back: on clean data that side is small.
    """
    facts = [F.count(F.lit(1)).alias("_rows"), slices_used()]
    if first:
        facts.append(F.min(F.struct(*first_by)).alias("_first"))
    sliced = with_slice(rows, *identity)
    groups = sliced.groupBy(*keys).agg(*facts).where(F.col("_rows") > 1)
    flagged = attach(sliced, keep("_".join(filter(None, [repeated, first])), per_slice(groups)), keys)

    flags: dict[str, Column] = {}
    if repeated:
        flags[repeated] = F.col("_rows").isNotNull()
    if first:
        flags[first] = F.col("_rows").isNull() | F.struct(*first_by).eqNullSafe(F.col("_first"))
    return flagged.withColumns(flags).drop("_rows", "_first")
