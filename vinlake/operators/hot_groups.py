"""Attach facts about a group to the rows of the group, without gathering the group anywhere.

A window ``COUNT(*) OVER (PARTITION BY k)`` sends all rows of a key to one task. With a third of a
table under one key that task never ends, and adaptive execution cannot split a window. So the
facts are computed by ``groupBy`` (reduced before the shuffle) and joined back:

1. every row gets a slice, a number below ``SLICES`` hashed from its own identity;
2. the aggregate notes which slices the group occupies, as the bits of one BIGINT;
3. the group's single fact row is repeated once per *occupied* slice, so a group of two rows gives
   at most two fact rows, never ``SLICES``; what becomes of the facts is decided after that, by their true size;
4. rows and facts meet on (key, slice): a hot group is spread over ``SLICES`` tasks.

The join keys differ from the grouping keys, so both sides get an exchange of their own. That is
the plan shape in which adaptive execution splits a still too large partition further.
"""

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICES = 64  # one bit each in a BIGINT

# What becomes of facts before they are attached: a name and the facts in, equal rows out.
Keep = Callable[[str, DataFrame], DataFrame]


def as_planned(_: str, facts: DataFrame) -> DataFrame:
    """Leave the facts a part of the plan that uses them, and merge them with the rows.

    Their size is not known when the query is planned: Spark takes an exploded table for no larger
    than the one before. So they are never broadcast.
    """
    return facts.hint("merge")


def _fits_broadcast(facts: DataFrame) -> bool:
    """Whether stored facts, all rows at full width, are below the session's broadcast limit."""
    limit = facts.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return facts.count() * facts._jdf.schema().defaultSize() <= limit


def in_folder(folder: str) -> Keep:
    """Write the facts to a shared folder and go on with the files.

    Then they are computed once for all plans that use them, survive the loss of executors, and
    have a known number of rows, which the file footers tell: Spark may broadcast them if these fit its
    limit, and then the rows they are attached to are not shuffled at all. Else both are merged.
    """

    def keep(name: str, facts: DataFrame) -> DataFrame:
        path = f"{folder}/{name}"
        facts.write.mode("overwrite").parquet(path)
        kept = facts.sparkSession.read.schema(facts.schema).parquet(path)
        return kept if _fits_broadcast(kept) else kept.hint("merge")

    return keep


def with_slice(rows: DataFrame, *identity: str) -> DataFrame:
    """Number the rows by a hash of their identity, the same in every evaluation of ``rows``."""
    return rows.withColumn("_slice", F.pmod(F.xxhash64(*identity), F.lit(SLICES)).cast("int"))


def slices_used() -> Column:
    """Aggregate: the slices that occur in the group, as bits."""
    return F.bit_or(F.expr("shiftleft(1L, _slice)")).alias("_slices")


def per_slice(facts: DataFrame) -> DataFrame:
    """Each fact row once for every slice that its group occupies. This is the size that joining it costs."""
    numbers = F.sequence(F.lit(0), F.lit(SLICES - 1))
    used = F.filter(numbers, lambda number: F.getbit(F.col("_slices"), number) == 1)
    return facts.select(*[name for name in facts.columns if name != "_slices"], F.explode(used).alias("_slice"))


def attach(rows: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join sliced ``rows`` with ``facts`` per slice; NULL keys form a group too."""
    renamed = facts.withColumnsRenamed({name: f"_fact_{name}" for name in (*keys, "_slice")})
    same_slice = F.col("_slice") == F.col("_fact__slice")
    matches = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_fact_{name}")) for name in keys], same_slice)
    return rows.join(renamed, matches, "left").drop("_slice", "_fact__slice", *[f"_fact_{name}" for name in keys])
