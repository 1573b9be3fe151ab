"""Connected components of a graph given as edges, with no vertex's edges in one task."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinlake.llm.common import stored
from vinlake.operators.joins import left_join_splittable


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("node", "to").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node that has an edge (``a``, ``b``).

    Large-star and small-star in turn: each node passes its smallest neighbour on to the larger
    ones, then to the smaller ones, until the edges no longer change. The number of rounds grows with
    the logarithm of the longest path. Each round is written to the shared folder, so a lost
    executor costs one round. Minima are aggregated before the shuffle, and joins split hot nodes.
    Repeated edges, loops and edges in both directions count once; edges with a NULL end do not count.
    """
    ends = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to"))
    now = stored(ends.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct(), "edges")
    before = None
    while (state := _state(now)) != before and state[0]:
        before = state
        both = now.unionAll(now.select(F.col("to").alias("node"), F.col("node").alias("to")))
        least = both.groupBy("node").agg(F.least(F.min("to"), F.col("node")).alias("least"))
        joined = left_join_splittable(both, least, "node")
        large = joined.filter("to > node").select(F.col("to").alias("node"), F.col("least").alias("to")).distinct()
        large = stored(large, "large_star")
        least = large.groupBy("node").agg(F.min("to").alias("least"))
        joined = left_join_splittable(large, least, "node")
        others = joined.filter("to != least").select(F.col("to").alias("node"), F.col("least").alias("to"))
        now = stored(others.unionAll(least.select("node", F.col("least").alias("to"))).distinct(), "small_star")
    return now.select("node", F.col("to").alias("root")).unionAll(now.select(F.col("to").alias("node"), F.col("to").alias("root")).distinct())
