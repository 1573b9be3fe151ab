"""Mixing sources to target weights by capped water-filling and seeded repetitions.

Every source is to get its share of all words by weight, but none more than ``most`` epochs of its own
words. Sources above that are clamped there, and what they leave is shared again by weight among the
others until none is above: the water level of a set of capped vessels.

A source's epochs are a whole and a fractional part. Every document is taken the whole number of times,
and once more if its seeded number, uniform from 0 to 1, is below the *threshold* of its source and size class
(sizes of as many binary digits). Each class is to give the fractional part of its own words, the largest
first. A threshold never passes what is wanted; what a class leaves goes to the next smaller one, so that small
documents settle what large ones cannot meet. At the end a source misses its target by less than half the
smallest document, or documents within 1/65536, that could still be added.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vinlake.llm.common import WORD, stored, unit_hash
from vinlake.operators.hot_groups import SLICES

EPOCHS = 3.0
WEIGHTS = (1.0, 2.0, 3.0)
SEED = 7
BUCKETS = 256  # of the seeded numbers, and again within the buckets where the thresholds lie


def size_of(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def repeating_weights(sources: DataFrame) -> DataFrame:
    """Add ``weight``: 1, 2, 3, repeating, to one row per source in code point order, NULL last.

    The table has a row per source, not per document.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(WEIGHTS)
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), turn + 1))


def targets(sources: DataFrame, most: float = EPOCHS) -> DataFrame:
    """``source, source_size, target`` of a table ``source, source_size, weight``.

    Without a positive weight or size left, nothing is shared. Each round clamps at least one source, so the
    rounds end; a round is one aggregate over the table of sources.
    """
    capped = F.col("source_size") * F.lit(most)
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, clamped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) >= capped
        left, weight, n = sources.agg(
            F.lit(float(total)) - F.coalesce(F.sum(F.when(above, capped)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
            F.coalesce(F.sum(above.cast("int")), F.lit(0)),
        ).first()
        if n == clamped or weight <= 0:
            break
        level, clamped = max(level, left / weight), n
    return sources.select("source", "source_size", F.least(F.col("weight") * F.lit(level), capped).alias("target"))


def _bucket(level: int) -> Column:
    """Place of the seeded number among the buckets of a level, 0 or 1."""
    scaled = F.col("chance") * F.lit(float(BUCKETS**(level + 1)))
    return (F.floor(scaled) % BUCKETS).cast("int")


def _size_class(size: Column) -> Column:
    """Number of binary digits of a size."""
    return F.length(F.bin(size))


def _masses(rows: DataFrame, level: int) -> DataFrame:
    """``source, classes``: per size class, the largest first, its words by bucket and altogether.

    At most BUCKETS numbers for each of at most 63 classes of a source, whatever the number of documents.
    """
    cells = rows.groupBy("source", "size_class", _bucket(level).alias("bucket")).agg(F.sum("size").alias("mass"))
    parts = F.array_sort(F.collect_list(F.struct("bucket", "mass"))).alias("parts")
    by_class = cells.groupBy("source", "size_class").agg(parts, F.sum("mass").alias("mass"))
    ordered = F.sort_array(F.collect_list(F.struct("size_class", "mass", "parts")), asc=False)
    return by_class.groupBy("source").agg(ordered.alias("classes"))


STOPS = "array<struct<size_class:int,bucket:int,mass:bigint>>"


def _stops(want: Column, share: Column) -> Column:
    """``want, stops``: buckets are taken while they fit, class by class, and each class stops at the first that does not.

    A class begins with what the classes before have left of ``want`` and with ``share`` of its own words.
    A class without a stop is taken whole.
    """

    def one_bucket(acc: Column, part: Column) -> Column:
        fits = acc["stop"].isNull() & (part["mass"] <= acc["want"])
        stop = F.when(acc["stop"].isNull() & (part["mass"] > acc["want"]), part).otherwise(acc["stop"])
        return F.struct(F.when(fits, acc["want"] - part["mass"]).otherwise(acc["want"]).alias("want"), stop.alias("stop"))

    def one_class(acc: Column, own: Column) -> Column:
        start = F.struct(
            (acc["want"] + share * own["mass"]).alias("want"),
            F.lit(None).cast("struct<bucket:int,mass:bigint>").alias("stop"),
        )

        def ended(end: Column) -> Column:
            stop = F.struct(own["size_class"].alias("size_class"), end["stop"]["bucket"].alias("bucket"), end["stop"]["mass"].alias("mass"))
            more = F.when(end["stop"].isNotNull(), F.array(stop)).otherwise(F.array().cast(STOPS))
            return F.struct(end["want"].alias("want"), F.concat(acc["stops"], more).alias("stops"))

        return F.transform(F.array(F.aggregate(own["parts"], start, one_bucket)), ended)[0]

    return F.aggregate("classes", F.struct(want.alias("want"), F.array().cast(STOPS).alias("stops")), one_class)


def _by_class(stops: Column, value) -> Column:
    """Map from size class to a value of its stop."""
    return F.map_from_entries(F.transform(stops, lambda stop: F.struct(stop["size_class"], value(stop))))


def _slice(chance: Column) -> Column:
    return F.floor(chance * F.lit(float(BUCKETS**3)) % SLICES).cast("int")


def _spread(facts: DataFrame) -> DataFrame:
    """Facts per source, once for each slice of its rows, so that no task has a whole source."""
    slices = F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1)))
    return facts.withColumnRenamed("source", "_source").withColumn("_other", slices)


def _with_facts(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Join facts per source to rows with ``source`` and ``chance``."""
    same = F.col("source").eqNullSafe(F.col("_source")) & (_slice(F.col("chance")) == F.col("_other"))
    return rows.join(_spread(facts), same, "left").drop("_source", "_other")


def mix(docs: DataFrame, most: float = EPOCHS, seed: int = SEED) -> DataFrame:
    """``doc_id, source, size, source_size, target, times, taken`` of every document.

    ``docs`` has doc_id, text and source; other columns are not read. A NULL text has size 0, a NULL source
    is a source of its own. Documents equal in id and text have the same chance and are taken alike. An
    empty table or one without words takes nothing. Reruns give the same rows.
    """
    chance = unit_hash(F.lit(seed), F.col("doc_id"), F.col("text"))
    sized = stored(docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), chance.alias("chance")), "sizes")
    facts = _plan(sized, most)
    mixed = _with_facts(sized, facts).select("doc_id", "source", "size", "source_size", "target", _times().alias("times"))
    return mixed.withColumn("taken", F.col("size") * F.col("times"))


def repeated(docs: DataFrame, most: float = EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs`` with every row as often as the mix takes it. All columns stay; texts are not shuffled unless the
    table of sources is too large for Spark to broadcast."""
    chance = unit_hash(F.lit(seed), F.col("doc_id"), F.col("text"))
    size = size_of(F.col("text"))
    facts = _plan(stored(docs.select("source", size.alias("size"), chance.alias("chance")), "sizes"), most)
    # The row travels whole in one column, so names of its columns cannot clash with those used here.
    rows = docs.select(F.struct("*").alias("row"), F.col("source").alias("source"), size.alias("size"), chance.alias("chance"))
    joined = _with_facts(rows, facts)
    return joined.select("row", F.explode(F.array_repeat(F.lit(1), _times().cast("int")))).select("row.*")


def _plan(sized: DataFrame, most: float) -> DataFrame:
    """Per source its size, target, whole repetitions and ``steps``: per size class where the fractional one ends."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stored(targets(stored(repeating_weights(sources), "sources"), most), "targets")
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("whole", F.floor(epochs))
    plan = plan.withColumn("share", F.when(F.col("source_size") > 0, epochs - F.col("whole")).otherwise(0.0))

    classed = sized.filter("size > 0").withColumn("size_class", _size_class(F.col("size")))
    first = _with_plan(_masses(classed, 0), plan.select("source", "share"))
    found = first.select("source", _stops(F.lit(0.0), F.col("share")).alias("at"))
    cells = _by_class(F.col("at.stops"), lambda stop: stop["bucket"])
    coarse = stored(found.select("source", F.col("at.want").alias("rest"), cells.alias("coarse")), "coarse")

    # Inside the buckets that did not fit: what is left is met as well as finer ones can.
    within = _with_facts(classed, coarse).filter(_bucket(0) == F.try_element_at("coarse", F.col("size_class")))
    second = _with_plan(_masses(within, 1), coarse.select("source", "rest", "coarse"))
    met = second.select("source", "coarse", _stops(F.col("rest"), F.lit(0.0)).alias("at"))
    least = F.array_min(F.transform("at.stops", lambda stop: F.struct(stop["mass"], stop["size_class"])))
    one_more = F.col("at.want") * 2 >= least["mass"]
    extra = lambda stop: (one_more & (stop["size_class"] == least["size_class"])).cast("int")
    # A class whose finer buckets were all taken ends behind its coarse bucket.
    whole_bucket = F.transform_values("coarse", lambda _, bucket: (bucket + 1) * BUCKETS)
    inside = _by_class(
        F.col("at.stops"),
        lambda stop: F.try_element_at("coarse", stop["size_class"]) * BUCKETS + stop["bucket"] + extra(stop),
    )
    steps = F.map_zip_with(whole_bucket, inside, lambda _, behind, at: F.coalesce(at, behind))
    facts = _with_plan(plan, met.select("source", steps.alias("steps")))
    return stored(facts.select("source", "source_size", "target", "whole", "share", "steps"), "facts")


def _times() -> Column:
    """How often a row with ``size`` and ``chance`` is taken: the whole repetitions, and once more below the threshold."""
    all_steps = F.lit(BUCKETS**2)
    steps = F.coalesce(F.try_element_at("steps", _size_class(F.col("size"))), all_steps)
    again = (F.floor(F.col("chance") * F.lit(float(BUCKETS**2))) < steps) & (F.col("share") > 0) & (F.col("size") > 0)
    return F.coalesce(F.col("whole"), F.lit(0)) + F.coalesce(again.cast("bigint"), F.lit(0))


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Left join of two tables by source, both with a bounded number of rows per source."""
    other = plan.withColumnRenamed("source", "_source")
    return rows.join(other, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
