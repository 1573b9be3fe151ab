"""Records of CSV files whose quoted values hold line breaks, found by all tasks at once.

Whether a line break ends a record depends on all that stands before it in the file. But a line can only do four things: leave
the state (outside or inside quotes) as it is, turn it over, or leave it outside or inside whatever it was. Such steps can be
put together without knowing the state: what counts is the last fixed one, and how often the state was turned over since.

1. Each block of a file (the part that one task reads) puts the steps of its lines together: a row per block.
2. A running sum over the blocks of a file, few rows, gives every block the state it begins in.
3. Each block then knows its records. A record of one line stays where it is; the lines of the others, which may cross
   blocks, are gathered by record.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A field is quoted if a quote is its first character; any other quote is text.
QUOTED_FIELD = r'(?<![^,\r\n])"(?:[^"]++|"")*+"'
OPENING_QUOTE = r'(?<![^,\r\n])"'
CLOSED = r'^(?:[^"]++|"")*+"'  # the rest of a quoted field that began on an earlier line
BYTE_ORDER_MARK = "﻿"


def left_open(text: Column) -> Column:
    """Whether a quoted field begins in the text and does not end in it."""
    return F.regexp_replace(text, QUOTED_FIELD, "").rlike(OPENING_QUOTE)


def _still_open(text: Column) -> Column:
    """The same for a text that begins inside a quoted field."""
    rest = F.regexp_replace(text, CLOSED, "x")  # what follows the end of a field does not begin one
    return F.when(text.rlike(CLOSED), left_open(rest)).otherwise(F.lit(True))


def lines_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, name, block, number, line``: lines by line feeds, numbered within the block of the file they begin in."""
    read = spark.read.text(list(paths), lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("number"),
        F.col("value").alias("line"),
    )
    marked = (F.col("block") == 0) & F.col("line").startswith(BYTE_ORDER_MARK)
    return read.withColumn("line", F.when(marked, F.substring("line", 2, 2**31 - 1)).otherwise(F.col("line")))


def put_together(steps: DataFrame, window: Window) -> DataFrame:
    """Add ``fixed`` (the state after the last step that fixes it, turned over as often as the steps behind it do; NULL before the first)
    and ``turned`` (whether all steps up to here turn the state over) to rows with the steps ``fixes`` and ``turns``."""
    turns = F.sum(F.col("turns").cast("int")).over(window) % 2 == 1
    last = F.last(F.when(F.col("fixes").isNotNull(), F.struct("fixes", "turned")), ignorenulls=True).over(window)
    known = steps.withColumn("turned", turns).withColumn("_last", last)
    same = F.col("_last.turned") == F.col("turned")
    return known.withColumn("fixed", F.when(same, F.col("_last.fixes")).otherwise(~F.col("_last.fixes"))).drop("_last")


def with_steps(lines: DataFrame) -> DataFrame:
    """Lines with what they do to the state and what all lines of their block before them do, ``fixed`` and ``turned``."""
    after_out, after_in = left_open(F.col("line")), _still_open(F.col("line"))
    steps = lines.withColumn("after_out", after_out).withColumn("after_in", after_in)
    steps = steps.withColumn("fixes", F.when(F.col("after_out") == F.col("after_in"), F.col("after_out")))
    steps = steps.withColumn("turns", F.col("after_out") & ~F.col("after_in"))
    order = Window.partitionBy("path", "block").orderBy("number")
    done = put_together(steps, order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = {name: F.lag(name).over(order) for name in ("fixed", "turned")}
    done = done.withColumns({"fixed_before": before["fixed"], "turned_before": F.coalesce(before["turned"], F.lit(False))})
    return done


def _state(fixed: str, turned: str, begin: Column) -> Column:
    """The state (true inside quotes) behind steps that were put together, from the state before them."""
    return F.coalesce(F.col(fixed), F.col(turned) != begin)


def blocks_of(lines: DataFrame) -> DataFrame:
    """A row per block of a file: ``begins`` and ``ends``, its states, ``carry``, the record that goes on into it, and ``header``."""
    starts = {inside: ~_state("fixed_before", "turned_before", F.lit(inside)) for inside in (False, True)}
    blocks = lines.groupBy("path", "block").agg(
        F.max_by(F.struct("fixed", "turned"), "number").alias("all"),
        *[F.max(F.when(start, F.col("number"))).alias(f"last_{inside}") for inside, start in starts.items()],
        F.min(F.when(F.trim(F.regexp_replace("line", r"\s", "")) != "", F.col("number"))).alias("text"),
    )
    steps = blocks.withColumns({"fixes": F.col("all.fixed"), "turns": F.col("all.turned")})
    steps = steps.withColumn("turns", F.col("turns") & F.col("fixes").isNull())
    file, order = Window.partitionBy("path"), Window.partitionBy("path").orderBy("block")
    done = put_together(steps, order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    done = done.withColumn("ends", _state("fixed", "turned", F.lit(False)))
    done = done.withColumn("begins", F.coalesce(F.lag("ends").over(order), F.lit(False)))
    own = F.when(F.col("begins"), F.col("last_true")).otherwise(F.col("last_false"))
    own = F.when(own.isNotNull(), F.struct(F.col("block"), own.alias("number")))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    text = F.when(F.col("text").isNotNull(), F.struct("block", F.col("text").alias("number")))
    return done.withColumn("own", own).select(
        "path",
        "block",
        "begins",
        "ends",
        F.last("own", ignorenulls=True).over(earlier).alias("carry"),
        F.min(text).over(file).alias("header"),
    )


def never_closed(spark: SparkSession, paths: Sequence[str]) -> set[str]:
    """Names of the files that end inside a quoted field."""
    lines = with_steps(lines_of(spark, paths))
    ends = blocks_of(lines).groupBy("path").agg(F.max_by("ends", "block").alias("open")).where("open")
    names = lines.select("path", "name").distinct()
    return {row.name for row in ends.join(names, "path").select("name").collect()}


def records_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``source_file, record``: the text of each record but headers and blank ones, without its last line break."""
    lines = with_steps(lines_of(spark, paths))
    joined = lines.join(blocks_of(lines), ["path", "block"])
    joined = joined.withColumn("inside", _state("fixed_before", "turned_before", F.col("begins")))
    open_after = F.when(F.col("inside"), F.col("after_in")).otherwise(F.col("after_out"))
    order = Window.partitionBy("path", "block").orderBy("number")
    here = F.last(F.when(~F.col("inside"), F.struct("block", "number")), ignorenulls=True).over(order)
    known = joined.withColumn("record", F.coalesce(here, F.col("carry"))).withColumn("alone", ~F.col("inside") & ~open_after)
    known = known.where(F.col("record") != F.col("header"))
    whole = known.where("alone").select("name", "line")
    parts = known.where("NOT alone").groupBy("path", "name", "record")
    ordered = F.sort_array(F.collect_list(F.struct("block", "number", "line")))
    gathered = parts.agg(F.array_join(F.transform(ordered, lambda part: part["line"]), "\n").alias("line")).select("name", "line")
    text = F.regexp_replace("line", r"\r$", "")
    found = whole.unionAll(gathered).select(F.col("name").alias("source_file"), text.alias("record"))
    return found.where(F.length(F.regexp_replace("record", r"\s", "")) > 0)
