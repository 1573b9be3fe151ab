"""Lay out a table so that readers can skip files by any one of several columns.

Sorting by customer, then class, then VIN gives files with narrow ranges of customers only: every file holds all
classes and VINs. Here each column is first replaced by its *rank*, a number of ``BITS`` bits that says how much of the
table lies below a value, and the bits of the ranks are interleaved, the highest ones first (a Morton
number). A range of Morton numbers is a small box: its rows are near each other in every column, so
files that hold such ranges have narrow minima and maxima for all of them.

Ranks come from cut points of equal depth. A value that fills a third of the table takes a third of the ranks,
as its cut points repeat; hence few distinct values (a price class) use the high bits as well as many do.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinlake.operators.joins import free_name

BITS = 6
SAMPLE = 16_384  # rows, about, that cut points are taken from; they decide where a row lies, not whether


def cut_points(rows: DataFrame, columns: Sequence[str], bits: int = BITS, sample: int = SAMPLE) -> dict[str, list]:
    """Per column the values that cut a sample into ``2 ** bits`` parts of equal size; none for a column of NULLs.

    ``rows`` is read twice, so it should be stored: its number of rows and these columns alone.
    """
    number = rows.count()
    few = rows.select(*columns)
    if number > sample:
        few = few.sample(fraction=sample / number, seed=1)
    parts = 1 << bits

    def cuts(column: str) -> Column:
        ordered = F.sort_array(F.collect_list(column))
        wanted = F.sequence(F.lit(1), F.lit(parts - 1))
        at = F.transform(wanted, lambda part: F.get("ordered", (part * F.size("ordered") / parts).cast("int")))
        whole = few.agg(ordered.alias("ordered")).select(F.filter(at, lambda value: value.isNotNull()))
        return whole.first()[0]

    return {column: cuts(column) for column in columns}


def rank(value: Column, cuts: Sequence) -> Column:
    """Number of cut points up to a value: 0 for NULL and for values below all of them."""
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= value))


def morton(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of all ranks interleaved as one BIGINT, the highest bit of the first rank in front."""
    if len(ranks) * bits > 63:
        raise ValueError(f"{len(ranks)} ranks of {bits} bits do not fit a BIGINT")
    places = []
    for bit in range(bits):
        for turn, one in enumerate(reversed(ranks)):
            set_bit = F.shiftright(one.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            places.append(F.shiftleft(set_bit, bit * len(ranks) + turn))
    return reduce(Column.bitwiseOR, places)


def clustered(rows: DataFrame, within: str, cuts: Mapping[str, list], key: str) -> DataFrame:
    """Rows range-partitioned and sorted by ``within``, then by the Morton number of the columns that are cut.

    ``key`` splits rows that agree in everything else, so that no partition has to hold them all.
    """
    place = free_name("_place", rows)
    placed = rows.withColumn(place, morton([rank(F.col(column), points) for column, points in cuts.items()]))
    order = [within, place, key]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).drop(place)
