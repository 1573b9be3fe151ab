"""Near-duplicate texts by SimHash fingerprints, found through distances to reference fingerprints.

A fingerprint's *pivot table* has its Hamming distances to reference fingerprints (pivots). Distances
obey the triangle inequality: two fingerprints with 3 or fewer differing bits have distances to any
pivot that differ by 3 or less. So a pair whose largest coordinate difference is above 3 is discarded
without comparing the fingerprints, and what survives is verified bit by bit.

Which pairs meet at all comes from the same table, cut in five blocks of 12 or 13 bits. With 3 or fewer
differing bits at least two blocks agree wholly, and there all their block distances to all pivots
agree. So fingerprints are joined on the pivot distances of two blocks, for each of the ten choices of
two: no pair that has to be found is missed, and no bucket is searched beyond about 26 bits of agreement.
"""

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from operator import and_

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from vinlake.llm.common import short_batches, stored
from vinlake.llm.components import components
from vinlake.operators.joins import left_join_splittable

BITS = 64
SHINGLE = 3
DIFFERING = 3  # most differing bits of a link
SEED = 42
BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]  # first bit and number of bits
PIVOTS = [xxhash.xxh64_intdigest(f"pivot {number}", SEED) for number in range(16)]
FOR_KEYS = 8  # pivots whose block distances make a join key: 8 distances of 0 to 13 fit 31 bits


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def fingerprint_of(text: str | None) -> int:
    """The fingerprint as a signed number; 0 for a text without words."""
    words = text.encode().lower().split() if text else []  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    size = min(SHINGLE, len(words))
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    spans = zip(begins[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    hashes = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in spans]), dtype=">u8").astype("u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for some in range(0, len(hashes), 1 << 16):  # bounded memory for texts of any length
        part = hashes[some : some + (1 << 16)].view("u1").reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")
    return _signed(int(bits[0]))


@F.pandas_udf(LongType())
def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The 64-bit SimHash of a text over its 3-word shingles; 0 for NULL and texts without words."""
    for texts in batches:
        yield pd.Series([fingerprint_of(text) for text in texts], dtype="int64")


def as_hex(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _distances(begin: int, bits: int) -> list[Column]:
    """Distances of the fingerprint to all pivots within a block."""
    mask = ((1 << bits) - 1) << begin
    return [
        F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(pivot))).bitwiseAND(F.lit(_signed(mask)))) for pivot in PIVOTS
    ]


def pivot_table(fps: DataFrame) -> DataFrame:
    """``fp`` with its pivot coordinates (eight to a number, a byte each) and a row for each ``key`` to meet under."""
    names = [f"_{block}_{pivot}" for block in range(len(BLOCKS)) for pivot in range(len(PIVOTS))]
    columns = [column for begin, bits in BLOCKS for column in _distances(begin, bits)]
    table = fps.select("fp", *[column.alias(name) for column, name in zip(columns, names, strict=True)])
    whole = [reduce(Column.__add__, [F.col(f"_{b}_{p}") for b in range(len(BLOCKS))]) for p in range(len(PIVOTS))]

    def packed(values: list[Column], step: int) -> Column:
        return reduce(Column.__add__, [v.cast("bigint") * F.lit(step**place) for place, v in enumerate(values)])

    def block(number: int) -> Column:
        return packed([F.col(f"_{number}_{pivot}") for pivot in range(FOR_KEYS)], 14)

    pairs = list(combinations(range(len(BLOCKS)), 2))
    keys = [F.xxhash64(F.lit(place), block(a), block(b)) for place, (a, b) in enumerate(pairs)]
    # Coordinates are at most 64, so a byte's sign bit stays free.
    halves = [packed(whole[half : half + 8], 128).alias(f"far{half // 8}") for half in (0, 8)]
    return table.select("fp", *halves, F.explode(F.array(*keys)).alias("key"))


def links(fps: DataFrame) -> DataFrame:
    """All pairs (``a``, ``b``) of distinct fingerprints in ``fp`` with 3 or fewer differing bits."""
    left, right = pivot_table(fps).alias("l"), pivot_table(fps).alias("r")

    def coordinate(side: str, pivot: int) -> Column:
        return F.shiftright(F.col(f"{side}.far{pivot // 8}"), 7 * (pivot % 8)).bitwiseAND(F.lit(127))

    near = [F.abs(coordinate("l", p) - coordinate("r", p)) <= DIFFERING for p in range(len(PIVOTS))]
    verified = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= DIFFERING
    meet = (F.col("l.key") == F.col("r.key")) & (F.col("l.fp") < F.col("r.fp"))
    return left.join(right, reduce(and_, [meet, *near, verified])).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (BIGINT) and ``component_id``, the smallest id reachable through links.

    NULL and wordless texts have the fingerprint 0 and link like any other. A NULL id takes part but
    is the smallest only where no id is known. Repeated rows keep a row each. Other columns are not
    read. Equal fingerprints are grouped before any pair is looked for, so thousands of copies cost
    one row, and the join that gives the copies their component can split a hot fingerprint.
    """
    short_batches()
    prints = stored(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text)).alias("fp")), "fingerprints")
    first = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "distinct")
    found = stored(components(links(first.select("fp"))), "components")
    linked = first.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = found.join(first, found["node"] == first["fp"]).groupBy("root").agg(F.min("first").alias("least"))
    facts = left_join_splittable(linked, least, "root").filter((F.col("n") > 1) | F.col("least").isNotNull())
    facts = stored(facts.select("fp", F.coalesce("least", "first").alias("component_id")), "facts")
    joined = left_join_splittable(prints, facts, "fp")
    alone = F.coalesce("component_id", "doc_id")
    return joined.select("doc_id", F.col("fp").alias("fingerprint"), alone.alias("component_id"))
