"""Clustering by several columns: any one of them skips files, and no row is lost."""

import glob

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vinlake.sources.clustering import BITS, cut_points, morton, rank
from vinlake.sources.tables import as_monthly_table, by_month

ROWS, FILES = 40_000, 64


def ranges(path, column):
    """Smallest and largest value of a column in each file, from the footers alone."""
    found = []
    for file in glob.glob(f"{path}/*/*.parquet"):
        footer = pq.read_metadata(file)
        place = footer.schema.to_arrow_schema().names.index(column)
        parts = [footer.row_group(group).column(place).statistics for group in range(footer.num_row_groups)]
        found.append((min(part.min for part in parts), max(part.max for part in parts)))
    return found


def share_read(path, column, value):
    """Share of the files whose range of the column holds the value."""
    spans = ranges(path, column)
    return sum(low <= value <= high for low, high in spans) / len(spans)


@pytest.fixture(scope="module")
def sales(spark):
    """One month with a customer who has a third of it, three classes and unique VINs; all independent."""
    number = F.col("id")
    return spark.range(0, ROWS, 1, 4).select(
        F.concat(F.lit("V"), F.lpad((number * 7919 % 100_003).cast("string"), 6, "0")).alias("vin"),
        F.when(F.pmod(F.xxhash64("id"), F.lit(3)) == 0, 500).otherwise(F.pmod(F.hash("id"), F.lit(1000))).cast("bigint").alias("customer_id"),
        F.element_at(F.array(*map(F.lit, ("high", "low", "mid"))), (F.pmod(F.crc32(number.cast("string")), F.lit(3)) + 1).cast("int")).alias("price_class"),
        F.lit("2025-05-05").cast("date").alias("invoice_date"),
    )


@pytest.fixture(scope="module")
def table(spark, sales, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clustered") / "fact_sales")
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(FILES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        as_monthly_table(sales, path, "invoice_date", ["customer_id", "price_class"], key="vin")
        by_month(sales, "invoice_date", "invoice_date_month", "customer_id", "price_class", "vin").write.partitionBy("invoice_date_month").parquet(path + "_sorted")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return path


def test_each_column_alone_skips_files(table):
    files = len(ranges(table, "vin"))
    assert files > FILES * 0.9
    assert share_read(table, "customer_id", 77) <= 0.4
    assert share_read(table, "price_class", "high") <= 0.6
    assert share_read(table, "price_class", "mid") <= 0.6
    assert share_read(table, "vin", "V050000") <= 0.4
    # Sorted by customer first, VINs skip nothing outside the hot customer, and no class skips half.
    assert share_read(table + "_sorted", "vin", "V050000") > 0.6


def test_no_row_is_lost_and_nothing_is_left_beside(spark, sales, table):
    stored = spark.read.parquet(table).select(*sales.columns)
    assert stored.count() == ROWS and stored.exceptAll(sales).isEmpty()
    assert not glob.glob(table.rsplit("/", 1)[0] + "/.fact_sales-*")


def test_a_hot_customer_is_spread_over_files_of_like_size(table):
    sizes = [pq.read_metadata(file).num_rows for file in glob.glob(f"{table}/*/*.parquet")]
    assert max(sizes) < 3 * ROWS / FILES


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 63), min_size=3, max_size=3))
def test_morton_numbers_interleave_bits(spark, ranks):
    expected = "".join(str(one >> bit & 1) for bit in reversed(range(BITS)) for one in ranks)
    assert spark.range(1).select(morton([F.lit(one) for one in ranks])).first()[0] == int(expected, 2)


def test_ranks_follow_values_and_fill_their_bits(spark):
    rows = spark.range(10_000).selectExpr("id as n", "cast(id % 3 as string) as few", "cast(null as string) as none")
    cuts = cut_points(rows, ["n", "few", "none"])
    ranked = rows.select("n", "few", *[rank(F.col(name), cuts[name]).alias("r_" + name) for name in cuts])
    few = {r.few: r.r_few for r in ranked.select("few", "r_few").distinct().collect()}
    assert 0 <= few["0"] < few["1"] < few["2"] == 63 and few["0"] > 10 and few["1"] > 30
    by_n = [r.r_n for r in ranked.orderBy("n").collect()]
    assert by_n == sorted(by_n) and (by_n[0], by_n[-1]) == (0, 63)
    assert ranked.agg(F.max("r_none")).first()[0] == 0
    assert rows.select(rank(F.lit(None).cast("bigint"), cuts["n"]).alias("r")).first().r == 0


def test_an_empty_table_and_one_row_are_written(spark, sales, tmp_path):
    for name, rows in (("empty", sales.limit(0)), ("one", sales.limit(1))):
        written = as_monthly_table(rows, str(tmp_path / name), "invoice_date", ["customer_id", "price_class"], key="vin")
        assert written.count() == (name == "one")
