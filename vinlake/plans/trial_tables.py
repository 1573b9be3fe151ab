"""The four raw tables, derived from the order-and-customer test tables, dirt included.

Every value is a function of the row's own key, so the tables are the same on every run and on
every engine, and grow with the tables they are derived from.
"""

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-06-01"

# The columns in use, declared: inferring a schema costs a job per table.
SOURCES = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_linenumber INT, l_shipdate TIMESTAMP_NTZ",
}


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.schema(SOURCES[name]).parquet(f"{folder}/{name}.parquet")


def _model(order_key: str):
    return F.expr(f"CASE {order_key} % 4 WHEN 0 THEN 'RAIZA' WHEN 1 THEN 'RANGGO' WHEN 2 THEN 'INNAVO' ELSE 'VELOS' END")


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Names with company prefixes; dates of birth in three shapes, missing, impossible or no date."""
    born = F.expr("CAST(DATE '1950-01-01' + CAST(c_custkey * 37 % 18000 AS INT) AS STRING)")
    rows = source(spark, folder, "customer").select("c_custkey", "c_name", born.alias("born"))
    return rows.select(
        F.col("c_custkey").alias("id"),
        F.expr(
            """CASE c_custkey % 20 WHEN 0 THEN 'PT ' || c_name WHEN 1 THEN 'CV ' || c_name
               WHEN 2 THEN 'UD ' || c_name WHEN 3 THEN 'pt ' || c_name ELSE c_name END"""
        ).alias("name"),
        F.expr(
            """CASE c_custkey % 9 WHEN 5 THEN replace(born, '-', '/')
               WHEN 6 THEN substr(born, 9, 2) || '/' || substr(born, 6, 2) || '/' || substr(born, 1, 4)
               WHEN 7 THEN CASE c_custkey % 4 WHEN 0 THEN '1900-01-01' WHEN 1 THEN '2001-02-30'
                                              WHEN 2 THEN 'unknown' ELSE '1900/01/01' END
               WHEN 8 THEN NULL ELSE born END"""
        ).alias("dob"),
        F.expr("TIMESTAMP_NTZ '2025-03-01 00:00:00'").alias("created_at"),
    )


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """One sale per order and a repeat, an hour later, of every 25th; some without date or price."""
    amount = F.expr("CAST(round(o_totalprice * 1000) AS BIGINT)").alias("amount")
    orders = source(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", amount)
    repeats = F.expr("CASE WHEN o_orderkey % 25 = 0 THEN array('', 'R') ELSE array('') END")
    return orders.withColumn("suffix", F.explode(repeats)).select(
        F.expr("'V' || CAST(o_orderkey AS STRING) || suffix").alias("vin"),
        F.col("o_custkey").alias("customer_id"),
        _model("o_orderkey").alias("model"),
        F.expr("CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) END").alias("invoice_date"),
        F.expr(
            """CASE WHEN o_orderkey % 101 = 0 THEN 'N/A' ELSE CAST(amount DIV 1000000 AS STRING)
               || '.' || lpad(CAST(amount DIV 1000 % 1000 AS STRING), 3, '0')
               || '.' || lpad(CAST(amount % 1000 AS STRING), 3, '0') END"""
        ).alias("price"),
        F.expr("CASE WHEN suffix = 'R' THEN o_orderdate + INTERVAL '1' HOUR ELSE o_orderdate END").alias("created_at"),
    )


def raw_after_sales(spark: SparkSession, folder: str) -> DataFrame:
    """One ticket per order line, up to 20 orders on one vehicle; some vehicles were never sold."""
    lines = (
        source(spark, folder, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.min("l_shipdate").alias("served"))
        .withColumn("sold_as", F.expr("l_orderkey - l_orderkey % 20"))
    )
    orders = source(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.sold_as == orders.o_orderkey).select(
        F.expr("'T' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)").alias("service_ticket"),
        F.expr("CASE WHEN l_orderkey % 50 = 7 THEN 'X' ELSE 'V' END || CAST(o_orderkey AS STRING)").alias("vin"),
        F.col("o_custkey").alias("customer_id"),
        _model("o_orderkey").alias("model"),
        F.col("served").cast("date").alias("service_date"),
        F.expr("CASE l_linenumber % 3 WHEN 0 THEN 'BP' WHEN 1 THEN 'PM' ELSE 'GR' END").alias("service_type"),
        F.col("served").alias("created_at"),
    )


def raw_customer_addresses(spark: SparkSession, folder: str, every_customer: bool = False) -> DataFrame:
    """One to three addresses per customer, all text; some customers have none unless ``every_customer``."""
    nation, region = source(spark, folder, "nation"), source(spark, folder, "region")
    customers = source(spark, folder, "customer").select("c_custkey", "c_nationkey")
    if not every_customer:
        customers = customers.where("c_custkey % 13 <> 0")
    placed = customers.join(nation, customers.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    return placed.withColumn("k", F.expr("explode(sequence(0L, c_custkey % 3))")).select(
        F.expr("CAST(c_custkey * 3 + k AS STRING)").alias("id"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.expr(
            "CASE WHEN c_custkey % 11 <> 0 THEN 'Jl ' || CAST(k AS STRING) || ' No ' || CAST(c_custkey AS STRING) END"
        ).alias("address"),
        F.expr("'  ' || n_name || ' '").alias("city"),
        F.expr("' ' || r_name || '  '").alias("province"),
        F.expr("CAST(DATE '2025-03-01' + CAST(k * 10 AS INT) AS STRING) || ' 14:24:40'").alias("created_at"),
    )


def trial_tables(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    """The raw tables by name, each planned when asked for."""
    tables = (raw_customers, raw_sales, raw_after_sales, raw_customer_addresses)
    return {table.__name__: partial(table, spark, folder) for table in tables}
