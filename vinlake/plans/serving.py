"""Serving marts: the two reports. This layer decides which flagged rows to leave out."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinlake.fixed_values import PRIORITY_HIGH_ABOVE, PRIORITY_MED_FROM
from vinlake.operators import left_join_splittable


def mart_sales_summary(sales_facts: DataFrame) -> DataFrame:
    """Sum and number of sales by period, price class and model."""
    return sales_facts.groupBy("periode", F.col("price_class").alias("class"), "model").agg(
        F.sum("price").alias("total"), F.count(F.lit(1)).alias("total_transactions")
    )


def mart_aftersales_priority(service_facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Services per year, vehicle and customer with a priority; ``customers`` is ``dim_customer``.

    Tickets are counted before the join, so the join sees one row per year, vehicle and customer.
    """
    valid = service_facts.where(~F.col("is_vin_not_in_sales") & ~F.col("is_future_date"))
    services = valid.groupBy(F.year("date_id").cast("bigint").alias("periode"), "vin", "customer_id").agg(
        F.count("service_ticket").alias("count_service")
    )
    names = customers.select("customer_id", "customer_name", F.col("full_address").alias("address"))
    number = F.col("count_service")
    return left_join_splittable(services, names, "customer_id").select(
        "periode",
        "vin",
        "customer_name",
        "address",
        "count_service",
        F.when(number > PRIORITY_HIGH_ABOVE, "HIGH").when(number >= PRIORITY_MED_FROM, "MED").otherwise("LOW").alias("priority"),
    )


def sales_summary_report(mart: DataFrame) -> DataFrame:
    """The sales report in reading order. The order is not part of the stored table."""
    return mart.orderBy("periode", "class", "model")


def aftersales_priority_report(mart: DataFrame) -> DataFrame:
    """The after-sales report in reading order: most services first within a year.

    Most vehicles share a year and a small count; the vehicle ends the sort key so that such a run
    can be cut into several ranges.
    """
    return mart.orderBy("periode", F.desc("count_service"), "vin", "customer_name")
