"""Core marts: the star schema. Load times are added on writing, not here."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinlake.fixed_values import CALENDAR_FROM, CALENDAR_TO, SERVICE_TYPES
from vinlake.functions import calendar_month, price_class
from vinlake.plans.intermediate import canonical_sales
from vinlake.schemas import DIM_SERVICE_TYPE


def dim_customer(enriched: DataFrame) -> DataFrame:
    """Customer dimension, from ``int_customer_enriched``."""
    return enriched.select(
        "customer_id",
        "customer_name",
        "date_of_birth",
        "is_dob_suspect",
        "customer_type",
        "city",
        "province",
        "full_address",
        "created_at",
    )


def dim_vehicle(sales_facts: DataFrame) -> DataFrame:
    """Vehicle models with their price range, from ``fact_sales``: exactly the canonical sales."""
    price = F.col("price")
    # Summed as a decimal: exact, and so the same in any order, where a DOUBLE or BIGINT sum is not.
    average = F.sum(price.cast("decimal(19,0)")).cast("double") / F.count(price)
    ranges = sales_facts.groupBy("model").agg(
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.when(F.count(price) > 0, average).alias("avg_price"),
    )
    return ranges.withColumn("default_price_class", price_class(F.col("avg_price")))


def calendar(spans: DataFrame) -> DataFrame:
    """One row per day of each span (``first_day``, ``last_day``), both ends included."""
    day = F.col("date_id")
    weekday = F.dayofweek(day)  # Sunday is 1
    return spans.select(F.explode(F.sequence("first_day", "last_day")).alias("date_id")).select(
        day,
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        F.quarter(day).cast("bigint").alias("quarter"),
        calendar_month(day).alias("year_month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekday.cast("bigint").alias("day_of_week"),
        weekday.isin(1, 7).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, first_day: str = CALENDAR_FROM, last_day: str = CALENDAR_TO) -> DataFrame:
    """Date dimension over the fixed years."""
    ends = spark.range(1).select(
        F.lit(first_day).cast("date").alias("first_day"), F.lit(last_day).cast("date").alias("last_day")
    )
    return calendar(ends)


def dim_service_type(spark: SparkSession) -> DataFrame:
    """The three service types."""
    names = DIM_SERVICE_TYPE.names
    rows = [F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row)]) for row in SERVICE_TYPES]
    return spark.range(1).select(F.inline(F.array(*rows)))


def fact_sales(raw_sales: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per sale that counts."""
    return canonical_sales(raw_sales, customers).select(
        "vin",
        "customer_id",
        "model",
        "invoice_date",
        "price",
        "price_class",
        "periode",
        "customer_name",
        "customer_type",
        "is_duplicate_suspect",
        "created_at",
    )


def fact_after_sales(tickets: DataFrame) -> DataFrame:
    """All service tickets, flagged ones included, from ``stg_after_sales``."""
    return tickets.select(
        "service_ticket",
        "vin",
        "customer_id",
        "model",
        F.col("service_date").alias("date_id"),
        F.col("service_type").alias("service_type_code"),
        "is_vin_not_in_sales",
        "is_future_date",
        "created_at",
    )
