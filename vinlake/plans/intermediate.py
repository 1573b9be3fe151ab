"""Intermediate: joins and business rules, inlined into the models that use them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinlake.fixed_values import NO_ADDRESS
from vinlake.functions import calendar_month, price_class
from vinlake.operators import Keep, as_planned, first_per_key, flag_repeats
from vinlake.plans.staging import SALE_KEYS, cleaned_sales, identity, repeat_keys, sale_order


def int_customer_enriched(customers: DataFrame, addresses: DataFrame) -> DataFrame:
    """Customers with their latest address, in parts and as one text."""
    parts = addresses.select("customer_id", "address", "city", "province")
    one_line = F.concat("address", F.lit(", "), "city", F.lit(", "), "province")  # NULL if any part is
    return customers.join(parts, "customer_id", "left").select(
        "customer_id",
        "customer_name",
        "date_of_birth",
        "is_dob_suspect",
        "customer_type",
        "address",
        "city",
        "province",
        F.coalesce(one_line, F.lit(NO_ADDRESS)).alias("full_address"),
        "created_at",
    )


def classed(sales: DataFrame) -> DataFrame:
    """Sales with price class and period."""
    return sales.withColumns({"price_class": price_class(F.col("price")), "periode": calendar_month(F.col("invoice_date"))})


def _described(sales: DataFrame, customers: DataFrame) -> DataFrame:
    buyers = customers.select("customer_id", "customer_name", "customer_type")
    return classed(sales.join(buyers, "customer_id", "left"))


def int_sales_enriched(raw_sales: DataFrame, customers: DataFrame, keep: Keep = as_planned) -> DataFrame:
    """Every dated sale with buyer, price class and period, and a flag on the one that counts.

    It starts from the raw table because the repeat flag of staging and the flag set here come out
    of one grouping when the raw invoice date is a DATE.
    """
    cleaned = cleaned_sales(raw_sales)
    same_day, same_raw = list(SALE_KEYS), repeat_keys(cleaned)
    told_by, order = identity(cleaned, "vin"), sale_order(cleaned)
    if same_raw == same_day:
        dated = cleaned.where(F.col("invoice_date").isNotNull())
        flagged = flag_repeats(dated, same_day, told_by, "is_duplicate_suspect", "is_canonical", order, keep)
    else:
        suspects = flag_repeats(cleaned, same_raw, told_by, repeated="is_duplicate_suspect", keep=keep)
        dated = suspects.where(F.col("invoice_date").isNotNull())
        flagged = flag_repeats(dated, same_day, told_by, first="is_canonical", first_by=order, keep=keep)
    return _described(flagged, customers).select(
        "vin",
        "customer_id",
        "customer_name",
        "customer_type",
        "model",
        "invoice_date",
        "price",
        "price_class",
        "periode",
        "is_duplicate_suspect",
        "created_at",
        "is_canonical",
    )


def canonical_sales(raw_sales: DataFrame, customers: DataFrame) -> DataFrame:
    """The rows of ``int_sales_enriched`` that are canonical, by one aggregate and no join back."""
    return _described(first_sales(raw_sales), customers)


def first_sales(raw_sales: DataFrame) -> DataFrame:
    """The same without what is known about the buyers."""
    cleaned = cleaned_sales(raw_sales)
    same_day, same_raw = list(SALE_KEYS), repeat_keys(cleaned)
    dated = cleaned.where(F.col("invoice_date").isNotNull())
    order = sale_order(cleaned)
    first = first_per_key(dated, list(dict.fromkeys([*same_day, *same_raw])), order, rows_as="_rows")
    if same_raw != same_day:
        first = first_per_key(first, same_day, order, rows_as="_raw_dates")
    return first.withColumn("is_duplicate_suspect", F.col("_rows") > 1)
