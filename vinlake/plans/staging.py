"""Staging: cast, clean and flag. No row with a key is dropped."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from vinlake.fixed_values import CORPORATE_PREFIXES, DOB_PLACEHOLDER
from vinlake.functions import dotted_amount, mixed_date, strip_space
from vinlake.operators import Keep, as_planned, flag_repeats, flag_unknown, latest_per_key

SALE_KEYS = ("customer_id", "model", "invoice_date")
# Of several sales under the same keys the earliest counts; the rest of the order settles ties.
SALE_ORDER = ("created_at", "vin", "price")
# Where a row lies in its file. Tables read with it tell exact copies of a row apart.
ROW_ID = "_row_id"


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    """Customers with a parsed date of birth, a suspect flag and a type."""
    dob, name = F.col("dob"), F.col("name")
    corporate = dob.isNull()
    for prefix in CORPORATE_PREFIXES:
        corporate = corporate | name.startswith(prefix)
    return raw_customers.where(F.col("id").isNotNull()).select(
        F.col("id").cast("bigint").alias("customer_id"),
        name.alias("customer_name"),
        mixed_date(dob).alias("date_of_birth"),
        (dob.isNull() | dob.eqNullSafe(DOB_PLACEHOLDER)).alias("is_dob_suspect"),
        F.when(corporate, "corporate").otherwise("individual").alias("customer_type"),
        "created_at",
    )


def cleaned_sales(raw_sales: DataFrame) -> DataFrame:
    """Sales with a VIN, cast. A raw date with a time of day is kept as ``_invoiced`` next to the date."""
    kept = [name for name in ("created_at", ROW_ID) if name in raw_sales.columns]
    if not isinstance(raw_sales.schema["invoice_date"].dataType, DateType):
        kept.append(F.col("invoice_date").alias("_invoiced"))
    return raw_sales.where(F.col("vin").isNotNull()).select(
        "vin",
        F.col("customer_id").cast("bigint").alias("customer_id"),
        "model",
        F.col("invoice_date").cast("date").alias("invoice_date"),
        dotted_amount(F.col("price")).alias("price"),
        *kept,
    )


def repeat_keys(cleaned: DataFrame) -> list[str]:
    """Keys under which a sale counts as a repeat: the raw invoice date, time of day included."""
    return [*SALE_KEYS[:2], "_invoiced" if "_invoiced" in cleaned.columns else "invoice_date"]


def identity(rows: DataFrame, key: str) -> list[str]:
    """What tells two rows apart: their place in the file if known, else their key."""
    return [ROW_ID] if ROW_ID in rows.columns else [key]


def sale_order(cleaned: DataFrame) -> list[str]:
    """The order that makes one sale of a group the first."""
    return [*SALE_ORDER, *[name for name in (ROW_ID,) if name in cleaned.columns]]


def stg_sales(raw_sales: DataFrame, keep: Keep = as_planned) -> DataFrame:
    """Sales with a whole-number price and a flag for suspected repeats."""
    cleaned = cleaned_sales(raw_sales)
    told_by = identity(cleaned, "vin")
    flagged = flag_repeats(cleaned, repeat_keys(cleaned), told_by, repeated="is_duplicate_suspect", keep=keep)
    return flagged.select(
        "vin", "customer_id", "model", "invoice_date", "price", "is_duplicate_suspect", "created_at"
    )


def stg_after_sales(
    raw_after_sales: DataFrame, raw_sales: DataFrame, as_of: Column | None = None, keep: Keep = as_planned
) -> DataFrame:
    """Service tickets with a flag for vehicles never sold and one for dates after ``as_of``.

    ``as_of`` is today unless given; a result that has to be repeatable needs it given.
    """
    tickets = raw_after_sales.where(F.col("service_ticket").isNotNull())
    told_by = identity(tickets, "service_ticket")
    flagged = flag_unknown(tickets, "vin", raw_sales, told_by, "is_vin_not_in_sales", keep)
    service_date = F.col("service_date").cast("date")
    return flagged.select(
        "service_ticket",
        "vin",
        "customer_id",
        "model",
        service_date.alias("service_date"),
        "service_type",
        "is_vin_not_in_sales",
        is_future(as_of).alias("is_future_date"),
        "created_at",
    )


def is_future(as_of: Column | None) -> Column:
    """Whether a ticket's raw date lies after a day, today unless given."""
    today = F.current_date() if as_of is None else as_of
    return F.coalesce(F.col("service_date").cast("date") > today, F.lit(False))


def dated_tickets(raw_after_sales: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The columns of staged tickets that need no look at the sales."""
    return raw_after_sales.where(F.col("service_ticket").isNotNull()).select(
        "service_ticket",
        "vin",
        "customer_id",
        "model",
        F.col("service_date").cast("date").alias("service_date"),
        "service_type",
        is_future(as_of).alias("is_future_date"),
        "created_at",
    )


def stg_customer_addresses(raw_customer_addresses: DataFrame) -> DataFrame:
    """The latest address of each customer.

    ``created_at`` is text and compared as text, and customers are told apart by their raw text id:
    ``1`` and ``01`` both stay and both become 1.
    """
    columns = ("id", "customer_id", "address", "city", "province", "created_at")
    latest = latest_per_key(raw_customer_addresses.select(*columns), "customer_id", ["created_at", "id"])
    return latest.select(
        F.col("id").try_cast("bigint").alias("address_id"),
        F.col("customer_id").try_cast("bigint").alias("customer_id"),
        "address",
        strip_space(F.col("city")).alias("city"),
        strip_space(F.col("province")).alias("province"),
        "created_at",
    )
