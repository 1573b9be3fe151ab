"""Declared schemas. Nothing is inferred: a raw table either fits or fails to load."""

from pyspark.sql.types import (
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


RAW_CUSTOMERS = _struct(id=LongType(), name=StringType(), dob=StringType(), created_at=TimestampNTZType())

RAW_SALES = _struct(
    vin=StringType(),
    customer_id=LongType(),
    model=StringType(),
    invoice_date=DateType(),
    price=StringType(),
    created_at=TimestampNTZType(),
)

RAW_AFTER_SALES = _struct(
    service_ticket=StringType(),
    vin=StringType(),
    customer_id=LongType(),
    model=StringType(),
    service_date=DateType(),
    service_type=StringType(),
    created_at=TimestampNTZType(),
)

# The address file is read as text throughout, created_at included.
RAW_CUSTOMER_ADDRESSES = _struct(
    id=StringType(),
    customer_id=StringType(),
    address=StringType(),
    city=StringType(),
    province=StringType(),
    created_at=StringType(),
)

RAW_TABLES = {
    "raw_customers": RAW_CUSTOMERS,
    "raw_sales": RAW_SALES,
    "raw_after_sales": RAW_AFTER_SALES,
    "raw_customer_addresses": RAW_CUSTOMER_ADDRESSES,
}

# The landing table's ids are whole numbers; the raw table keeps them as text.
LANDED_ADDRESSES = _struct(
    id=IntegerType(),
    customer_id=IntegerType(),
    address=StringType(),
    city=StringType(),
    province=StringType(),
    created_at=TimestampNTZType(),
    loaded_at=TimestampType(),
    source_file=StringType(),
)

AUDIT_LOG = _struct(
    status=StringType(),
    rows_loaded=LongType(),
    error_message=StringType(),
    loaded_at=TimestampType(),
    pipeline=StringType(),
    source_file=StringType(),
)

DIM_SERVICE_TYPE = _struct(
    service_type_code=StringType(), service_type_name=StringType(), description=StringType()
)
