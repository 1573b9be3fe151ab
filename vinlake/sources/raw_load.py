"""The raw loads: source tables and the latest address file, as they are, plus metadata."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinlake.functions import blank_to_null
from vinlake.sources.files import find_files, latest_file, read_text_columns, with_load_metadata
from vinlake.sources.landing import inspect
from vinlake.sources.tables import replace_files, replace_from_snapshot, snapshot


def load_source_table(rows: DataFrame, target: str, ingestion_date: str | None = None, source: str = "mysql") -> int:
    """Replace a raw table with the rows of a source table and return the number of rows."""
    return replace_files(with_load_metadata(rows, ingestion_date, _source=source), target)


def read_address_file(spark: SparkSession, path: str) -> DataFrame:
    """An address file as it is, every column text and missing texts NULL.

    The file is taken whole or not at all: without a header, with bytes that are no UTF-8, a quote that is
    never closed or a row of more fields than the header it raises an error that says so. Quoted values may
    hold line breaks.
    """
    (arrival,) = inspect(spark, [path], known=None)
    if arrival.error:
        raise ValueError(f"{arrival.name}: {arrival.error}")
    rows = read_text_columns(spark, [path], list(arrival.header), arrival.multi_line)
    n_long = rows.where(F.col("_overflow").isNotNull()).count()
    if n_long:
        raise ValueError(f"{arrival.name}: {n_long} rows with more fields than the header")
    return rows.select(*[blank_to_null(F.col(f"`{name}`")).alias(name) for name in arrival.header])


def load_latest_addresses(
    spark: SparkSession, folder: str, lake: str, target: str, ingestion_date: str | None = None
) -> int:
    """Replace the raw address table with the file modified last, kept in the lake as well."""
    day = ingestion_date or date.today().isoformat()
    path, name = latest_file(find_files(spark, folder))
    rows = read_address_file(spark, path)
    snapshot(with_load_metadata(rows, day, _source_file=name), lake, day)
    return replace_from_snapshot(spark, lake, day, target)
