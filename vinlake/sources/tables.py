"""Writing and reading tables."""

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vinlake.schemas import RAW_TABLES
from vinlake.session import remove_folder
from vinlake.sources.clustering import clustered, cut_points
from vinlake.sources.versions import commit, latest, swap


ROW_PLACE = StructType([StructField("file", LongType()), StructField("row", LongType())])


def with_loaded_at(rows: DataFrame) -> DataFrame:
    """Add the time of the load, the last column of facts and reports."""
    return rows.withColumn("dbt_loaded_at", F.current_timestamp())


def schema_for(custom: str | None, default: str) -> str:
    """The schema a model is written to: its own if it names one, else the default one."""
    return default if custom is None else custom.strip()


def replace_files(rows: DataFrame, path: str) -> int:
    """Replace a Parquet table and return its number of rows, read from the file footers.

    The new table is written beside the old one and takes its place when it is complete: a load that fails changes nothing.
    """
    spark, (folder, name) = rows.sparkSession, path.rstrip("/").rsplit("/", 1)
    new = f"{folder}/.{name}-new-{uuid4().hex}"
    try:
        rows.write.parquet(new)
    except BaseException:
        remove_folder(spark, new)
        raise
    swap(spark, new, path)
    return spark.read.schema(rows.schema).parquet(path).count()


def replace_partitions(rows: DataFrame, path: str, *partitions: str) -> None:
    """Replace just the partitions that occur in ``rows``. Repeating a load changes nothing."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def snapshot(rows: DataFrame, path: str, ingestion_date: str) -> None:
    """Keep the rows under ``ingestion_date=YYYY-MM-DD``, replacing an earlier load of that day."""
    replace_partitions(rows.withColumn("ingestion_date", F.lit(ingestion_date)), path, "ingestion_date")


def replace_from_snapshot(spark: SparkSession, path: str, ingestion_date: str, target: str) -> int:
    """Replace a raw table with one day's snapshot and return its number of rows."""
    return replace_files(spark.read.parquet(f"{path}/ingestion_date={ingestion_date}"), target)


def as_view(rows: DataFrame, name: str) -> DataFrame:
    """Name a plan. It is computed anew by each reader."""
    rows.createOrReplaceTempView(name)
    return rows.sparkSession.table(name)


def as_table(rows: DataFrame, path: str) -> DataFrame:
    """Write a table to a new folder, in full, and return it as stored."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def publish(spark: SparkSession, folder: str, run: str) -> int:
    """Make a finished run the one that readers of the folder see, and return its version.

    Readers see the earlier run or the new one, and a run that dies before this point changes nothing for them. Of two
    builds that end at once both are published, one after the other.
    """
    return commit(spark, folder, run)


def published(spark: SparkSession, folder: str) -> str | None:
    """The run that was published last, None if there is none."""
    return latest(spark, folder)[1]


def by_month(rows: DataFrame, day: str, month: str, *cluster_by: str) -> DataFrame:
    """Lay rows out for a table partitioned by month and clustered within it.

    Range partitioning by month, clustering columns and key cuts a month with very many rows into
    several files, each with its own range of clustering values, so that readers can skip files.
    """
    laid_out = rows.withColumn(month, F.trunc(day, "month"))
    order = [month, *cluster_by]
    return laid_out.repartitionByRange(*order).sortWithinPartitions(*order)


def as_monthly_table(rows: DataFrame, path: str, day: str, cluster_by: list[str], key: str) -> DataFrame:
    """Write a table partitioned by the month of ``day`` to a new folder, clustered by all given columns and the key alike.

    The month column is named ``<day>_month``; readers filter on it to prune partitions. The rows are computed once and
    kept beside the table until it is complete: cut points, ranges and the table itself are then taken from files.
    """
    spark, (folder, name), month = rows.sparkSession, path.rstrip("/").rsplit("/", 1), f"{day}_month"
    dated = rows.withColumn(month, F.trunc(day, "month"))
    beside = f"{folder}/.{name}-unordered-{uuid4().hex}"
    try:
        dated.write.parquet(beside)
        kept = spark.read.schema(dated.schema).parquet(beside)
        cuts = cut_points(kept, list(dict.fromkeys([*cluster_by, key])))
        clustered(kept, month, cuts, key).write.partitionBy(month).parquet(path)
    finally:
        remove_folder(spark, beside)
    return spark.read.schema(dated.schema).parquet(path)


def days_between(rows: DataFrame, day: str, first: str, last: str) -> DataFrame:
    """Rows of a span of days of a monthly table, reading only the months it touches."""
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    months = F.col(f"{day}_month").between(F.trunc(low, "month"), F.trunc(high, "month"))
    return rows.where(months & F.col(day).between(low, high))


def read_raw(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A declared raw table stored as Parquet, in its declared types, without load metadata.

    ``_row_id`` says where a row lies, so that copies of a row can be told apart.
    """
    stored = spark.read.parquet(path)
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    declared = RAW_TABLES[name]
    numbered = StructType([*declared.fields, StructField("_row_id", ROW_PLACE)])
    return stored.select(*declared.names, place.alias("_row_id")).to(numbered)
