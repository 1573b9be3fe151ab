"""Finding and reading files of a drop folder."""

from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vinlake.fixed_values import LANDING_GLOB, LANDING_NAME
from vinlake.sources.csv_records import records_of

CSV_OPTIONS = {"header": "true", "escape": '"', "encoding": "UTF-8", "mode": "PERMISSIVE"}


def find_files(spark: SparkSession, folder: str, day: str = "*", kind: str = "csv") -> DataFrame:
    """Files of a day (``yyyymmdd``), or of any day, by name. Their content is not read.

    ``kind`` is a file extension, or several: ``{csv,xlsx}``. Scans pass over empty files.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", LANDING_GLOB.format(day, kind)).load(folder)
    return files.select(
        "path", F.col("_metadata.file_name").alias("source_file"), F.col("modificationTime").alias("modified_at")
    )


def list_files(spark: SparkSession, folder: str, day: str = "*") -> DataFrame:
    """The same with empty files, from the list of files that Spark keeps for a scan."""
    paths = [unquote(path) for path in find_files(spark, folder, day).inputFiles()]
    return spark.createDataFrame([(path, path.rsplit("/", 1)[-1]) for path in paths], "path STRING, source_file STRING")


def well_named(files: DataFrame) -> DataFrame:
    """Files whose name carries a full date."""
    return files.where(F.col("source_file").rlike(LANDING_NAME))


def latest_file(files: DataFrame) -> tuple[str, str]:
    """Path and name of the file modified last."""
    newest = files.agg(F.max(F.struct("modified_at", "source_file", "path")).alias("file")).first().file
    if newest is None:
        raise FileNotFoundError("no address file found")
    return newest.path, newest.source_file


def read_text_columns(spark: SparkSession, paths: list[str], names: list[str], multi_line: bool = False) -> DataFrame:
    """CSV files that share a header, every column text; ``_overflow`` has what exceeds the header, ``_file_name`` the file.

    Lines are records, or, where quoted values hold line breaks, are put together to records. Files are split either way.
    """
    schema = StructType([StructField(name, StringType()) for name in [*names, "_overflow"]])
    if not multi_line:
        rows = spark.read.schema(schema).options(**CSV_OPTIONS).csv(paths)
        return rows.select("*", F.col("_metadata.file_name").alias("_file_name"))
    options = {**CSV_OPTIONS, "header": "false", "multiLine": "true"}
    parsed = F.from_csv("record", schema.toDDL(), options).alias("_row")
    return records_of(spark, paths).select(parsed, F.col("source_file").alias("_file_name")).select("_row.*", "_file_name")


def with_load_metadata(rows: DataFrame, ingestion_date: date | str | None = None, **origin: str) -> DataFrame:
    """Add ``_ingestion_date`` and ``_loaded_at``, as text, and the origin, e.g. ``_source="mysql"``."""
    day = F.current_date() if ingestion_date is None else F.lit(str(ingestion_date))
    return rows.withColumns(
        {
            "_ingestion_date": day.cast("string"),
            "_loaded_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            **{name: F.lit(value) for name, value in origin.items()},
        }
    )
