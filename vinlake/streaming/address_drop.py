from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from vinlake.fixed_values import LANDING_GLOB
from vinlake.sources.landing import FILES_PER_LOAD, land_addresses, load_files, pending_paths, read_audit, tidy

# Files are never too old: their modification times say nothing about when they arrive.
FILE_AGE = "36500d"
FILE_COLUMNS = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def arriving_files(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of new files, content unread, at most ``FILES_PER_LOAD`` to a batch."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_COLUMNS)
        .option("pathGlobFilter", LANDING_GLOB.format("*", "csv"))
        .option("maxFilesPerTrigger", FILES_PER_LOAD)
        .option("maxFileAge", FILE_AGE)
        .load(folder)
    )
    return files.select("path", F.col("_metadata.file_name").alias("source_file"))


def stream_addresses(
    spark: SparkSession, folder: str, landing: str, audit: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Load files as they arrive: all present ones and stop, or keep watching if not ``once``.

    The checkpoint remembers which files were delivered and the audit log which were loaded. A batch
    delivered again after a crash skips what was logged and replaces what was not. Files that
    failed are left to the next batch run of ``land_addresses``, for a stream delivers a file once;
    so are empty files, which it does not deliver: see ``stream_once``.
    """

    def load(batch: DataFrame, _: int) -> None:
        after = ""
        while paths := pending_paths(batch, read_audit(batch.sparkSession, audit), after):
            load_files(batch.sparkSession, paths, landing, audit)
            tidy(batch.sparkSession, landing, audit)
            after = paths[-1].rsplit("/", 1)[-1]

    writer = arriving_files(spark, folder).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(**({"availableNow": True} if once else {"processingTime": "1 minute"})).start()


def stream_once(spark: SparkSession, folder: str, landing: str, audit: str, checkpoint: str) -> None:
    """Load what the stream delivers now, then what it passed over: empty files and files that failed before."""
    stream_addresses(spark, folder, landing, audit, checkpoint).awaitTermination()
    land_addresses(spark, folder, landing, audit)
