"""What the operators share: tables, stored intermediate results, words, held-out rows."""

import re
import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
_WORDS = re.compile(WORD)
ROWS_AT_ONCE = 1_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@cache
def _folder_of(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix=f"vinlake-{application}-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it in spark.checkpoint.dir.

    Only a session in one process, which has no executors elsewhere, may do without that setting.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _folder_of(context.applicationId)


def stored(rows: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write rows to the shared folder and go on with the files: computed once, safe from lost executors."""
    path = f"{shared_folder(rows.sparkSession)}/llm-{uuid4().hex}/{name}"
    rows.write.partitionBy(*partition_by).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def short_batches() -> None:
    """Let Python take texts ``ROWS_AT_ONCE`` at a time at most: the memory of a batch grows with its texts.

    It lowers the session's setting for Arrow batches and leaves a lower one alone.
    """
    conf, name = SparkSession.active().conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= ROWS_AT_ONCE:
        conf.set(name, str(ROWS_AT_ONCE))


def words(text: str | None) -> list[str]:
    """The runs of characters other than ASCII white space."""
    return _WORDS.findall(text) if text else []


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def unit_hash(*columns: Column | str) -> Column:
    """A number from 0 up to 1, the same for the same values in every run."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))
