"""Landing of the daily address files, each loaded once, with an audit row per file.

A file is taken whole or not at all. Landed rows and audit rows are two logs of upserts (``sources/merge_log.py``), keyed by
file and by pipeline and file. So a crash between the two writes, or a batch delivered twice, leads to the same tables, and
the number of folders grows with the logarithm of the loads, not with the files.
"""

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from vinlake.fixed_values import LANDING_PIPELINE
from vinlake.functions import blank_to_null, mixed_timestamp, strip_space, title_words
from vinlake.schemas import AUDIT_LOG, LANDED_ADDRESSES, RAW_CUSTOMER_ADDRESSES
from vinlake.sources import merge_log
from vinlake.sources.csv_records import left_open, never_closed
from vinlake.sources.files import list_files, read_text_columns, well_named

FILES_PER_LOAD = 1000  # bounds what one load keeps per file on the driver: name, header, counts
EXPECTED = RAW_CUSTOMER_ADDRESSES.names
LANDED_KEY, AUDIT_KEY = ("source_file",), ("pipeline", "source_file")
NUMBERS = ("id", "customer_id")  # whole numbers in the landing table; a file with any other fails


@dataclass(frozen=True)
class Arrival:
    """What is known about a file before its rows are parsed."""

    path: str
    name: str
    header: tuple[str, ...] = ()
    multi_line: bool = False  # some value has a line break in it, so lines are not records
    error: str | None = None


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The audit log: one row per pipeline and file, its latest outcome."""
    return merge_log.read(spark, path, AUDIT_LOG, *AUDIT_KEY)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """All landed addresses, of each file those of its last load."""
    return merge_log.read(spark, path, LANDED_ADDRESSES, *LANDED_KEY)


def not_loaded(files: DataFrame, audit: DataFrame) -> DataFrame:
    """Files without a successful load. Failed ones are tried again."""
    done = audit.where((F.col("pipeline") == LANDING_PIPELINE) & (F.col("status") == "success"))
    return files.join(done.select("source_file"), "source_file", "left_anti")


def whole_number(text: Column) -> Column:
    """A number of the size the table's ids have, NULL where the text is none; a missing text is missing."""
    return blank_to_null(text).try_cast("int")


def clean_addresses(rows: DataFrame) -> DataFrame:
    """Standard form for places and times; everything else as it came."""
    columns = {name: blank_to_null(F.col(name)) for name in EXPECTED}
    for place in ("city", "province"):
        columns[place] = title_words(strip_space(columns[place]))
    for name in NUMBERS:
        columns[name] = whole_number(columns[name])
    columns["created_at"] = mixed_timestamp(columns["created_at"])
    return rows.withColumns({**columns, "loaded_at": F.current_timestamp()})


HEADER_LENGTH = 65_536  # characters; no longer first line is taken for a header, nor sent to the driver


def _header_error(header: tuple[str, ...], known: Sequence[str] | None) -> str | None:
    unknown = sorted(set(header) - set(known)) if known is not None else []
    if unknown:
        return f"unknown column: {', '.join(unknown)}"
    return None if len(set(header)) == len(header) else "repeated column"


def inspect(spark: SparkSession, paths: Sequence[str], known: Sequence[str] | None = EXPECTED) -> list[Arrival]:
    """Header and health of each file, from one pass over their lines.

    Headers are split on the executors, and only those of a sane length reach the driver. Files in
    which a quoted field goes on over a line break are looked at once more, block by block.
    """
    line = F.col("value")
    number = F.monotonically_increasing_id()  # grows along the lines of a file's first block
    first_lines = (F.col("block_start") == 0) & (F.trim(line) != "")
    short = F.when(F.length(line) <= HEADER_LENGTH, line)
    names = F.transform(
        F.split(F.regexp_replace("first.value", "^\ufeff", ""), ",", -1),
        lambda name: F.lower(strip_space(F.regexp_replace(strip_space(name), '^"+|"+$', ""))),
    )
    seen = (
        spark.read.text(list(paths))
        .select("value", F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("block_start"))
        .withColumn("number", number)
        .groupBy("name")
        .agg(
            F.min(F.when(first_lines, F.struct("number", short.alias("value")))).alias("first"),
            F.max(left_open(line)).alias("open_lines"),
            F.min(F.is_valid_utf8(line)).alias("is_text"),
        )
        .select("name", F.col("first").isNotNull().alias("has_first"), names.alias("header"), "open_lines", "is_text")
    )
    found = {row.name: row for row in seen.collect()}
    across = [path for path in paths if (row := found.get(path.rsplit("/", 1)[-1])) and row.is_text and row.open_lines]
    unclosed = never_closed(spark, across) if across else set()
    arrivals = []
    for path in paths:
        name = path.rsplit("/", 1)[-1]
        row = found.get(name)
        if row is None or not row.has_first:
            arrivals.append(Arrival(path, name, error="no columns in file"))
        elif not row.is_text:
            arrivals.append(Arrival(path, name, error="not valid UTF-8"))
        elif row.header is None:
            arrivals.append(Arrival(path, name, error=f"first line has over {HEADER_LENGTH} characters"))
        elif name in unclosed:
            arrivals.append(Arrival(path, name, error="a quote is never closed"))
        else:
            header = tuple(row.header)
            arrivals.append(Arrival(path, name, header, row.open_lines, _header_error(header, known)))
    return arrivals


def read_arrivals(spark: SparkSession, arrivals: Sequence[Arrival]) -> DataFrame:
    """The rows of files, columns matched by name; a column that a file lacks is NULL."""
    alike = defaultdict(list)
    for arrival in arrivals:
        alike[arrival.header, arrival.multi_line].append(arrival.path)
    frames = []
    for (header, multi_line), paths in alike.items():
        rows = read_text_columns(spark, paths, list(header), multi_line)
        columns = [F.col(name) if name in header else F.lit(None).cast("string").alias(name) for name in EXPECTED]
        frames.append(rows.select(*columns, "_overflow", F.col("_file_name").alias("source_file")))
    return reduce(DataFrame.unionByName, frames)


def _count_rows(spark: SparkSession, arrivals: Sequence[Arrival]) -> dict[str, Row]:
    """Rows of each file, how many have more fields than the header, and how many an id that is no whole number."""
    rows = read_arrivals(spark, arrivals).groupBy("source_file")
    no_number = [blank_to_null(F.col(name)).isNotNull() & whole_number(F.col(name)).isNull() for name in NUMBERS]
    counts = rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("_overflow").alias("n_long"),
        F.count_if(reduce(or_, no_number)).alias("n_no_number"),
    )
    return {row.source_file: row for row in counts.collect()}


def _write_audit(spark: SparkSession, path: str, outcomes: list[tuple[str, str, int, str | None]]) -> None:
    rows = spark.createDataFrame(outcomes, "source_file STRING, status STRING, rows_loaded BIGINT, error_message STRING")
    stamped = rows.withColumns({"loaded_at": F.current_timestamp(), "pipeline": F.lit(LANDING_PIPELINE)})
    merge_log.upsert(stamped.select(*AUDIT_LOG.names).coalesce(1), stamped.select(*AUDIT_KEY), path)


def _load(spark: SparkSession, paths: Sequence[str], landing: str, audit: str) -> None:
    arrivals = inspect(spark, paths)
    outcomes = [(a.name, "failed", 0, a.error) for a in arrivals if a.error]
    sound = [a for a in arrivals if not a.error]
    counts = _count_rows(spark, sound) if sound else {}
    good = []
    for arrival in sound:
        seen = counts.get(arrival.name)
        if seen and seen.n_long:
            outcomes.append((arrival.name, "failed", 0, f"{seen.n_long} rows with more fields than the header"))
        elif seen and seen.n_no_number:
            outcomes.append((arrival.name, "failed", 0, f"{seen.n_no_number} rows with an id that is no whole number"))
        else:
            good.append(arrival)
            outcomes.append((arrival.name, "success", seen.n_rows if seen else 0, None))
    if good:
        rows = clean_addresses(read_arrivals(spark, good)).select(*LANDED_ADDRESSES.names)
        names = spark.createDataFrame([(arrival.name,) for arrival in good], "source_file STRING")
        merge_log.upsert(rows, names, landing)
    _write_audit(spark, audit, outcomes)


def is_file_error(error: PySparkException) -> bool:
    """Whether a failure is a file's own, not the cluster's."""
    text = f"{error.getCondition()} {error}"
    return any(mark in text for mark in ("FAILED_READ_FILE", "PATH_NOT_FOUND", "FileNotFoundException", "MALFORMED_CSV"))


def load_files(spark: SparkSession, paths: Sequence[str], landing: str, audit: str, again: bool = True) -> None:
    """Load files and log each. A file that cannot be read fails alone, with the whole error in the log.

    If a load breaks on a file, its files are loaded in two halves, down to the file at fault. Any
    other failure is not the files': it is tried once more, then raised, and nothing is logged.
    """
    try:
        _load(spark, paths, landing, audit)
    except PySparkException as error:
        if not is_file_error(error):
            if not again:
                raise
            load_files(spark, paths, landing, audit, again=False)
            return
        if len(paths) == 1:
            _write_audit(spark, audit, [(paths[0].rsplit("/", 1)[-1], "failed", 0, str(error))])
            return
        middle = len(paths) // 2
        load_files(spark, paths[:middle], landing, audit, again)
        load_files(spark, paths[middle:], landing, audit, again)


def tidy(spark: SparkSession, landing: str, audit: str) -> None:
    """Merge what small loads left behind, and remove what was merged long enough ago."""
    for path, schema, key in ((landing, LANDED_ADDRESSES, LANDED_KEY), (audit, AUDIT_LOG, AUDIT_KEY)):
        if list(merge_log.compact(spark, path, schema, *key)):
            merge_log.retire(spark, path)


def pending_paths(files: DataFrame, audit: DataFrame, after: str = "") -> list[str]:
    """Paths of the next files to load, in order of name: at most ``FILES_PER_LOAD``, with names after the given one."""
    pending = not_loaded(well_named(files), audit).where(F.col("source_file") > after)
    return [row.path for row in pending.orderBy("source_file").limit(FILES_PER_LOAD).collect()]


def land_addresses(spark: SparkSession, folder: str, landing: str, audit: str, day: str = "*") -> None:
    """Load the files of a day, or all, that were not loaded before."""
    files, after = list_files(spark, folder, day), ""
    while paths := pending_paths(files, read_audit(spark, audit), after):
        load_files(spark, paths, landing, audit)
        tidy(spark, landing, audit)
        after = paths[-1].rsplit("/", 1)[-1]
