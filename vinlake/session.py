from uuid import uuid4

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: coalesce small partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Hash instead of sort-merge where every partition of the build side is small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Strict casts fail, safe casts give NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(app: str = "vinlake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the models are designed for.

    Shuffle partitions are left to the cluster: give ``spark.sql.shuffle.partitions`` about the
    shuffled bytes over 128 MB, and adaptive execution merges what turns out too small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, wanted: str | None = None) -> str:
    """A new folder for a run's intermediate tables: in the wanted folder, else in the shared one that the cluster names."""
    shared = wanted or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("spark.checkpoint.dir is not set and no other folder was given")
    return f"{shared.rstrip('/')}/vinlake-{uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that a run has made, in whatever file system it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
