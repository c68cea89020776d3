"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
STRING_BYTES = 64
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_ready(spark: SparkSession) -> None:
    """Make sure checkpoints can be written.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    session without one gets a temporary folder: executors of a cluster could
    not read it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="asphalt-checkpoint-")
    context.setCheckpointDir(folder)


def materialise(df: DataFrame) -> DataFrame:
    """Compute a table once that several later steps read.

    Meant for aggregates that are far smaller than the accidents they come
    from: without it each reader would scan the accidents again. The copy is in
    the shared checkpoint folder, so it survives the loss of an executor.
    """
    checkpoint_ready(df.sparkSession)
    return df.checkpoint()


def read_by(df: DataFrame, tasks: int | None) -> DataFrame:
    """A materialised table read by so many tasks at most, however many files it has."""
    return df if tasks is None else df.coalesce(tasks)


def scan_tasks(df: DataFrame) -> int:
    """Tasks for tables that grow like this one: as many as scan it, but no fewer than the session has cores.

    Meant for plain scans: to count its tasks, Spark computes any other table up to its last exchange.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions())


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it a query's shuffle files go as soon as it has run, not when the driver collects its garbage.

    Meant for long chains of checkpoints: what was shuffled for one is never
    read again. A session that set this itself keeps its value.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a materialised table whose counted rows are small; a larger one is joined by shuffle.

    Rows are taken at the width of the table's types, strings at ``STRING_BYTES``.
    """
    width = 16 + sum(STRING_BYTES if f.dataType.typeName() in ("string", "binary") else 16 for f in df.schema)
    most = max_bytes // width
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def job_session(name: str) -> SparkSession:
    """The session of a submitted job; checkpoints go when they are no longer used."""
    return (
        SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate()
    )


def local_session(cores: int | str = "*", name: str = "asphalt", **settings: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
