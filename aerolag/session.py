"""Session for local runs, and the one place that cuts lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Spark's setting by which the shuffle files of an action go when it ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", app: str = "aerolag") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the one the session names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster a
    machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="aerolag-checkpoint-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


@contextmanager
def shuffles_discarded(spark: SparkSession) -> Iterator[None]:
    """Frames planned and run in here leave no shuffle files: what they were for is written by then."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to :func:`checkpoint_folder`, free of its lineage."""
    checkpoint_folder(df.sparkSession)
    with shuffles_discarded(df.sparkSession):
        return df.select("*").checkpoint()


def new_folder(spark: SparkSession, kind: str) -> str:
    """A new folder in :func:`checkpoint_folder`, not made yet."""
    return f"{checkpoint_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """The same as Parquet: compressed and by column, for tables with as many rows as the flights.

    ``path`` may name the folder, so that :func:`discard` can delete it once nothing reads it any more.
    """
    path = path or new_folder(df.sparkSession, "stored")
    with shuffles_discarded(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`stored` has written."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
