"""Where intermediate results go, and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it then gets a temporary
    folder of its own.  On a cluster that folder would exist on one machine
    only, so a missing setting is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tamiz-"))
    return context.getCheckpointDir()


def checkpointed(frame: DataFrame) -> DataFrame:
    """``frame`` computed once into the shared folder; survives lost executors.
    For small results; Spark removes the files when they are no longer used if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


SCAN_TASKS, TASKS_A_CORE = "spark.sql.files.minPartitionNum", 4


@contextmanager
def balanced_scans(spark: SparkSession) -> Iterator[None]:
    """Scans have several tasks a core meanwhile, unless the session says how many at
    least.  Tables here hold a row in a few bytes: divided by their size alone, they
    make fewer tasks than it takes to keep all cores busy to the end."""
    given = spark.conf.get(SCAN_TASKS, None)
    if given is None:
        spark.conf.set(SCAN_TASKS, str(TASKS_A_CORE * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if given is None:
            spark.conf.unset(SCAN_TASKS)


class Scratch:
    """A folder of its own under the shared one, for the large intermediate
    tables of one run.  As a context manager it removes the folder at the end,
    so a run leaves nothing behind but its output tables."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_dir(spark).rstrip('/')}/tamiz/{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def stage(
        self, frame: DataFrame, name: str, partition_by: tuple[str, ...] = ()
    ) -> DataFrame:
        """``frame`` written as a table and read back, so later readers prune
        columns and partitions instead of recomputing it."""
        path = self.path(f"{name}-{uuid.uuid4().hex[:8]}")
        with balanced_scans(self.spark):
            frame.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure: object) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
