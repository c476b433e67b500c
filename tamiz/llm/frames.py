"""Small helpers on DataFrames that the operators share."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Hashable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

import tamiz
from tamiz.session import Scratch

#: Largest table sent to every executor; larger ones are joined by shuffle.
BROADCAST_BYTES = 8 << 20


def broadcast_if_small(frame: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``frame`` (already written, so counting it is cheap) with a broadcast hint
    if its rows of at most ``row_bytes`` bytes fit into ``limit``."""
    return F.broadcast(frame) if frame.count() * row_bytes <= limit else frame


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of a partition sorted by ``key``, in tables that never cut a group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = batch.column(key)[batch.num_rows - 1]
        if held and held[-1].column(key)[held[-1].num_rows - 1] == last and batch.column(key)[0] == last:
            held.append(batch)
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int((keys != keys[-1]).sum())
        if cut:
            held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held = []
        elif held:
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


_kept: dict[Hashable, object] = {}


def kept_in_worker(key: Hashable, make: Callable[[], object]) -> object:
    """What a Python worker keeps between tasks: one object, of the operator that ran last."""
    if key not in _kept:
        forget_in_worker()
        _kept[key] = make()
    return _kept[key]


def forget_in_worker() -> None:
    """Gives back to the system what earlier tasks, of whichever operator, have left in this worker."""
    if _kept:
        _kept.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, as
    ``--py-files`` would: executors need not have it installed."""
    context, name = spark.sparkContext, f"{tamiz.__name__}-workers.zip"
    if any(os.path.basename(path) == name for path in context._python_includes):
        return
    root = Path(tamiz.__file__).parent
    path = os.path.join(tempfile.mkdtemp(prefix="tamiz-"), name)
    with zipfile.ZipFile(path, "w") as bundle:
        for source in sorted(root.rglob("*.py")):
            bundle.write(source, source.relative_to(root.parent))
    context.addPyFile(path)


class Workspace(Scratch):
    """A scratch folder whose tables can be dropped one by one, by name."""

    def drop(self, *names: str) -> None:
        """Deletes the tables staged under ``names``; nothing unfinished may read them."""
        for name in names:
            pattern = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(f"{name}-*"))
            files = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for found in files.globStatus(pattern) or []:
                files.delete(found.getPath(), True)


def scratch_of(frame: DataFrame) -> Workspace:
    """A folder of intermediate tables for one call, in the shared folder."""
    ship_package(frame.sparkSession)
    return Workspace(frame.sparkSession)
