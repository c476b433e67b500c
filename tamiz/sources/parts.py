"""What each run adds to a summary, so that a run can be repeated or die at any time.

A summary is the sum of its parts.  The parts of a run are rows (key, measures,
run, version) in a segment folder of their year; nothing that is written is ever
overwritten.  A small register says what counts:

* ``publicado`` run, version: the rows of this version are the run's parts, those of
  earlier versions no longer are.  One small file makes a repeated run's parts
  replace the old ones at once.
* ``terminado`` run, version: the summary shows them.  Until then every key the run ever
  had can be found in its old rows, and the years they are in are added up anew
  as a whole by whichever run comes next, so a run that dies after any write
  leaves nothing wrong behind once it, or another one, has run.
* ``fundido`` segment, names: the segment holds what the named ones held.

Segments of single runs are folded into larger ones from ``SEGMENTS`` of them a year
on, and those into one from ``SEGMENTS`` on, so a year has a bounded number of folders
however many runs there are.  Rows keep their run, since it may be repeated, and
are sorted by key, so a refresh of a few keys skips most of them.

One job writes to a summary at a time.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tamiz.operators.histogram import add_up
from tamiz.session import Scratch
from tamiz.sources import tables

#: Segments of a kind that a year may have before they are folded into one.
SEGMENTS = 16
#: Files of the register before they are rewritten as one.
REGISTER_FILES = 64
PUBLISHED, DONE, FOLDED = "publicado", "terminado", "fundido"
VERSION, SEGMENT = "version", "tramo"
_OF_RUN, _OF_FOLD = "e-", "f-"
_ENTRY = f"hecho string, {tables.RUN} string, {VERSION} bigint, {SEGMENT} string, sustituye array<string>"


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [found.getPath().getName() for found in files.listStatus(place)] if files.exists(place) else []


class Register:
    """Append-only entries; a full generation is rewritten as the next one, and the
    newest complete generation counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _generation(self) -> str | None:
        complete = [g for g in _folders(self.spark, self.path) if "_SUCCESS" in _folders(self.spark, f"{self.path}/{g}")]
        return max(complete, default=None)

    def entries(self) -> DataFrame:
        generation = self._generation()
        if generation is None:
            return self.spark.createDataFrame([], _ENTRY)
        return self.spark.read.schema(_ENTRY).parquet(f"{self.path}/{generation}")

    def add(self, *entries: tuple) -> None:
        """All of the entries at once: they are one file."""
        generation = self._generation() or f"g{0:08d}"
        rows = self.spark.createDataFrame(list(entries), _ENTRY).coalesce(1)
        rows.write.mode("append").parquet(f"{self.path}/{generation}")

    def current(self) -> DataFrame:
        """(run, version) that counts."""
        return self._latest(PUBLISHED)

    def pending(self) -> DataFrame:
        """(run, version) that the summary may not show, or only in part."""
        return self.current().join(self._latest(DONE), [tables.RUN, VERSION], "left_anti")

    def _latest(self, fact: str) -> DataFrame:
        found = self.entries().where(F.col("hecho") == fact)
        return found.groupBy(tables.RUN).agg(F.max(VERSION).alias(VERSION))

    def folds(self) -> tuple[set[str], set[str]]:
        """Segments that hold others, and those they hold."""
        found = self.entries().where(F.col("hecho") == FOLDED).select(SEGMENT, "sustituye").collect()
        return {row[0] for row in found}, {name for row in found for name in row[1]}

    def shorten(self, living: set[str]) -> None:
        """Rewrites a long generation: the last facts of each run, and the folds of
        segments that are still there."""
        generation = self._generation()
        if generation is None or len(_folders(self.spark, f"{self.path}/{generation}")) <= REGISTER_FILES:
            return
        entries = self.entries()
        runs = entries.where(F.col("hecho") != FOLDED).groupBy("hecho", tables.RUN).agg(F.max(VERSION).alias(VERSION))
        nothing = F.lit(None).cast("string").alias(SEGMENT), F.lit(None).cast("array<string>").alias("sustituye")
        folds = entries.where((F.col("hecho") == FOLDED) & F.col(SEGMENT).isin(sorted(living)))
        kept = runs.select("hecho", tables.RUN, VERSION, *nothing).unionByName(folds)
        following = f"g{int(generation[1:]) + 1:08d}"
        kept.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{following}")
        for old in _folders(self.spark, self.path):
            if old < following:
                tables.remove(self.spark, f"{self.path}/{old}")


@dataclass(frozen=True)
class Parts:
    """The parts of ``summary``, whose measures are ``measures`` (a DDL text)."""

    name: str
    key: str
    measures: str
    summary: tables.Table

    @property
    def rows(self) -> tables.Table:
        return tables.Table(
            self.name,
            f"{self.key}, {self.measures}, {tables.RUN} string, {VERSION} bigint, anio int, {SEGMENT} string",
            partition=("anio", SEGMENT),
        )

    @property
    def identity(self) -> list[str]:
        return list(dict.fromkeys((*self.summary.key, *self.summary.partition)))

    def register(self, spark: SparkSession, warehouse: str) -> Register:
        return Register(spark, f"{warehouse.rstrip('/')}/{self.name}_registro")

    def written(self, spark: SparkSession, warehouse: str) -> DataFrame:
        """The rows of all versions, once each."""
        folds, replaced = self.register(spark, warehouse).folds()
        segment = F.col(SEGMENT)
        rows = tables.read_table(spark, warehouse, self.rows)
        whole = segment.startswith(_OF_RUN) | segment.isin(sorted(folds))
        return rows.where(whole & ~segment.isin(sorted(replaced)))

    def living(self, spark: SparkSession, warehouse: str) -> DataFrame:
        """The rows that count."""
        current = self.register(spark, warehouse).current()
        return self.written(spark, warehouse).join(F.broadcast(current), [tables.RUN, VERSION], "left_semi")


DAILY_PARTS = Parts(
    "resumen_transacciones_diarias_por_ejecucion", "fecha date", tables.DAILY_MEASURES, tables.DAILY_SUMMARY
)
STATEMENT_PARTS = Parts(
    "estado_cuenta_anual_por_ejecucion", "cuenta_id bigint", tables.STATEMENT_MEASURES, tables.ANNUAL_STATEMENT
)


def refresh_summary(scratch: Scratch, added: DataFrame, warehouse: str, parts: Parts, run_id: str) -> None:
    """Makes ``added`` the parts of run ``run_id`` and brings the summary up to date.

    Only keys that the run adds to, or ever added to, can change: they are added
    up over the living parts, and replaced or, where no run has them any more,
    removed.  Years in which a run died before are added up as a whole.
    """
    spark, identity = scratch.spark, parts.identity
    register = parts.register(spark, warehouse)
    before = parts.written(spark, warehouse)
    # One value per year of runs that died.
    unsure = before.join(F.broadcast(register.pending()), tables.RUN, "left_semi")
    unsure = [row[0] for row in unsure.select("anio").distinct().collect()]
    healed = [(DONE, *row, None, None) for row in register.pending().collect()]
    of_run = F.col(tables.RUN) == run_id

    published = register.entries().agg(F.max(VERSION)).first()[0] or 0
    version = 1 + max(published, before.where(of_run).agg(F.max(VERSION)).first()[0] or 0)
    rows = added.withColumn(tables.RUN, F.lit(run_id)).withColumn(VERSION, F.lit(version))
    _write_segment(rows, warehouse, parts, f"{_OF_RUN}{run_id}-v{version}")
    register.add((PUBLISHED, run_id, version, None, None))

    # A key once for each version: joins that only test for it need no more.
    keys = parts.written(spark, warehouse).where(of_run).select(*identity)
    years = sorted({row[0] for row in keys.select("anio").distinct().collect()} | set(unsure))
    living = parts.living(spark, warehouse).where(F.col("anio").isin(years))
    in_whole = F.col("anio").isin(unsure)
    of_keys = living.where(~(in_whole | of_run)).join(keys, identity, "left_semi")
    found = living.where(in_whole | of_run).unionByName(of_keys)
    # A key has one row for each run, so nothing would combine before the shuffle: rows
    # go there as they are, which is half of what partial sums take.
    totals = add_up(found.repartition(*identity), *identity, leaving_out=(tables.RUN, VERSION, SEGMENT))
    totals = totals.withColumn("generado_en", F.current_timestamp())
    tables.refresh(totals, keys, warehouse, parts.summary, whole=unsure)
    # Runs that died are shown too now: their years were added up from what they published.
    healed = [entry for entry in healed if entry[1] != run_id]
    register.add((DONE, run_id, version, None, None), *healed)
    fold_segments(spark, warehouse, parts, years)


def _write_segment(rows: DataFrame, warehouse: str, parts: Parts, name: str) -> None:
    rows = tables.conform(rows.withColumn(SEGMENT, F.lit(name)), parts.rows)
    sorted_rows = rows.sortWithinPartitions("anio", *parts.summary.key)
    sorted_rows.write.mode("append").partitionBy(*parts.rows.partition).parquet(parts.rows.path(warehouse))


def fold_segments(spark: SparkSession, warehouse: str, parts: Parts, years: list[int]) -> None:
    """Folds the segments of the years that have many of them.  No run is pending, so
    rows of old versions are left behind."""
    register, path = parts.register(spark, warehouse), parts.rows.path(warehouse)
    living: set[str] = set()
    for year in years:
        folder = f"{path}/anio={year}"
        folds, replaced = register.folds()
        for name in _segments(spark, folder):  # what a fold that died has left
            if name in replaced or (name.startswith(_OF_FOLD) and name not in folds):
                tables.remove(spark, f"{folder}/{SEGMENT}={name}")
        for kind in (_OF_RUN, _OF_FOLD):
            names = [name for name in _segments(spark, folder) if name.startswith(kind)]
            if len(names) <= SEGMENTS:
                continue
            rows = parts.living(spark, warehouse).where((F.col("anio") == year) & F.col(SEGMENT).isin(names))
            folded = f"{_OF_FOLD}{uuid.uuid4().hex}"
            _write_segment(rows.repartitionByRange(*parts.summary.key), warehouse, parts, folded)
            register.add((FOLDED, None, None, folded, names))
            for name in names:
                tables.remove(spark, f"{folder}/{SEGMENT}={name}")
    for folder in _folders(spark, path):
        living |= set(_segments(spark, f"{path}/{folder}"))
    register.shorten(living)


def _segments(spark: SparkSession, folder: str) -> list[str]:
    return sorted(
        match.group(1) for name in _folders(spark, folder) if (match := re.fullmatch(f"{SEGMENT}=(.+)", name))
    )
