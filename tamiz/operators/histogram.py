"""Row counts by status or by worker, and sums of summaries made in parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def status_histogram(detail: DataFrame, status: str = "estado") -> DataFrame:
    return detail.groupBy(status).agg(F.count(F.lit(1)).alias("cantidad"))


def rows_per_worker(detail: DataFrame, worker: str = "procesado_por_hilo") -> DataFrame:
    """Evidence of parallel work: rows by the worker noted in the detail table."""
    return detail.groupBy(worker).agg(F.count(F.lit(1)).alias("cantidad"))


def add_up(parts: DataFrame, *keys: str, leaving_out: tuple[str, ...] = ()) -> DataFrame:
    """Summaries of disjoint parts of a table, added up per key to the summary
    of the whole.  For measures that are counts and sums."""
    measures = [name for name in parts.columns if name not in {*keys, *leaving_out}]
    return parts.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in measures])


def worker_name() -> Column:
    return F.concat(F.lit("particion-"), F.spark_partition_id().cast("string"))
