"""Reject log, run counters and the quality gate."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tamiz import vocabulary as v
from tamiz.functions.text import truncate
from tamiz.operators.rules import REJECT_REASON, REJECTED

_log = logging.getLogger(__name__)

LOG_COLUMNS = ("job_name", "step_name", "etapa", "detalle_item", "mensaje_error")


STEP_COUNTERS = (
    "leidos", "escritos", "filtrados", "saltados_lectura", "saltados_proceso", "saltados_escritura",
)
_STEP_SCHEMA = "job_name string, step_name string, estado string, segundos double, " + ", ".join(
    f"{name} bigint" for name in (*STEP_COUNTERS, "total_saltados")
)


class StepReport:
    """Status, duration and counters of the steps of a run, also of one that fails."""

    def __init__(self, job_name: str):
        self.job_name = job_name
        self.rows: list[tuple] = []

    @contextmanager
    def step(self, name: str) -> Iterator[dict[str, int]]:
        """Times a step; what it puts into the dictionary are its counters, 0 if not given."""
        counts: dict[str, int] = {}
        started, status = time.monotonic(), v.FAILED
        try:
            yield counts
            status = v.COMPLETED
        finally:
            values = [counts.get(counter) or 0 for counter in STEP_COUNTERS]
            skipped = sum(values[STEP_COUNTERS.index("saltados_lectura") :])
            self.rows.append((self.job_name, name, status, time.monotonic() - started, *values, skipped))
            _log.info("%s %s %s: %.1f s, %s", self.job_name, name, status, self.rows[-1][3], counts)

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per step, in order."""
        return spark.createDataFrame(self.rows, _STEP_SCHEMA).coalesce(1)


class QualityGateError(RuntimeError):
    """A slice of the feed has more rejected rows than the limit allows."""


def reject_log(
    rejected: DataFrame,
    job_name: str,
    step_name: str,
    item: Column | None,
    stage: str = v.STAGE_PROCESS,
    reason: str = REJECT_REASON,
) -> DataFrame:
    """One log row per rejected row, after its other columns.  ``item`` is the
    row as text; a line that could not be read has none."""
    return rejected.select(
        *[name for name in rejected.columns if name not in {*LOG_COLUMNS, REJECTED, reason}],
        F.lit(job_name).alias("job_name"),
        F.lit(step_name).alias("step_name"),
        F.lit(stage).alias("etapa"),
        (F.lit(None).cast("string") if item is None else truncate(item, v.LOG_TEXT_WIDTH)).alias(
            "detalle_item"
        ),
        truncate(F.col(reason), v.LOG_TEXT_WIDTH).alias("mensaje_error"),
    )


def newest_first(error_log: DataFrame) -> DataFrame:
    return error_log.orderBy(F.desc("ocurrido_en"))


def run_counters(
    job_name: str,
    step_name: str,
    processed: DataFrame,
    rejected: Column,
    copies: str | None = None,
    unreadable: DataFrame | None = None,
) -> DataFrame:
    """One row: lines read, written, filtered and skipped, by stage.

    ``processed`` has one row per distinct line; ``copies`` names its column
    with the number of lines each stands for (one, if not given).  All counts
    are plain aggregates, so they stay exact when tasks are retried.
    """
    nothing = F.lit(0).cast("long")
    counts = processed.agg(
        (F.sum(copies) if copies else F.count(F.lit(1))).alias("leidos"),
        F.count(F.lit(1)).alias("unicos"),
        nothing.alias("saltados_lectura"),
        F.count_if(rejected).alias("saltados_proceso"),
    )
    if unreadable is not None:
        counts = counts.unionByName(
            unreadable.agg(
                nothing.alias("leidos"),
                nothing.alias("unicos"),
                F.count(F.lit(1)).alias("saltados_lectura"),
                nothing.alias("saltados_proceso"),
            )
        ).agg(
            *[
                F.sum(name).alias(name)
                for name in ("leidos", "unicos", "saltados_lectura", "saltados_proceso")
            ]
        )
    read = F.coalesce(F.col("leidos"), nothing)
    skipped = F.col("saltados_lectura") + F.col("saltados_proceso")
    return counts.select(
        F.lit(job_name).alias("job_name"),
        F.lit(step_name).alias("step_name"),
        read.alias("leidos"),
        (F.col("unicos") - F.col("saltados_proceso")).alias("escritos"),
        (read - F.col("unicos")).alias("filtrados"),
        "saltados_lectura",
        "saltados_proceso",
        # A row that cannot be stored fails the run: nothing is skipped on write.
        nothing.alias("saltados_escritura"),
        skipped.alias("total_saltados"),
    )


def rejects_by_slice(rows: DataFrame, number: Column, rejected: Column, limit: int) -> DataFrame:
    """Rows and rejects of each slice, and whether it is over the limit.
    Exactly ``limit`` rejects pass; one more does not."""
    return (
        rows.groupBy(number.alias("particion"))
        .agg(F.count(F.lit(1)).alias("filas"), F.count_if(rejected).alias("rechazos"))
        .withColumn("excede", F.col("rechazos") > limit)
    )


def enforce_gate(by_slice: DataFrame, limit: int) -> None:
    """Raises if any slice is over the limit.  The table has one row per slice."""
    over = by_slice.where("excede").orderBy("particion").collect()
    if over:
        found = ", ".join(f"slice {row['particion']}: {row['rechazos']}" for row in over)
        raise QualityGateError(f"more than {limit} rejected rows in a slice ({found})")
