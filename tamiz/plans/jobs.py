"""The three batch jobs, from text files to tables, chosen by name."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tamiz import vocabulary as v
from tamiz.functions.text import render_row
from tamiz.operators.histogram import worker_name
from tamiz.operators.quality import StepReport, enforce_gate, reject_log, rejects_by_slice
from tamiz.operators.rules import REJECT_REASON, REJECTED, split
from tamiz.operators.slices import slice_of_index
from tamiz.plans import interest, statements, transactions
from tamiz.session import Scratch, balanced_scans
from tamiz.sources import delimited, parts, tables


@dataclass(frozen=True)
class JobResult:
    job_name: str
    run_id: str
    seconds: float
    counters: DataFrame
    detail: DataFrame
    summary: DataFrame | None = None


def _with_provenance(detail: DataFrame) -> DataFrame:
    return detail.withColumn("procesado_por_hilo", worker_name()).withColumn(
        "procesado_en", F.current_timestamp()
    )


def _write_rejects(warehouse: str, run_id: str, config: Any, *logs: DataFrame) -> dict[str, int]:
    """Adds the rejects to the error log; returns how many were rejected on reading."""
    columns = ("step_name", "etapa", "detalle_item", "mensaje_error")
    log = reduce(DataFrame.unionByName, [part.select(*columns) for part in logs])
    seen = Observation()
    log = log.observe(seen, F.count_if(F.col("etapa") == v.STAGE_READ).alias("saltados_lectura"))
    tables.write_run(
        log.withColumn("ocurrido_en", F.current_timestamp()),
        warehouse,
        tables.ERROR_LOG,
        job_name=config.job_name,
        run_id=run_id,
    )
    return seen.get


def _write_detail(
    detail: DataFrame, warehouse: str, table: tables.Table, run_id: str, seen: Observation | None = None
) -> dict[str, int]:
    """Writes a run's rows of the detail table; returns how many, by ``seen`` if that
    observes them already."""
    if seen is None:
        seen = Observation()
        detail = detail.observe(seen, F.count(F.lit(1)).alias("escritos"))
    tables.write_run(_with_provenance(detail), warehouse, table, run_id=run_id)
    return seen.get


def _stage_classified(
    scratch: Scratch, classified: DataFrame, name: str, lines: Column
) -> tuple[DataFrame, dict[str, int]]:
    """The classified rows, written once so that kept and rejected ones are read back by
    partition; and counts taken by that write: ``lines`` is how many lines a row stands for."""
    seen = Observation()
    observed = classified.observe(
        seen,
        F.sum(lines).alias("leidos"),
        (F.sum(lines) - F.count(F.lit(1))).alias("filtrados"),
        F.count_if(REJECTED).alias("saltados_proceso"),
    )
    return scratch.stage(observed, name, (REJECTED,)), seen.get


def _stage_rejected(
    scratch: Scratch, classified: DataFrame, config: Any
) -> tuple[DataFrame, dict[str, int]]:
    """The rejected rows as they were read, with the reason, written once; and their number.
    They are counted behind the filter, so of other rows only what it tests is worked out."""
    seen = Observation()
    rejected = classified.where(REJECTED).select(*config.fields, delimited.SEQ, REJECT_REASON)
    counted = rejected.observe(seen, F.count(F.lit(1)).alias("saltados_proceso"))
    return scratch.stage(counted, "rejected"), seen.get


def _check_gate(rejected: DataFrame, total: int, config: Any) -> None:
    """Fails the run when any row range of the input holds too many rejects.
    Slices are over all ``total`` lines; of the rejects only ``seq`` is read."""
    number = slice_of_index(F.col(delimited.SEQ), total, config.slices)
    by_slice = rejects_by_slice(rejected, number, F.lit(True), config.reject_limit)
    enforce_gate(by_slice, config.reject_limit)


def _malformed_log(lines: DataFrame, config: Any) -> DataFrame:
    return reject_log(
        delimited.malformed(lines), config.job_name, config.step_name, None, v.STAGE_READ
    )


def _process_log(rejected: DataFrame, config: Any, item: Column) -> DataFrame:
    return reject_log(rejected, config.job_name, config.step_name, item)


def _rows_of(detail: DataFrame, run_id: str) -> DataFrame:
    return detail.where(F.col(tables.RUN) == run_id)


def daily_report(
    scratch: Scratch,
    steps: StepReport,
    source: str,
    warehouse: str,
    run_id: str,
    config: transactions.TransactionsConfig = transactions.TransactionsConfig(),
) -> tuple[DataFrame, DataFrame]:
    spark = scratch.spark
    with steps.step(config.step_name) as counts:
        lines, total = delimited.stage_lines(scratch, source, config.fields)
        bad = delimited.malformed(lines)
        counts |= _write_rejects(warehouse, run_id, config, _malformed_log(lines, config))
        _check_gate(bad, total, config)
        rows = delimited.readable(lines)
        classified = transactions.classify_transactions(rows, config, delimited.SEQ)
        counts |= _write_detail(classified, warehouse, tables.TRANSACTIONS, run_id)
        counts["leidos"] = counts["escritos"]

    detail = tables.read_table(spark, warehouse, tables.TRANSACTIONS)
    with steps.step(v.DAILY_SUMMARY_STEP):
        added = transactions.daily_summary(_rows_of(detail, run_id))
        added = added.withColumn("anio", F.year("fecha"))
        parts.refresh_summary(scratch, added, warehouse, parts.DAILY_PARTS, run_id)
    return detail, tables.read_table(spark, warehouse, tables.DAILY_SUMMARY)


def monthly_interest(
    scratch: Scratch,
    steps: StepReport,
    source: str,
    warehouse: str,
    run_id: str,
    config: interest.InterestConfig = interest.InterestConfig(),
) -> tuple[DataFrame, None]:
    with steps.step(config.step_name) as counts:
        lines, total = delimited.stage_lines(scratch, source, config.fields)
        classified, seen = _stage_classified(
            scratch,
            interest.classify_accounts(delimited.readable(lines), config, delimited.SEQ),
            "accounts",
            F.col("copias"),
        )
        counts |= seen
        kept, rejected = split(classified)
        item = render_row(v.ACCOUNT_LABEL, v.ACCOUNT_PRINT_FIELDS)
        counts |= _log_and_check(lines, total, rejected, item, warehouse, run_id, config)
        detail = interest.interest_detail(kept, config)
        counts |= _write_detail(detail, warehouse, tables.ACCOUNTS, run_id)
    return tables.read_table(scratch.spark, warehouse, tables.ACCOUNTS), None


def annual_statements(
    scratch: Scratch,
    steps: StepReport,
    source: str,
    warehouse: str,
    run_id: str,
    config: statements.StatementsConfig = statements.StatementsConfig(),
) -> tuple[DataFrame, DataFrame]:
    spark = scratch.spark
    with steps.step(config.step_name) as counts:
        lines, total = delimited.stage_lines(scratch, source, config.fields)
        classified = statements.classify_movements(delimited.readable(lines))
        try:
            rejected, skipped = _stage_rejected(scratch, classified, config)
            counts |= skipped
            item = render_row(v.MOVEMENT_LABEL, v.MOVEMENT_PRINT_FIELDS)
            counts |= _log_and_check(lines, total, rejected, item, warehouse, run_id, config)
            kept, _ = split(classified)
            seen = Observation()
            detail = statements.movement_detail(kept, config, seen)
            counts |= _write_detail(detail, warehouse, tables.MOVEMENTS, run_id, seen)
        except Exception:
            # The log of a run that fails has it, too.
            counts["leidos"] = delimited.readable(lines).count()
            raise
        # Every row that was read is kept or rejected.
        counts["leidos"] = counts["escritos"] + counts["saltados_proceso"]

    detail = tables.read_table(spark, warehouse, tables.MOVEMENTS)
    with steps.step(v.STATEMENT_SUMMARY_STEP):
        keyed = F.col("cuenta_id").isNotNull() & F.col("fecha").isNotNull()
        added = statements.annual_statement(_rows_of(detail, run_id).where(keyed))
        parts.refresh_summary(scratch, added, warehouse, parts.STATEMENT_PARTS, run_id)
    return detail, tables.read_table(spark, warehouse, tables.ANNUAL_STATEMENT)


def _log_and_check(
    lines: DataFrame,
    total: int,
    rejected: DataFrame,
    item: Column,
    warehouse: str,
    run_id: str,
    config: Any,
) -> dict[str, int]:
    """Logs the rejected rows and malformed lines, and then lets them pass the gate."""
    counts = _write_rejects(
        warehouse, run_id, config, _process_log(rejected, config, item), _malformed_log(lines, config)
    )
    bad = delimited.malformed(lines).select(delimited.SEQ)
    _check_gate(rejected.select(delimited.SEQ).unionByName(bad), total, config)
    return counts


JOBS: dict[str, Callable[..., tuple[DataFrame, DataFrame | None]]] = {
    v.DAILY_REPORT_JOB: daily_report,
    v.MONTHLY_INTEREST_JOB: monthly_interest,
    v.ANNUAL_STATEMENT_JOB: annual_statements,
}


def run_job(
    spark: SparkSession,
    name: str,
    source: str,
    warehouse: str,
    run_id: str | None = None,
    config: Any = None,
) -> JobResult:
    """Runs the job called ``name`` over the text files at ``source`` and adds
    its results to the tables under ``warehouse``.

    Rejected rows are logged before the quality gate is checked, so a run that
    fails the gate leaves its evidence and no detail rows.
    """
    if name not in JOBS:
        raise ValueError(f"unknown job {name!r}; known: {', '.join(JOBS)}")
    if spark.conf.get("spark.sql.ansi.enabled", "true").lower() != "true":
        raise RuntimeError("needs spark.sql.ansi.enabled=true: sink casts must raise")
    run_id = run_id or uuid.uuid4().hex
    options = {} if config is None else {"config": config}
    started = time.monotonic()
    steps = StepReport(name)
    with Scratch(spark) as scratch, balanced_scans(spark):
        detail, summary = JOBS[name](scratch, steps, source, warehouse, run_id, **options)
    seconds = time.monotonic() - started
    return JobResult(name, run_id, seconds, steps.frame(spark), detail, summary)
