"""``python -m tamiz JOB --source PATH --warehouse PATH``: run one job by name."""

from __future__ import annotations

import argparse
from typing import Any

from pyspark.sql import SparkSession

from tamiz import vocabulary as v
from tamiz.plans.interest import InterestConfig
from tamiz.plans.jobs import JOBS, run_job
from tamiz.plans.statements import StatementsConfig
from tamiz.plans.transactions import TransactionsConfig

CONFIGS = {
    v.DAILY_REPORT_JOB: TransactionsConfig,
    v.MONTHLY_INTEREST_JOB: InterestConfig,
    v.ANNUAL_STATEMENT_JOB: StatementsConfig,
}


def _rate(text: str) -> tuple[str, str]:
    name, equals, rate = text.partition("=")
    if not equals:
        raise argparse.ArgumentTypeError(f"{text!r} is not NAME=RATE")
    return name, rate


def _config(job: str, chosen: argparse.Namespace) -> Any:
    """The job's settings with those given on the command line."""
    given: dict[str, Any] = {"reject_limit": chosen.reject_limit, "slices": chosen.slices}
    if job == v.MONTHLY_INTEREST_JOB:
        given |= {"min_age": chosen.min_age, "max_age": chosen.max_age}
        given["rates"] = dict(chosen.rate) if chosen.rate else None
    return CONFIGS[job](**{name: value for name, value in given.items() if value is not None})


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tamiz")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--source", required=True, help="delimited files of the feed")
    parser.add_argument("--warehouse", required=True, help="folder of the output tables")
    parser.add_argument("--run-id", help="repeat a run: replaces that run's rows")
    parser.add_argument("--reject-limit", type=int, help="rejected rows a slice may have")
    parser.add_argument("--slices", type=int, help="slices that the limit is checked for")
    parser.add_argument("--min-age", type=int, help="interest job: lowest age used")
    parser.add_argument("--max-age", type=int, help="interest job: highest age used")
    parser.add_argument(
        "--rate", type=_rate, action="append", metavar="NAME=RATE",
        help="interest job: rate of a category; once for each, all others are unknown",
    )
    chosen = parser.parse_args(arguments)
    spark = (
        SparkSession.builder.appName(f"tamiz {chosen.job}")
        # A generated method above 8000 bytes is never compiled to machine code.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    config = _config(chosen.job, chosen)
    result = run_job(spark, chosen.job, chosen.source, chosen.warehouse, chosen.run_id, config)
    print(f"{result.job_name} run {result.run_id}: {result.seconds:.1f} s")
    for row in result.counters.collect():
        print(", ".join(f"{name}={value}" for name, value in row.asDict().items()))


if __name__ == "__main__":
    main()
