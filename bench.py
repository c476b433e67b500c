"""Seconds per registered query; prints one JSON line.

Each query is run to completion over the whole tables at ``$BENCH_SF_DIR`` on
``local[$BENCH_CPUS]``, every row and column of its result computed.  One small
warm-up query is not counted: it pays for starting the engine, not for work.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from tamiz.catalog.queries import QUERIES


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tamiz bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        # A generated method above 8000 bytes is never compiled to machine code.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(result: DataFrame) -> None:
    result.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    run(spark.read.parquet(f"{sf_dir}/region.parquet"))
    chosen = sys.argv[1:] or list(QUERIES)
    seconds = {}
    for name in chosen:
        started = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - started, 3)
    scale = re.search(r"sf([\d.]+)/?$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total wall-clock of all registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
