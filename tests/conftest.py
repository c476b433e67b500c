import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tamiz tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def text_rows(spark, values, name="texto"):
    """One text column with the values in order, numbered."""
    return spark.createDataFrame(
        [(position, value) for position, value in enumerate(values)], f"n int, {name} string"
    )


def in_order(frame, *columns):
    return [tuple(row[column] for column in columns) for row in frame.orderBy("n").collect()]


def physical_plan(frame) -> str:
    return frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "simple")


def write_text(path, lines):
    with open(path, "w", encoding="utf-8", newline="\n") as out:
        out.write("\n".join(lines) + "\n")
    return str(path)
