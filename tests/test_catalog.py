"""Every registered query against its SQL, and the shape of its plan."""

import os

import duckdb
import pytest
from conftest import physical_plan

import __spark_entry__ as contract
from tamiz.catalog.oracle import ORACLE
from tamiz.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("customer", "lineitem", "orders")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return connection


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda place: columns[place])
    return sorted(repr([row[place] for place in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, database, name):
    frame = contract.queries()[name](spark, SF_DIR)
    cursor = database.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    expected = sorted_rows(columns, cursor.fetchall())
    assert expected, "the check must see rows"
    assert sorted_rows(frame.columns, [tuple(row) for row in frame.collect()]) == expected


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_rows_by_worker_accounts_for_every_row(spark, database):
    """Every task that wrote rows is one worker, and their counts are those of its rows."""
    found = {r.procesado_por_hilo: r.cantidad for r in QUERIES["rows_by_worker"](spark, SF_DIR).collect()}
    (orders,) = database.execute("select count(*) from orders").fetchone()
    assert sum(found.values()) == orders and len(found) >= 1
    assert all(name.startswith("particion-") and count > 0 for name, count in found.items())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns[0] == "fecha" and frame.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_stay_on_the_engine(spark, name):
    plan = physical_plan(contract.queries()[name](spark, SF_DIR))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
        assert operator not in plan, operator


def test_flagship_reads_the_columns_it_needs_and_shuffles_only_the_sums(spark):
    plan = physical_plan(contract.queries()["daily_summary"](spark, SF_DIR))
    assert "o_custkey" not in plan and "o_orderpriority" not in plan
    assert plan.count("hashpartitioning(fecha") == 1
    assert plan.count("hashpartitioning") == 1
    assert "concat_ws" not in plan, "messages are pruned"
