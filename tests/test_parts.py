"""Parts of summaries: runs that die after any write, and runs without number."""

import datetime
import shutil

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from tamiz.operators.histogram import add_up
from tamiz.session import Scratch
from tamiz.sources import parts, tables
from tamiz.sources.parts import DAILY_PARTS, refresh_summary


class Died(RuntimeError):
    pass


def added(spark, days):
    rows = [(datetime.date.fromisoformat(d), n, n, 0, 0) for d, n in days.items()]
    frame = spark.createDataFrame(
        rows, "fecha date, total_transacciones bigint, total_validas bigint, total_anomalias bigint, total_duplicadas bigint"
    )
    amount = F.col("total_validas").cast("decimal(15,2)")
    return frame.withColumns(
        {"monto_total_credito": amount, "monto_total_debito": amount * 0, "anio": F.year("fecha")}
    )


def run(spark, warehouse, run_id, days):
    with Scratch(spark) as scratch:
        refresh_summary(scratch, added(spark, days), warehouse, DAILY_PARTS, run_id)


def summary(spark, warehouse):
    found = tables.read_table(spark, warehouse, tables.DAILY_SUMMARY)
    return {r.fecha.isoformat(): r.total_transacciones for r in found.collect()}


def total(*runs):
    out = {}
    for days in runs:
        for day, n in days.items():
            out[day] = out.get(day, 0) + n
    return out


A1 = {"2022-03-03": 1, "2023-01-01": 2, "2024-05-05": 4}
A2 = {"2024-05-05": 8, "2024-06-06": 16}
B1 = {"2022-03-03": 32, "2022-04-04": 64}


@pytest.fixture
def writes(monkeypatch):
    """Counts the writes and removals, and dies after the chosen one."""
    state = {"count": 0, "die_after": None}

    def counted(real):
        def call(*args, **options):
            state["count"] += 1
            result = real(*args, **options)
            if state["count"] == state["die_after"]:
                raise Died
            return result

        return call

    monkeypatch.setattr(DataFrameWriter, "parquet", counted(DataFrameWriter.parquet))
    monkeypatch.setattr(tables, "remove", counted(tables.remove))
    return state


def test_a_run_that_dies_after_any_write_is_healed_by_its_repetition_or_by_the_next_run(spark, tmp_path, writes):
    warehouse = str(tmp_path / "count")
    run(spark, warehouse, "a", A1)
    run(spark, warehouse, "b", B1)
    shutil.copytree(warehouse, tmp_path / "before")
    writes["count"] = 0
    run(spark, warehouse, "a", A2)
    assert summary(spark, warehouse) == total(A2, B1)
    for step in range(1, writes["count"] + 1):
        warehouse = str(tmp_path / f"died-{step}")
        shutil.copytree(tmp_path / "before", warehouse)
        writes.update(count=0, die_after=step)
        with pytest.raises(Died):
            run(spark, warehouse, "a", A2)
        writes["die_after"] = None
        if step % 2:
            run(spark, warehouse, "a", A2)
            assert summary(spark, warehouse) == total(A2, B1), step
        else:  # another run comes first; "a" counts as far as it was published
            run(spark, warehouse, "c", {"2021-01-01": 1})
            assert summary(spark, warehouse)["2021-01-01"] == 1
            living = DAILY_PARTS.living(spark, warehouse)
            shown = summary(spark, warehouse)
            counted = {r.fecha.isoformat(): r.total_transacciones for r in add_up(living, "fecha", leaving_out=("run_id", "version", "tramo", "anio")).collect()}
            assert shown == counted, step
            run(spark, warehouse, "a", A2)
            assert summary(spark, warehouse) == total(A2, B1, {"2021-01-01": 1}), step


def test_a_summary_year_lost_in_the_middle_of_a_write_is_added_up_anew(spark, tmp_path, monkeypatch):
    """As if a run had died while the year's folder was being exchanged."""
    warehouse = str(tmp_path / "t")
    run(spark, warehouse, "a", A1)
    run(spark, warehouse, "b", B1)

    def lose(*args, **options):
        tables.remove(spark, f"{tables.DAILY_SUMMARY.path(warehouse)}/anio=2022")
        raise Died

    with monkeypatch.context() as patched:
        patched.setattr(tables, "refresh", lose)
        with pytest.raises(Died):
            run(spark, warehouse, "a", {"2022-03-03": 5})
    assert "2022-04-04" not in summary(spark, warehouse)
    run(spark, warehouse, "a", {"2022-03-03": 5})
    assert summary(spark, warehouse) == total({"2022-03-03": 5}, B1)


def test_many_runs_leave_few_folders_and_can_still_be_repeated(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(parts, "SEGMENTS", 2)
    monkeypatch.setattr(parts, "REGISTER_FILES", 9)
    warehouse, runs = str(tmp_path / "t"), {}
    for n in range(9):
        runs[f"r{n}"] = {"2024-01-01": 1, f"2024-02-{n + 1:02d}": 2}
        run(spark, warehouse, f"r{n}", runs[f"r{n}"])
    folder = tmp_path / "t" / DAILY_PARTS.name
    assert [p.name for p in folder.iterdir() if p.name.startswith("anio")] == ["anio=2024"]
    assert len([p for p in (folder / "anio=2024").iterdir() if p.is_dir()]) <= 4
    register = tmp_path / "t" / f"{DAILY_PARTS.name}_registro"
    assert len(list(register.iterdir())) == 1
    assert len([p for p in next(register.iterdir()).iterdir() if p.suffix == ".parquet"]) <= 16
    assert summary(spark, warehouse) == total(*runs.values())
    runs["r1"] = {"2024-01-01": 100}  # folded long ago
    run(spark, warehouse, "r1", runs["r1"])
    assert summary(spark, warehouse) == total(*runs.values())
    living = DAILY_PARTS.living(spark, warehouse)
    assert living.count() == sum(len(days) for days in runs.values())


def test_a_fold_that_dies_counts_nothing_twice(spark, tmp_path, monkeypatch, writes):
    monkeypatch.setattr(parts, "SEGMENTS", 2)
    days = [{"2024-01-01": 1}, {"2024-01-02": 2}, {"2024-01-01": 4}]
    first = str(tmp_path / "count")
    for n, own in enumerate(days[:2]):
        run(spark, first, f"r{n}", own)
    shutil.copytree(first, tmp_path / "before")
    writes["count"] = 0
    run(spark, first, "r2", days[2])
    steps = writes["count"]
    for step in range(steps - 4, steps + 1, 2):  # the fold and the removals of what it holds
        warehouse = str(tmp_path / f"t{step}")
        shutil.copytree(tmp_path / "before", warehouse)
        writes.update(count=0, die_after=step)
        with pytest.raises(Died):
            run(spark, warehouse, "r2", days[2])
        writes["die_after"] = None
        assert add_up(DAILY_PARTS.living(spark, warehouse), "anio", leaving_out=("fecha", "run_id", "version", "tramo")).first().total_transacciones == 7
        run(spark, warehouse, "r3", {"2024-01-02": 8})
        assert summary(spark, warehouse) == total(*days, {"2024-01-02": 8}), step
