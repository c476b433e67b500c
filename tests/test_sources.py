import datetime
import os
import random
from decimal import Decimal

import pytest
from conftest import physical_plan, write_text

from pyspark.sql import functions as F

from tamiz import session
from tamiz.sources import delimited, tables

FIELDS = ("id", "fecha", "monto", "tipo")


def stage(spark, path):
    return delimited.stage_lines(session.Scratch(spark), path, FIELDS)


def test_fields_are_positional_and_malformed_lines_are_kept(spark, tmp_path):
    path = write_text(
        tmp_path / "t.csv",
        [
            "whatever,the,header,says",
            "1,2024-01-10,100,credito",
            "2,2024-01-10",
            "# a comment, with, four, fields",
            '"3","10/01/2024"," 5 ","a ""quoted"", b"',
            "",
            "4,2024-01-10,1,debito,extra",
            "5,,,",
            "   ",
            ",,,",
            'a"b,c,d,e',  # the quote is never closed: one field
            '6,2024-01-01,5,de"bi,to"',
            ' "7, a" ,"",x"y"z,"a""b" c',
        ],
    )
    rows, total = stage(spark, path)
    good = rows.where(F.col("_corrupt").isNull()).orderBy("seq")
    assert [tuple(r) for r in good.select("_line", *FIELDS).collect()] == [
        (2, "1", "2024-01-10", "100", "credito"),
        (5, "3", "10/01/2024", " 5 ", 'a "quoted", b'),
        (8, "5", None, None, None),
        (10, None, None, None, None),
        (12, "6", "2024-01-01", "5", 'de"bi,to"'),
        (13, "7, a", None, 'x"y"z', '"a""b" c'),
    ]
    bad = rows.where("_corrupt is not null").orderBy("seq")
    assert [tuple(r) for r in bad.select("_line", "_corrupt").collect()] == [
        (3, "2,2024-01-10"),
        (6, ""),
        (7, "4,2024-01-10,1,debito,extra"),
        (9, "   "),
        (11, 'a"b,c,d,e'),
    ]
    # Noticed from any set of columns.
    assert rows.where("_corrupt is not null").count() == 5
    assert rows.count() == 11 and total == 12  # the comment is a line, not a row


def test_line_ends(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes(b"h,h,h,h\r\n1,a,b,c\r\n2,a,b,c")
    rows, total = stage(spark, str(tmp_path / "t.csv"))
    assert sorted((r["id"], r["tipo"]) for r in rows.collect()) == [("1", "c"), ("2", "c")]
    assert total == 2


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_lines_are_numbered_across_splits_and_files(spark, tmp_path, broadcast_bytes):
    sizes = {"a.csv": 700, "b.csv": 1, "c.csv": 0, "d.csv": 900}
    expected, total = {}, 0
    for name, rows in sizes.items():
        lines = [f"{name}-{row},2024-01-10,{row},credito" for row in range(rows)]
        write_text(tmp_path / name, [",".join(FIELDS), *lines])
        for row in range(rows):
            expected[f"{name}-{row}"] = (total + row, row + 2)
        total += rows
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    try:
        lines = delimited.read_lines(spark, str(tmp_path), FIELDS)
        assert lines.rdd.getNumPartitions() > 5
        stored = session.Scratch(spark).stage(lines, "lines")
        numbered, count = delimited.number_lines(stored, broadcast_bytes)
        found = {r["id"]: (r["seq"], r["_line"]) for r in numbered.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == expected and count == total


def test_malformed_reason_names_line_and_file(spark, tmp_path):
    path = write_text(tmp_path / "t.csv", ["h1,h2,h3,h4", "1,2,3,4", "1,2"])
    lines, count = stage(spark, path)
    assert count == 2
    row = delimited.malformed(lines).first()
    assert row["seq"] == 1
    assert row["reject_reason"].startswith(
        "FlatFileParseException: Parsing error at line: 3 in resource=["
    )
    assert row["reject_reason"].endswith("t.csv], input=[1,2]")


# --- tables ---------------------------------------------------------------------

DAY_1, DAY_2, DAY_3 = (datetime.date(2023 + n // 3, 1, 1 + n) for n in range(3))


def summary(spark, totals):
    rows = [(day, total) for day, total in totals.items()]
    frame = spark.createDataFrame(rows, "fecha date, total_transacciones int")
    for name in ("total_validas", "total_anomalias", "total_duplicadas"):
        frame = frame.withColumn(name, F.lit(0))
    for name in ("monto_total_credito", "monto_total_debito"):
        frame = frame.withColumn(name, F.lit(0))
    return frame.withColumn("generado_en", F.current_timestamp()).withColumn(
        "anio", F.year("fecha")
    )


def stored(spark, warehouse):
    rows = tables.read_table(spark, warehouse, tables.DAILY_SUMMARY).collect()
    return {r["fecha"]: r["total_transacciones"] for r in rows}


def test_upsert_replaces_adds_and_leaves_the_rest(spark, tmp_path):
    warehouse = str(tmp_path)
    old_year = datetime.date(2020, 5, 5)
    tables.upsert(summary(spark, {DAY_1: 5, DAY_2: 6, old_year: 7}), warehouse, tables.DAILY_SUMMARY, session.Scratch(spark))
    tables.upsert(summary(spark, {DAY_2: 9, DAY_3: 1}), warehouse, tables.DAILY_SUMMARY, session.Scratch(spark))
    assert stored(spark, warehouse) == {DAY_1: 5, DAY_2: 9, DAY_3: 1, old_year: 7}
    tables.upsert(summary(spark, {}), warehouse, tables.DAILY_SUMMARY, session.Scratch(spark))
    assert stored(spark, warehouse) == {DAY_1: 5, DAY_2: 9, DAY_3: 1, old_year: 7}


def test_upsert_on_two_keys(spark, tmp_path):
    def statement(rows):
        frame = spark.createDataFrame(rows, "cuenta_id long, anio int, saldo_neto_anual int")
        for name in ("total_depositos", "total_salidas", "cantidad_movimientos", "cantidad_anomalias"):
            frame = frame.withColumn(name, F.lit(0))
        return frame.withColumn("generado_en", F.current_timestamp())

    warehouse = str(tmp_path)
    tables.upsert(statement([(1, 2023, 5), (1, 2024, 6), (2, 2024, 7)]), warehouse, tables.ANNUAL_STATEMENT, session.Scratch(spark))
    tables.upsert(statement([(1, 2024, 8), (2, 2023, 9)]), warehouse, tables.ANNUAL_STATEMENT, session.Scratch(spark))
    rows = tables.read_table(spark, warehouse, tables.ANNUAL_STATEMENT).collect()
    assert {(r["cuenta_id"], r["anio"]): r["saldo_neto_anual"] for r in rows} == {
        (1, 2023): Decimal("5.00"),
        (1, 2024): Decimal("8.00"),
        (2, 2024): Decimal("7.00"),
        (2, 2023): Decimal("9.00"),
    }


def log_rows(spark, texts):
    frame = spark.createDataFrame([(text,) for text in texts], "mensaje_error string")
    return frame.select(
        F.lit("s").alias("step_name"),
        F.lit("PROCESS").alias("etapa"),
        F.lit(None).cast("string").alias("detalle_item"),
        "mensaje_error",
        F.current_timestamp().alias("ocurrido_en"),
    )


def test_a_run_is_replaced_and_others_are_not(spark, tmp_path):
    warehouse = str(tmp_path)

    def write(job, run_id, texts):
        tables.write_run(
            log_rows(spark, texts), warehouse, tables.ERROR_LOG, job_name=job, run_id=run_id
        )

    def found():
        rows = tables.read_table(spark, warehouse, tables.ERROR_LOG).collect()
        return sorted((r["job_name"], r["run_id"], r["mensaje_error"]) for r in rows)

    assert found() == []
    write("a", "1", ["x", "y"])
    write("a", "2", ["x"])
    write("b", "1", ["x"])
    assert found() == [("a", "1", "x"), ("a", "1", "y"), ("a", "2", "x"), ("b", "1", "x")]
    write("a", "1", ["z"])
    assert found() == [("a", "1", "z"), ("a", "2", "x"), ("b", "1", "x")]
    write("a", "1", [])  # a repeated run without rows leaves none behind
    assert found() == [("a", "2", "x"), ("b", "1", "x")]


def test_run_ids_are_folder_names(spark, tmp_path):
    with pytest.raises(ValueError, match="run_id"):
        tables.write_run(
            log_rows(spark, ["x"]), str(tmp_path), tables.ERROR_LOG, job_name="a", run_id="../1"
        )


def test_a_summary_read_touches_only_the_partitions_asked_for(spark, tmp_path):
    warehouse = str(tmp_path)
    tables.upsert(summary(spark, {DAY_1: 5}), warehouse, tables.DAILY_SUMMARY, session.Scratch(spark))
    read = tables.read_table(spark, warehouse, tables.DAILY_SUMMARY).where("anio = 2023")
    assert "PartitionFilters: [isnotnull(anio" in physical_plan(read)


def test_scratch_is_gone_after_the_run(spark):
    with session.Scratch(spark) as scratch:
        stored = scratch.stage(spark.range(5), "numbers")
        assert stored.count() == 5 and os.path.isdir(local_path(scratch.folder))
    assert not os.path.exists(local_path(scratch.folder))


def local_path(uri):
    return uri.removeprefix("file:")


# --- shared folder ----------------------------------------------------------------


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, master, **conf):
        self.sparkContext = FakeContext(master)
        self.conf = type("Conf", (), {"get": lambda _, key, default=None: conf.get(key, default)})()


def test_shared_dir_comes_from_the_session():
    fake = FakeSession("spark://cluster:7077", **{"spark.checkpoint.dir": "hdfs:///shared"})
    assert session.shared_dir(fake) == "hdfs:///shared"
    assert fake.sparkContext.folder == "hdfs:///shared"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession("spark://cluster:7077"))
    assert session.shared_dir(FakeSession("local[2]"))


def test_fields_equal_a_scanner_that_counts_quotes(spark):
    """Random lines against a character by character reading."""

    def scanned(line):
        fields, field, inside = [], "", False
        for char in line:
            if char == '"':
                inside = not inside
            if char == "," and not inside:
                fields.append(field)
                field = ""
            else:
                field += char
        out = []
        for text in [*fields, field]:
            bare = text.strip(" ")
            if bare.startswith('"') and bare.endswith('"'):
                text = bare.replace('""', '"')[1:-1] if bare != '"' else ""
            out.append(text or None)
        return out

    rng = random.Random(7)
    lines = ["", '"', '""', '"""', '""""', ",", '","', ' " , " '] + [
        "".join(rng.choice('ab, "",') for _ in range(rng.randrange(1, 24))) for _ in range(2000)
    ]
    frame = spark.createDataFrame([(n, line) for n, line in enumerate(lines)], "n int, line string")
    found = frame.select("n", delimited.split_fields(F.col("line")).alias("fields")).orderBy("n").collect()
    assert [r.fields for r in found] == [scanned(line) for line in lines]


def test_widths_of_text_columns(spark):
    table = tables.Table("t", "a varchar(3), b string, n int")
    assert [field.dataType.simpleString() for field in table.schema] == ["string", "string", "int"]
    rows = [("abc", "abcdef", 1), ("ab    ", "x", 2), (None, None, None), ("ñü\U0001f600", "", 4), ("  a ", "", 5)]
    frame = spark.createDataFrame(rows, "a string, b string, n int")
    found = sorted((r.n or 0, r.a) for r in tables.conform(frame, table).collect())
    assert found == [(0, None), (1, "abc"), (2, "ab "), (4, "ñü\U0001f600"), (5, "  a")]
    with pytest.raises(Exception, match="a holds 3 characters, not 4"):
        tables.conform(frame.select(F.lit("abcd").alias("a"), "b", "n"), table).collect()
