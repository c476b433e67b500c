"""The three jobs on small hand-made files, every edge in one row each."""

import datetime
import logging
from decimal import Decimal

import pytest
from conftest import physical_plan, write_text
from pyspark.sql import Observation, functions as F

from tamiz import vocabulary as v
from tamiz.__main__ import main
from tamiz.operators.quality import QualityGateError
from tamiz.operators.rules import split
from tamiz.plans import jobs, statements, transactions
from tamiz.plans.interest import InterestConfig
from tamiz.plans.jobs import run_job
from tamiz.plans.transactions import TransactionsConfig
from tamiz.session import SCAN_TASKS, Scratch
from tamiz.sources import delimited, tables

JAN_10 = datetime.date(2024, 1, 10)


def money(text):
    return None if text is None else Decimal(text)


def day(text):
    return None if text is None else datetime.date.fromisoformat(text)


def rows_of(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)


TRANSACTIONS = [
    "id,fecha,monto,tipo",
    "1,2024-01-10,100,credito",
    "1,2024-01-10,100,credito",
    "01,10/01/2024,50.005, DEBITO",
    ",2024-01-10,5,credito",
    ",2024-01-10,5,credito",
    "x9,2024/01/10,7,credito",
    "2,2024-13-01,-5,otro",
    "3,,0,debito",
    "4,31-04-2024,1e2,credito",
    "2,2024-01-10,abc,credito",
    "5,2024-01-10,0.004,debito",
    "6,2024-01-10",
]
DETAIL = [
    (1, "2024-01-10", "100.00", "credito", "VALIDA", None),
    (1, "2024-01-10", "100.00", "credito", "DUPLICADA", "Id de transaccion duplicado: 1"),
    (1, "2024-01-10", "50.01", "debito", "VALIDA", None),
    (None, "2024-01-10", "5.00", "credito", "VALIDA", None),
    (None, "2024-01-10", "5.00", "credito", "VALIDA", None),
    (None, "2024-01-10", "7.00", "credito", "VALIDA", None),
    (
        2,
        None,
        "-5.00",
        "otro",
        "ANOMALIA",
        "Formato de fecha no reconocido: '2024-13-01'; Monto no positivo: -5; "
        "Tipo de transaccion invalido: 'otro'",
    ),
    (3, None, "0.00", "debito", "ANOMALIA", "Fecha vacia; Monto no positivo: 0"),
    (4, "2024-04-30", "100.00", "credito", "VALIDA", None),
    (2, "2024-01-10", None, "credito", "DUPLICADA", "Id de transaccion duplicado: 2"),
    (5, "2024-01-10", "0.00", "debito", "VALIDA", None),
]
SUMMARY_COLUMNS = (
    "fecha",
    "total_transacciones",
    "total_validas",
    "total_anomalias",
    "total_duplicadas",
    "monto_total_credito",
    "monto_total_debito",
)
SUMMARY = [
    (JAN_10, 8, 6, 0, 2, Decimal("117.00"), Decimal("50.01")),
    (datetime.date(2024, 4, 30), 1, 1, 0, 0, Decimal("100.00"), Decimal("0.00")),
]


def test_daily_report(spark, tmp_path):
    source = write_text(tmp_path / "transacciones.csv", TRANSACTIONS)
    warehouse = str(tmp_path / "tablas")
    result = run_job(spark, v.DAILY_REPORT_JOB, source, warehouse, "r1")
    expected = sorted(
        [(i, day(d), money(m), *rest) for i, d, m, *rest in DETAIL], key=str
    )
    assert (
        rows_of(
            result.detail,
            "transaccion_id_origen",
            "fecha",
            "monto",
            "tipo",
            "estado",
            "motivo",
        )
        == expected
    )
    assert rows_of(result.summary, *SUMMARY_COLUMNS) == sorted(SUMMARY, key=str)
    assert all(r["procesado_por_hilo"] and r["procesado_en"] for r in result.detail.collect())

    counters = result.counters.first()
    assert counters["leidos"] == counters["escritos"] == 11
    assert counters["saltados_lectura"] == counters["total_saltados"] == 1
    log = tables.read_table(spark, warehouse, tables.ERROR_LOG).collect()
    assert [(r["job_name"], r["step_name"], r["etapa"], r["detalle_item"]) for r in log] == [
        (v.DAILY_REPORT_JOB, v.DAILY_REPORT_STEP, "READ", None)
    ]
    assert "Parsing error at line: 13 in" in log[0]["mensaje_error"]
    assert log[0]["mensaje_error"].endswith("input=[6,2024-01-10]")


def test_repeating_a_run_counts_once_and_a_new_run_adds(spark, tmp_path):
    source = write_text(tmp_path / "transacciones.csv", TRANSACTIONS)
    warehouse = str(tmp_path / "tablas")
    for run_id in ("r1", "r1"):
        result = run_job(spark, v.DAILY_REPORT_JOB, source, warehouse, run_id)
    assert result.detail.count() == 11
    assert rows_of(result.summary, *SUMMARY_COLUMNS) == sorted(SUMMARY, key=str)

    more = write_text(tmp_path / "mas.csv", [TRANSACTIONS[0], "7,2024-01-10,10,debito"])
    result = run_job(spark, v.DAILY_REPORT_JOB, more, warehouse, "r2")
    assert result.detail.count() == 12
    expected = [(JAN_10, 9, 7, 0, 2, Decimal("117.00"), Decimal("60.01")), SUMMARY[1]]
    assert rows_of(result.summary, *SUMMARY_COLUMNS) == sorted(expected, key=str)


def test_summaries_added_up_equal_the_summary_of_the_whole_table(spark, tmp_path):
    warehouse = str(tmp_path / "tablas")
    header, *lines = TRANSACTIONS
    loads = [("r1", lines[:5]), ("r2", lines[3:]), ("r3", lines[6:]), ("r2", lines[8:])]
    for run_id, load in loads:
        source = write_text(tmp_path / f"{run_id}.csv", [header, *load])
        result = run_job(spark, v.DAILY_REPORT_JOB, source, warehouse, run_id)
    whole = transactions.daily_summary(result.detail)
    assert rows_of(result.summary, *SUMMARY_COLUMNS) == rows_of(whole, *SUMMARY_COLUMNS)

    header, *lines = MOVEMENTS
    for run_id, load in [("r1", lines[:8]), ("r2", lines[4:]), ("r1", lines[:9])]:
        source = write_text(tmp_path / f"m-{run_id}.csv", [header, *load])
        result = run_job(spark, v.ANNUAL_STATEMENT_JOB, source, warehouse, run_id)
    whole = statements.annual_statement(result.detail)
    assert rows_of(result.summary, *whole.columns) == rows_of(whole, *whole.columns)


def test_rates_and_age_range_are_settings(spark, tmp_path):
    source = write_text(tmp_path / "i.csv", [ACCOUNTS[0], "1,A,100,20,Oro", "2,B,100,20,ahorro"])
    config = InterestConfig(rates={"oro": "0.02"}, min_age=21, max_age=65)
    result = run_job(
        spark, v.MONTHLY_INTEREST_JOB, source, str(tmp_path / "tablas"), "r1", config
    )
    (row,) = result.detail.collect()
    assert (row["tipo"], row["interes_calculado"], row["edad_utilizada"]) == (
        "oro",
        Decimal("2.00"),
        21,
    )
    assert "acoto al minimo (21)" in row["observacion"]


def test_command_line(spark, tmp_path, capsys):
    source = write_text(tmp_path / "t.csv", TRANSACTIONS)
    folder = str(tmp_path / "tablas")
    main([v.DAILY_REPORT_JOB, "--source", source, "--warehouse", folder, "--run-id", "r1"])
    printed = capsys.readouterr().out
    assert "run r1" in printed and "leidos=11" in printed and "saltados_lectura=1" in printed


ACCOUNTS = [
    "cuenta_id,nombre,saldo,edad,tipo",
    "101,Ana,1000,30,ahorro",
    "101, ana ,1000,30,AHORRO",
    "102,Luis,333.33,17,prestamo",
    "103,Eva,250.5,91,hipoteca",
    "104,Leo,0,,ahorro",
    "105,Zoe,-1,40,ahorro",
    "106,Pia,,40,-1",
    "107,Tom,,40,ahorro",
    "107,Tom,,40,ahorro",
    "108,Kim,100,treinta,hipoteca",
    "109,Max,1000,30.0,ahorro",
]
MISSING = "Edad no informada, se utilizo la edad minima configurada (18)"
INTEREST = [
    (101, "Ana", "ahorro", "1000.00", 30, 30, "0.0050", "5.00", "1005.00", "VALIDA", None),
    (102, "Luis", "prestamo", "333.33", 17, 18, "0.0150", "5.00", "338.33", "VALIDA_CORREGIDA",
     "Edad fuera de rango (17), se acoto al minimo (18)"),
    (103, "Eva", "hipoteca", "250.50", 91, 90, "0.0100", "2.51", "253.01", "VALIDA_CORREGIDA",
     "Edad fuera de rango (91), se acoto al maximo (90)"),
    (104, "Leo", "ahorro", "0.00", None, 18, "0.0050", "0.00", "0.00", "VALIDA_CORREGIDA", MISSING),
    (108, "Kim", "hipoteca", "100.00", None, 18, "0.0100", "1.00", "101.00", "VALIDA_CORREGIDA",
     MISSING),
    (109, "Max", "ahorro", "1000.00", None, 18, "0.0050", "5.00", "1005.00", "VALIDA_CORREGIDA",
     MISSING),
]


def test_monthly_interest(spark, tmp_path):
    source = write_text(tmp_path / "intereses.csv", ACCOUNTS)
    warehouse = str(tmp_path / "tablas")
    result = run_job(spark, v.MONTHLY_INTEREST_JOB, source, warehouse, "r1")
    found = rows_of(
        result.detail, "cuenta_id", "nombre", "tipo", "saldo_inicial", "edad_original",
        "edad_utilizada", "tasa_aplicada", "interes_calculado", "saldo_final", "estado",
        "observacion",
    )
    expected = [
        (i, n, t, money(s), a, u, money(r), money(c), money(f), e, o)
        for i, n, t, s, a, u, r, c, f, e, o in INTEREST
    ]
    assert found == sorted(expected, key=str)
    counters = result.counters.first().asDict()
    assert (counters["leidos"], counters["escritos"]) == (11, 6)
    assert (counters["filtrados"], counters["saltados_proceso"]) == (2, 3)
    log = tables.read_table(spark, warehouse, tables.ERROR_LOG)
    assert rows_of(log, "etapa", "detalle_item", "mensaje_error") == [
        ("PROCESS", "InteresRaw(cuentaId=105, nombre=Zoe, saldo=-1, edad=40, tipo=ahorro)",
         "InvalidAmountException: Saldo negativo no permitido: -1"),
        ("PROCESS", "InteresRaw(cuentaId=106, nombre=Pia, saldo=, edad=40, tipo=-1)",
         "InvalidCategoryException: Tipo de cuenta invalido: '-1'"),
        ("PROCESS", "InteresRaw(cuentaId=107, nombre=Tom, saldo=, edad=40, tipo=ahorro)",
         "InvalidAmountException: Saldo vacio o no numerico para la cuenta 107"),
    ]


def test_gate_stops_the_job_and_keeps_the_evidence(spark, tmp_path):
    source = write_text(tmp_path / "intereses.csv", ACCOUNTS)
    warehouse = str(tmp_path / "tablas")

    def run(limit):
        config = InterestConfig(reject_limit=limit)
        return run_job(spark, v.MONTHLY_INTEREST_JOB, source, warehouse, "r1", config)

    # 11 lines in slices of 3, 3, 3 and 2: one reject in the second, two in the third.
    with pytest.raises(QualityGateError, match="slice 2: 2"):
        run(1)
    assert tables.read_table(spark, warehouse, tables.ERROR_LOG).count() == 3
    assert tables.read_table(spark, warehouse, tables.ACCOUNTS).count() == 0
    assert run(2).detail.count() == 6
    assert tables.read_table(spark, warehouse, tables.ERROR_LOG).count() == 3


def test_malformed_lines_count_for_the_gate(spark, tmp_path):
    source = write_text(tmp_path / "t.csv", [TRANSACTIONS[0], "1", "2", "3,2024-01-10,1,debito"])
    config = TransactionsConfig(reject_limit=1, slices=1)
    with pytest.raises(QualityGateError, match="slice 0: 2"):
        run_job(spark, v.DAILY_REPORT_JOB, source, str(tmp_path / "tablas"), "r1", config)


MOVEMENTS = [
    "cuenta_id,fecha,transaccion,monto,descripcion",
    "201,2024-01-15,deposito,1000,Nomina",
    "201,20-02-2024,retiro,300,Cajero",
    "201,2024/03/10,compra,-50.25,Super",
    "201,11/04/2024,deposito,-20,Ajuste",
    "201,2024-05-01,transferencia,75,X",
    "201,2024-13-01,deposito,500,Y",
    "201,2024-06-01,deposito,,Z",
    "202,2023-12-31,Compra,40,",
    "202,2024-01-01,deposito,0,Cero",
    "abc,2024-01-01,deposito,10,Sin cuenta",
    "202,2024-02-30,retiro,-5,Febrero",
    "202,,deposito,15,",
]
SIGN = "Se normalizo el signo del monto de salida ({}) a negativo"
MOVED = [
    (201, "2024-01-15", "deposito", "1000.00", "Nomina", "VALIDA", None),
    (201, "2024-02-20", "retiro", "-300.00", "Cajero", "VALIDA_CORREGIDA", SIGN.format("retiro")),
    (201, "2024-03-10", "compra", "-50.25", "Super", "VALIDA", None),
    (201, "2024-04-11", "deposito", "-20.00", "Ajuste", "ANOMALIA",
     "Monto no positivo para un deposito: -20"),
    (201, "2024-05-01", "transferencia", "75.00", "X", "ANOMALIA",
     "Tipo de transaccion anual desconocido: 'transferencia'"),
    (201, None, "deposito", "500.00", "Y", "ANOMALIA",
     "Formato de fecha no reconocido: '2024-13-01'"),
    (202, "2023-12-31", "compra", "-40.00", "Sin descripcion", "VALIDA_CORREGIDA",
     SIGN.format("compra") + "; Descripcion vacia, se uso el valor por defecto"),
    (202, "2024-01-01", "deposito", "0.00", "Cero", "ANOMALIA",
     "Monto no positivo para un deposito: 0"),
    (None, "2024-01-01", "deposito", "10.00", "Sin cuenta", "VALIDA", None),
    (202, "2024-02-29", "retiro", "-5.00", "Febrero", "VALIDA", None),
    (202, None, "deposito", "15.00", "Sin descripcion", "ANOMALIA", "Fecha vacia"),
]


def test_annual_statements(spark, tmp_path):
    source = write_text(tmp_path / "cuentas_anuales.csv", MOVEMENTS)
    warehouse = str(tmp_path / "tablas")
    result = run_job(spark, v.ANNUAL_STATEMENT_JOB, source, warehouse, "r1")
    found = rows_of(
        result.detail, "cuenta_id", "fecha", "tipo_transaccion", "monto", "descripcion",
        "estado", "motivo",
    )
    expected = [(c, day(d), t, money(m), *rest) for c, d, t, m, *rest in MOVED]
    assert found == sorted(expected, key=str)
    statement = rows_of(
        result.summary, "cuenta_id", "anio", "total_depositos", "total_salidas",
        "saldo_neto_anual", "cantidad_movimientos", "cantidad_anomalias",
    )
    assert statement == [
        (201, 2024, Decimal("1000.00"), Decimal("350.25"), Decimal("704.75"), 5, 2),
        (202, 2023, Decimal("0.00"), Decimal("40.00"), Decimal("-40.00"), 1, 0),
        (202, 2024, Decimal("0.00"), Decimal("5.00"), Decimal("-5.00"), 2, 1),
    ]
    log = tables.read_table(spark, warehouse, tables.ERROR_LOG)
    assert rows_of(log, "mensaje_error", "detalle_item") == [
        ("InvalidAmountException: Monto vacio o no numerico para la cuenta 201",
         "MovimientoRaw(cuentaId=201, fecha=2024-06-01, transaccion=deposito, monto=, "
         "descripcion=Z)")
    ]
    counters = result.counters.first()
    assert (counters["leidos"], counters["escritos"], counters["total_saltados"]) == (12, 11, 1)


def test_annual_statements_write_kept_movements_and_their_summary_once(spark, tmp_path, monkeypatch):
    """Between lines and tables nothing is written but the rejected rows."""
    staged = {}
    real = Scratch.stage

    def stage(self, frame, name, *options):
        found = real(self, frame, name, *options)
        staged[name] = found.count()
        return found

    monkeypatch.setattr(Scratch, "stage", stage)
    source = write_text(tmp_path / "m.csv", MOVEMENTS)
    run_job(spark, v.ANNUAL_STATEMENT_JOB, source, str(tmp_path / "tablas"), "r1")
    assert staged == {"lines": 13, "rejected": 1}


def longest_generated_method(frame):
    """Bytes of the longest method that Spark generates for a frame."""
    spark = frame.sparkSession
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = frame.select("*")._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        code = debug.codegenStringSeq(plan)
        return max(code.apply(place)._3().maxMethodCodeSize() for place in range(code.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_movements_are_judged_by_code_that_the_jvm_compiles(spark, tmp_path):
    """It leaves methods of more than 8,000 bytes to its interpreter, which takes many times as long."""
    lines, _ = delimited.stage_lines(
        Scratch(spark), write_text(tmp_path / "m.csv", MOVEMENTS), v.MOVEMENT_FIELDS
    )
    kept, rejected = split(statements.classify_movements(delimited.readable(lines)))
    assert longest_generated_method(rejected) < 8000
    seen = Observation()
    detail = jobs._with_provenance(statements.movement_detail(kept, seen=seen)).withColumn("run_id", F.lit("r"))
    written = tables.conform(detail, tables.MOVEMENTS)
    assert 3000 < longest_generated_method(written) < 7500
    assert written.count() == seen.get["escritos"] == 11


def test_rejected_movements_are_looked_for_before_anything_is_made_of_the_others(spark, tmp_path, monkeypatch):
    staged = {}
    real = Scratch.stage
    monkeypatch.setattr(
        Scratch, "stage", lambda self, frame, name: real(self, staged.setdefault(name, frame), name)
    )
    source = write_text(tmp_path / "m.csv", MOVEMENTS)
    result = run_job(spark, v.ANNUAL_STATEMENT_JOB, source, str(tmp_path / "tablas"), "r1")
    above, below = physical_plan(staged["rejected"]).split("CollectMetrics")
    assert "RLIKE" in below.split("Join")[1] and "RLIKE" not in above
    assert result.counters.first()["saltados_proceso"] == 1


def test_a_run_that_fails_tells_how_many_movements_it_read(spark, tmp_path, caplog):
    source = write_text(tmp_path / "m.csv", MOVEMENTS)
    config = statements.StatementsConfig(reject_limit=0)
    with caplog.at_level(logging.INFO, "tamiz.operators.quality"), pytest.raises(QualityGateError):
        run_job(spark, v.ANNUAL_STATEMENT_JOB, source, str(tmp_path / "t"), "r1", config)
    assert "'leidos': 12" in caplog.text and "'saltados_proceso': 1" in caplog.text
    wide = write_text(tmp_path / "n.csv", [*MOVEMENTS, "201,2024-01-01,deposito,1e20,x"])
    with caplog.at_level(logging.INFO, "tamiz.operators.quality"), pytest.raises(Exception, match="OUT_OF_RANGE"):
        run_job(spark, v.ANNUAL_STATEMENT_JOB, wide, str(tmp_path / "u"), "r1")
    assert "'leidos': 13" in caplog.text


def test_jobs_deal_scans_into_several_tasks_a_core_and_leave_the_setting_alone(spark, tmp_path, monkeypatch):
    found = []
    real = tables.write_run

    def write_run(frame, *place, **run):
        found.append(spark.conf.get(SCAN_TASKS, None))
        real(frame, *place, **run)

    monkeypatch.setattr(tables, "write_run", write_run)
    source = write_text(tmp_path / "m.csv", MOVEMENTS)
    run_job(spark, v.ANNUAL_STATEMENT_JOB, source, str(tmp_path / "t"), "r1")
    assert set(found) == {"32"} and spark.conf.get(SCAN_TASKS, None) is None
    found.clear()
    spark.conf.set(SCAN_TASKS, "3")
    try:
        run_job(spark, v.ANNUAL_STATEMENT_JOB, source, str(tmp_path / "t"), "r2")
        assert set(found) == {"3"} and spark.conf.get(SCAN_TASKS) == "3"
    finally:
        spark.conf.unset(SCAN_TASKS)


def test_an_empty_file_is_a_run_without_rows(spark, tmp_path):
    warehouse = str(tmp_path / "tablas")
    for job, feed in (
        (v.DAILY_REPORT_JOB, TRANSACTIONS),
        (v.MONTHLY_INTEREST_JOB, ACCOUNTS),
        (v.ANNUAL_STATEMENT_JOB, MOVEMENTS),
    ):
        source = write_text(tmp_path / f"{job}.csv", feed[:1])
        result = run_job(spark, job, source, warehouse, "r1")
        assert result.detail.count() == 0
        assert result.counters.first()["leidos"] == 0


def test_an_amount_that_does_not_fit_fails_the_run(spark, tmp_path):
    source = write_text(
        tmp_path / "t.csv", [TRANSACTIONS[0], "1,2024-01-10,99999999999999,credito"]
    )
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        run_job(spark, v.DAILY_REPORT_JOB, source, str(tmp_path / "tablas"), "r1")


def test_a_text_wider_than_its_column_fails_the_run(spark, tmp_path):
    warehouse, name = str(tmp_path / "tablas"), "n" * 150
    source = write_text(tmp_path / "i.csv", [ACCOUNTS[0], f"1,{name},100,30,ahorro"])
    assert run_job(spark, v.MONTHLY_INTEREST_JOB, source, warehouse, "r1").detail.first().nombre == name
    # Characters count, not bytes; rejected rows may be as wide as they like.
    rows = [ACCOUNTS[0], f"1,{'ñ' * 150},100,30,ahorro", f"2,{name * 20},100,30,{name}"]
    source = write_text(tmp_path / "i2.csv", rows)
    found = run_job(spark, v.MONTHLY_INTEREST_JOB, source, warehouse, "r2").detail
    assert found.where("run_id = 'r2'").count() == 1
    source = write_text(tmp_path / "i3.csv", [ACCOUNTS[0], f"1,{name}n,100,30,ahorro"])
    with pytest.raises(Exception, match="nombre holds 150 characters, not 151"):
        run_job(spark, v.MONTHLY_INTEREST_JOB, source, warehouse, "r3")
    assert tables.read_table(spark, warehouse, tables.ACCOUNTS).where("run_id = 'r3'").isEmpty()


def test_jobs_are_chosen_by_name(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown job"):
        run_job(spark, "otro", "x", str(tmp_path))


def test_a_missing_input_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_job(spark, v.ANNUAL_STATEMENT_JOB, str(tmp_path / "no.csv"), str(tmp_path / "t"))


def test_row_rules_apply_to_a_stream_unchanged(spark, tmp_path):
    header, *lines = MOVEMENTS
    schema = ", ".join(f"{name} string" for name in header.split(","))
    write_text(tmp_path / "m.csv", lines)
    batch = statements.movement_detail(
        split(statements.classify_movements(spark.read.schema(schema).csv(str(tmp_path))))[0]
    )
    stream = statements.movement_detail(
        split(
            statements.classify_movements(
                spark.readStream.schema(schema).option("pathGlobFilter", "*.csv").csv(str(tmp_path))
            )
        )[0]
    )
    query = stream.writeStream.format("memory").queryName("movimientos").start()
    try:
        query.processAllAvailable()
        found = rows_of(spark.table("movimientos"), *batch.columns)
    finally:
        query.stop()
    assert found == rows_of(batch, *batch.columns) and len(found) == 11


def test_keys_that_a_repeated_run_no_longer_has_are_removed(spark, tmp_path):
    header, warehouse = TRANSACTIONS[0], str(tmp_path / "tablas")
    both = ["1,2024-01-01,5,credito", "2,2023-01-02,7,credito", "3,2022-03-03,9,debito"]
    source = write_text(tmp_path / "a.csv", [header, *both])
    run_job(spark, v.DAILY_REPORT_JOB, source, warehouse, "a")
    other = write_text(tmp_path / "b.csv", [header, "9,2022-03-03,1,debito"])
    run_job(spark, v.DAILY_REPORT_JOB, other, warehouse, "b")
    source = write_text(tmp_path / "a.csv", [header, both[0]])
    result = run_job(spark, v.DAILY_REPORT_JOB, source, warehouse, "a")
    assert result.detail.count() == 2
    assert rows_of(result.summary, "fecha", "total_transacciones") == [
        (datetime.date(2022, 3, 3), 1),
        (datetime.date(2024, 1, 1), 1),
    ]
    assert rows_of(result.summary, *SUMMARY_COLUMNS) == rows_of(
        transactions.daily_summary(result.detail), *SUMMARY_COLUMNS
    )


def test_a_run_leaves_the_files_of_other_years_alone(spark, tmp_path):
    header, folder = TRANSACTIONS[0], tmp_path / "tablas"
    for run_id, line in (("a", "1,2020-05-05,5,credito"), ("b", "2,2024-01-02,7,credito")):
        before = {p: p.stat().st_mtime_ns for p in folder.rglob("anio=2020/*")}
        source = write_text(tmp_path / f"{run_id}.csv", [header, line])
        result = run_job(spark, v.DAILY_REPORT_JOB, source, str(folder), run_id)
    assert before == {p: p.stat().st_mtime_ns for p in folder.rglob("anio=2020/*")} and before
    assert result.summary.count() == 2


def test_rejected_rows_may_hold_any_number(spark, tmp_path):
    source = write_text(
        tmp_path / "i.csv",
        [ACCOUNTS[0], "1,A,1e30,20,otro", "2,B,-1e30,20,ahorro", "3,C,-0.0000000000000000000001,20,ahorro",
         "4,D,0.99999999999999999,20,ahorro"],
    )
    result = run_job(spark, v.MONTHLY_INTEREST_JOB, source, str(tmp_path / "t"), "r1")
    assert rows_of(result.detail, "cuenta_id", "interes_calculado") == [(4, Decimal("0.00"))]
    assert result.counters.first()["saltados_proceso"] == 3
    kept = write_text(tmp_path / "j.csv", [ACCOUNTS[0], "1,A,1e30,20,ahorro"])
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        run_job(spark, v.MONTHLY_INTEREST_JOB, kept, str(tmp_path / "u"), "r1")


def test_the_header_is_the_first_line_that_is_no_comment(spark, tmp_path):
    files = tmp_path / "in"
    files.mkdir()
    write_text(files / "1.csv", ["# made by x", "# twice", TRANSACTIONS[0], "1,2024-01-10,5,credito", "# c"])
    write_text(files / "2.csv", ["# only comments"])
    write_text(files / "3.csv", [TRANSACTIONS[0], "2,2024-01-10,5,credito"])
    result = run_job(spark, v.DAILY_REPORT_JOB, str(files), str(tmp_path / "t"), "r1")
    assert rows_of(result.detail, "transaccion_id_origen", "estado") == [(1, "VALIDA"), (2, "VALIDA")]


def test_settings_on_the_command_line(spark, tmp_path, capsys):
    source = write_text(tmp_path / "i.csv", [ACCOUNTS[0], "1,A,100,20,oro", "2,B,100,20,plata"])
    options = ["--source", source, "--warehouse", str(tmp_path / "t"), "--run-id", "r1"]
    rate = ["--rate", "oro=0.02", "--min-age", "30", "--slices", "1"]
    with pytest.raises(QualityGateError):
        main([v.MONTHLY_INTEREST_JOB, *options, *rate, "--reject-limit", "0"])
    main([v.MONTHLY_INTEREST_JOB, *options, *rate, "--reject-limit", "1"])
    detail = tables.read_table(spark, str(tmp_path / "t"), tables.ACCOUNTS)
    assert rows_of(detail, "edad_utilizada", "interes_calculado") == [(30, Decimal("2.00"))]
    assert "saltados_proceso=1" in capsys.readouterr().out
