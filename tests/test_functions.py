import calendar
import datetime
import random
import re
from decimal import Decimal

import pytest
from conftest import in_order, text_rows
from pyspark.sql import functions as F

from tamiz.functions import numbers as num
from tamiz.functions.dates import date_problem, flexible_date
from tamiz.functions.text import clean, is_blank, message, normalise, render_row, truncate


def text():
    return F.col("texto")


def day(year, month, number):
    return datetime.date(year, month, number)


DATES = {
    "2024-01-10": day(2024, 1, 10),
    "10-01-2024": day(2024, 1, 10),
    "10/01/2024": day(2024, 1, 10),
    "2024/01/10": day(2024, 1, 10),
    "0001-01-01": day(1, 1, 1),
    "9999-12-31": day(9999, 12, 31),
    "29-02-2024": day(2024, 2, 29),
    # past the end of the month
    "31-04-2024": day(2024, 4, 30),
    "2024-02-30": day(2024, 2, 29),
    "2023/02/31": day(2023, 2, 28),
    "29/02/1900": day(1900, 2, 28),
    # no such date, or no such layout
    "2024-13-01": None,
    "2024-00-10": None,
    "2024-01-00": None,
    "2024-01-32": None,
    "0000-01-01": None,
    "01-01-0000": None,
    "2024-1-10": None,
    "24-01-10": None,
    "2024-01/10": None,
    "10-01/2024": None,
    "2024.01.10": None,
    "20240110": None,
    "2024-01-10T00:00": None,
    "2024-01-10 x": None,
    "12024-01-10": None,
    "-2024-01-10": None,
    "abc": None,
    "": None,
}


def test_flexible_date_clamps(spark):
    rows = text_rows(spark, list(DATES)).withColumn("fecha", flexible_date(text()))
    assert dict(in_order(rows, "texto", "fecha")) == DATES


def test_flexible_date_strict(spark):
    clamped = {"31-04-2024", "2024-02-30", "2023/02/31", "29/02/1900"}
    rows = text_rows(spark, list(DATES)).withColumn("fecha", flexible_date(text(), "strict"))
    expected = {text: None if text in clamped else date for text, date in DATES.items()}
    assert dict(in_order(rows, "texto", "fecha")) == expected


def test_flexible_date_every_day_number(spark):
    expected = {}
    for year in (1900, 2000, 2023, 2024):
        for month in range(0, 14):
            for number in range(0, 33):
                fine = 1 <= month <= 12 and 1 <= number <= 31
                date = None
                if fine:
                    last = calendar.monthrange(year, month)[1]
                    date = day(year, month, min(number, last))
                expected[f"{year}-{month:02}-{number:02}"] = date
                expected[f"{number:02}/{month:02}/{year}"] = date
    rows = text_rows(spark, list(expected)).withColumn("fecha", flexible_date(text()))
    assert dict(in_order(rows, "texto", "fecha")) == expected


def test_flexible_date_rejects_unknown_mode():
    with pytest.raises(ValueError):
        flexible_date(text(), "lenient")


def test_date_problem(spark):
    rows = text_rows(spark, ["", "2024-13-01", " "]).withColumn("m", date_problem(text()))
    assert [m for (m,) in in_order(rows, "m")] == [
        "Fecha vacia",
        "Formato de fecha no reconocido: '2024-13-01'",
        "Fecha vacia",
    ]


def test_decimal_or_null(spark):
    cases = {
        "100": "100",
        "-0.5": "-0.5",
        "+7": "7",
        ".5": "0.5",
        "5.": "5",
        "1e3": "1000",
        "1E-3": "0.001",
        "0.004": "0.004",
        "": None,
        "abc": None,
        "1,0": None,
        "1 0": None,
        "NaN": None,
        "Infinity": None,
        "5d": None,
        ".": None,
        "+": None,
        "1e": None,
        "--1": None,
    }
    rows = text_rows(spark, list(cases)).withColumn("x", num.decimal_or_null(text()))
    found = dict(in_order(rows, "texto", "x"))
    assert found == {k: None if x is None else Decimal(x) for k, x in cases.items()}


@pytest.mark.parametrize("huge", ["1e30", "123456789012345678901234567890"])
def test_a_number_too_large_is_not_missing(spark, huge):
    rows = text_rows(spark, [huge]).select(num.decimal_or_null(text()))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        rows.collect()


def test_sink_rounds_half_up_and_raises_on_overflow(spark):
    rows = text_rows(spark, ["50.005", "-0.125", "0.004", "2.675"])
    money = rows.withColumn("x", num.to_money(num.decimal_or_null(text())))
    assert [str(x) for (x,) in in_order(money, "x")] == ["50.01", "-0.13", "0.00", "2.68"]
    wide = text_rows(spark, ["12345678901234"]).select(num.to_money(num.decimal_or_null(text())))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        wide.collect()


def test_whole_numbers(spark):
    texts = ["5", "+5", "-5", "3.0", "", "x9", "01", "2147483648", "9223372036854775808"]
    rows = text_rows(spark, texts).select(
        "n", num.int_or_null(text()).alias("i"), num.long_or_null(text()).alias("l")
    )
    assert in_order(rows, "i", "l") == [
        (5, 5),
        (5, 5),
        (-5, -5),
        (None, None),
        (None, None),
        (None, None),
        (1, 1),
        (None, 2147483648),
        (None, None),
    ]


def test_number_text(spark):
    cases = {
        "-5": "-5",
        "+5": "5",
        "0": "0",
        "00": "0",
        "-0": "0",
        "-0.00": "0.00",
        "-007.10": "-7.10",
        "-.5": "-0.5",
        "5.": "5",
        "0.": "0",
        "0.000": "0.000",
        "-112946.26": "-112946.26",
        "0.0000000": "0E-7",
        "0.000000": "0.000000",
        "1e2": "1E+2",
        "-12.5e3": "-1.25E+4",
        "12.5E1": "125",
        "12.5e+0": "12.5",
        "0e5": "0E+5",
        "-0e-3": "0.000",
        "0.0000012": "0.0000012",
        "0.00000012": "1.2E-7",
        "100e-8": "0.00000100",
        "1e-2000000000": "1E-2000000000",
        "1e-2147483647": "1E-2147483647",
        "1e99999999999": "1e99999999999",
        "": "",
        "abc": "abc",
        "e5": "e5",
    }
    rows = text_rows(spark, list(cases)).withColumn("x", num.number_text(text()))
    assert dict(in_order(rows, "texto", "x")) == cases
    assert in_order(text_rows(spark, [None]).withColumn("x", num.number_text(text())), "x") == [(None,)]


def test_number_text_equals_decimal_numbers(spark):
    """``decimal`` prints by the same rule, but keeps the sign of a zero."""
    pick = random.Random(11)
    digits = lambda most: "".join(pick.choice("000123456789") for _ in range(pick.randrange(most)))
    texts = set()
    while len(texts) < 3000:
        number = pick.choice(["", "-", "+"]) + digits(5) + pick.choice(["", ".", "."]) + digits(12)
        texts.add(number + pick.choice(["", "", f"e{pick.randrange(-12, 12)}", f"E+{pick.randrange(30)}"]))
    texts = [x for x in texts if re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", x)]
    expected = [str(Decimal(x) or Decimal(x).copy_abs()) for x in texts]
    assert len(texts) > 2000
    rows = text_rows(spark, texts).withColumn("x", num.number_text(text()))
    assert [x for (x,) in in_order(rows, "x")] == expected


def test_number_text_bound_to_columns(spark):
    """Step by step it is the same, for rows that have a number to print."""
    texts = [
        "-5", "+5", "00", "-0.00", "-007.10", "-.5", "5.", "0.000", "0.0000000", "0.000000", "1e2", "-12.5e3",
        "12.5E1", "0e5", "-0e-3", "0.0000012", "0.00000012", "100e-8", "1e99999999999", "-1e-2147483647",
    ]
    rows = text_rows(spark, texts)
    stepwise = num.with_number_text(rows, "x", text())
    assert stepwise.columns == ["n", "texto", "x"]
    assert in_order(stepwise, "x") == in_order(rows.withColumn("x", num.number_text(text())), "x")
    some = num.with_number_text(rows, "x", F.when(F.col("n") < 2, text()))
    assert [x for (x,) in in_order(some, "x")] == ["-5", "5"] + [None] * (len(texts) - 2)


def test_clamp_keeps_range_and_defaults_to_minimum(spark):
    rows = spark.createDataFrame([(0, 17), (1, 18), (2, 90), (3, 91), (4, None)], "n int, x int")
    clamped = rows.withColumn("y", num.clamp(F.col("x"), 18, 90))
    assert [y for (y,) in in_order(clamped, "y")] == [18, 18, 90, 90, 18]


def test_rates_and_interest(spark):
    rows = spark.createDataFrame(
        [(0, "ahorro", "1000"), (1, "prestamo", "333.33"), (2, "hipoteca", "250.5"), (3, "x", "1")],
        "n int, tipo string, texto string",
    ).withColumn("saldo", num.decimal_or_null(text()))
    rates = {"ahorro": "0.005", "prestamo": "0.015", "hipoteca": "0.010"}
    rated = rows.withColumn("tasa", num.rate_for(F.col("tipo"), rates))
    rated = rated.withColumn("interes", num.interest_on(F.col("saldo"), F.col("tasa")))
    rated = rated.withColumn("final", num.balance_after(F.col("saldo"), F.col("interes")))
    found = [tuple(map(str, row)) for row in in_order(rated, "tasa", "interes", "final")]
    assert found == [
        ("0.0050", "5.00", "1005.00"),
        ("0.0150", "5.00", "338.33"),
        ("0.0100", "2.51", "253.01"),
        ("None", "None", "None"),
    ]


def test_outflow_has_no_negative_zero(spark):
    rows = text_rows(spark, ["300", "-50.25", "0"])
    signed = rows.withColumn("x", num.to_money(num.outflow(num.decimal_or_null(text()))))
    assert [str(x) for (x,) in in_order(signed, "x")] == ["-300.00", "-50.25", "0.00"]


def test_clean_and_blank(spark):
    cases = [
        ("a", "a", False),
        (" a ", "a", False),
        ("\ta\r\n", "a", False),
        ("\x00a\x1f", "a", False),
        ("", "", True),
        ("   ", "", True),
        ("\u2003", "\u2003", True),  # white space, but not a character that is trimmed
        ("\u00a0", "\u00a0", False),  # a non-breaking space is not white space
        (None, "", True),
        ("a b", "a b", False),
        ("\u00f1 ", "\u00f1", False),
    ]
    rows = text_rows(spark, [raw for raw, _, _ in cases]).withColumn("limpio", clean(text()))
    rows = rows.withColumn("vacio", is_blank(F.col("limpio")))
    assert in_order(rows, "limpio", "vacio") == [(found, blank) for _, found, blank in cases]


def test_normalise(spark):
    rows = text_rows(spark, [" DEBITO", "Crédito", None]).withColumn("x", normalise(clean(text())))
    assert [x for (x,) in in_order(rows, "x")] == ["debito", "crédito", ""]


def test_message_render_truncate(spark):
    rows = spark.createDataFrame([(0, "7", None)], "n int, a string, b string")
    made = rows.select(
        "n",
        message("<{}|{}>", F.col("a"), F.col("b")).alias("m"),
        render_row("Fila", {"x": "a", "y": "b"}).alias("r"),
        truncate(F.lit("abcdef"), 3).alias("t"),
    )
    assert in_order(made, "m", "r", "t") == [("<7|null>", "Fila(x=7, y=null)", "abc")]
    with pytest.raises(ValueError):
        message("no slot", F.col("a"))


@pytest.mark.parametrize("tail", ["\u0085", "\u2028", "\u2029"])
def test_a_line_terminator_inside_a_field_is_no_part_of_a_number_or_date(spark, tail):
    rows = text_rows(spark, [f"5{tail}", f"2024-01-10{tail}", f"10/01/2024{tail}"]).select(
        "n",
        num.decimal_or_null(text()).alias("x"),
        num.long_or_null(text()).alias("y"),
        flexible_date(text()).alias("z"),
    )
    assert in_order(rows, "x", "y", "z") == [(None, None, None)] * 3


def test_signs_are_judged_on_all_digits(spark):
    cases = {
        "0.0000000000000000001": 1,
        "-0.0000000000000000001": -1,
        "-0.000000000000000000": 0,
        "0e5": 0,
        "-1e30": -1,
        "1e-30": 1,
        "+.5": 1,
        "-": 0,
        "x1": 0,
    }
    rows = text_rows(spark, list(cases)).select(
        "n", num.is_positive(text()).alias("p"), num.is_negative(text()).alias("m")
    )
    assert in_order(rows, "p", "m") == [(sign > 0, sign < 0) for sign in cases.values()]


def test_interest_and_money_are_rounded_once(spark):
    rows = text_rows(spark, ["0.99999999999999999", "0.00499999999999999999999999", "333.33"])
    balance = num.decimal_or_null(text())
    found = rows.select(
        "n",
        num.interest_on(balance, F.lit("0.005").cast(num.RATE)).alias("i"),
        num.to_money(balance).alias("m"),
    )
    assert [(str(i), str(m)) for i, m in in_order(found, "i", "m")] == [
        ("0.00", "1.00"),
        ("0.00", "0.00"),
        ("1.67", "333.33"),
    ]


def test_an_amount_too_large_is_an_error_only_where_it_is_required(spark):
    rows = text_rows(spark, ["1e30", "7", "x"])
    fits = num.decimal_if_it_fits(text())
    assert in_order(rows.select("n", fits.alias("x")), "x") == [(None,), (Decimal(7),), (None,)]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        rows.select(num.required(fits, text())).collect()
