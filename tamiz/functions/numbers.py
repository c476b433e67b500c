"""Lenient numbers: NULL instead of an error, exact decimals, half-up rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

AMOUNT = "decimal(38,18)"
MONEY = "decimal(15,2)"
RATE = "decimal(6,4)"
# What fits a money column, with the scale of an amount; times a rate it is
# exactly 38 digits, so a product is rounded once.
BALANCE = "decimal(31,18)"

# "\z", because "$" also matches before a final line terminator.
_WHOLE = r"\A[+-]?[0-9]+\z"
_NUMBER = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
_NOT_ZERO = r"\A[^eE]*[1-9]"
# All of a number but the digits of its mantissa, without zeros in front; the last zero stays.
_NO_DIGITS = r"\A[+-]?[0.]*(?=[0-9])|[eE].*\z|[^0-9]"
_FRACTION = r"\.([0-9]*)"
_EXPONENT = r"[eE]([+-]?[0-9]+)"
#: A plain number below one has at most this many zeros before its first digit, the one
#: before the point included.
_MOST_ZEROS = 6
_LONG_FRACTION = r"\A([^eE.]*\.[0-9]{18})[0-9]+\z"


def is_number(text: Column) -> Column:
    return text.rlike(_NUMBER)


def is_negative(text: Column) -> Column:
    """Whether a number is below zero, judged on all its digits; false for other text."""
    return is_number(text) & text.startswith("-") & text.rlike(_NOT_ZERO)


def is_positive(text: Column) -> Column:
    """Whether a number is above zero, judged on all its digits; false for other text."""
    return is_number(text) & is_above_zero(text)


def is_above_zero(number: Column) -> Column:
    """``is_positive`` of a text that is known to be a number."""
    return ~number.startswith("-") & number.rlike(_NOT_ZERO)


def _storable(text: Column) -> Column:
    """Digits after the 18th decimal are cut off: rounding them here would round
    the amount twice."""
    return F.when(
        F.length(text) > 19, F.regexp_replace(text, _LONG_FRACTION, "$1")
    ).otherwise(text)


def decimal_or_null(text: Column, number: Column | None = None) -> Column:
    """Amount of a row that is stored, or NULL when the text is not a number; ``number``
    tells whether it is, where that is a column already.

    A number too large for any money column is not "missing": the guarded ANSI
    cast raises on it, so it can never be filed as one more anomalous row.
    """
    return F.when(is_number(text) if number is None else number, _storable(text).cast(AMOUNT))


def decimal_if_it_fits(text: Column) -> Column:
    """Amount, or NULL when the text is not a number or too large: for rows that
    may yet be rejected.  ``required`` restores the error for those that are not."""
    return F.when(is_number(text), _storable(text).try_cast(AMOUNT))


def required(amount: Column, text: Column) -> Column:
    """``amount``, or where that is NULL the amount of ``text``, too large or not."""
    return F.coalesce(amount, decimal_or_null(text))


def int_or_null(text: Column) -> Column:
    """Whole number, or NULL when the text is none or does not fit."""
    return _whole_or_null(text, "int")


def long_or_null(text: Column) -> Column:
    return _whole_or_null(text, "bigint")


def _whole_or_null(text: Column, kind: str) -> Column:
    # Tested first: a cast that fails costs an exception per row.
    return F.when(text.rlike(_WHOLE), text.try_cast(kind))


def to_money(amount: Column) -> Column:
    """Sink column: two decimals, half up; an amount that does not fit raises
    (ANSI cast, never ``try_cast``)."""
    return amount.cast(MONEY)


def _digits(number: Column) -> Column:
    """All digits before the exponent, without zeros in front."""
    return F.regexp_replace(number, _NO_DIGITS, "")


def _scale(number: Column) -> Column:
    """The digits after the point less the exponent; NULL if no ``int`` holds that."""
    # The first exponent counts: its own, or the 0 of a number that has none.
    exponent = F.regexp_extract(F.concat(number, F.lit("e0")), _EXPONENT, 1).try_cast("int")
    return F.length(F.regexp_extract(number, _FRACTION, 1)) - exponent.cast("bigint")


def _behind_point(digits: Column, scale: Column) -> Column:
    """How many of the digits are printed behind the point: all but the first, if it
    takes an exponent to print the number."""
    first = F.length(digits) - 1
    return F.when((scale < 0) | (first - scale < -_MOST_ZEROS), first).otherwise(scale).cast("int")


def _padded(digits: Column, behind: Column) -> Column:
    return F.lpad(digits, F.greatest(F.length(digits), behind + 1), F.lit("0"))


def _printed(number: Column, digits: Column, scale: Column, behind: Column, padded: Column) -> Column:
    # No point is left behind a whole number.
    pointed = F.rtrim(F.overlay(padded, F.lit("."), F.length(padded) - behind + 1, F.lit(0)), F.lit("."))
    exponent = F.when(behind == scale, F.lit("")).otherwise(F.format_string("E%+d", F.length(digits) - 1 - scale))
    minus = F.when(number.startswith("-") & (digits != "0"), F.lit("-")).otherwise(F.lit(""))
    return F.coalesce(F.concat(minus, pointed, exponent), number)


def number_text(text: Column) -> Column:
    """A number as a message prints it: its digits without leading zeros, and a
    scale, the digits after the point less the exponent.  With a scale of 0 the
    digits alone; with a positive one the point stands that many digits from the
    right, unless that takes more than six zeros after the point; all else is
    one digit, the others behind the point, and an exponent (``1E+2``, ``0E-7``).
    Other text, and an exponent that no ``int`` holds, pass through as written.
    """
    digits, scale = _digits(text), _scale(text)
    behind = _behind_point(digits, scale)
    return F.when(is_number(text), _printed(text, digits, scale, behind, _padded(digits, behind))).otherwise(text)


def with_number_text(rows: DataFrame, name: str, number: Column) -> DataFrame:
    """``rows`` with ``number_text`` of ``number``, which is a number or NULL, as column
    ``name``.  Each step is a column of its own: as one expression, which
    repeats them, the generated code is too long for the JVM to compile."""
    steps = [f"__{name}_{step}" for step in ("number", "digits", "scale", "behind", "padded")]
    number_, digits, scale, behind, padded = map(F.col, steps)
    rows_ = rows.select("*", number.alias(steps[0]))
    rows_ = rows_.select("*", _digits(number_).alias(steps[1]), _scale(number_).alias(steps[2]))
    rows_ = rows_.select("*", _behind_point(digits, scale).alias(steps[3]))
    rows_ = rows_.select("*", _padded(digits, behind).alias(steps[4]))
    return rows_.select(*rows.columns, _printed(number_, digits, scale, behind, padded).alias(name))


def rate_for(category: Column, rates: dict[str, str]) -> Column:
    """Rate of a category as a literal lookup; NULL for an unknown one.

    The rate list is configuration (a handful of entries), so it is part of the
    expression and needs neither a join nor a broadcast.
    """
    picked = F.lit(None).cast(RATE)
    for name, rate in rates.items():
        picked = F.when(category == name, F.lit(rate).cast(RATE)).otherwise(picked)
    return picked


def interest_on(balance: Column, rate: Column) -> Column:
    return F.round(balance.cast(BALANCE) * rate, 2).cast(MONEY)


def balance_after(balance: Column, interest: Column) -> Column:
    return F.round(balance.cast(BALANCE) + interest, 2).cast(MONEY)


def clamp(value: Column, low: int, high: int) -> Column:
    """``value`` held within ``low..high``; a missing value becomes ``low``."""
    return F.coalesce(F.least(F.greatest(value, F.lit(low)), F.lit(high)), F.lit(low))


def outflow(amount: Column) -> Column:
    return -F.abs(amount)
