"""Dates written in any of four day-precision layouts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tamiz import vocabulary as v
from tamiz.functions.text import is_blank, message

# The layouts yyyy-MM-dd, dd-MM-yyyy, dd/MM/yyyy and yyyy/MM/dd,
# with year 1-9999, month 1-12 and day 1-31.  No text fits more than one.
# "\z", because "$" also matches before a final line terminator.
_YEAR_FIRST = r"\A(?!0000)\d{4}([-/])(0[1-9]|1[0-2])\1(0[1-9]|[12]\d|3[01])\z"
_DAY_FIRST = r"\A(0[1-9]|[12]\d|3[01])([-/])(0[1-9]|1[0-2])\2(?!0000)\d{4}\z"


def flexible_date(text: Column, month_end: str = "clamp") -> Column:
    """Date, or NULL when no layout fits or the calendar has no such month/day.

    ``month_end='clamp'`` moves days 29-31 of a shorter month to its last day
    (``31-04-2024`` is 30 April); ``'strict'`` makes them NULL.

    The patterns settle layout and ranges, so the first of the month always
    exists and the day is counted from it: no cast here can fail.
    """
    if month_end not in ("clamp", "strict"):
        raise ValueError(f"month_end must be 'clamp' or 'strict', not {month_end!r}")
    year_first, day_first = text.rlike(_YEAR_FIRST), text.rlike(_DAY_FIRST)

    def month_start(year_at: int, month_at: int) -> Column:
        year, month = F.substring(text, year_at, 4), F.substring(text, month_at, 2)
        return F.concat(year, F.lit("-"), month, F.lit("-01"))

    first = (
        F.when(year_first, month_start(1, 6)).when(day_first, month_start(7, 4)).cast("date")
    )
    day = (
        F.when(year_first, F.substring(text, 9, 2))
        .when(day_first, F.substring(text, 1, 2))
        .cast("int")
    )
    days = F.dayofmonth(F.last_day(first))
    if month_end == "clamp":
        return F.date_add(first, F.least(day, days) - 1)
    return F.when(day <= days, F.date_add(first, day - 1))


def date_problem(text: Column) -> Column:
    """Why a ``clean`` text gave no date."""
    return F.when(is_blank(text), F.lit(v.MSG_DATE_EMPTY)).otherwise(
        message(v.MSG_DATE_UNKNOWN, text)
    )
