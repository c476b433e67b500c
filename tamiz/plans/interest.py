"""Monthly interest: drop copies, reject, repair the age, apply the rate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tamiz import vocabulary as v
from tamiz.functions.numbers import (
    balance_after,
    clamp,
    decimal_if_it_fits,
    int_or_null,
    interest_on,
    is_negative,
    is_number,
    long_or_null,
    number_text,
    rate_for,
    required,
    to_money,
)
from tamiz.functions.text import clean, message, normalise
from tamiz.operators.repeats import drop_copies
from tamiz.operators.rules import Reject, not_in, with_outcome

DETAIL_COLUMNS = (
    "cuenta_id",
    "nombre",
    "tipo",
    "saldo_inicial",
    "edad_original",
    "edad_utilizada",
    "tasa_aplicada",
    "interes_calculado",
    "saldo_final",
    "estado",
    "observacion",
)


@dataclass(frozen=True)
class InterestConfig:
    job_name: str = v.MONTHLY_INTEREST_JOB
    step_name: str = v.MONTHLY_INTEREST_STEP
    fields: tuple[str, ...] = v.ACCOUNT_FIELDS
    rates: dict[str, str] = field(default_factory=lambda: dict(v.MONTHLY_RATES))
    min_age: int = v.MIN_AGE
    max_age: int = v.MAX_AGE
    reject_limit: int = v.REJECT_LIMIT
    slices: int = v.SLICES


def clean_accounts(feed: DataFrame, seq: str = "seq") -> DataFrame:
    return feed.select(
        F.col(seq).alias("seq"), *[clean(F.col(name)).alias(name) for name in v.ACCOUNT_FIELDS]
    )


def distinct_accounts(feed: DataFrame, seq: str = "seq") -> DataFrame:
    """Copies on all five fields, whatever their case, dropped before any rule
    looks at them: a repeated bad row is rejected once."""
    accounts = clean_accounts(feed, seq)
    keys = [normalise(F.col(name)) for name in v.ACCOUNT_FIELDS]
    return drop_copies(accounts, keys, "seq", "copias")


def account_rejects(allowed_types) -> list[Reject]:
    """In order; the first that holds is the one logged.  Zero is a fine balance.
    All look at the text: an amount that no column holds is an error only in a
    row that is kept."""
    balance = F.col("saldo")
    return [
        Reject(
            not_in(F.col("tipo_normal"), allowed_types),
            message(v.MSG_ACCOUNT_TYPE, F.col("tipo")),
            v.BAD_CATEGORY,
        ),
        Reject(
            ~is_number(balance),
            message(v.MSG_BALANCE_MISSING, F.col("cuenta_id")),
            v.BAD_AMOUNT,
        ),
        Reject(
            is_negative(balance),
            message(v.MSG_BALANCE_NEGATIVE, number_text(balance)),
            v.BAD_AMOUNT,
        ),
    ]


def age_note(age: Column, low: int, high: int) -> Column:
    """What was done to the age; NULL when it was used as given."""
    return (
        F.when(age.isNull(), message(v.MSG_AGE_MISSING, F.lit(low)))
        .when(age < low, message(v.MSG_AGE_LOW, age, F.lit(low)))
        .when(age > high, message(v.MSG_AGE_HIGH, age, F.lit(high)))
    )


def age_repaired(age: Column, low: int, high: int) -> Column:
    return age.isNull() | (age < low) | (age > high)


def parse_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.select(
        "*",
        normalise(F.col("tipo")).alias("tipo_normal"),
        decimal_if_it_fits(F.col("saldo")).alias("saldo_leido"),
        int_or_null(F.col("edad")).alias("edad_original"),
    )


def classify_accounts(
    feed: DataFrame, config: InterestConfig = InterestConfig(), seq: str = "seq"
) -> DataFrame:
    """One row per distinct account line: cleaned fields, number of copies,
    parsed fields, whether it is rejected and why."""
    parsed = parse_accounts(distinct_accounts(feed, seq))
    return with_outcome(parsed, account_rejects(tuple(config.rates)))


def interest_detail(kept: DataFrame, config: InterestConfig = InterestConfig()) -> DataFrame:
    """Kept account lines with age repaired and interest applied."""
    age, balance = F.col("edad_original"), required(F.col("saldo_leido"), F.col("saldo"))
    rated = kept.select(
        "*",
        rate_for(F.col("tipo_normal"), config.rates).alias("tasa_aplicada"),
        clamp(age, config.min_age, config.max_age).alias("edad_utilizada"),
    ).select("*", interest_on(balance, F.col("tasa_aplicada")).alias("interes_calculado"))
    repaired = age_repaired(age, config.min_age, config.max_age)
    return rated.select(
        "seq",
        long_or_null(F.col("cuenta_id")).alias("cuenta_id"),
        "nombre",
        F.col("tipo_normal").alias("tipo"),
        to_money(balance).alias("saldo_inicial"),
        "edad_original",
        "edad_utilizada",
        "tasa_aplicada",
        "interes_calculado",
        balance_after(balance, F.col("interes_calculado")).alias("saldo_final"),
        F.when(repaired, v.CORRECTED).otherwise(v.VALID).alias("estado"),
        age_note(age, config.min_age, config.max_age).alias("observacion"),
    )


def first_accounts(detail: DataFrame, how_many: int = 20) -> DataFrame:
    """The first accounts by id; ``seq`` settles ties, so the report is stable."""
    return detail.orderBy("cuenta_id", "seq").limit(how_many)
