"""Daily transactions: classify every row, flag repeated ids, sum up per day."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from tamiz import vocabulary as v
from tamiz.functions.dates import date_problem, flexible_date
from tamiz.functions.numbers import (
    decimal_or_null,
    is_number,
    is_positive,
    long_or_null,
    number_text,
    to_money,
)
from tamiz.functions.text import clean, is_blank, message, normalise
from tamiz.operators.repeats import RepeatLimits, flag_repeats
from tamiz.operators.rules import Rule, all_messages, any_holds, not_in

DETAIL_COLUMNS = ("transaccion_id_origen", "fecha", "monto", "tipo", "estado", "motivo")


@dataclass(frozen=True)
class TransactionsConfig:
    job_name: str = v.DAILY_REPORT_JOB
    step_name: str = v.DAILY_REPORT_STEP
    fields: tuple[str, ...] = v.TRANSACTION_FIELDS
    allowed_types: tuple[str, ...] = v.TRANSACTION_TYPES
    reject_limit: int = v.REJECT_LIMIT
    slices: int = v.SLICES
    limits: RepeatLimits = field(default_factory=RepeatLimits)


def parse_transactions(feed: DataFrame, seq: str = "seq") -> DataFrame:
    """Typed columns next to the cleaned text.  ``id_key`` is the id as *text*
    (``1`` and ``01`` differ) and NULL when blank, so blanks never repeat."""
    texts = feed.select(
        F.col(seq).alias("seq"),
        *[clean(F.col(name)).alias(f"{name}_texto") for name in v.TRANSACTION_FIELDS],
    )
    return texts.select(
        "*",
        F.when(~is_blank(F.col("id_texto")), F.col("id_texto")).alias("id_key"),
        flexible_date(F.col("fecha_texto")).alias("fecha"),
        decimal_or_null(F.col("monto_texto")).alias("importe"),
        normalise(F.col("tipo_texto")).alias("tipo"),
    )


def transaction_issues(allowed_types=v.TRANSACTION_TYPES) -> list[Rule]:
    date_text, date = F.col("fecha_texto"), F.col("fecha")
    amount, amount_text = F.col("importe"), F.col("monto_texto")
    return [
        Rule(date.isNull(), date_problem(date_text)),
        Rule(amount.isNull(), F.lit(v.MSG_AMOUNT_MISSING)),
        # On the text: 0.004 is positive although it is stored as 0.00.
        Rule(
            is_number(amount_text) & ~is_positive(amount_text),
            message(v.MSG_AMOUNT_NOT_POSITIVE, number_text(amount_text)),
        ),
        Rule(
            not_in(F.col("tipo"), allowed_types),
            message(v.MSG_TRANSACTION_TYPE, F.col("tipo_texto")),
        ),
    ]


def classify_transactions(
    feed: DataFrame, config: TransactionsConfig = TransactionsConfig(), seq: str = "seq"
) -> DataFrame:
    """Every row of the feed with its status; duplicate beats anomaly."""
    flagged = flag_repeats(
        parse_transactions(feed, seq), "id_key", "seq", "es_duplicado", config.limits
    )
    issues = transaction_issues(config.allowed_types)
    duplicate = F.col("es_duplicado")
    return flagged.select(
        "seq",
        long_or_null(F.col("id_texto")).alias("transaccion_id_origen"),
        "fecha",
        to_money(F.col("importe")).alias("monto"),
        "tipo",
        F.when(duplicate, v.DUPLICATE)
        .when(any_holds(issues), v.ANOMALY)
        .otherwise(v.VALID)
        .alias("estado"),
        F.when(duplicate, message(v.MSG_DUPLICATE_ID, F.col("id_texto")))
        .otherwise(all_messages(issues))
        .alias("motivo"),
    )


def daily_summary(detail: DataFrame) -> DataFrame:
    """One row per dated day.  Sums take the rounded, stored amounts of valid
    rows; rows without a date are in the detail only.

    The undated group is dropped by its count after the aggregate: as a filter
    on ``fecha`` it would be pushed below the projection and parse each date of
    an unsaved detail a second time.
    """
    status = F.col("estado")

    def valid_sum(kind: str):
        total = F.sum(F.when((status == v.VALID) & (F.col("tipo") == kind), F.col("monto")))
        return to_money(F.coalesce(total, F.lit(0)))

    return (
        detail.groupBy("fecha")
        .agg(
            F.count("fecha").alias("total_transacciones"),
            F.count_if(status == v.VALID).alias("total_validas"),
            F.count_if(status == v.ANOMALY).alias("total_anomalias"),
            F.count_if(status == v.DUPLICATE).alias("total_duplicadas"),
            valid_sum("credito").alias("monto_total_credito"),
            valid_sum("debito").alias("monto_total_debito"),
        )
        .where(F.col("total_transacciones") > 0)
    )


def undated_by_status(detail: DataFrame) -> DataFrame:
    """Rows that no day's summary contains, by status."""
    return (
        detail.groupBy("estado")
        .agg(F.count_if(F.col("fecha").isNull()).alias("cantidad"))
        .where(F.col("cantidad") > 0)
    )
