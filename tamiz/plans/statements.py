"""Annual statements: normalise signs, default texts, sum up per account and year."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tamiz import vocabulary as v
from tamiz.functions.dates import date_problem, flexible_date
from tamiz.functions.numbers import (
    decimal_or_null,
    is_above_zero,
    is_number,
    long_or_null,
    outflow,
    to_money,
    with_number_text,
)
from tamiz.functions.text import clean, is_blank, message, normalise
from tamiz.operators.rules import (
    REJECT_REASON,
    REJECTED,
    Reject,
    Rule,
    all_messages,
    any_holds,
    judged,
    not_in,
    with_outcome,
)

DETAIL_COLUMNS = (
    "cuenta_id",
    "fecha",
    "tipo_transaccion",
    "monto",
    "descripcion",
    "estado",
    "motivo",
)
HAS_AMOUNT, PRINTED_AMOUNT = "monto_valido", "monto_impreso"


@dataclass(frozen=True)
class StatementsConfig:
    job_name: str = v.ANNUAL_STATEMENT_JOB
    step_name: str = v.ANNUAL_STATEMENT_STEP
    fields: tuple[str, ...] = v.MOVEMENT_FIELDS
    known_types: tuple[str, ...] = v.MOVEMENT_TYPES
    default_description: str = v.DEFAULT_DESCRIPTION
    reject_limit: int = v.REJECT_LIMIT
    slices: int = v.SLICES


def parse_movements(feed: DataFrame) -> DataFrame:
    """Cleaned fields under their own names, typed ones next to them; any other
    column of the feed (its sequence, say) is carried along."""
    carried = [name for name in feed.columns if name not in v.MOVEMENT_FIELDS]
    texts = feed.select(*carried, *[clean(F.col(name)).alias(name) for name in v.MOVEMENT_FIELDS])
    return texts.withColumn(HAS_AMOUNT, is_number(F.col("monto"))).select(
        "*",
        flexible_date(F.col("fecha")).alias("fecha_leida"),
        decimal_or_null(F.col("monto"), F.col(HAS_AMOUNT)).alias("importe"),
        normalise(F.col("transaccion")).alias("tipo_transaccion"),
    )


def movement_rejects() -> list[Reject]:
    # On the text: a filter by this rule is pushed down without the conversion.
    return [
        Reject(
            ~F.col(HAS_AMOUNT),
            message(v.MSG_MOVEMENT_AMOUNT_MISSING, F.col("cuenta_id")),
            v.BAD_AMOUNT,
        )
    ]


def movement_issues(known_types=v.MOVEMENT_TYPES) -> list[Rule]:
    """The message of the last one prints column ``PRINTED_AMOUNT``."""
    kind, date = F.col("tipo_transaccion"), F.col("fecha_leida")
    amount = F.col("monto")
    not_positive = F.col(HAS_AMOUNT) & ~is_above_zero(amount)
    return [
        Rule(date.isNull(), date_problem(F.col("fecha"))),
        Rule(not_in(kind, known_types), message(v.MSG_MOVEMENT_TYPE, F.col("transaccion"))),
        Rule(
            kind.isin(*v.DEPOSIT_TYPES) & not_positive,
            message(v.MSG_DEPOSIT_NOT_POSITIVE, F.col(PRINTED_AMOUNT)),
        ),
    ]


def is_outflow(kind: Column) -> Column:
    return kind.isin(*v.OUTFLOW_TYPES)


def signed_amount(kind: Column, amount: Column) -> Column:
    """Outflows are stored negative, whatever sign they came with."""
    return F.when(is_outflow(kind), outflow(amount)).otherwise(amount)


def movement_corrections() -> list[Rule]:
    kind = F.col("tipo_transaccion")
    positive = F.col(HAS_AMOUNT) & is_above_zero(F.col("monto"))
    return [
        Rule(is_outflow(kind) & positive, message(v.MSG_SIGN_FIXED, kind)),
        Rule(is_blank(F.col("descripcion")), F.lit(v.MSG_DESCRIPTION_DEFAULTED)),
    ]


def default_text(text: Column, default: str) -> Column:
    return F.when(is_blank(text), F.lit(default)).otherwise(text)


def classify_movements(feed: DataFrame) -> DataFrame:
    """Parsed rows, whether they are rejected and why; no shuffle."""
    return with_outcome(parse_movements(feed), movement_rejects())


def movement_detail(
    kept: DataFrame, config: StatementsConfig = StatementsConfig(), seen: Observation | None = None
) -> DataFrame:
    """Kept movements with status; an anomaly's note hides its corrections.  ``seen``, if
    given, takes their number as ``escritos`` and nothing is carried: it counts halfway, which parts the generated
    code, so that neither half is too long for the JVM to compile."""
    known = movement_issues(config.known_types)
    rows, rules = judged(kept, [*known, *movement_corrections()])
    issues, corrections = rules[: len(known)], rules[len(known) :]
    no_description = corrections[-1]
    rows = with_number_text(rows, PRINTED_AMOUNT, F.when(issues[-1].holds, F.col("monto")))
    kind = F.col("tipo_transaccion")
    parsed = {*v.MOVEMENT_FIELDS, HAS_AMOUNT, "fecha_leida", "importe", "tipo_transaccion"}
    carried = [name for name in kept.columns if name not in parsed | {REJECTED, REJECT_REASON}]
    rows = rows.withColumn("monto", to_money(signed_amount(kind, F.col("importe"))))
    rows = rows.drop("importe", HAS_AMOUNT, REJECTED, REJECT_REASON)
    if seen is not None:
        rows, carried = rows.drop(*carried).observe(seen, F.count(F.lit(1)).alias("escritos")), []
    return rows.select(
        *carried,
        long_or_null(F.col("cuenta_id")).alias("cuenta_id"),
        F.col("fecha_leida").alias("fecha"),
        "tipo_transaccion",
        "monto",
        F.when(no_description.holds, config.default_description).otherwise(F.col("descripcion")).alias("descripcion"),
        F.when(any_holds(issues), v.ANOMALY)
        .when(any_holds(corrections), v.CORRECTED)
        .otherwise(v.VALID)
        .alias("estado"),
        F.coalesce(all_messages(issues), all_messages(corrections)).alias("motivo"),
    )


def annual_statement(detail: DataFrame) -> DataFrame:
    """One row per account and year.  Deposits leave anomalies out, the net sum
    keeps them, so deposits minus outflows need not equal the net.

    Rows without account or date form groups that count no movement; they go by
    that count, not by a filter that would be pushed below the projection.
    """
    status, kind, amount = F.col("estado"), F.col("tipo_transaccion"), F.col("monto")

    def total(condition: Column, value: Column) -> Column:
        return to_money(F.coalesce(F.sum(F.when(condition, value)), F.lit(0)))

    deposit = kind.isin(*v.DEPOSIT_TYPES) & (status != v.ANOMALY)
    return (
        detail.groupBy("cuenta_id", F.year("fecha").alias("anio"))
        .agg(
            total(deposit, amount).alias("total_depositos"),
            total(is_outflow(kind), F.abs(amount)).alias("total_salidas"),
            total(F.lit(True), amount).alias("saldo_neto_anual"),
            F.expr("count(cuenta_id, fecha)").alias("cantidad_movimientos"),
            F.count_if(status == v.ANOMALY).alias("cantidad_anomalias"),
        )
        .where(F.col("cantidad_movimientos") > 0)
    )
