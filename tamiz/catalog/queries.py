"""Every operator as a query over the given tables: name -> (spark, sf_dir) -> rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tamiz import vocabulary as v
from tamiz.catalog import feeds
from tamiz.functions.dates import date_problem, flexible_date
from tamiz.functions.numbers import (
    balance_after,
    clamp,
    decimal_or_null,
    int_or_null,
    interest_on,
    long_or_null,
    rate_for,
    number_text,
    to_money,
)
from tamiz.functions.text import clean, is_blank, normalise, render_row
from tamiz.operators.histogram import rows_per_worker, status_histogram, worker_name
from tamiz.operators.quality import (
    LOG_COLUMNS,
    newest_first,
    reject_log,
    rejects_by_slice,
    run_counters,
)
from tamiz.operators.repeats import flag_repeats
from tamiz.operators.rules import REJECT_REASON, REJECTED, split
from tamiz.operators.slices import slice_feed, slice_of, slice_table
from tamiz.plans import interest, statements, transactions
from tamiz.plans.jobs import JobResult, run_job
from tamiz.session import Scratch, balanced_scans
from tamiz.sources import delimited, tables

Query = Callable[[SparkSession, str], DataFrame]

# Jobs over feeds this dirty would not pass the default gate; how many rejects
# are too many is a setting of the feed.
OPEN_GATE = 1 << 62

ACCOUNT_ITEM = (v.ACCOUNT_LABEL, v.ACCOUNT_PRINT_FIELDS)
MOVEMENT_ITEM = (v.MOVEMENT_LABEL, v.MOVEMENT_PRINT_FIELDS)


# --- scalar operators ---------------------------------------------------------


def _parsed_dates(spark: SparkSession, sf_dir: str, month_end: str) -> DataFrame:
    text = F.col("texto")
    return (
        feeds.transactions(spark, sf_dir)
        .select("seq", clean(F.col("fecha")).alias("texto"))
        .select("seq", "texto", flexible_date(text, month_end).alias("fecha"))
        .select("*", F.when(F.col("fecha").isNull(), date_problem(text)).alias("problema"))
    )


def flexible_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed_dates(spark, sf_dir, "clamp")


def flexible_date_parse_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed_dates(spark, sf_dir, "strict")


def lenient_number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    def numbers(feed: DataFrame, name: str, whole: str, small: str | None, amount: str):
        small_text = F.lit("") if small is None else clean(F.col(small))
        return feed.select(
            "seq",
            F.lit(name).alias("origen"),
            long_or_null(clean(F.col(whole))).alias("entero_largo"),
            int_or_null(small_text).alias("entero"),
            to_money(decimal_or_null(clean(F.col(amount)))).alias("importe"),
        )

    return numbers(feeds.transactions(spark, sf_dir), "T", "id", None, "monto").unionByName(
        numbers(feeds.accounts(spark, sf_dir), "I", "cuenta_id", "edad", "saldo")
    )


def number_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts as messages print them, whatever exponent they are written with."""

    def texts(feed: DataFrame, name: str, amount: str) -> DataFrame:
        spelled = feed.selectExpr("seq", f"'{name}' as origen", feeds.NUMBER_TEXT.format(amount=amount))
        return spelled.withColumn("impreso", number_text(F.col("texto")))

    return texts(feeds.transactions(spark, sf_dir), "T", "monto").unionByName(
        texts(feeds.accounts(spark, sf_dir), "I", "saldo")
    )


def category_normalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw categories, blank test and allowed-set test."""
    text = clean(F.col("tipo"))
    return (
        feeds.transactions(spark, sf_dir)
        .select("seq", normalise(text).alias("tipo"), is_blank(clean(F.col("id"))).alias("id_vacio"))
        .select("*", F.col("tipo").isin(*v.TRANSACTION_TYPES).alias("permitido"))
    )


def age_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = F.col("edad_original")
    return (
        feeds.accounts(spark, sf_dir)
        .select("seq", int_or_null(clean(F.col("edad"))).alias("edad_original"))
        .select(
            "*",
            clamp(age, v.MIN_AGE, v.MAX_AGE).alias("edad_utilizada"),
            interest.age_note(age, v.MIN_AGE, v.MAX_AGE).alias("observacion"),
        )
    )


def rate_lookup_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate, interest and final balance of every line; NULL where either the
    category or the balance is no good."""
    balance, rate = F.col("saldo_leido"), F.col("tasa_aplicada")
    return (
        feeds.accounts(spark, sf_dir)
        .select(
            "seq",
            normalise(clean(F.col("tipo"))).alias("tipo"),
            decimal_or_null(clean(F.col("saldo"))).alias("saldo_leido"),
        )
        .select("*", rate_for(F.col("tipo"), v.MONTHLY_RATES).alias("tasa_aplicada"))
        .select("*", interest_on(balance, rate).alias("interes_calculado"))
        .select(
            "seq",
            "tipo",
            "tasa_aplicada",
            "interes_calculado",
            balance_after(balance, F.col("interes_calculado")).alias("saldo_final"),
        )
    )


def sign_normalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, amount = F.col("tipo_transaccion"), F.col("importe")
    return statements.parse_movements(feeds.movements(spark, sf_dir)).select(
        "pedido",
        "linea",
        "tipo_transaccion",
        to_money(amount).alias("monto_original"),
        to_money(statements.signed_amount(kind, amount)).alias("monto"),
    )


def default_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = clean(F.col("descripcion"))
    return feeds.movements(spark, sf_dir).select(
        "pedido",
        "linea",
        statements.default_text(text, v.DEFAULT_DESCRIPTION).alias("descripcion"),
        is_blank(text).alias("por_defecto"),
    )


# --- transactions -------------------------------------------------------------


def transactions_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions.classify_transactions(feeds.transactions(spark, sf_dir))


def duplicate_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.transactions(spark, sf_dir).select("seq", clean(F.col("id")).alias("id"))
    keyed = rows.select("*", F.when(~is_blank(F.col("id")), F.col("id")).alias("clave"))
    return flag_repeats(keyed, "clave", "seq", "es_duplicado").select("seq", "id", "es_duplicado")


def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = transactions.classify_transactions(feeds.transactions(spark, sf_dir))
    return transactions.daily_summary(detail).orderBy("fecha")


def undated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = transactions.classify_transactions(feeds.transactions(spark, sf_dir))
    return transactions.undated_by_status(detail)


def summary_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that share many days: the summary of the credits is upserted
    over that of all other rows, and the stored table is the result."""
    detail = transactions.classify_transactions(feeds.transactions(spark, sf_dir))
    scratch = Scratch(spark)
    warehouse = scratch.path("warehouse")
    for part in (detail.where("tipo <> 'credito'"), detail.where("tipo = 'credito'")):
        summary = transactions.daily_summary(part).withColumn("anio", F.year("fecha"))
        tables.upsert(
            summary.withColumn("generado_en", F.current_timestamp()),
            warehouse,
            tables.DAILY_SUMMARY,
            scratch,
        )
    return tables.read_table(spark, warehouse, tables.DAILY_SUMMARY).drop("generado_en", "anio")


def detail_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail stored by run and read back; the second write of a run id replaces
    the first."""
    detail = transactions.classify_transactions(feeds.transactions(spark, sf_dir))
    stamped = detail.withColumn("procesado_por_hilo", worker_name()).withColumn(
        "procesado_en", F.current_timestamp()
    )
    warehouse = Scratch(spark).path("warehouse")
    for run_id in ("a", "b", "b"):
        tables.write_run(stamped, warehouse, tables.TRANSACTIONS, run_id=run_id)
    stored = tables.read_table(spark, warehouse, tables.TRANSACTIONS)
    return stored.select("run_id", *transactions.DETAIL_COLUMNS)


def _stored_with_workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = transactions.classify_transactions(feeds.transactions(spark, sf_dir))
    stamped = detail.withColumn("procesado_por_hilo", worker_name()).withColumn(
        "procesado_en", F.current_timestamp()
    )
    warehouse = Scratch(spark).path("warehouse")
    tables.write_run(stamped, warehouse, tables.TRANSACTIONS, run_id="run-1")
    return tables.read_table(spark, warehouse, tables.TRANSACTIONS)


def rows_by_worker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the worker noted in the stored table; which worker had which depends on the run."""
    return rows_per_worker(_stored_with_workers(spark, sf_dir))


def rows_by_worker_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows stored with worker and time, and whether the counts by worker add up to them."""
    stored = _stored_with_workers(spark, sf_dir)
    by_worker = rows_per_worker(stored).agg(F.sum("cantidad").alias("por_trabajador"))
    rows = stored.agg(
        F.count(F.lit(1)).alias("filas"),
        F.count_if(F.col("procesado_por_hilo").isNull()).alias("sin_trabajador"),
        F.count_if(F.col("procesado_en").isNull()).alias("sin_hora"),
    )
    return rows.join(by_worker, F.col("filas") == F.col("por_trabajador"), "left").select(
        "filas", "sin_trabajador", "sin_hora", F.col("por_trabajador").isNotNull().alias("cuadra")
    )


# --- interest -----------------------------------------------------------------


def exact_duplicate_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interest.distinct_accounts(feeds.accounts(spark, sf_dir))


def interest_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = split(interest.classify_accounts(feeds.accounts(spark, sf_dir)))
    return interest.interest_detail(kept)


def interest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = interest.InterestConfig()
    _, rejected = split(interest.classify_accounts(feeds.accounts(spark, sf_dir), config))
    log = reject_log(rejected, config.job_name, config.step_name, render_row(*ACCOUNT_ITEM))
    return log.select("seq", "job_name", "step_name", "etapa", "detalle_item", "mensaje_error")


def outcome_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept and rejected by reason: every distinct line is in one of them."""
    reason = F.col(REJECT_REASON)
    kind = F.when(reason.isNull(), "aceptada").otherwise(F.substring_index(reason, ":", 1))
    return (
        interest.classify_accounts(feeds.accounts(spark, sf_dir))
        .groupBy(kind.alias("resultado"))
        .agg(F.count(F.lit(1)).alias("lineas"), F.sum("copias").alias("leidas"))
    )


def run_counters_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = interest.InterestConfig()
    classified = interest.classify_accounts(feeds.accounts(spark, sf_dir), config)
    return run_counters(
        config.job_name, config.step_name, classified, F.col(REJECTED), "copias"
    )


def reject_gate_by_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects in each quarter of the feed against the limit; a copy that was
    dropped counts in the slice of the line that stands for it."""
    config = interest.InterestConfig()
    feed = feeds.accounts(spark, sf_dir)
    slices = slice_feed(feed, "seq", config.slices)
    return rejects_by_slice(
        interest.classify_accounts(feed, config),
        slice_of(F.col("seq"), slices),
        F.col(REJECTED),
        config.reject_limit,
    )


def line_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line ranges of the feed and the rows found in each."""
    feed = feeds.accounts(spark, sf_dir)
    slices = slice_feed(feed, "seq", v.SLICES)
    found = feed.groupBy(slice_of(F.col("seq"), slices).cast("long").alias("particion")).agg(
        F.count(F.lit(1)).alias("filas")
    )
    return slice_table(spark, slices).join(found, "particion")


def accounts_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interest.first_accounts(interest_accepted(spark, sf_dir), 20)


# --- statements ---------------------------------------------------------------


def movements_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = split(statements.classify_movements(feeds.movements(spark, sf_dir)))
    return statements.movement_detail(kept)


def movement_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = statements.StatementsConfig()
    _, rejected = split(statements.classify_movements(feeds.movements(spark, sf_dir)))
    log = reject_log(rejected, config.job_name, config.step_name, render_row(*MOVEMENT_ITEM))
    return log.select(
        "pedido", "linea", "job_name", "step_name", "etapa", "detalle_item", "mensaje_error"
    )


def annual_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    statement = statements.annual_statement(movements_classified(spark, sf_dir))
    return statement.orderBy("cuenta_id", "anio")


def statement_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that share many keys: statements of the outflows upserted over
    those of all other movements."""
    detail = movements_classified(spark, sf_dir)
    outflows = statements.is_outflow(F.col("tipo_transaccion"))
    scratch = Scratch(spark)
    warehouse = scratch.path("warehouse")
    for part in (detail.where(~outflows), detail.where(outflows)):
        statement = statements.annual_statement(part)
        tables.upsert(
            statement.withColumn("generado_en", F.current_timestamp()),
            warehouse,
            tables.ANNUAL_STATEMENT,
            scratch,
        )
    return tables.read_table(spark, warehouse, tables.ANNUAL_STATEMENT).drop("generado_en")


def status_histogram_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by status in the three detail tables."""
    parts = {
        "transacciones": transactions_classified(spark, sf_dir),
        "cuentas_interes": interest_accepted(spark, sf_dir),
        "movimientos_anuales": movements_classified(spark, sf_dir),
    }
    counted = [
        status_histogram(detail).select(F.lit(name).alias("tabla"), "estado", "cantidad")
        for name, detail in parts.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


# --- text files and whole jobs ---------------------------------------------------


LINES_A_FILE = 1_000_000


def _written_feed(spark: SparkSession, feed: DataFrame, fields: tuple[str, ...], *order) -> str:
    """The feed as delimited files with a header, in feed order where the job goes by it.
    They are compressed, which is done fast, and short enough for each to be one task's work."""
    path = Scratch(spark).path("feed")
    lines = (feed.orderBy(*order) if order else feed).select(*fields)
    compressed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    with balanced_scans(spark):
        lines.write.options(header=True, maxRecordsPerFile=LINES_A_FILE, **compressed).csv(path)
    return path


RAGGED_LINE = """case
    when k % 13 = 0 then id || ',' || fecha
    when k % 29 = 0 then id || ',' || fecha || ',' || monto || ',' || tipo || ',sobra'
    when k % 37 = 0 then id || ',' || fecha || ',' || monto || ',de"bi,to"'
    when k % 31 = 0 then '"' || id || '"," ' || fecha || ' ",' || monto || ',"' || tipo || '"'
    else id || ',' || fecha || ',' || monto || ',' || tipo end"""


def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with too few or too many fields, written to files and read back."""
    feed = feeds.transactions(spark, sf_dir).withColumnRenamed("seq", "k")
    scratch = Scratch(spark)
    path = scratch.path("ragged")
    # One column, no quoting: its name becomes the header line, its text the lines.
    feed.select(F.expr(RAGGED_LINE).alias(",".join(v.TRANSACTION_FIELDS))).write.options(
        header=True, sep="\u0001", quote="\u0000", emptyValue="", ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    lines, _ = delimited.stage_lines(scratch, path, v.TRANSACTION_FIELDS)
    bad = F.col(delimited.MALFORMED).isNotNull()
    return lines.select(
        *[F.when(~bad, clean(F.col(name))).alias(name) for name in v.TRANSACTION_FIELDS],
        F.col(delimited.MALFORMED).alias("linea_rechazada"),
    )


def daily_report_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to summary table, end to end."""
    path = _written_feed(
        spark, feeds.transactions(spark, sf_dir), v.TRANSACTION_FIELDS, "seq"
    )
    result = run_job(spark, v.DAILY_REPORT_JOB, path, Scratch(spark).path("warehouse"), "run-1")
    return result.summary.drop("generado_en", "anio").orderBy("fecha")


def _run_monthly_interest(spark: SparkSession, sf_dir: str) -> tuple[JobResult, str]:
    path = _written_feed(spark, feeds.accounts(spark, sf_dir), v.ACCOUNT_FIELDS, "seq")
    warehouse = Scratch(spark).path("warehouse")
    config = interest.InterestConfig(reject_limit=OPEN_GATE)
    return run_job(spark, v.MONTHLY_INTEREST_JOB, path, warehouse, "run-1", config), warehouse


def monthly_interest_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to detail table, end to end."""
    result, _ = _run_monthly_interest(spark, sf_dir)
    return result.detail.select(*interest.DETAIL_COLUMNS)


def monthly_interest_job_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and counters of each step; how long it took depends on the run."""
    result, _ = _run_monthly_interest(spark, sf_dir)
    return result.counters.drop("segundos")


def monthly_interest_job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job rejected, from the stored error log, newest first."""
    _, warehouse = _run_monthly_interest(spark, sf_dir)
    log = newest_first(tables.read_table(spark, warehouse, tables.ERROR_LOG))
    return log.select(*LOG_COLUMNS, "run_id")


def annual_statement_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to statement table, end to end."""
    path = _written_feed(spark, feeds.movements(spark, sf_dir), v.MOVEMENT_FIELDS)
    warehouse = Scratch(spark).path("warehouse")
    config = statements.StatementsConfig(reject_limit=OPEN_GATE)
    result = run_job(spark, v.ANNUAL_STATEMENT_JOB, path, warehouse, "run-1", config)
    return result.summary.drop("generado_en").orderBy("cuenta_id", "anio")


def daily_report_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs into one warehouse, then the first again: at first it also held the lines
    of the other, half of them on a day of a year that no line has afterwards."""
    feed = feeds.transactions(spark, sf_dir)
    moved = feed.withColumn("fecha", F.expr("if(seq % 2 = 0, '1990-06-15', fecha)"))
    warehouse = Scratch(spark).path("warehouse")
    for run_id, lines in (("a", moved), ("b", feed.where("seq % 3 <> 0")), ("a", feed.where("seq % 3 = 0"))):
        path = _written_feed(spark, lines, v.TRANSACTION_FIELDS, "seq")
        result = run_job(spark, v.DAILY_REPORT_JOB, path, warehouse, run_id)
    return result.summary.drop("generado_en", "anio").orderBy("fecha")


def annual_statement_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``daily_report_two_runs``; accounts vanish, and a year."""
    # Joined once; of movements the order does not matter.
    feed = Scratch(spark).stage(feeds.movements(spark, sf_dir), "movements")
    moved = feed.withColumn("cuenta_id", F.expr("if(pedido % 2 = 0, '99' || cuenta_id, cuenta_id)"))
    moved = moved.withColumn("fecha", F.expr("if(pedido % 5 = 0, '1990-06-15', fecha)"))
    warehouse = Scratch(spark).path("warehouse")
    config = statements.StatementsConfig(reject_limit=OPEN_GATE)
    runs = (("a", moved), ("b", feed.where("pedido % 3 <> 0")), ("a", feed.where("pedido % 3 = 0")))
    for run_id, lines in runs:
        path = _written_feed(spark, lines, v.MOVEMENT_FIELDS)
        result = run_job(spark, v.ANNUAL_STATEMENT_JOB, path, warehouse, run_id, config)
    return result.summary.drop("generado_en").orderBy("cuenta_id", "anio")


QUERIES: dict[str, Query] = {
    "flexible_date_parse": flexible_date_parse,
    "flexible_date_parse_strict": flexible_date_parse_strict,
    "lenient_number_parse": lenient_number_parse,
    "number_messages": number_messages,
    "category_normalisation": category_normalisation,
    "transactions_classified": transactions_classified,
    "duplicate_flag": duplicate_flag,
    "daily_summary": daily_summary,
    "undated_rows": undated_rows,
    "exact_duplicate_drop": exact_duplicate_drop,
    "interest_accepted": interest_accepted,
    "interest_rejects": interest_rejects,
    "outcome_split": outcome_split,
    "age_clamp": age_clamp,
    "rate_lookup_interest": rate_lookup_interest,
    "movements_classified": movements_classified,
    "movement_rejects": movement_rejects,
    "sign_normalisation": sign_normalisation,
    "default_text": default_text,
    "annual_statement": annual_statement,
    "status_histogram": status_histogram_query,
    "rows_by_worker": rows_by_worker,
    "rows_by_worker_totals": rows_by_worker_totals,
    "run_counters": run_counters_query,
    "reject_gate_by_slice": reject_gate_by_slice,
    "line_slices": line_slices,
    "summary_upsert": summary_upsert,
    "statement_upsert": statement_upsert,
    "detail_round_trip": detail_round_trip,
    "accounts_top_k": accounts_top_k,
    "malformed_lines": malformed_lines,
    "daily_report_job": daily_report_job,
    "monthly_interest_job": monthly_interest_job,
    "monthly_interest_job_counters": monthly_interest_job_counters,
    "monthly_interest_job_log": monthly_interest_job_log,
    "annual_statement_job": annual_statement_job,
    "daily_report_two_runs": daily_report_two_runs,
    "annual_statement_two_runs": annual_statement_two_runs,
}
