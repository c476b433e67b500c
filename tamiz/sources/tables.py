"""Output tables as Parquet: declared schemas, one partition per run, upsert by key."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType, VarcharType

from tamiz.session import Scratch

RUN = "run_id"


@dataclass(frozen=True)
class Table:
    """``partition`` names the columns the files are laid out by; ``key`` is the
    primary key of a table that is upserted.  A ``varchar`` is read as text; its
    width holds for what is written."""

    name: str
    ddl: str
    partition: tuple[str, ...] = (RUN,)
    key: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType(
            [
                StructField(field.name, StringType()) if field.name in self.widths else field
                for field in StructType.fromDDL(self.ddl)
            ]
        )

    @property
    def widths(self) -> dict[str, int]:
        """Characters that each text column of limited width holds."""
        declared = StructType.fromDDL(self.ddl)
        return {field.name: field.dataType.length for field in declared if isinstance(field.dataType, VarcharType)}

    def path(self, warehouse: str) -> str:
        return f"{warehouse.rstrip('/')}/{self.name}"


_PROVENANCE = "procesado_por_hilo varchar(60), procesado_en timestamp, run_id string"

TRANSACTIONS = Table(
    "transacciones",
    "transaccion_id_origen bigint, fecha date, monto decimal(15,2), tipo varchar(20), "
    f"estado varchar(20), motivo varchar(500), {_PROVENANCE}",
)
ACCOUNTS = Table(
    "cuentas_interes",
    "cuenta_id bigint, nombre varchar(150), tipo varchar(20), saldo_inicial decimal(15,2), "
    "edad_original int, edad_utilizada int, tasa_aplicada decimal(6,4), "
    "interes_calculado decimal(15,2), saldo_final decimal(15,2), estado varchar(25), "
    f"observacion varchar(500), {_PROVENANCE}",
)
MOVEMENTS = Table(
    "movimientos_anuales",
    "cuenta_id bigint, fecha date, tipo_transaccion varchar(20), monto decimal(15,2), "
    f"descripcion varchar(255), estado varchar(25), motivo varchar(500), {_PROVENANCE}",
)
ERROR_LOG = Table(
    "batch_error_log",
    "step_name varchar(100), etapa varchar(20), detalle_item varchar(1000), mensaje_error varchar(1000), "
    "ocurrido_en timestamp, job_name varchar(100), run_id string",
    partition=("job_name", RUN),
)
DAILY_MEASURES = (
    "total_transacciones bigint, total_validas bigint, total_anomalias bigint, "
    "total_duplicadas bigint, "
    "monto_total_credito decimal(15,2), monto_total_debito decimal(15,2)"
)
STATEMENT_MEASURES = (
    "total_depositos decimal(15,2), total_salidas decimal(15,2), "
    "saldo_neto_anual decimal(15,2), cantidad_movimientos bigint, cantidad_anomalias bigint"
)
DAILY_SUMMARY = Table(
    "resumen_transacciones_diarias",
    f"fecha date, {DAILY_MEASURES}, generado_en timestamp, anio int",
    partition=("anio",),
    key=("fecha",),
)
ANNUAL_STATEMENT = Table(
    "estado_cuenta_anual",
    f"cuenta_id bigint, {STATEMENT_MEASURES}, generado_en timestamp, anio int",
    partition=("anio",),
    key=("cuenta_id", "anio"),
)


def _fitting(name: str, width: int) -> Column:
    """A text that fits its column; blanks that are too many at its end are cut off,
    anything else that is too much raises."""
    text = F.col(name).cast("string")
    message = F.concat(F.lit(f"{name} holds {width} characters, not "), F.length(text).cast("string"))
    return (
        F.when(text.isNull() | (F.length(text) <= width), text)
        .when(F.length(F.rtrim(text)) <= width, F.substring(text, 1, width))
        .otherwise(F.raise_error(message).cast("string"))
    )


def conform(frame: DataFrame, table: Table) -> DataFrame:
    """Columns of ``frame`` in the table's order and types; a number that does not
    fit raises by the ANSI cast, and a text that is wider than its column as well."""
    widths = table.widths
    return frame.select(
        *[
            (_fitting(field.name, widths[field.name]) if field.name in widths else F.col(field.name).cast(field.dataType))
            .alias(field.name)
            for field in table.schema
        ]
    )


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_table(spark: SparkSession, warehouse: str, table: Table) -> DataFrame:
    """The table, empty if nothing has been written to it yet; reading writes nothing."""
    if not _exists(spark, table.path(warehouse)):
        return spark.createDataFrame([], table.schema)
    return spark.read.schema(table.schema).parquet(table.path(warehouse))


def write_run(frame: DataFrame, warehouse: str, table: Table, **partition: str) -> None:
    """The rows of one run, in the table's partition for it.

    Other runs are left alone, so the table grows by appending; repeating a run
    replaces its rows (by none, if there are none), so a job that is started
    again does not count twice.
    """
    given, rest = tuple(partition), table.partition[len(partition) :]
    if given != table.partition[: len(given)] or RUN not in given:
        raise ValueError(f"{table.name} is laid out by {table.partition}")
    path = table.path(warehouse)
    for name, value in partition.items():
        if not re.fullmatch(r"[\w.-]+", value):
            raise ValueError(f"{name} {value!r}: letters, digits, '_', '.' and '-' only")
        frame = frame.withColumn(name, F.lit(value))
        path = f"{path}/{name}={value}"
    rows = conform(frame, table).drop(*given)
    rows.write.mode("overwrite").partitionBy(*rest).parquet(path)


def upsert(frame: DataFrame, warehouse: str, table: Table, scratch: Scratch) -> None:
    """Inserts new keys, replaces known ones, leaves all others as they are.

    Only the partitions that hold a new key are read and rewritten.
    """
    new = scratch.stage(conform(frame, table), f"{table.name}-new")
    _replace(new, new.select(*_identity(table)), warehouse, table)


def refresh(
    frame: DataFrame,
    keys: DataFrame,
    warehouse: str,
    table: Table,
    whole: Sequence[int] = (),
) -> None:
    """Makes ``frame`` all that the table holds of ``keys``, and of the partitions
    ``whole``: keys that it has are inserted or replaced, the others are removed.
    ``keys`` has the table's key and layout columns, and may repeat; ``frame`` is
    worked out once."""
    _replace(conform(frame, table), keys, warehouse, table, whole)


def _identity(table: Table) -> list[str]:
    return list(dict.fromkeys((*table.key, *table.partition)))


def _replace(
    new: DataFrame,
    keys: DataFrame,
    warehouse: str,
    table: Table,
    whole: Sequence[int] = (),
) -> None:
    """A row is written once: rows that stay are read from the table by the write that
    replaces their partitions.  Such a write goes to a folder of its own and changes
    places with the old partitions when all of it is there, not before."""
    spark = new.sparkSession
    (layout,) = table.partition
    # One value per partition of the table (years), however many rows there are.
    touched = {row[0] for row in keys.select(layout).distinct().collect()} | set(whole)
    if not touched:
        return
    kept = F.col(layout).isin(sorted(touched - set(whole)))
    current = read_table(spark, warehouse, table).where(kept)
    staying = current.join(keys.select(*table.key), list(table.key), "left_anti").select(*new.columns)
    seen = Observation()
    held = [F.count_if(F.col(layout) == value).alias(f"{layout}={value}") for value in sorted(touched)]
    merged = staying.unionByName(new).observe(seen, *held)
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        layout
    ).parquet(table.path(warehouse))
    for folder, rows in seen.get.items():
        if rows == 0:  # a partition that is written no row is left as it was
            remove(spark, f"{table.path(warehouse)}/{folder}")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
