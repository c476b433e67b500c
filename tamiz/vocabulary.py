"""Words and numbers that appear in the output tables.

They have to be exactly these for results to agree with the workloads this
library reproduces, so they are kept together and in plain text.
"""

# --- status of a kept row -------------------------------------------------
VALID = "VALIDA"
CORRECTED = "VALIDA_CORREGIDA"
ANOMALY = "ANOMALIA"
DUPLICATE = "DUPLICADA"

# --- stage of a rejected row ----------------------------------------------
STAGE_READ = "READ"
STAGE_PROCESS = "PROCESS"

# --- kinds of error named in the reject log --------------------------------
MALFORMED_LINE = "FlatFileParseException"
BAD_CATEGORY = "InvalidCategoryException"
BAD_AMOUNT = "InvalidAmountException"

# --- allowed categories, after trimming and lower-casing -------------------
TRANSACTION_TYPES = ("debito", "credito")
MOVEMENT_TYPES = ("deposito", "retiro", "compra")
DEPOSIT_TYPES = ("deposito",)
OUTFLOW_TYPES = ("retiro", "compra")

# --- business parameters ----------------------------------------------------
MONTHLY_RATES = {"ahorro": "0.005", "prestamo": "0.015", "hipoteca": "0.010"}
MIN_AGE = 18
MAX_AGE = 90
DEFAULT_DESCRIPTION = "Sin descripcion"
REJECT_LIMIT = 300
SLICES = 4
LOG_TEXT_WIDTH = 1000

# --- job and step names -----------------------------------------------------
DAILY_REPORT_JOB = "reporteTransaccionesDiariasJob"
DAILY_REPORT_STEP, DAILY_SUMMARY_STEP = "transaccionesWorkerStep", "resumenDiarioStep"
MONTHLY_INTEREST_JOB = "calculoInteresesMensualesJob"
MONTHLY_INTEREST_STEP = "interesesWorkerStep"
ANNUAL_STATEMENT_JOB = "estadosCuentaAnualesJob"
ANNUAL_STATEMENT_STEP, STATEMENT_SUMMARY_STEP = "cuentasAnualesWorkerStep", "estadoCuentaStep"
COMPLETED, FAILED = "COMPLETED", "FAILED"

# --- feed columns, in file order -------------------------------------------
TRANSACTION_FIELDS = ("id", "fecha", "monto", "tipo")
ACCOUNT_FIELDS = ("cuenta_id", "nombre", "saldo", "edad", "tipo")
MOVEMENT_FIELDS = ("cuenta_id", "fecha", "transaccion", "monto", "descripcion")

# --- how a rejected row is printed: label and field names -------------------
ACCOUNT_LABEL = "InteresRaw"
ACCOUNT_PRINT_FIELDS = {
    "cuentaId": "cuenta_id",
    "nombre": "nombre",
    "saldo": "saldo",
    "edad": "edad",
    "tipo": "tipo",
}
MOVEMENT_LABEL = "MovimientoRaw"
MOVEMENT_PRINT_FIELDS = {
    "cuentaId": "cuenta_id",
    "fecha": "fecha",
    "transaccion": "transaccion",
    "monto": "monto",
    "descripcion": "descripcion",
}

# --- messages ({} marks the value put in) -----------------------------------
MSG_DATE_EMPTY = "Fecha vacia"
MSG_DATE_UNKNOWN = "Formato de fecha no reconocido: '{}'"
MSG_AMOUNT_MISSING = "Monto vacio o no numerico"
MSG_AMOUNT_NOT_POSITIVE = "Monto no positivo: {}"
MSG_TRANSACTION_TYPE = "Tipo de transaccion invalido: '{}'"
MSG_DUPLICATE_ID = "Id de transaccion duplicado: {}"
MSG_ACCOUNT_TYPE = "Tipo de cuenta invalido: '{}'"
MSG_BALANCE_MISSING = "Saldo vacio o no numerico para la cuenta {}"
MSG_BALANCE_NEGATIVE = "Saldo negativo no permitido: {}"
MSG_AGE_MISSING = "Edad no informada, se utilizo la edad minima configurada ({})"
MSG_AGE_LOW = "Edad fuera de rango ({}), se acoto al minimo ({})"
MSG_AGE_HIGH = "Edad fuera de rango ({}), se acoto al maximo ({})"
MSG_MOVEMENT_AMOUNT_MISSING = "Monto vacio o no numerico para la cuenta {}"
MSG_MOVEMENT_TYPE = "Tipo de transaccion anual desconocido: '{}'"
MSG_DEPOSIT_NOT_POSITIVE = "Monto no positivo para un deposito: {}"
MSG_SIGN_FIXED = "Se normalizo el signo del monto de salida ({}) a negativo"
MSG_DESCRIPTION_DEFAULTED = "Descripcion vacia, se uso el valor por defecto"
MSG_MALFORMED_LINE = "Parsing error at line: {} in resource=[{}], input=[{}]"
NOTE_SEPARATOR = "; "
