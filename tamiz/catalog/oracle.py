"""The same queries as SQL for the checking database, written independently:
windows and row numbers where the library aggregates, joins and narrows."""

from __future__ import annotations

from tamiz import vocabulary as v
from tamiz.catalog.feeds import NUMBER_TEXT, SQL_FEEDS
from tamiz.catalog.queries import RAGGED_LINE


def _date(text: str, strict: bool = False) -> str:
    year_first = rf"regexp_full_match({text}, '\d{{4}}-\d\d-\d\d|\d{{4}}/\d\d/\d\d')"
    day_first = rf"regexp_full_match({text}, '\d\d-\d\d-\d{{4}}|\d\d/\d\d/\d{{4}}')"

    def part(when_year_first: str, when_day_first: str) -> str:
        return (
            f"cast(case when {year_first} then substr({text}, {when_year_first}) "
            f"when {day_first} then substr({text}, {when_day_first}) end as int)"
        )

    y, m, d = part("1, 4", "7, 4"), part("6, 2", "4, 2"), part("9, 2", "1, 2")
    month_days = f"day(last_day(make_date({y}, {m}, 1)))"
    known = f"{y} >= 1 and {m} between 1 and 12 and {d} between 1 and 31"
    if strict:
        return (
            f"case when {known} then case when {d} <= {month_days} "
            f"then make_date({y}, {m}, {d}) end end"
        )
    return f"case when {known} then make_date({y}, {m}, least({d}, {month_days})) end"


def _date_problem(text: str, date: str) -> str:
    return (
        f"case when {date} is null then case when {text} = '' then 'Fecha vacia' "
        f"else 'Formato de fecha no reconocido: ''' || {text} || '''' end end"
    )


_T = f"""
T_text as (select seq, trim(id) as id, trim(fecha) as texto, trim(monto) as monto_texto,
    trim(tipo) as tipo_texto from T),
T_parsed as (select *, {_date('texto')} as fecha, lower(tipo_texto) as tipo,
    try_cast(monto_texto as decimal(15,2)) as monto,
    id <> '' and row_number() over (partition by id order by seq) > 1 as es_duplicado
    from T_text),
T_noted as (select *, concat_ws('; ',
    {_date_problem('texto', 'fecha')},
    case when monto is null then 'Monto vacio o no numerico'
        when monto <= 0 then 'Monto no positivo: ' || monto_texto end,
    case when tipo not in ('debito', 'credito')
        then 'Tipo de transaccion invalido: ''' || tipo_texto || '''' end) as problemas
    from T_parsed),
T_detail as (select seq, try_cast(id as bigint) as transaccion_id_origen, fecha, monto, tipo,
    case when es_duplicado then 'DUPLICADA' when problemas <> '' then 'ANOMALIA'
        else 'VALIDA' end as estado,
    case when es_duplicado then 'Id de transaccion duplicado: ' || id
        when problemas <> '' then problemas end as motivo
    from T_noted)"""


def _daily(source: str) -> str:
    return f"""select fecha, count(*) as total_transacciones,
    count(*) filter (where estado = 'VALIDA') as total_validas,
    count(*) filter (where estado = 'ANOMALIA') as total_anomalias,
    count(*) filter (where estado = 'DUPLICADA') as total_duplicadas,
    cast(coalesce(sum(monto) filter (where estado = 'VALIDA' and tipo = 'credito'), 0)
        as decimal(15,2)) as monto_total_credito,
    cast(coalesce(sum(monto) filter (where estado = 'VALIDA' and tipo = 'debito'), 0)
        as decimal(15,2)) as monto_total_debito
    from {source} and fecha is not null group by fecha"""


_I = """
I_text as (select seq, trim(cuenta_id) as cuenta_id, trim(nombre) as nombre,
    trim(saldo) as saldo, trim(edad) as edad, trim(tipo) as tipo from I),
I_ranked as (select *,
    row_number() over same_line as copia,
    count(*) over (partition by lower(cuenta_id), lower(nombre), lower(saldo), lower(edad),
        lower(tipo)) as copias
    from I_text window same_line as (partition by lower(cuenta_id), lower(nombre),
        lower(saldo), lower(edad), lower(tipo) order by seq)),
I_distinct as (select * exclude (copia) from I_ranked where copia = 1),
I_parsed as (select *, lower(tipo) as tipo_normal, try_cast(saldo as decimal(15,2)) as importe,
    try_cast(edad as int) as edad_original from I_distinct),
I_judged as (select *, case
    when tipo_normal not in ('ahorro', 'prestamo', 'hipoteca')
        then 'InvalidCategoryException: Tipo de cuenta invalido: ''' || tipo || ''''
    when importe is null then
        'InvalidAmountException: Saldo vacio o no numerico para la cuenta ' || cuenta_id
    when importe < 0 then 'InvalidAmountException: Saldo negativo no permitido: ' || saldo
    end as rechazo from I_parsed),
I_rated as (select *, cast(case tipo_normal when 'ahorro' then 0.005 when 'prestamo' then 0.015
    else 0.010 end as decimal(6,4)) as tasa_aplicada from I_judged where rechazo is null),
I_detail as (select seq, try_cast(cuenta_id as bigint) as cuenta_id, nombre,
    tipo_normal as tipo, importe as saldo_inicial, edad_original,
    case when edad_original is null or edad_original < 18 then 18
        when edad_original > 90 then 90 else edad_original end as edad_utilizada,
    tasa_aplicada, cast(importe * tasa_aplicada as decimal(15,2)) as interes_calculado,
    cast(importe + cast(importe * tasa_aplicada as decimal(15,2)) as decimal(15,2))
        as saldo_final,
    case when edad_original between 18 and 90 then 'VALIDA' else 'VALIDA_CORREGIDA' end
        as estado,
    case when edad_original is null
        then 'Edad no informada, se utilizo la edad minima configurada (18)'
    when edad_original < 18
        then 'Edad fuera de rango (' || edad_original || '), se acoto al minimo (18)'
    when edad_original > 90
        then 'Edad fuera de rango (' || edad_original || '), se acoto al maximo (90)' end
        as observacion from I_rated)"""

_M = f"""
M_text as (select pedido, linea, trim(cuenta_id) as cuenta_id, trim(fecha) as texto,
    trim(transaccion) as transaccion, trim(monto) as monto_texto,
    trim(descripcion) as descripcion from M),
M_parsed as (select *, {_date('texto')} as fecha, lower(transaccion) as tipo_transaccion,
    try_cast(monto_texto as decimal(15,2)) as importe from M_text),
M_noted as (select *,
    concat_ws('; ', {_date_problem('texto', 'fecha')},
        case when tipo_transaccion not in ('deposito', 'retiro', 'compra') then
            'Tipo de transaccion anual desconocido: ''' || transaccion || '''' end,
        case when tipo_transaccion = 'deposito' and importe <= 0 then
            'Monto no positivo para un deposito: ' || monto_texto end) as problemas,
    concat_ws('; ',
        case when tipo_transaccion in ('retiro', 'compra') and importe > 0 then
            'Se normalizo el signo del monto de salida (' || tipo_transaccion
            || ') a negativo' end,
        case when descripcion = '' then 'Descripcion vacia, se uso el valor por defecto' end)
        as correcciones,
    case when tipo_transaccion in ('retiro', 'compra') then -abs(importe) else importe end
        as con_signo
    from M_parsed),
M_detail as (select pedido, linea, try_cast(cuenta_id as bigint) as cuenta_id, fecha,
    tipo_transaccion, cast(con_signo as decimal(15,2)) as monto,
    case when descripcion = '' then 'Sin descripcion' else descripcion end as descripcion,
    case when problemas <> '' then 'ANOMALIA' when correcciones <> '' then 'VALIDA_CORREGIDA'
        else 'VALIDA' end as estado,
    case when problemas <> '' then problemas when correcciones <> '' then correcciones end
        as motivo
    from M_noted where importe is not null)"""


def _annual(source: str) -> str:
    return f"""select cuenta_id, cast(year(fecha) as int) as anio,
    cast(coalesce(sum(monto) filter (where tipo_transaccion = 'deposito'
        and estado <> 'ANOMALIA'), 0) as decimal(15,2)) as total_depositos,
    cast(coalesce(sum(abs(monto)) filter (where tipo_transaccion in ('retiro', 'compra')), 0)
        as decimal(15,2)) as total_salidas,
    cast(coalesce(sum(monto), 0) as decimal(15,2)) as saldo_neto_anual,
    count(*) as cantidad_movimientos,
    count(*) filter (where estado = 'ANOMALIA') as cantidad_anomalias
    from {source} and cuenta_id is not null and fecha is not null
    group by cuenta_id, year(fecha)"""


def _as_int(columns: str, counts: tuple[str, ...]) -> str:
    casts = ", ".join(f"cast({name} as bigint) as {name}" for name in counts)
    return f"* replace ({casts})" if columns == "*" else columns


_DAILY_COUNTS = ("total_transacciones", "total_validas", "total_anomalias", "total_duplicadas")
_ANNUAL_COUNTS = ("cantidad_movimientos", "cantidad_anomalias")


def _with(*parts: str) -> str:
    return "with " + ",".join((SQL_FEEDS, *parts)) + "\n"


def _histogram(source: str, label: str) -> str:
    return (
        f"select '{label}' as tabla, estado, count(*) as cantidad from {source} group by estado"
    )


def _part(sql: str, feed: str, name: str, condition: str) -> str:
    """The same tables over some lines of a feed, under another name."""
    return sql.replace(f"from {feed})", f"from {feed} where {condition})").replace(f"{feed}_", f"{name}_")


_OUTFLOW = "tipo_transaccion in ('retiro', 'compra')"
_T_SQL, _I_SQL, _M_SQL = _with(_T), _with(_I), _with(_M)
_INTEREST_NAMES = f"'{v.MONTHLY_INTEREST_JOB}' as job_name, '{v.MONTHLY_INTEREST_STEP}' as step_name"
_STATEMENT_NAMES = f"'{v.ANNUAL_STATEMENT_JOB}' as job_name, '{v.ANNUAL_STATEMENT_STEP}' as step_name"

_INTEREST_LOG = f"""{_INTEREST_NAMES}, 'PROCESS' as etapa,
    'InteresRaw(cuentaId=' || cuenta_id || ', nombre=' || nombre || ', saldo=' || saldo
    || ', edad=' || edad || ', tipo=' || tipo || ')' as detalle_item,
    rechazo as mensaje_error from I_judged where rechazo is not null"""

_COUNTERS = f"""select {_INTEREST_NAMES}, cast(sum(copias) as bigint) as leidos,
    count(*) filter (where rechazo is null) as escritos,
    cast(sum(copias) as bigint) - count(*) as filtrados,
    cast(0 as bigint) as saltados_lectura, count(rechazo) as saltados_proceso,
    cast(0 as bigint) as saltados_escritura, count(rechazo) as total_saltados"""

_SLICED = """
I_placed as (select seq, row_number() over (order by seq) as fila, count(*) over () as filas
    from I),
I_sliced as (select seq, fila, cast((fila - 1) // cast(ceil(filas / 4) as bigint) as int)
    as particion from I_placed)"""

ORACLE: dict[str, str] = {
    "flexible_date_parse": _T_SQL
    + f"select seq, texto, fecha, {_date_problem('texto', 'fecha')} as problema from T_parsed",
    "flexible_date_parse_strict": _T_SQL
    + f"""select seq, texto, fecha, {_date_problem('texto', 'fecha')} as problema
    from (select seq, texto, {_date('texto', strict=True)} as fecha from T_text)""",
    "lenient_number_parse": _with()
    + """select seq, 'T' as origen, try_cast(id as bigint) as entero_largo,
        cast(null as int) as entero, try_cast(trim(monto) as decimal(15,2)) as importe from T
    union all
    select seq, 'I', try_cast(cuenta_id as bigint), try_cast(edad as int),
        try_cast(trim(saldo) as decimal(15,2)) from I""",
    "number_messages": _with()
    + f""", texts as (select seq, 'T' as origen, {NUMBER_TEXT.format(amount='monto')} from T
        union all select seq, 'I', {NUMBER_TEXT.format(amount='saldo')} from I),
    parts as (select *, regexp_full_match(texto, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') as good,
        split_part(replace(lower(ltrim(texto, '+-')), 'e+', 'e'), 'e', 1) as mantissa,
        coalesce(try_cast(split_part(lower(texto), 'e', 2) as int), 0) as power from texts),
    scaled as (select *, coalesce(cast(try_cast(replace(mantissa, '.', '') as hugeint) as varchar), '0') as digits,
        length(split_part(mantissa, '.', 2)) - power as scale from parts),
    placed as (select *, length(digits) - 1 - scale as high,
        case when texto like '-%' and digits <> '0' then '-' else '' end as minus from scaled)
    select seq, origen, texto, case when not good then texto when scale = 0 then minus || digits
        when scale > 0 and high >= 0 then minus || left(digits, -scale) || '.' || right(digits, scale)
        when scale > 0 and high >= -6 then minus || '0.' || repeat('0', -1 - high) || digits
        else minus || rtrim(left(digits, 1) || '.' || substr(digits, 2), '.')
            || 'E' || case when high > 0 then '+' else '' end || high end as impreso from placed""",
    "category_normalisation": _with()
    + """select seq, lower(trim(tipo)) as tipo, trim(id) = '' as id_vacio,
        lower(trim(tipo)) in ('debito', 'credito') as permitido from T""",
    "transactions_classified": _T_SQL + "select * from T_detail",
    "duplicate_flag": _T_SQL + "select seq, id, es_duplicado from T_parsed",
    "daily_summary": _T_SQL + _daily("T_detail where true"),
    "undated_rows": _T_SQL
    + "select estado, count(*) as cantidad from T_detail where fecha is null group by estado",
    "exact_duplicate_drop": _I_SQL + "select * from I_distinct",
    "interest_accepted": _I_SQL + "select * from I_detail",
    "interest_rejects": _I_SQL + f"select seq, {_INTEREST_LOG}",
    "outcome_split": _I_SQL
    + """select coalesce(split_part(rechazo, ':', 1), 'aceptada') as resultado,
        count(*) as lineas, cast(sum(copias) as bigint) as leidas from I_judged group by 1""",
    "age_clamp": _with()
    + """select seq, edad_original,
        case when edad_original is null or edad_original < 18 then 18
            when edad_original > 90 then 90 else edad_original end as edad_utilizada,
        case when edad_original is null
            then 'Edad no informada, se utilizo la edad minima configurada (18)'
        when edad_original < 18
            then 'Edad fuera de rango (' || edad_original || '), se acoto al minimo (18)'
        when edad_original > 90
            then 'Edad fuera de rango (' || edad_original || '), se acoto al maximo (90)' end
            as observacion
        from (select seq, try_cast(edad as int) as edad_original from I)""",
    "rate_lookup_interest": _with()
    + """, rated as (select seq, lower(trim(tipo)) as tipo,
        try_cast(saldo as decimal(15,2)) as saldo,
        cast(case lower(trim(tipo)) when 'ahorro' then 0.005 when 'prestamo' then 0.015
            when 'hipoteca' then 0.010 end as decimal(6,4)) as tasa_aplicada from I)
    select seq, tipo, tasa_aplicada,
        cast(saldo * tasa_aplicada as decimal(15,2)) as interes_calculado,
        cast(saldo + cast(saldo * tasa_aplicada as decimal(15,2)) as decimal(15,2))
            as saldo_final from rated""",
    "movements_classified": _M_SQL + "select * from M_detail",
    "movement_rejects": _M_SQL
    + f"""select pedido, linea, {_STATEMENT_NAMES}, 'PROCESS' as etapa,
        'MovimientoRaw(cuentaId=' || cuenta_id || ', fecha=' || texto || ', transaccion='
        || transaccion || ', monto=' || monto_texto || ', descripcion=' || descripcion || ')'
        as detalle_item,
        'InvalidAmountException: Monto vacio o no numerico para la cuenta ' || cuenta_id
        as mensaje_error from M_parsed where importe is null""",
    "sign_normalisation": _M_SQL
    + """select pedido, linea, tipo_transaccion, importe as monto_original,
        cast(con_signo as decimal(15,2)) as monto from M_noted""",
    "default_text": _M_SQL
    + """select pedido, linea,
        case when descripcion = '' then 'Sin descripcion' else descripcion end as descripcion,
        descripcion = '' as por_defecto from M_text""",
    "annual_statement": _M_SQL + _annual("M_detail where true"),
    "status_histogram": _with(_T, _I, _M)
    + " union all ".join(
        [
            _histogram("T_detail", "transacciones"),
            _histogram("I_detail", "cuentas_interes"),
            _histogram("M_detail", "movimientos_anuales"),
        ]
    ),
    "run_counters": _I_SQL + _COUNTERS + " from I_judged",
    "reject_gate_by_slice": _with(_I, _SLICED)
    + """select particion, count(*) as filas, count(rechazo) as rechazos,
        count(rechazo) > 300 as excede
        from I_judged join I_sliced using (seq) group by particion""",
    "line_slices": _with(_SLICED)
    + """select cast(particion as bigint) as particion, min(fila) as linea_inicial,
        max(fila) as linea_final, count(*) as filas from I_sliced group by particion""",
    "summary_upsert": _T_SQL
    + f""", first_load as ({_daily("T_detail where tipo <> 'credito'")}),
    second_load as ({_daily("T_detail where tipo = 'credito'")}),
    merged as (select * from second_load union all
        select * from first_load where fecha not in (select fecha from second_load))
    select {_as_int('*', _DAILY_COUNTS)} from merged""",
    "statement_upsert": _M_SQL
    + f""", first_load as ({_annual(f'M_detail where not {_OUTFLOW}')}),
    second_load as ({_annual(f'M_detail where {_OUTFLOW}')}),
    merged as (select * from second_load union all
        select * from first_load anti join second_load using (cuenta_id, anio))
    select {_as_int('*', _ANNUAL_COUNTS)} from merged""",
    "detail_round_trip": _T_SQL
    + """select run_id, * exclude (seq, run_id) from T_detail, (values ('a'), ('b')) runs(run_id)""",
    "accounts_top_k": _I_SQL + "select * from I_detail order by cuenta_id, seq limit 20",
    "malformed_lines": _with()
    + f""", lines as (select seq as k, * exclude (seq), seq % 13 = 0 or seq % 29 = 0 as mala
        from T)
    select case when not mala then trim(id) end as id,
        case when not mala then trim(fecha) end as fecha,
        case when not mala then trim(monto) end as monto,
        case when not mala and k % 37 = 0 then 'de"bi,to"' when not mala then trim(tipo) end as tipo,
        case when mala then {RAGGED_LINE} end as linea_rechazada from lines""",
    "daily_report_job": _T_SQL
    + f"select {_as_int('*', _DAILY_COUNTS)} from ({_daily('T_detail where true')})",
    "monthly_interest_job": _I_SQL + "select * exclude (seq) from I_detail",
    "monthly_interest_job_counters": _I_SQL + _COUNTERS + ", 'COMPLETED' as estado from I_judged",
    "monthly_interest_job_log": _I_SQL + f"select 'run-1' as run_id, {_INTEREST_LOG}",
    "rows_by_worker_totals": _T_SQL
    + """select count(*) as filas, cast(0 as bigint) as sin_trabajador,
        cast(0 as bigint) as sin_hora, true as cuadra from T_detail""",
    "daily_report_two_runs": _with(
        _part(_T, "T", "Ta", "seq % 3 = 0"), _part(_T, "T", "Tb", "seq % 3 <> 0")
    )
    + f""", T_both as (select * from Ta_detail union all select * from Tb_detail)
    select {_as_int('*', _DAILY_COUNTS)} from ({_daily('T_both where true')})""",
    "annual_statement_two_runs": _with(
        _part(_M, "M", "Ma", "pedido % 3 = 0"), _part(_M, "M", "Mb", "pedido % 3 <> 0")
    )
    + f""", M_both as (select * from Ma_detail union all select * from Mb_detail)
    select {_as_int('*', _ANNUAL_COUNTS)} from ({_annual('M_both where true')})""",
    "annual_statement_job": _M_SQL
    + f"select {_as_int('*', _ANNUAL_COUNTS)} from ({_annual('M_detail where true')})",
}
