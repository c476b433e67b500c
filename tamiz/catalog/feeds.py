"""Dirty text feeds derived from clean tables.

The expressions are plain SQL that both Spark and the checking database accept,
so the same text builds the same feed in either engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

def _base(key: str, date: str | None, money: str, *others: str) -> list[str]:
    """Columns a feed is made of: key, date parts and money as text."""
    columns = [f"{key} as k", f"cast(cast({money} as decimal(15,2)) as string) as price", *others]
    if date is None:
        return columns
    day = f"cast({date} as date)"
    return columns + [
        f"cast(year({day}) as string) as y",
        f"lpad(cast(month({day}) as string), 2, '0') as m",
        f"lpad(cast(day({day}) as string), 2, '0') as d",
    ]


# Seven styles: four good layouts, a thirteenth month, a 31 February, nothing.
_DIRTY_DATE = """case {} % 7
    when 0 then y || '-' || m || '-' || d when 1 then d || '-' || m || '-' || y
    when 2 then d || '/' || m || '/' || y when 3 then y || '/' || m || '/' || d
    when 4 then y || '-13-01' when 5 then '31-02-' || y else '' end as fecha"""

TRANSACTION_BASE = _base("o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus as status")
TRANSACTIONS = [
    "k as seq",
    """case when k % 17 = 16 then '' when k % 10 = 9 then cast(k - 1 as string)
        when k % 23 = 22 then 'x' || cast(k as string) else cast(k as string) end as id""",
    _DIRTY_DATE.format("k"),
    """case k % 11 when 0 then '' when 1 then '-' || price when 2 then '0'
        when 3 then 'abc' else price end as monto""",
    """case when status = 'F' then 'credito' when status = 'O' then ' Debito '
        when k % 4 = 0 then 'invalid' else 'credito' end as tipo""",
]

ACCOUNT_BASE = _base("c_custkey", None, "c_acctbal", "c_name as name", "c_mktsegment as segment")
_ACCOUNT_FIELDS = [
    "case when k % 9 = 0 then '' else price end as saldo",
    """case k % 13 when 0 then '' when 1 then 'n/a'
        else cast((k * 7) % 120 as string) end as edad""",
    """case when segment in ('BUILDING', 'FURNITURE') then 'ahorro'
        when segment = 'MACHINERY' then ' Prestamo'
        when segment = 'HOUSEHOLD' then 'hipoteca' else '-1' end as tipo""",
]
# Amounts of any feed with every exponent from -9 to 9, one line in four as it is.
NUMBER_TEXT = """case seq % 4 when 0 then trim({amount}) when 1 then trim({amount}) || 'E' || cast(seq % 19 - 9 as string)
    when 2 then '-000' || trim({amount}) || 'e' || cast(seq % 19 - 9 as string)
    else '+0.0' || cast(seq % 1000 as string) || 'e' || cast(seq % 7 - 6 as string) end as texto"""

ACCOUNTS = ["2 * k as seq", "cast(k as string) as cuenta_id", "name as nombre", *_ACCOUNT_FIELDS]
# Every twentieth line comes a second time, next and spelled differently.
ACCOUNT_COPIED = "k % 20 = 0"
ACCOUNT_COPIES = [
    "2 * k + 1 as seq",
    "cast(k as string) as cuenta_id",
    "upper(name) as nombre",
    *_ACCOUNT_FIELDS,
]

MOVEMENT_BASE = _base(
    "l_orderkey",
    "l_shipdate",
    "l_extendedprice",
    "l_linenumber as line",
    "l_partkey as part",
    "l_suppkey as supplier",
    "l_returnflag as flag",
    "o_custkey as customer",
)
MOVEMENTS = [
    "k as pedido",
    "line as linea",
    "case when k % 50 = 49 then 'n/d' else cast(customer as string) end as cuenta_id",
    _DIRTY_DATE.format("(k + line)"),
    """case when flag = 'R' then 'retiro' when flag = 'A' then 'Compra'
        when line % 4 = 0 then 'transferencia' else 'deposito' end as transaccion""",
    """case (k + part) % 19 when 0 then '' when 1 then '-' || price else price end as monto""",
    """case when supplier % 6 = 0 then '' else 'mov ' || cast(line as string) end
        as descripcion""",
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _table(spark, sf_dir, "orders").selectExpr(*TRANSACTION_BASE)
    return base.selectExpr(*TRANSACTIONS)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _table(spark, sf_dir, "customer").selectExpr(*ACCOUNT_BASE)
    copies = base.where(ACCOUNT_COPIED).selectExpr(*ACCOUNT_COPIES)
    return base.selectExpr(*ACCOUNTS).unionByName(copies)


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.selectExpr(*MOVEMENT_BASE).selectExpr(*MOVEMENTS)


def _select(columns: list[str], source: str) -> str:
    return f"select {', '.join(columns)} from {source}"


SQL_FEEDS = f"""
T_base as ({_select(TRANSACTION_BASE, 'orders')}),
T as ({_select(TRANSACTIONS, 'T_base')}),
I_base as ({_select(ACCOUNT_BASE, 'customer')}),
I as ({_select(ACCOUNTS, 'I_base')}
    union all {_select(ACCOUNT_COPIES, f'I_base where {ACCOUNT_COPIED}')}),
M_base as ({_select(MOVEMENT_BASE, 'lineitem join orders on l_orderkey = o_orderkey')}),
M as ({_select(MOVEMENTS, 'M_base')})"""
