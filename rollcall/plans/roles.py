"""HR roles played by the given tables.

Each role is a projection of one table, so a query's plan is that of its operators. ``plans.oracle`` holds the same
definitions as SQL.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions import codes
from rollcall.operators.absence import shift_hours_dim
from rollcall.operators.timeclock import AFD_LENGTH, shift_starts
from rollcall.sources.erp import normalize
from rollcall.sources.files import split_records

AS_OF = "1998-07-15"
FIRST_MONTH = "1998-01-01"
MONTHS = 12
CYCLE_START = "1998-06-20"
PUNCH_FIRST, PUNCH_LAST = "2024-01-01", "2024-01-30"
# Days between the events of the ERP and the punches: June 1998 is the month of the timesheet, January 2024.
TIME_SHIFT = 9345
SHEET_FIRST, SHEET_END = "1998-06-01", "1998-07-01"

# Small sheets the users keep by hand.
SHIFTS = [
    ("000", "SEG-SEX 25 DIAS"), ("001", "SEG-SAB 30 DIAS"), ("002", "ESCALA 19:00-07:00 (12X36)"),
    ("003", "ESCALA FOL SAB"), ("004", "ESCALA FOL DOM"), ("005", "ESCALA 4X2"), ("006", "SEG-SAB 44H"),
    ("007", "ADMINISTRATIVO"), ("008", "12X36 30 DIAS"), ("009", "NOTURNO 22:00"), ("010", "TARDE 13:20"),
    ("011", "TARDE 13:21"),
]
SHIFT_HOURS = [
    ("SEG-SEX 25 DIAS", "8,80", None, None), ("SEG-SAB 30 DIAS", "7,33", "4,00", "Sab"),
    ("ESCALA 19:00-07:00 (12X36)", "11,00", None, None), ("ESCALA FOL SAB", "7,50", "6,00", "Dom"),
    ("ESCALA FOL DOM", "7,33", "5,50", "Quar"), ("ESCALA 4X2", "12,00", None, None),
    ("SEG-SAB 44H", "8,00", "4,00", "Sab"), ("ADMINISTRATIVO", "0,00", None, None), ("NOTURNO 22:00", "7,00", "6,00", "Sex"),
    ("SEM USO", "6,00", None, None),
]
SHIFT_START = [
    ("ESCALA 19:00-07:00 (12X36)", "19:00:00"), ("NOTURNO 22:00", "22:00:00"), ("TARDE 13:20", "13:20:00"),
    ("TARDE 13:21", "13:20:01"), ("ADMINISTRATIVO", "08:00:00"), ("ADMINISTRATIVO", "08:00:00"),
]
EVENT_CODES = [
    ("000", "HE 50% - IN"), ("001", "HE 70% - NO"), ("002", "ADIC.NOT.EXTRA 50%"), ("003", "ADIC.NOTURNO 20%"),
    ("004", "SAIDA ANTECIPADA"), ("005", "HE 60% - IN"), ("006", "OUTROS"), ("007", "ATRASO"), ("008", "FALTA"),
    ("009", "FALTA 1/2 PERIODO"), ("010", "FALTA"), ("011", "ATRASO PER.ANT"), ("012", "SAIDA EXPEDIENTE"),
    ("013", "ABONO"), ("014", "ATRASO PER.ANT.NA"),
]
LEAVE_TYPES = [
    ("000", codes.PAID_LEAVE), ("001", "FERIAS"), ("002", "FOLGA"), ("003", codes.NEVER_PAID_LEAVES[0]),
    ("004", codes.NEVER_PAID_LEAVES[1]), ("005", codes.MATERNITY_LEAVES[0]), ("006", codes.MATERNITY_LEAVES[1]),
]
UNIONS = [("U0", "SIND LIMPEZA"), ("U1", "SIND SERVICOS"), ("U2", "SIND OBRAS"), ("U3", "SIND PORTARIA"), ("U4", "SIND SAUDE"), ("U5", "SIND GERAL")]
UNION_RULES = [("U0", "SIM", 15), ("U1", "NAO", 30), ("U2", "SIM", 0), ("U3", "NAO", 900), ("U4", "SIM", None)]
BENEFITS = [
    ("1", "TK VA MENSAL", "2"), ("2", "TK VA 25 DIAS", "2"), ("3", "TK CESTA", "2"), ("4", "VR TICKET DIAS", "1"),
    ("5", "VR CARTAO", "2"),
]
CONTRACTS = [("01", "C-1001"), ("02", "C-2002")]
HOLIDAYS = ["1998-06-11", "1998-06-24", "1998-07-09", "1998-12-25"]
JOBS = 9


@lru_cache(maxsize=256)
def _schema(spark: SparkSession, path: str) -> T.StructType:
    return spark.read.parquet(path).schema


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; its schema is looked up once per session."""
    path = f"{folder}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def branch_of(emp_no: str) -> str:
    return f"CASE WHEN {emp_no} % 10 < 6 THEN '01' WHEN {emp_no} % 10 < 9 THEN '02' ELSE '03' END"


def code3(number: str) -> str:
    return f"lpad(CAST({number} AS string), 3, '0')"


def cc_of(nation: str) -> str:
    return f"concat('CC', lpad(CAST({nation} AS string), 2, '0'))"


# Rows that are not soft-deleted.
KEPT_EMPLOYEE = "c_acctbal >= -900"
KEPT_EVENT = "l_tax < 0.08"

ADMISSION = "date_add(DATE '1997-01-01', CAST(c_custkey * 7919 % 700 AS int))"
TERMINATION = f"CASE WHEN c_custkey % 3 = 0 THEN date_add({ADMISSION}, CAST(30 + c_custkey * 104729 % 500 AS int)) END"
NOT_TERMINATED = "CASE WHEN c_custkey % 2 = 0 THEN rpad('', 8, ' ') ELSE '19000101' END"
EMPLOYEE = {
    "branch": branch_of("c_custkey"),
    "emp_no": "c_custkey",
    "name": "c_name",
    "admission": ADMISSION,
    "termination": TERMINATION,
    "status": "CASE WHEN c_custkey % 3 = 0 AND c_custkey % 33 <> 0 THEN 'D' ELSE 'A' END",
    "cost_centre": cc_of("c_nationkey"),
    "dept": "concat('DEPT-', lpad(CAST(c_custkey % 7 AS string), 4, '0'))",
    "job": f"concat('J', c_custkey % {JOBS})",
    "union_code": "concat('U', c_custkey % 6)",
    "shift": code3("c_custkey % 12"),
    "daily_hours": "CAST(6 + c_custkey % 3 AS double)",
    "salary": "c_acctbal",
    "pis": "c_custkey",
    "cpf": "CAST(c_custkey * 37 AS string)",
}
CODED = {
    "unhealthy_code": "CAST(c_custkey % 6 AS string)",
    "hazard_code": "CAST(c_custkey % 2 + 1 AS string)",
    "marital_code": "substring('CDMQSVX', CAST(c_custkey % 7 + 1 AS int), 1)",
    "schooling_code": "CAST(c_custkey % 20 * 5 AS string)",
    "disabled_code": "CAST(c_custkey % 3 AS string)",
    "disability_code": "CAST(c_custkey % 8 AS string)",
    "hour_bank_code": "substring('NSX', CAST(c_custkey % 3 + 1 AS int), 1)",
}
AS_LANDED = (
    EMPLOYEE
    | CODED
    | {c: f"rpad({EMPLOYEE[c]}, 40, ' ')" for c in ("name", "cost_centre", "dept", "union_code")}
    | {
        "admission": f"date_format({ADMISSION}, 'yyyyMMdd')",
        "termination": f"coalesce(date_format({TERMINATION}, 'yyyyMMdd'), {NOT_TERMINATED})",
        "deleted": f"CASE WHEN {KEPT_EMPLOYEE} THEN '' ELSE '*' END",
    }
)


def project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expression} AS `{name}`" for name, expression in columns.items()])


def employees(spark: SparkSession, folder: str) -> DataFrame:
    """Employees from ``customer``, as the operators expect them."""
    return project(table(spark, folder, "customer").filter(KEPT_EMPLOYEE), EMPLOYEE)


def card_holders(spark: SparkSession, folder: str) -> DataFrame:
    """Employees with what a meal card shows."""
    card = {
        "full_name": "concat(c_name, ' DA SILVA')",
        "birth": "date_add(DATE '1960-01-01', CAST(c_custkey * 37 % 14000 AS int))",
        "sex": "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END",
    }
    return project(table(spark, folder, "customer").filter(KEPT_EMPLOYEE), EMPLOYEE | card)


def normalized_employees(spark: SparkSession, folder: str) -> DataFrame:
    """Employees as the ERP lands them (padded text, ``yyyyMMdd`` dates, delete flag), then normalised."""
    landed = project(table(spark, folder, "customer"), AS_LANDED)
    return normalize(landed, dates=["admission", "termination"])


WAIVER = "CASE WHEN l_linenumber % 4 = 1 THEN '001' WHEN l_linenumber % 4 = 2 THEN '004' ELSE '' END"
CLOCK_EVENT = {
    "branch": branch_of("o_custkey"),
    "emp_no": "o_custkey",
    "date": "CAST(l_shipdate AS date)",
    "code": code3("(l_suppkey + l_linenumber) % 15"),
    "waiver": WAIVER,
    "hours_calc": "l_quantity % 8 + l_linenumber * 7 % 60 / 100",
    "hours_waived": f"CASE WHEN {WAIVER} = '' THEN 0.0D ELSE l_quantity % 5 + l_linenumber * 11 % 60 / 100 END",
    "processed": "CASE WHEN l_linestatus = 'F' THEN 'X' ELSE '' END",
}


def clock_events(spark: SparkSession, folder: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Clock events from ``lineitem``: employee = customer of the order. The bounds restrict the scan itself."""
    items = table(spark, folder, "lineitem").filter(KEPT_EVENT)
    if first:
        items = items.filter(f"l_shipdate >= TIMESTAMP_NTZ '{first}'")
    if last:
        items = items.filter(f"l_shipdate < TIMESTAMP_NTZ '{last}'")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return project(items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")), CLOCK_EVENT)


def values(rows: list, columns: str) -> str:
    """Rows as an SQL table; Spark knows the exact size of such a table and broadcasts it by itself."""

    def literal(x) -> str:
        if x is None:
            return "NULL"
        return str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"

    lines = ", ".join("(" + ", ".join(literal(x) for x in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {lines}) AS t({columns}))"


def small(spark: SparkSession, rows: list, columns: str) -> DataFrame:
    return spark.sql(values(rows, columns))


def shifts(spark: SparkSession) -> DataFrame:
    return small(spark, SHIFTS, "shift, shift_desc")


def shift_hours(spark: SparkSession) -> DataFrame:
    return shift_hours_dim(small(spark, SHIFT_HOURS, "shift_desc, main_hours, secondary_hours, secondary_weekday"))


def shift_start(spark: SparkSession) -> DataFrame:
    return shift_starts(small(spark, SHIFT_START, "shift_desc, start"))


def event_codes(spark: SparkSession) -> DataFrame:
    return small(spark, EVENT_CODES, "code, event_desc")


def leave_types(spark: SparkSession) -> DataFrame:
    return small(spark, LEAVE_TYPES, "leave_type, leave_desc")


def unions(spark: SparkSession) -> DataFrame:
    return small(spark, UNIONS, "union_code, union_desc")


def union_rules(spark: SparkSession) -> DataFrame:
    return small(spark, UNION_RULES, "union_code, maternity_120, leave_limit_days")


def benefit_definitions(spark: SparkSession) -> DataFrame:
    return small(spark, BENEFITS, "benefit_code, benefit_desc, voucher_type")


def contracts(spark: SparkSession) -> DataFrame:
    return small(spark, CONTRACTS, "branch, contract")


def holidays(spark: SparkSession) -> DataFrame:
    return small(spark, [(d,) for d in HOLIDAYS], "date").select(F.to_date("date").alias("date"))


def cost_centres(spark: SparkSession, folder: str) -> DataFrame:
    """Cost centres per branch from ``nation``; some are named after abandonment."""
    columns = {
        "branch": "explode(array('01', '02', '03'))",
        "cost_centre": cc_of("n_nationkey"),
        "cost_centre_desc": "CASE WHEN n_nationkey % 10 = 3 THEN concat(n_name, ' ABANDONO') ELSE n_name END",
    }
    return project(table(spark, folder, "nation"), columns)


def departments(spark: SparkSession, folder: str) -> DataFrame:
    """Departments per cost centre from ``nation``; department 6 exists in some regions only."""
    numbered = table(spark, folder, "nation").selectExpr("n_nationkey", "n_regionkey", "explode(sequence(0, 6)) AS number")
    columns = {
        "dept": "concat('DEPT-', lpad(CAST(number AS string), 4, '0'))",
        "cost_centre": cc_of("n_nationkey"),
        "dept_desc": "concat('DEPARTMENT ', number)",
    }
    return project(numbered.filter("number < 6 OR n_regionkey < 3"), columns)


def jobs(spark: SparkSession) -> DataFrame:
    return project(spark.range(JOBS), {"job": "concat('J', id)", "job_desc": "concat('JOB ', id)"})


def payment_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Payment day per cost centre from ``nation``; some have none."""
    day = "CASE n_nationkey % 4 WHEN 0 THEN '5' WHEN 1 THEN '1' ELSE '0' END"
    dated = table(spark, folder, "nation").filter("n_regionkey <> 3")
    return project(dated, {"cost_centre": cc_of("n_nationkey"), "payment_day": day})


def managers(spark: SparkSession, folder: str) -> DataFrame:
    """Supervisor and manager per cost centre from ``nation``; some have none."""
    columns = {
        "cost_centre": cc_of("n_nationkey"),
        "supervisor": "concat('SUP ', n_nationkey % 9)",
        "manager": "CASE WHEN n_nationkey % 5 <> 4 THEN concat('MGR ', n_regionkey) END",
    }
    return project(table(spark, folder, "nation"), columns)


def schedule(spark: SparkSession, folder: str) -> DataFrame:
    """Planned intervals in minutes for the shifts of ``customer``, weekdays 2 to 7; shift 7 has no plan."""
    used = table(spark, folder, "customer").selectExpr("CAST(c_custkey % 12 AS int) AS n").distinct()
    days = used.filter("n <> 7").selectExpr("n", "420 + n * 15 AS begin", "explode(sequence(2, 7)) AS day")
    columns = {
        "shift": code3("n"),
        "week": "day",
        "day": "day",
        "in1": "begin",
        "out1": "begin + 240",
        "in2": "begin + 300",
        "out2": "begin + 300 + CASE WHEN day = 7 THEN 0 ELSE 180 + n * 5 END",
    }
    return project(days, columns | {c: "CAST(NULL AS int)" for c in ("in3", "out3", "in4", "out4")})


def leaves(spark: SparkSession, folder: str) -> DataFrame:
    """Leaves from ``orders``."""
    start = "CAST(o_orderdate AS date)"
    columns = {
        "branch": branch_of("o_custkey"),
        "emp_no": "o_custkey",
        "leave_type": code3("o_orderkey % 8"),
        "start_date": start,
        "end_date": f"CASE WHEN o_orderkey % 5 <> 0 THEN date_add({start}, CAST(o_orderkey % 400 AS int)) END",
    }
    return project(table(spark, folder, "orders"), columns)


def shifted(df: DataFrame, *dates: str) -> DataFrame:
    """Dates of the ERP moved to the time of the punches."""
    return df.withColumns({c: F.date_add(c, TIME_SHIFT) for c in dates})


def benefits(spark: SparkSession, folder: str) -> DataFrame:
    """Benefit rows from ``orders``: the benefit is its priority."""
    number = "substring(o_orderpriority, 1, 1)"
    work = "CAST(20 + o_orderkey % 4 AS int)"
    columns = {
        "branch": branch_of("o_custkey"),
        "emp_no": "o_custkey",
        "benefit_row": "o_orderkey",
        "benefit_code": number,
        "benefit_type": f"CASE {number} WHEN '3' THEN '92' WHEN '4' THEN '87' WHEN '5' THEN '94' ELSE '90' END",
        "work_days": work,
        "prop_days": f"CAST({work} - o_orderkey % 3 AS int)",
        "calc_days": f"CAST({work} - o_orderkey % 5 AS int)",
        "unit_value": "o_totalprice",
        "total_value": f"o_totalprice * {work}",
        "vacation_days": "CASE WHEN o_orderkey % 7 = 0 THEN 10 ELSE 0 END",
    }
    return project(table(spark, folder, "orders"), columns)


def punches(spark: SparkSession, folder: str) -> DataFrame:
    """Device punches from ``events``."""
    return project(table(spark, folder, "events"), {"id": "event_id", "pis": "user_id", "device": "event_type", "at": "ts"})


def afd_lines(spark: SparkSession, folder: str) -> DataFrame:
    """AFD records written from the punches; a few are too long, too short or hold no date, or an unknown PIS."""
    day = "CASE WHEN id % 47 = 0 THEN '31022024' ELSE date_format(at, 'ddMMyyyy') END"
    pis = "lpad(CAST(pis * CASE WHEN id % 53 = 0 THEN 1000003 ELSE 1 END AS string), 12, '0')"
    record = f"concat(lpad(CAST(id AS string), 9, '0'), '3', {day}, date_format(at, 'HHmm'), {pis})"
    written = punches(spark, folder).selectExpr("id", f"{record} AS record")
    columns = {
        "tenant": "CASE WHEN id % 2 = 0 THEN 'A' ELSE 'B' END",
        "value": f"CASE WHEN id % 41 = 0 THEN concat(record, 'X') "
        f"WHEN id % 43 = 0 THEN substring(record, 1, {AFD_LENGTH - 1}) ELSE record END",
    }
    return split_records(project(written, columns), "value")


def erp_punch_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Punches known to the ERP: all but those of device type ``error``, time as HH.MM."""
    columns = {
        "branch": branch_of("pis"),
        "emp_no": "pis",
        "date": "CAST(at AS date)",
        "hhmm": "hour(at) + minute(at) / 100",
    }
    return project(punches(spark, folder).filter("device <> 'error'"), columns)


ZONES = ["America/Sao_Paulo", "EUROPE/MADRID", "ASIA/AQTOBE", "MOON/BASE", "AMERICA/PHOENIX"]


def clockings(source: DataFrame) -> DataFrame:
    """Punches as the JSON of the device service, every fourth delivered twice, one in 28 of these once with a date that is none."""
    zones = ", ".join(f"'{z}'" for z in ZONES)
    fields = (
        "'id', CAST(id + 10000000000 AS string), 'personPIS', CAST(pis AS string), 'clockingCollectorName', device, "
        f"'clockingDate', date_format(at, 'ddMMyyyyHHmmss'), 'timezone', element_at(array({zones}), CAST(pis % 5 + 1 AS int))"
    )
    unreadable = fields.replace("date_format(at, 'ddMMyyyyHHmmss')", "'99999999999999'")
    one = source.selectExpr("id", f"to_json(named_struct({fields})) AS one", f"to_json(named_struct({unreadable})) AS bad")
    twice = "concat('[', CASE WHEN id % 28 = 0 THEN bad ELSE one END, ',', one, ']')"
    return one.selectExpr(f"CASE WHEN id % 4 = 0 THEN {twice} ELSE concat('[', one, ']') END AS payload")


def loaded_punches(spark: SparkSession, folder: str) -> DataFrame:
    """Punches loaded before: those of device type ``signup``, the id with the ending a float column leaves."""
    columns = {"recno": "id", "id": "concat(CAST(id + 10000000000 AS string), '.0')"}
    return project(punches(spark, folder).filter("device = 'signup'"), columns)


def receipt_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Receipt pages from ``orders``: one document per payee, some pages without marker or with a field missing."""
    lines = [
        "CASE WHEN o_orderkey % 17 = 0 THEN 'EXTRATO' ELSE 'COMPROVANTE DE PAGAMENTO' END",
        "'PAGADOR: EMPRESA S.A.'",
        "'AGENCIA: 1234 CONTA: 5678-9'",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'NR. DOCUMENTO: ' ELSE concat('NR. DOCUMENTO: ', o_orderkey) END",
        "concat('BENEFICIARIO: PESSOA ', o_custkey, ' ')",
        "concat('CPF/CNPJ: 0', o_custkey, '.000-1')",
        "concat('AGENCIA: 4', o_custkey, ' CONTA: 77-', o_custkey)",
        "concat('NR. DOCUMENTO: ', o_orderkey)",
        "concat('DATA DO PAGAMENTO: ', date_format(o_orderdate, 'dd/MM/yyyy'))",
        "concat('VALOR: ', replace(format_string('%.2f', o_totalprice), '.', ','))",
        "CASE WHEN o_orderkey % 13 = 0 THEN 'SEM CODIGO' "
        "ELSE concat('NR. AUTENTICACAO: A.', o_orderkey - o_orderkey % 2) END",
    ]
    columns = {
        "doc": "CASE WHEN o_custkey % 19 = 0 THEN concat('a_b_c_', o_custkey) ELSE concat('LOTE_', o_custkey) END",
        "page": "o_orderkey",
        "text": f"concat_ws('\\n', {', '.join(lines)})",
    }
    return project(table(spark, folder, "orders"), columns)


def known_receipts(spark: SparkSession, folder: str) -> DataFrame:
    """Receipts written before: the names of the orders with status P."""
    name = (
        "concat('PESSOA', o_custkey, '_0', o_custkey, '0001_', date_format(o_orderdate, 'ddMMyyyy'), "
        "'_A', o_orderkey - o_orderkey % 2)"
    )
    return project(table(spark, folder, "orders").filter("o_orderstatus = 'P'"), {"receipt": name})


DELIVERIES = [
    "dayofmonth(at) <= 10 AND id % 9 <> 0",
    # Two days come again, soon enough for the state of the stream.
    "(dayofmonth(at) BETWEEN 11 AND 20 AND id % 9 <> 0) OR (dayofmonth(at) IN (9, 10) AND id % 9 <> 0 AND id % 4 = 1)",
    # The first days come again, when the state has forgotten them.
    "dayofmonth(at) > 20 OR (dayofmonth(at) <= 10 AND id % 9 <> 0 AND id % 4 = 1)",
    # Punches nobody delivered before, some of them weeks late.
    "dayofmonth(at) <= 20 AND id % 9 = 0",
    "dayofmonth(at) <= 20 AND id % 9 = 0 AND id % 2 = 0",
]


#: Punches in each file of the smallest delivery, at least.
FILE_PUNCHES = 10_000


def deliver_punches(spark: SparkSession, folder: str, path: str) -> DataFrame:
    """The punches as the device service delivers them, in turn: on time, again and late. The result is the stream of the deliveries.

    Every delivery has the same number of files, which grows with the smallest, and the stream takes that many at a time: a delivery.
    """
    source = punches(spark, folder)
    sizes = source.agg(*[F.count_if(F.expr(part)) for part in DELIVERIES]).first()
    files = max(1, min(sizes) // FILE_PUNCHES)
    for number, part in enumerate(DELIVERIES):
        # Dealt before the JSON is written, so that only the fields move.
        clockings(source.filter(part).repartition(files)).write.parquet(f"{path}/delivery={number}")
    reader = spark.readStream.schema("payload string, delivery int").option("maxFilesPerTrigger", files)
    return reader.parquet(path).drop("delivery")


def payroll_rows(orders: DataFrame) -> DataFrame:
    """Payroll sheet rows from ``orders``, all text, with the name of their file; one column is missing, one too many.

    Some files of March hold a value that is no number.
    """
    columns = {
        "file_name": "concat(date_format(o_orderdate, 'yyyy-MM'), CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE '-01' END, '.xlsx')",
        "Filial": branch_of("o_custkey"),
        "Matricula": "CAST(o_custkey AS string)",
        "CPF": "CASE WHEN o_orderkey % 23 <> 0 THEN CAST(o_custkey * 37 + 1 AS string) END",
        "Status": "o_orderstatus",
        "Descrição Verba": "o_orderpriority",
        "Valor": "CASE WHEN month(o_orderdate) = 3 AND o_orderkey % 20 = 0 THEN 'x' ELSE CAST(o_totalprice AS string) END",
        "PERIODO DA FOLHA": "CASE WHEN o_orderkey % 31 = 0 THEN '199813' ELSE date_format(o_orderdate, 'yyyyMM') END",
        "Observação": "'x'",
    }
    return project(orders, columns)


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Days at irregular distances, on which someone asks for the head count: those of some orders."""
    return table(spark, folder, "orders").filter("o_orderkey % 101 = 0").selectExpr("CAST(o_orderdate AS date) AS day").distinct()


def consent_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Consent requests from ``orders``; some without consent, photo or CPF."""
    columns = {
        "cpf": "CASE WHEN o_orderkey % 37 = 0 THEN ' ' ELSE CAST(o_custkey * 37 AS string) END",
        "branch": f"CASE WHEN o_orderkey % 6 = 0 THEN '02' ELSE {branch_of('o_custkey')} END",
        "accepted": "o_orderstatus <> 'F'",
        "photo": "CASE WHEN o_orderkey % 9 <> 0 THEN concat('photo-', o_orderkey) END",
        "requested": "o_orderkey",
    }
    return project(table(spark, folder, "orders"), columns)


def known_consents(spark: SparkSession, folder: str) -> DataFrame:
    """Consents registered before: the employees of segment BUILDING."""
    return table(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'").selectExpr("CAST(c_custkey * 37 AS string) AS cpf")


def synced_employees(spark: SparkSession, folder: str) -> DataFrame:
    """Employees the warehouse holds already: all but segment MACHINERY."""
    return table(spark, folder, "customer").filter("c_mktsegment <> 'MACHINERY'").selectExpr("c_custkey AS emp_no")
