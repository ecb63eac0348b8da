"""SQL with the results of the registered queries, for an engine that reads the same tables.

The statements spell out what the operators compute in another way: a row per employee and day where Spark counts
weekdays, range joins where Spark unfolds months, row numbers where Spark aggregates.
"""

from __future__ import annotations

from rollcall.functions import codes
from rollcall.plans import roles
from rollcall.plans.roles import AS_OF, CYCLE_START, values

BRANCH = "CASE WHEN {0} % 10 < 6 THEN '01' WHEN {0} % 10 < 9 THEN '02' ELSE '03' END"


def branch(key: str) -> str:
    return BRANCH.format(key)


def code3(number: str) -> str:
    return f"lpad(CAST({number} AS VARCHAR), 3, '0')"


def cc(key: str) -> str:
    return f"'CC' || lpad(CAST({key} AS VARCHAR), 2, '0')"


def text_list(items: list[str]) -> str:
    return ", ".join("'" + i.replace("'", "''") + "'" for i in items)


def case(column: str, labels: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items() if k is not None)
    return f"CASE {column} {whens} ELSE '{labels[None]}' END"


def iso(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), '')"


def hundredths(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


def minutes(column: str) -> str:
    return f"(({hundredths(column)} // 100) * 60 + {hundredths(column)} % 100)"


def weekday(date: str, labels: list[str]) -> str:
    return f"([{text_list(labels)}])[isodow({date})]"


def percent(part: str, whole: str) -> str:
    """Whole numbers only, halves to the even neighbour."""
    down, rest = f"(10000 * ({part}) // ({whole}))", f"(10000 * ({part}) % ({whole}))"
    return f"({down} + CASE WHEN 2 * {rest} > ({whole}) OR 2 * {rest} = ({whole}) AND {down} % 2 = 1 THEN 1 ELSE 0 END) / 100"


ZONE_HOURS = "(CASE user_id % 5 WHEN 0 THEN -3 WHEN 1 THEN 2 WHEN 2 THEN 5 WHEN 3 THEN 0 ELSE -7 END)"
LOCAL = f"(ts + to_hours({ZONE_HOURS}))"

RECEIPT_FIELDS = {
    "payer": r"PAGADOR: (.+?)\n",
    "payer_branch": r"AGENCIA: (\d+) +CONTA",
    "payer_account": r"CONTA: ([\d.-]+)\nNR\. DOCUMENTO",
    "payer_doc_no": r"NR\. DOCUMENTO:\s*(\d*)",
    "payee": r"BENEFICIARIO: +(.+?)\n",
    "tax_id": r"CPF/CNPJ: +([\d.-]+)",
    "payee_branch": r"(?s)BENEFICIARIO:.*?AGENCIA: (\d+)",
    "payee_account": r"(?s)BENEFICIARIO:.*?CONTA: ([\d.-]+)",
    "paid_on": r"DATA DO PAGAMENTO: +([\d/]+)",
    "amount": r"VALOR: +([\d.,]+)",
    "auth_no": r"NR. AUTENTICACAO: +([\w.]+)",
    "payee_doc_no": r"(?s)BENEFICIARIO:.*?NR\. DOCUMENTO:\s*(\d*)",
}

# ---- the roles as SQL, and steps several queries share: name -> (names it builds on, SQL) -----------------------

CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "emp": ((), f"""
        SELECT {branch('c_custkey')} AS branch, c_custkey AS emp_no, c_name AS name, admission,
          CASE WHEN c_custkey % 3 = 0 THEN admission + CAST(30 + c_custkey * 104729 % 500 AS INTEGER) END AS termination,
          CASE WHEN c_custkey % 3 = 0 AND c_custkey % 33 <> 0 THEN 'D' ELSE 'A' END AS status,
          {cc('c_nationkey')} AS cost_centre, 'DEPT-' || lpad(CAST(c_custkey % 7 AS VARCHAR), 4, '0') AS dept,
          'J' || (c_custkey % 9) AS job, 'U' || (c_custkey % 6) AS union_code, {code3('c_custkey % 12')} AS shift,
          CAST(6 + c_custkey % 3 AS DOUBLE) AS daily_hours, c_acctbal AS salary, c_custkey AS pis,
          CAST(c_custkey * 37 AS VARCHAR) AS cpf
        FROM (SELECT *, DATE '1997-01-01' + CAST(c_custkey * 7919 % 700 AS INTEGER) AS admission FROM customer)
        WHERE c_acctbal >= -900"""),
    "ev": ((), f"""
        SELECT *, CASE WHEN waiver = '' THEN 0 ELSE l_quantity % 5 + (l_linenumber * 11 % 60) / 100 END AS hours_waived
        FROM (SELECT {branch('o_custkey')} AS branch, o_custkey AS emp_no, CAST(l_shipdate AS DATE) AS date,
            {code3('(l_suppkey + l_linenumber) % 15')} AS code,
            CASE l_linenumber % 4 WHEN 1 THEN '001' WHEN 2 THEN '004' ELSE '' END AS waiver,
            l_quantity % 8 + (l_linenumber * 7 % 60) / 100 AS hours_calc,
            CASE WHEN l_linestatus = 'F' THEN 'X' ELSE '' END AS processed, l_quantity, l_linenumber
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_tax < 0.08)"""),
    "cc": ((), f"""
        SELECT b.branch, {cc('n_nationkey')} AS cost_centre,
          CASE WHEN n_nationkey % 10 = 3 THEN n_name || ' ABANDONO' ELSE n_name END AS cost_centre_desc
        FROM nation, (VALUES ('01'), ('02'), ('03')) AS b(branch)"""),
    "dep": ((), f"""
        SELECT 'DEPT-' || lpad(CAST(k AS VARCHAR), 4, '0') AS dept, {cc('n_nationkey')} AS cost_centre,
          'DEPARTMENT ' || k AS dept_desc
        FROM nation, range(7) AS r(k) WHERE k < 6 OR n_regionkey < 3"""),
    "dep_name": (("dep",), "SELECT DISTINCT dept, dept_desc FROM dep"),
    "job": ((), "SELECT 'J' || k AS job, 'JOB ' || k AS job_desc FROM range(9) AS r(k)"),
    "snapshot": ((), "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderkey % 101 = 0"),
    "shifts": ((), values(roles.SHIFTS, "shift, shift_desc")),
    "event_code": ((), values(roles.EVENT_CODES, "code, event_desc")),
    "leave_type": ((), values(roles.LEAVE_TYPES, "leave_type, leave_desc")),
    "unions": ((), values(roles.UNIONS, "union_code, union_desc")),
    "union_rule": ((), values(roles.UNION_RULES, "union_code, maternity_120, leave_limit_days")),
    "benefit_def": ((), values(roles.BENEFITS, "benefit_code, benefit_desc, voucher_type")),
    "contracts": ((), values(roles.CONTRACTS, "branch, contract")),
    "months": ((), """
        SELECT CAST(DATE '1998-01-01' + to_months(CAST(i AS INTEGER)) AS DATE) AS m,
          CAST(DATE '1998-01-01' + to_months(CAST(i + 1 AS INTEGER)) AS DATE) AS next_m
        FROM range(12) AS r(i)"""),
    "plan": ((), f"""
        SELECT {code3('n')} AS shift, CAST(d AS INTEGER) AS day,
          240 + CASE WHEN d = 7 THEN 0 ELSE 180 + n * 5 END AS minutes
        FROM (SELECT DISTINCT c_custkey % 12 AS n FROM customer), range(2, 8) AS r(d) WHERE n <> 7"""),
    "spine": (("emp", "months"), """
        SELECT branch, emp_no, shift, daily_hours, m, CAST(unnest(generate_series(
            greatest(admission, m), least(coalesce(termination, next_m - 1), next_m - 1), INTERVAL 1 DAY)) AS DATE) AS day
        FROM emp JOIN months ON (termination IS NULL OR termination > m) AND admission < next_m"""),
    "ideal": (("spine", "plan"), """
        SELECT branch, emp_no, m, sum(coalesce(p.minutes, daily_hours * 60)) / 60 AS ideal_hours,
          CAST(sum(coalesce(p.minutes, daily_hours * 60)) AS BIGINT) AS ideal_minutes
        FROM spine s LEFT JOIN plan p ON p.shift = s.shift AND p.day = dayofweek(s.day) + 1
        GROUP BY ALL"""),
    "absent": (("ev",), f"""
        SELECT branch, emp_no, CAST(date_trunc('month', date) AS DATE) AS m, sum({minutes('hours_calc')}) AS all_minutes,
          sum(CASE WHEN waiver = '' AND date <= DATE '1998-10-31' THEN {minutes('hours_calc')} END) AS unwaived_minutes,
          sum(CASE WHEN waiver = '001' THEN {minutes('hours_calc')} END) AS medical_minutes
        FROM ev WHERE code IN ({text_list(codes.ABSENCE_CODES)}) AND date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
        GROUP BY ALL"""),
    "sheet": ((), """
        SELECT trim(shift_desc) AS shift_desc, coalesce(TRY_CAST(replace(main, ',', '.') AS DOUBLE), 0) AS main_hours,
          coalesce(TRY_CAST(replace(secondary, ',', '.') AS DOUBLE), 0) AS secondary_hours, secondary_weekday
        FROM """ + values(roles.SHIFT_HOURS, "shift_desc, main, secondary, secondary_weekday")),
    "used": (("emp", "shifts"), """
        SELECT DISTINCT shift, shift_desc FROM emp JOIN shifts USING (shift) WHERE status <> 'D'"""),
    "catalogue": (("used", "sheet"), """
        SELECT u.shift, shift_desc, main_hours, secondary_hours, secondary_weekday, s.shift_desc IS NULL AS shift_missing
        FROM used u LEFT JOIN sheet s USING (shift_desc)"""),
    "leaves": ((), f"""
        SELECT {branch('o_custkey')} AS branch, o_custkey AS emp_no, {code3('o_orderkey % 8')} AS leave_type,
          CAST(o_orderdate AS DATE) AS start_date,
          CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) END AS end_date
        FROM orders"""),
    "running": (("leaves", "leave_type"), f"""
        SELECT *, date_diff('day', start_date, DATE '{AS_OF}') AS days_away FROM leaves JOIN leave_type USING (leave_type)
        WHERE end_date IS NULL OR end_date > DATE '{AS_OF}'"""),
    "current": (("running", "emp", "unions"), f"""
        SELECT r.*, name, union_code, union_desc
        FROM (SELECT * FROM running WHERE leave_type NOT IN ({text_list(codes.EXCLUDED_LEAVE_TYPES)})
          QUALIFY row_number() OVER (PARTITION BY branch, emp_no
            ORDER BY end_date IS NOT NULL, start_date, leave_type, end_date) = 1) r
        JOIN emp USING (branch, emp_no) JOIN unions USING (union_code)"""),
    "latest": (("running",), """
        SELECT * FROM running QUALIFY row_number() OVER (PARTITION BY branch, emp_no
          ORDER BY start_date DESC, leave_type DESC, end_date DESC NULLS LAST) = 1"""),
    "ben": ((), f"""
        SELECT {branch('o_custkey')} AS branch, o_custkey AS emp_no, o_orderkey AS benefit_row,
          left(o_orderpriority, 1) AS benefit_code, CAST(20 + o_orderkey % 4 AS INTEGER) AS work_days,
          CAST(20 + o_orderkey % 4 - o_orderkey % 3 AS INTEGER) AS prop_days,
          CAST(20 + o_orderkey % 4 - o_orderkey % 5 AS INTEGER) AS calc_days, o_totalprice AS unit_value,
          CASE WHEN o_orderkey % 7 = 0 THEN 10 ELSE 0 END AS vacation_days,
          CASE left(o_orderpriority, 1) WHEN '3' THEN '92' WHEN '4' THEN '87' WHEN '5' THEN '94' ELSE '90' END AS kind
        FROM orders"""),
    "people": (("emp", "cc", "unions", "shifts", "dep_name", "contracts"), """
        SELECT emp.*, cost_centre_desc, union_desc, shift_desc, dept_desc, coalesce(contract, 'Verificar') AS contract
        FROM emp JOIN cc USING (branch, cost_centre) JOIN unions USING (union_code) JOIN shifts USING (shift)
        JOIN dep_name USING (dept) LEFT JOIN contracts USING (branch) WHERE termination IS NULL"""),
    "ledger": (("ev", "emp", "event_code", "cc", "shifts", "dep_name", "job"), """
        SELECT branch, emp_no, name, job_desc, cost_centre_desc, status, shift_desc, date, code, event_desc, waiver,
          hours_calc, hours_waived, hours_calc - hours_waived AS net_hours, dept_desc
        FROM ev JOIN emp USING (branch, emp_no) JOIN event_code USING (code) JOIN cc USING (branch, cost_centre)
        JOIN shifts USING (shift) JOIN dep_name USING (dept) JOIN job USING (job)
        WHERE hours_calc - hours_waived > 0 AND processed = ''"""),
    "event_lists": (("ledger",), f"""
        SELECT branch, emp_no, date, class, string_agg(event_desc, ' | ' ORDER BY event_desc) AS events
        FROM (SELECT branch, emp_no, date, event_desc,
            CASE WHEN event_desc IN ({text_list(codes.ABSENCE_EVENTS)}) THEN 'A'
              WHEN event_desc IN ({text_list(codes.OVERTIME_EVENTS)}) THEN 'H' ELSE '' END AS class
          FROM ledger) GROUP BY ALL"""),
    "event_days": (("event_lists",), """
        SELECT branch, emp_no, date, coalesce(max(events) FILTER (class = 'H'), '') AS overtime_events,
          coalesce(max(events) FILTER (class = 'A'), '') AS absence_events,
          coalesce(max(events) FILTER (class = ''), '') AS other_events
        FROM event_lists GROUP BY ALL"""),
    "afd_text": ((), """
        SELECT CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'B' END AS tenant,
          CASE WHEN event_id % 41 = 0 THEN r || 'X' WHEN event_id % 43 = 0 THEN left(r, 33) ELSE r END AS value
        FROM (SELECT event_id, lpad(CAST(event_id AS VARCHAR), 9, '0') || '3'
            || CASE WHEN event_id % 47 = 0 THEN '31022024' ELSE strftime(ts, '%d%m%Y') END || strftime(ts, '%H%M')
            || lpad(CAST(user_id * CASE WHEN event_id % 53 = 0 THEN 1000003 ELSE 1 END AS VARCHAR), 12, '0') AS r
          FROM events)"""),
    "afd": (("afd_text",), """
        SELECT tenant, value, CAST(try_strptime(substr(value, 11, 8), '%d%m%Y') AS DATE) AS date,
          CAST(substr(value, 19, 2) AS INTEGER) * 60 + CAST(substr(value, 21, 2) AS INTEGER) AS minute,
          CAST(substr(value, 23, 12) AS BIGINT) AS pis
        FROM afd_text WHERE length(value) = 34"""),
    "staff": (("emp", "shifts"), "SELECT emp.*, shift_desc FROM emp JOIN shifts USING (shift)"),
    "matched": (("afd", "staff"), """
        SELECT value, afd.pis, date, minute, branch, emp_no, cost_centre, shift_desc
        FROM afd LEFT JOIN (SELECT * FROM staff WHERE status <> 'D') s ON s.pis = afd.pis"""),
    "worked": (("matched",), f"""
        SELECT m.*, start_second, CASE WHEN start_second > 48000 AND minute > 0 AND minute < 600 THEN date - 1 ELSE date END
          AS work_date
        FROM matched m LEFT JOIN (SELECT DISTINCT shift_desc, CAST(left(start, 2) AS INTEGER) * 3600
            + CAST(substr(start, 4, 2) AS INTEGER) * 60 + CAST(right(start, 2) AS INTEGER) AS start_second
          FROM {values(roles.SHIFT_START, "shift_desc, start")}) s USING (shift_desc)
        WHERE emp_no IS NOT NULL"""),
    "erp_punch": ((), f"""
        SELECT DISTINCT {branch('user_id')} AS branch, user_id AS emp_no, CAST(ts AS DATE) AS date,
          hour(ts) * 60 + minute(ts) AS minute
        FROM events WHERE event_type <> 'error'"""),
    "device": (("matched",), """
        SELECT branch, emp_no, date, minute, count(*) AS punches FROM matched
        WHERE emp_no IS NOT NULL AND date IS NOT NULL GROUP BY ALL"""),
    "daily": (("worked",), """
        SELECT branch, emp_no, work_date, count(*) AS punches_count,
          string_agg(printf('%02d:%02d:00', minute // 60, minute % 60), ' | ' ORDER BY minute) AS punches
        FROM worked WHERE work_date IS NOT NULL GROUP BY ALL"""),
    "grid": (("staff", "latest", "daily"), f"""
        SELECT s.branch, s.emp_no, g.day, s.cost_centre, name, shift_desc, supervisor, manager,
          coalesce(leave_desc, '') AS leave_desc, {iso(f'(start_date + {roles.TIME_SHIFT})')} AS start_date,
          {iso(f'(end_date + {roles.TIME_SHIFT})')} AS end_date, coalesce(punches_count, 0) AS punches_count, coalesce(punches, 'Sem registro') AS punches,
          {weekday('g.day', codes.TIMESHEET_WEEKDAYS)} AS weekday
        FROM staff s
        JOIN (SELECT {cc('n_nationkey')} AS cost_centre, 'SUP ' || (n_nationkey % 9) AS supervisor,
            'MGR ' || n_regionkey AS manager FROM nation WHERE n_nationkey % 5 <> 4) m USING (cost_centre)
        CROSS JOIN (SELECT DATE '2024-01-01' + CAST(i AS INTEGER) AS day FROM range(30) AS r(i)) g
        LEFT JOIN latest l ON l.branch = s.branch AND l.emp_no = s.emp_no
        LEFT JOIN daily d ON d.branch = s.branch AND d.emp_no = s.emp_no AND d.work_date = g.day"""),
    "import_once": ((), f"""
        SELECT event_id, user_id, event_type, CAST(event_id + 10000000000 AS VARCHAR) AS id,
          strftime({LOCAL}, '%Y%m%d') AS date, CAST(hour({LOCAL}) * 3600 + minute({LOCAL}) * 60 AS INTEGER) AS seconds,
          strftime(ts, '%Y%m%d') AS device_date
        FROM events"""),
    "imports": (("import_once",), """
        SELECT * FROM import_once UNION ALL
        SELECT * REPLACE (CASE WHEN event_id % 28 <> 0 THEN date ELSE '' END AS date,
            CASE WHEN event_id % 28 <> 0 THEN seconds END AS seconds,
            CASE WHEN event_id % 28 <> 0 THEN device_date ELSE '' END AS device_date)
        FROM import_once WHERE event_id % 4 = 0"""),
    "pending": (("import_once", "emp"), """
        SELECT i.* FROM import_once i WHERE event_type <> 'signup'
          AND EXISTS (SELECT 1 FROM emp WHERE status <> 'D' AND emp.pis = i.user_id)"""),
    "sheet_rows": ((), f"""
        SELECT *, CASE WHEN o_orderkey % 29 <> 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS file_date,
          strftime(o_orderdate, '%Y-%m') || CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE '-01' END || '.xlsx' AS file_name,
          CASE WHEN o_orderkey % 31 <> 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS period,
          month(o_orderdate) = 3 AND o_orderkey % 20 = 0 AS bad
        FROM orders"""),
    "bad_file": (("sheet_rows",), """
        SELECT file_name, CAST(count(*) AS BIGINT) AS rows, count(*) FILTER (bad) AS bad_rows FROM sheet_rows
        GROUP BY ALL HAVING bool_or(bad)"""),
    "mark": (("sheet_rows",), "SELECT max(file_date) AS file_date FROM sheet_rows WHERE file_date <= DATE '1998-07-01'"),
    "fresh": (("sheet_rows", "mark"), "SELECT s.* FROM sheet_rows s, mark WHERE s.file_date > mark.file_date"),
    "receipt_text": ((), """
        SELECT CASE WHEN o_custkey % 19 = 0 THEN 'a_b_c_' ELSE 'LOTE_' END || o_custkey AS doc, o_orderkey AS page,
          concat_ws(chr(10), CASE WHEN o_orderkey % 17 = 0 THEN 'EXTRATO' ELSE 'COMPROVANTE DE PAGAMENTO' END,
            'PAGADOR: EMPRESA S.A.', 'AGENCIA: 1234 CONTA: 5678-9',
            'NR. DOCUMENTO: ' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END,
            'BENEFICIARIO: PESSOA ' || o_custkey || ' ', 'CPF/CNPJ: 0' || o_custkey || '.000-1',
            'AGENCIA: 4' || o_custkey || ' CONTA: 77-' || o_custkey, 'NR. DOCUMENTO: ' || o_orderkey,
            'DATA DO PAGAMENTO: ' || strftime(o_orderdate, '%d/%m/%Y'),
            'VALOR: ' || replace(printf('%.2f', o_totalprice), '.', ','),
            CASE WHEN o_orderkey % 13 = 0 THEN 'SEM CODIGO'
              ELSE 'NR. AUTENTICACAO: A.' || (o_orderkey - o_orderkey % 2) END) AS text
        FROM orders"""),
    "receipt_page": (("receipt_text",), """
        SELECT * FROM receipt_text WHERE length(doc) - length(replace(doc, '_', '')) <> 3 AND contains(text, 'COMPROVANTE')
          AND doc IN (SELECT doc FROM receipt_text GROUP BY doc HAVING count(*) > 1)"""),
    "receipt_raw": (("receipt_page",), "SELECT doc, page, "
        + ", ".join(f"regexp_extract(text, '{p}', 1) AS {n}" for n, p in RECEIPT_FIELDS.items())
        + " FROM receipt_page"),
    "receipt": (("receipt_raw",), r"""
        SELECT doc, page, translate(payer, '/\:*?"<>.-', '') AS payer, payer_branch, payer_account, payer_doc_no,
          trim(payee) AS payee, translate(tax_id, '/\:*?"<>.-', '') AS tax_id, payee_branch, payee_account, paid_on,
          CAST(replace(replace(amount, '.', ''), ',', '.') AS DOUBLE) AS amount,
          translate(auth_no, '/\:*?"<>.-', '') AS auth_no, payee_doc_no,
          translate(concat_ws('_', trim(payee), tax_id, paid_on, auth_no), '/\:*?"<>.- ', '') AS receipt
        FROM receipt_raw WHERE auth_no <> ''"""),
    "known_receipt": ((), """
        SELECT 'PESSOA' || o_custkey || '_0' || o_custkey || '0001_' || strftime(o_orderdate, '%d%m%Y')
          || '_A' || (o_orderkey - o_orderkey % 2) AS receipt FROM orders WHERE o_orderstatus = 'P'"""),
    "request": ((), f"""
        SELECT CASE WHEN o_orderkey % 37 = 0 THEN ' ' ELSE CAST(o_custkey * 37 AS VARCHAR) END AS cpf,
          CASE WHEN o_orderkey % 6 = 0 THEN '02' ELSE {branch('o_custkey')} END AS branch, o_orderstatus <> 'F' AS accepted,
          CASE WHEN o_orderkey % 9 <> 0 THEN 'photo-' || o_orderkey END AS photo, o_orderkey AS requested
        FROM orders"""),
    "person": (("emp", "cc", "dep_name"), """
        SELECT emp.*, cost_centre_desc, dept_desc
        FROM emp JOIN cc USING (branch, cost_centre) JOIN dep_name USING (dept)"""),
    "consented": ((), "SELECT CAST(c_custkey * 37 AS VARCHAR) AS cpf FROM customer WHERE c_mktsegment = 'BUILDING'"),
}


def sql(body: str, *names: str, **extra: tuple[tuple[str, ...], str]) -> str:
    """A statement with the common table expressions it needs, in order."""
    known = CTE | extra
    ordered: list[str] = []

    def need(name: str) -> None:
        for dependency in known[name][0]:
            need(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        need(name)
    head = ",\n".join(f"{name} AS ({known[name][1]})" for name in ordered)
    return f"WITH {head}\n{body}" if head else body


def absence_days(until: str | None = None) -> tuple[tuple[str, ...], str]:
    upper = f"AND date < DATE '{until}'" if until else ""
    planned = f"""CASE WHEN secondary_weekday = {weekday('date', codes.ABSENCE_WEEKDAYS)} THEN secondary_hours
        ELSE main_hours END"""
    return ("ev", "emp", "shifts", "catalogue"), f"""
        SELECT branch, emp_no, CAST(coalesce(sum(m), 0) AS BIGINT) AS medical_days,
          CAST(coalesce(sum(u), 0) AS BIGINT) AS unexcused_days
        FROM (SELECT branch, emp_no,
            CASE WHEN med > 0 THEN CASE WHEN med / 60 / nullif(planned, 0) < 0.5 THEN 0 ELSE 1 END END AS m,
            CASE WHEN unx IS NOT NULL THEN CASE WHEN unx / 60 / nullif(planned, 0) < 0.5 THEN 0 ELSE 1 END END AS u
          FROM (SELECT d.*, {planned} AS planned
            FROM (SELECT branch, emp_no, date,
                sum({minutes('hours_waived')}) FILTER (waiver NOT IN ({text_list(codes.NON_MEDICAL_WAIVERS)})) AS med,
                sum({minutes('hours_calc')}) FILTER (waiver = '' AND code = '010') AS unx
              FROM ev WHERE date > DATE '{CYCLE_START}' {upper} GROUP BY ALL) d
            JOIN emp USING (branch, emp_no) JOIN shifts USING (shift) LEFT JOIN catalogue c ON c.shift = emp.shift))
        GROUP BY ALL HAVING sum(m) > 0 OR sum(u) > 0"""


CLASS = """CASE WHEN contains(shift_desc, '25 DIAS') THEN 1 WHEN contains(shift_desc, '30 DIAS') THEN 2
  WHEN regexp_matches(shift_desc, '(12X36)') AND NOT contains(shift_desc, 'DIAS') THEN 3
  WHEN contains(shift_desc, 'FOL SAB') AND NOT contains(shift_desc, 'DIAS') THEN 4
  WHEN contains(shift_desc, 'FOL DOM') AND NOT contains(shift_desc, 'DIAS') THEN 5
  WHEN regexp_matches(shift_desc, '(4X2)') AND NOT contains(shift_desc, 'DIAS') THEN 6
  WHEN contains(shift_desc, 'SAB') AND NOT contains(shift_desc, 'DIAS') THEN 7 ELSE 0 END"""


def prorata(first: str, last: str) -> tuple[tuple[str, ...], str]:
    """June 1998 has 30 days and two holidays of the sheet; its days are listed one by one."""
    listed = "(SELECT count(*) FROM range(a, 31) AS r(d) WHERE {0})"
    saturdays = listed.format("dayofweek(make_date(1998, 6, CAST(d AS INTEGER))) = 6")
    sundays = listed.format("dayofweek(make_date(1998, 6, CAST(d AS INTEGER))) = 0")
    return ("emp", "shifts"), f"""
        SELECT branch, emp_no, admission, shift_class, CAST(CASE
            WHEN shift_class IN (1, 2) THEN 30 - a
            WHEN shift_class = 3 THEN {listed.format('d % 2 = a % 2')}
            WHEN shift_class = 4 THEN 30 - a - {saturdays}
            WHEN shift_class = 5 THEN 30 - a - {sundays}
            WHEN shift_class = 6 THEN round_even((30 - a) * 20 / 30, 0)
            WHEN shift_class = 7 THEN 30 - a - 2 - {sundays}
            ELSE 30 - a - {saturdays} - {sundays} - 2 END AS INTEGER) AS admission_days
        FROM (SELECT branch, emp_no, admission, {CLASS} AS shift_class, day(admission) AS a
          FROM emp JOIN shifts USING (shift)
          WHERE admission BETWEEN DATE '{first}' AND DATE '{last}' AND termination IS NULL)"""


def payments(missing: str) -> tuple[tuple[str, ...], str]:
    limit = f"coalesce(leave_limit_days, {missing})"
    return ("current", "union_rule"), f"""
        SELECT branch, emp_no, leave_desc, union_code, days_away, {limit} AS leave_limit_days, CASE
            WHEN leave_desc IN ({text_list(codes.NEVER_PAID_LEAVES)}) THEN 'NÃO PAGA'
            WHEN leave_desc IN ({text_list(codes.MATERNITY_LEAVES)}) AND maternity_120 = 'SIM' THEN 'PAGA'
            WHEN days_away > {limit} THEN 'NÃO PAGA' WHEN days_away < {limit} THEN 'PAGA'
            WHEN days_away = 0 AND {limit} = 0 THEN 'NÃO PAGA' ELSE 'UNDEFINED' END AS payment
        FROM current LEFT JOIN union_rule USING (union_code) WHERE leave_desc <> '{codes.PAID_LEAVE}'"""


BASE = """branch, emp_no, benefit_row, benefit_desc, name, cost_centre, cost_centre_desc, union_desc, shift_desc, dept_desc,
  contract, base_days, unused_days, unit_value, vacation_days"""


def base(voucher: str, kinds: str, days: str = "prop_days") -> tuple[tuple[str, ...], str]:
    return ("ben", "benefit_def", "people"), f"""
        SELECT {BASE}, dept, calc_days
        FROM (SELECT *, {days} AS base_days, work_days - {days} AS unused_days FROM ben) b
        JOIN benefit_def USING (benefit_code) JOIN people USING (branch, emp_no)
        WHERE voucher_type = '{voucher}' AND kind IN ({kinds})"""


ENRICHED = """branch, emp_no, benefit_row, medical_days, unexcused_days, admission_days,
  round({amount}, 4) AS admission_amount, terminated, payment"""


def enriched(body: str, base_rows, admitted: tuple[str, str], left: tuple[str, str], missing: str) -> str:
    steps = {
        "base": base_rows,
        "absence": absence_days(),
        "prorata": prorata(*admitted),
        "pay": payments(missing),
        "rich": (("base", "absence", "prorata", "pay", "emp"), f"""
            SELECT b.*, coalesce(medical_days, 0) AS medical_days, coalesce(unexcused_days, 0) AS unexcused_days,
              coalesce(admission_days, 0) AS admission_days, unit_value * coalesce(admission_days, 0) AS amount,
              coalesce(e.termination BETWEEN DATE '{left[0]}' AND DATE '{left[1]}', false) AS terminated,
              coalesce(payment, '') AS payment
            FROM base b LEFT JOIN absence USING (branch, emp_no) LEFT JOIN prorata USING (branch, emp_no)
            LEFT JOIN pay USING (branch, emp_no) LEFT JOIN emp e USING (branch, emp_no)"""),
    }
    return sql(body, "rich", **steps)


CORRECTED = """CASE WHEN contains(benefit_desc, 'DIAS') THEN base_days - medical_days - unexcused_days - vacation_days
  ELSE base_days - medical_days - unexcused_days END"""
BASKET_DAYS = "CASE WHEN payment = 'NÃO PAGA' THEN 0 ELSE 1 END"
BASKET_AMOUNT = "CASE WHEN admission_days >= 15 THEN unit_value ELSE 0 END"
JULY, JUNE = ("1998-07-01", "1998-07-31"), ("1998-06-01", "1998-06-30")
FOOD = base("2", "'90', '92'")
LEDGER = f"""branch, emp_no, name, job_desc, cost_centre_desc, status, shift_desc, {iso('date')} AS date, code, event_desc,
  waiver, round(hours_calc, 4) AS hours_calc, round(hours_waived, 4) AS hours_waived, round(net_hours, 4) AS net_hours,
  dept_desc"""
REGISTRY = f"""
    SELECT branch, emp_no, name, {iso('admission')} AS admission, {iso('termination')} AS termination, status, cost_centre,
      dept, job, union_code, shift, daily_hours, salary, pis, cpf, job_desc, cost_centre_desc, union_desc, shift_desc,
      dept_desc, {case('CAST(emp_no % 6 AS VARCHAR)', codes.UNHEALTHY_LABELS)} AS unhealthy,
      {case('CAST(emp_no % 2 + 1 AS VARCHAR)', codes.HAZARD_LABELS)} AS hazard,
      {case("substr('CDMQSVX', CAST(emp_no % 7 + 1 AS INTEGER), 1)", codes.MARITAL_LABELS)} AS marital,
      {case('CAST(emp_no % 20 * 5 AS VARCHAR)', codes.SCHOOLING_LABELS)} AS schooling,
      {case('CAST(emp_no % 3 AS VARCHAR)', codes.DISABLED_LABELS)} AS disabled,
      {case('CAST(emp_no % 8 AS VARCHAR)', codes.DISABILITY_LABELS)} AS disability,
      {case("substr('NSX', CAST(emp_no % 3 + 1 AS INTEGER), 1)", codes.HOUR_BANK_LABELS)} AS hour_bank
    FROM emp JOIN job USING (job) JOIN cc USING (branch, cost_centre) JOIN unions USING (union_code)
    JOIN shifts USING (shift) JOIN dep_name USING (dept)"""
REGISTRY_NEEDS = ("emp", "job", "cc", "unions", "shifts", "dep_name")
IMPORT = """id, CAST(user_id AS VARCHAR) AS pis, event_type AS collector, event_type AS rep, right(id, 9) AS nsr, date, seconds,
  'clockinmobile' AS unit, '0' AS ip, '0' AS geofence, '99999999999' AS cc_rep, 0 AS layout"""

TURNOVER = f"""
    SELECT h.cost_centre, strftime(h.m, '%m/%Y') AS month_label, headcount, coalesce(a.n, 0) AS admitted,
      coalesce(t.n, 0) AS terminated, {percent('coalesce(t.n, 0) + coalesce(a.n, 0)', '2 * headcount')} AS turnover_rate
    FROM (SELECT cost_centre, m, count(emp_no) AS headcount
        FROM months JOIN emp ON admission < next_m AND (termination IS NULL OR termination >= next_m) GROUP BY ALL) h
    LEFT JOIN (SELECT cost_centre, date_trunc('month', admission) AS m, count(emp_no) AS n FROM emp GROUP BY ALL) a
      ON a.cost_centre = h.cost_centre AND a.m = h.m
    LEFT JOIN (SELECT cost_centre, date_trunc('month', termination) AS m, count(emp_no) AS n FROM emp
        WHERE status = 'D' GROUP BY ALL) t
      ON t.cost_centre = h.cost_centre AND t.m = h.m"""

ORACLE: dict[str, str] = {
    "month_dimension": """
        SELECT CAST(month(m) AS INTEGER) AS month_no, strftime(m, '%m/%Y') AS month_label, CAST(m AS VARCHAR) AS first_day,
          CAST(last_day(m) AS VARCHAR) AS last_day, CAST(last_day(m) + 1 AS VARCHAR) AS snapshot_day
        FROM (SELECT CAST(unnest(generate_series(min(date_trunc('month', o_orderdate)), max(date_trunc('month', o_orderdate)),
            INTERVAL 1 MONTH)) AS DATE) AS m FROM orders)""",
    "turnover_monthly": sql(TURNOVER, "emp", "months"),
    "turnover_report": sql(f"SELECT month_label, cost_centre, turnover_rate FROM ({TURNOVER})", "emp", "months"),
    "headcount_monthly": sql("""
        SELECT cost_centre, CAST(m AS VARCHAR) AS month, count(*) AS headcount
        FROM months JOIN emp ON admission < m AND (termination IS NULL OR termination >= m) GROUP BY ALL""",
        "emp", "months"),
    "headcount_snapshots": sql("""
        SELECT cost_centre, CAST(day AS VARCHAR) AS day, count(*) AS headcount
        FROM emp JOIN snapshot ON admission < day AND (termination IS NULL OR termination >= day) GROUP BY ALL""", "emp", "snapshot"),
    "active_on_snapshots": sql("""
        SELECT branch, CAST(day AS VARCHAR) AS day, count(*) AS employees, CAST(sum(emp_no) AS BIGINT) AS numbers
        FROM emp JOIN snapshot ON admission < day AND (termination IS NULL OR termination >= day) GROUP BY ALL""", "emp", "snapshot"),
    "events_on_leave": sql("""
        SELECT e.emp_no, CAST(e.date AS VARCHAR) AS date, leave_type, count(*) AS events, CAST(min(start_date) AS VARCHAR) AS first_start
        FROM ev e JOIN leaves l ON l.emp_no = e.emp_no AND e.date >= start_date AND (end_date IS NULL OR e.date <= end_date)
        WHERE e.date >= DATE '1998-01-01' AND e.date < DATE '1999-01-01' GROUP BY ALL""", "ev", "leaves"),
    "active_days": sql("""
        SELECT branch, CAST(day AS VARCHAR) AS day, count(*) AS employees FROM spine GROUP BY ALL""", "spine"),
    "scheduled_hours": sql("""
        SELECT shift, day AS week, day, CAST(minutes AS BIGINT) AS minutes, round(minutes / 60, 4) AS hours FROM plan""",
        "plan"),
    "absence_hours": sql("""
        SELECT branch, emp_no, CAST(m AS VARCHAR) AS month, CAST(all_minutes AS BIGINT) AS all_minutes,
          CAST(coalesce(unwaived_minutes, 0) AS BIGINT) AS unwaived_minutes,
          CAST(coalesce(medical_minutes, 0) AS BIGINT) AS medical_minutes
        FROM absent""", "absent"),
    "absenteeism_rate": sql(f"""
        SELECT strftime(i.m, '%d/%m/%Y') AS month_label, emp_no, name, cost_centre, cost_centre_desc, shift, branch,
          round(ideal_hours, 4) AS ideal_hours, round(coalesce(all_minutes, 0) / 60, 4) AS absent_hours,
          {percent('CAST(coalesce(all_minutes, 0) AS BIGINT)', 'ideal_minutes')} AS absenteeism_rate
        FROM ideal i JOIN emp USING (branch, emp_no) LEFT JOIN cc USING (branch, cost_centre)
        LEFT JOIN absent a USING (branch, emp_no, m)""", "ideal", "emp", "cc", "absent"),
    "absenteeism_split": sql("""
        SELECT strftime(i.m, '%m/%Y') AS month_label, emp_no, name, cost_centre, cost_centre_desc, shift, shift_desc, branch,
          round(ideal_hours, 4) AS ideal_hours, round(coalesce(unwaived_minutes, 0) / 60, 4) AS absent_hours,
          round(coalesce(medical_minutes, 0) / 60, 4) AS medical_hours
        FROM ideal i JOIN emp USING (branch, emp_no) JOIN shifts USING (shift) LEFT JOIN cc USING (branch, cost_centre)
        LEFT JOIN absent a USING (branch, emp_no, m)""", "ideal", "emp", "shifts", "cc", "absent"),
    "medical_days": sql(
        "SELECT branch, emp_no, medical_days FROM days WHERE medical_days > 0", "days", days=absence_days()),
    "unexcused_days": sql(
        "SELECT branch, emp_no, unexcused_days FROM days WHERE unexcused_days > 0", "days", days=absence_days()),
    "absence_days_cycle": sql("SELECT * FROM days", "days", days=absence_days("1998-07-21")),
    "shift_catalogue_check": sql("""
        SELECT shift, shift_desc, coalesce(main_hours, 0) AS main_hours, coalesce(secondary_hours, 0) AS secondary_hours,
          coalesce(secondary_weekday, '') AS secondary_weekday, shift_missing FROM catalogue""", "catalogue"),
    "shift_catalogue_outer": sql("""
        SELECT coalesce(shift, '') AS shift, shift_desc, coalesce(main_hours, 0) AS main_hours,
          coalesce(secondary_hours, 0) AS secondary_hours, coalesce(secondary_weekday, '') AS secondary_weekday,
          main_hours IS NULL AS shift_missing
        FROM used FULL JOIN sheet USING (shift_desc)""", "used", "sheet"),
    "terminated_employees": sql("""
        SELECT branch, emp_no, true AS terminated FROM emp
        WHERE termination BETWEEN DATE '1998-07-01' AND DATE '1998-08-31'""", "emp"),
    "new_employees": sql(f"""
        SELECT branch, emp_no, name, {iso('admission')} AS admission, cost_centre, dept, cpf, cost_centre_desc, dept_desc
        FROM emp JOIN cc USING (branch, cost_centre) JOIN dep USING (dept, cost_centre)
        WHERE status <> 'D' AND emp_no NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')""",
        "emp", "cc", "dep"),
    "erp_normalize": sql(f"""
        SELECT branch, emp_no, name, {iso('admission')} AS admission, {iso('termination')} AS termination, cost_centre, dept,
          union_code FROM emp""", "emp"),
    "employee_registry": sql(REGISTRY + " WHERE status <> 'D'", *REGISTRY_NEEDS),
    "admitted_between": sql(f"""
        SELECT branch, emp_no, name, admission, cost_centre_desc, job_desc
        FROM ({REGISTRY} WHERE status <> 'D') WHERE admission BETWEEN '1998-02-01' AND '1998-02-28'""", *REGISTRY_NEEDS),
    "registry_segment": sql(f"""
        SELECT branch, emp_no, cost_centre_desc, status, termination FROM ({REGISTRY})
        WHERE contains(cost_centre_desc, 'ABANDONO')""", *REGISTRY_NEEDS),
    "current_leave": sql(f"""
        SELECT branch, emp_no, leave_type, {iso('start_date')} AS start_date, {iso('end_date')} AS end_date, leave_desc,
          CAST(days_away AS INTEGER) AS days_away, name, union_code, union_desc FROM current""", "current"),
    "latest_leave": sql(f"""
        SELECT leave_type, branch, emp_no, {iso('start_date')} AS start_date, {iso('end_date')} AS end_date, leave_desc,
          CAST(days_away AS INTEGER) AS days_away FROM latest""", "latest"),
    "leave_payment": sql("""
        SELECT branch, emp_no, leave_desc, union_code, CAST(days_away AS INTEGER) AS days_away, leave_limit_days, payment
        FROM pay""", "pay", pay=payments("0")),
    "shift_class": sql(f"""
        SELECT shift_desc, {CLASS} AS shift_class, count(*) AS employees FROM emp JOIN shifts USING (shift) GROUP BY ALL""",
        "emp", "shifts"),
    "admission_prorata": sql(f"""
        SELECT branch, emp_no, {iso('admission')} AS admission, shift_class, admission_days FROM days""",
        "days", days=prorata("1998-06-01", "1998-07-31")),
    "benefit_base_food": sql(f"SELECT {BASE} FROM base", "base", base=FOOD),
    "benefit_base_meal_ticket": sql(f"SELECT {BASE} FROM base", "base", base=base("1", "'87'")),
    "benefit_base_meal_sheet": sql(f"SELECT {BASE} FROM base", "base", base=base("1", "'87'", "calc_days")),
    "benefit_base_meal_card": sql(f"""
        SELECT {BASE}, right(dept, 4) AS site, name || ' DA SILVA' AS full_name, name AS printed_name,
          strftime(DATE '1960-01-01' + CAST(emp_no * 37 % 14000 AS INTEGER), '%d/%m/%Y') AS birth_date,
          CASE WHEN emp_no % 2 = 0 THEN 'F' ELSE 'M' END AS sex
        FROM base""", "base", base=base("2", "'94'")),
    "benefit_enrich": enriched(f"SELECT {ENRICHED.format(amount='amount')} FROM rich", FOOD, JULY, JULY, "NULL"),
    "corrected_days": enriched(
        f"SELECT {ENRICHED.format(amount='amount')}, base_days, {CORRECTED} AS corrected_days FROM rich",
        base("1", "'87'", "calc_days"), JUNE, ("1998-07-01", "1998-08-31"), "NULL"),
    "basket_rule": enriched(
        f"SELECT {ENRICHED.format(amount=BASKET_AMOUNT)}, {BASKET_DAYS} AS corrected_days FROM rich "
        "WHERE contains(benefit_desc, 'TK CESTA')", FOOD, JULY, JULY, "0"),
    "payment_routing": enriched(f"""
        SELECT {ENRICHED.format(amount='paid')}, rule, coalesce(payment_day, 'none') AS payment_day, corrected_days
        FROM (SELECT *, 'food' AS rule, {CORRECTED} AS corrected_days, amount AS paid FROM rich
            WHERE contains(benefit_desc, 'TK VA')
          UNION ALL SELECT *, 'basket', {BASKET_DAYS}, {BASKET_AMOUNT} FROM rich WHERE contains(benefit_desc, 'TK CESTA'))
        LEFT JOIN (SELECT {cc('n_nationkey')} AS cost_centre,
            CASE n_nationkey % 4 WHEN 0 THEN '5' WHEN 1 THEN '1' ELSE '0' END AS payment_day
          FROM nation WHERE n_regionkey <> 3) USING (cost_centre)""", FOOD, JULY, JULY, "0"),
    "abandonment_split": sql("""
        SELECT branch, emp_no, benefit_row,
          CASE WHEN contains(cost_centre_desc, 'ABANDONO') THEN 'abandonment' ELSE 'other' END AS part FROM base""",
        "base", base=base("1", "'87'", "calc_days")),
    "event_ledger": sql(f"SELECT {LEDGER} FROM ledger", "ledger"),
    "event_report": sql(f"""
        SELECT {LEDGER} FROM ledger WHERE dept_desc = 'DEPARTMENT 3'
          AND code NOT IN ({text_list(codes.REPORT_EXCLUDED_CODES)})""", "ledger"),
    "event_pivot": sql(f"""
        SELECT branch, emp_no, {iso('date')} AS date, overtime_events, absence_events, other_events FROM event_days""",
        "event_days"),
    "afd_parse": sql(f"SELECT tenant, value, {iso('date')} AS date, minute, pis FROM afd", "afd"),
    "duplicate_punches": sql(f"""
        SELECT tenant, value, {iso('date')} AS date, minute, pis FROM afd WHERE date IS NOT NULL
        QUALIFY count(*) OVER (PARTITION BY date, minute, pis) > 1""", "afd"),
    "matched_punches": sql(f"""
        SELECT value, pis, {iso('date')} AS date, minute, coalesce(branch, '') AS branch, coalesce(emp_no, -1) AS emp_no,
          coalesce(cost_centre, '') AS cost_centre, coalesce(shift_desc, '') AS shift_desc FROM matched""", "matched"),
    "unmatched_punches": sql("SELECT DISTINCT pis FROM matched WHERE emp_no IS NULL", "matched"),
    "work_date_shift": sql(f"""
        SELECT value, branch, emp_no, {iso('date')} AS date, minute, coalesce(start_second, -1) AS start_second,
          {iso('work_date')} AS work_date FROM worked""", "worked"),
    "punch_reconciliation": sql("""
        SELECT branch, emp_no, CAST(date AS VARCHAR) AS date, minute, punches, e.minute IS NOT NULL AS in_erp
        FROM device d LEFT JOIN erp_punch e USING (branch, emp_no, date, minute)""".replace(
        "e.minute IS NOT NULL", "e.emp_no IS NOT NULL"), "device", "erp_punch"),
    "punches_missing_in_erp": sql("""
        SELECT branch, emp_no, CAST(date AS VARCHAR) AS date, minute, punches
        FROM device d ANTI JOIN erp_punch e USING (branch, emp_no, date, minute)""", "device", "erp_punch"),
    "daily_punch_list": sql("""
        SELECT branch, emp_no, CAST(work_date AS VARCHAR) AS work_date, punches_count, punches FROM daily""", "daily"),
    "daily_punch_entries": sql("""
        SELECT branch, emp_no, CAST(work_date AS VARCHAR) AS work_date,
          CAST(row_number() OVER (PARTITION BY branch, emp_no, work_date ORDER BY minute) - 1 AS INTEGER) AS position,
          printf('%02d:%02d:00', minute // 60, minute % 60) AS time
        FROM worked WHERE work_date IS NOT NULL""", "worked"),
    "event_list_pivot": sql(f"""
        SELECT branch, emp_no, {iso('date')} AS date, list,
          CAST(row_number() OVER (PARTITION BY branch, emp_no, date, list ORDER BY event_desc) - 1 AS INTEGER) AS position, event_desc AS event
        FROM (SELECT *, CASE WHEN event_desc IN ({text_list(codes.ABSENCE_EVENTS)}) THEN 'absence_events'
            WHEN event_desc IN ({text_list(codes.OVERTIME_EVENTS)}) THEN 'overtime_events' ELSE 'other_events' END AS list FROM ledger)""", "ledger"),
    "punch_parity": sql("""
        SELECT branch, emp_no, CAST(work_date AS VARCHAR) AS work_date, punches_count,
          punches_count % 2 <> 0 AS inconsistent FROM daily""", "daily"),
    "attendance_grid": sql("SELECT * REPLACE (CAST(day AS VARCHAR) AS day) FROM grid", "grid"),
    "timesheet": sql("""
        SELECT g.branch, g.emp_no, CAST(g.day AS VARCHAR) AS day, manager, weekday, punches,
          coalesce(overtime_events, '') AS overtime_events, coalesce(absence_events, '') AS absence_events,
          coalesce(other_events, '') AS other_events
        FROM grid g LEFT JOIN event_days e
          ON e.branch = g.branch AND e.emp_no = g.emp_no AND e.date + {shift} = g.day""".replace("{shift}", str(roles.TIME_SHIFT)), "grid", "event_days"),
    "import_rows": sql(f"SELECT {IMPORT} FROM imports", "imports"),
    "import_rows_keep_date": sql("SELECT id, device_date AS date, seconds FROM imports", "imports"),
    "pending_punches": sql(f"SELECT {IMPORT} FROM pending", "pending"),
    "pending_punches_by_day": sql("SELECT date, count(*) AS punches FROM pending GROUP BY ALL", "pending"),
    "surrogate_ids": sql("""
        SELECT id, date, (SELECT max(event_id) FROM events WHERE event_type = 'signup')
          + row_number() OVER (ORDER BY date, CAST(id AS BIGINT)) AS recno FROM pending""", "pending"),
    "stream_clockings": sql("""
        SELECT id, CAST(user_id AS VARCHAR) AS pis, right(id, 9) AS nsr, date, seconds FROM import_once""", "import_once"),
    "stream_pending_by_day": sql("SELECT date, count(*) AS punches FROM pending GROUP BY ALL", "pending"),
    "punch_load": sql("""
        SELECT * FROM (WITH brought AS (
          SELECT *, 'all' AS load FROM imports UNION ALL
          SELECT *, 'first' FROM imports WHERE date = '' OR date <= '20240110'),
        checked AS (
          SELECT id, date, load, CASE WHEN date = '' THEN 'no readable date'
            WHEN NOT EXISTS (SELECT 1 FROM emp WHERE status <> 'D' AND emp.pis = b.user_id) THEN 'no active employee' ELSE '' END AS reason
          FROM brought b),
        once AS (
          SELECT *, row_number() OVER (PARTITION BY load, reason, id) AS copy,
            load = 'all' AND reason = '' AND date <= '20240110' AS held FROM checked),
        named AS (
          SELECT load, date, id, CASE WHEN held THEN 'key exists' WHEN reason = '' AND copy > 1 THEN 'key repeats' ELSE reason END AS reason,
            reason = '' AS counted, copy > 1 AS again FROM once)
        SELECT load, date, reason, count(*) AS punches,
          CAST(count(DISTINCT CASE WHEN counted THEN id || again END) + count(*) FILTER (NOT counted) AS BIGINT) AS rows
        FROM named GROUP BY ALL)""", "imports", "emp"),
    "stream_rejects": sql("""
        SELECT id, CAST(user_id AS VARCHAR) AS pis, right(id, 9) AS nsr FROM import_once WHERE event_id % 28 = 0""", "import_once"),
    "high_water_mark": sql("SELECT CAST(file_date AS VARCHAR) AS file_date FROM mark", "mark"),
    "new_files": sql("""
        SELECT file_name, CAST(file_date AS VARCHAR) AS file_date, count(*) AS rows FROM fresh GROUP BY ALL""", "fresh"),
    "new_sheets": sql("SELECT DISTINCT file_name, CAST(file_date AS VARCHAR) AS file_date FROM fresh", "fresh"),
    "payroll_ingest": sql(f"""
        SELECT CAST(o_custkey AS VARCHAR) AS matricula, {branch('o_custkey')} AS filial,
          CASE WHEN o_orderkey % 23 <> 0 THEN lpad(CAST(o_custkey * 37 + 1 AS VARCHAR), 11, '0') ELSE '' END AS cpf,
          o_orderstatus AS status, o_orderpriority AS descricao_verba, '' AS funcao, o_totalprice AS valor,
          coalesce(CAST(period AS VARCHAR), '') AS data_referencia
        FROM fresh ANTI JOIN bad_file USING (file_name)""", "fresh", "bad_file"),
    "payroll_rejects": sql("""
        SELECT file_name, rows, bad_rows FROM bad_file WHERE file_name IN (SELECT file_name FROM fresh)""",
        "bad_file", "fresh"),
    "stream_payroll": sql("""
        SELECT coalesce(CAST(period AS VARCHAR), '') AS data_referencia, count(*) AS rows,
          count(*) FILTER (o_orderkey % 23 <> 0) AS with_cpf
        FROM sheet_rows ANTI JOIN bad_file USING (file_name) WHERE file_date IS NOT NULL GROUP BY ALL""",
        "sheet_rows", "bad_file"),
    "all_text": """
        SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size,
          CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part""",
    "receipt_extract": sql("""
        SELECT * FROM receipt WHERE receipt NOT IN (SELECT receipt FROM known_receipt)
        QUALIFY row_number() OVER (PARTITION BY receipt ORDER BY doc, page) = 1""", "receipt", "known_receipt"),
    "receipt_rejects": sql("SELECT doc, page FROM receipt_raw WHERE auth_no = ''", "receipt_raw"),
    "text_markers": """
        SELECT doc_id, CAST(length(text) AS INTEGER) AS length,
          CAST(length(text) - length(replace(text, '.', '')) AS INTEGER) AS sentences, lang || ' | ' || source AS origin
        FROM documents WHERE regexp_matches(text, '[0-9]{3}') AND NOT contains(text, '|')""",
    "consent_register": sql(f"""
        SELECT emp_no, name, {iso('admission')} AS admission, cost_centre, cost_centre_desc, dept, dept_desc, photo, accepted,
          cpf
        FROM request JOIN person USING (cpf, branch)
        WHERE accepted AND trim(cpf) <> '' AND photo IS NOT NULL AND cpf NOT IN (SELECT cpf FROM consented)
        QUALIFY row_number() OVER (PARTITION BY cpf ORDER BY requested) = 1""", "request", "person", "consented"),
    "consent_rejects": sql("""
        SELECT cpf, branch, reason, count(*) AS requests
        FROM (SELECT r.cpf, r.branch, CASE WHEN NOT accepted THEN 'not accepted' WHEN trim(r.cpf) = '' THEN 'no CPF'
              WHEN photo IS NULL THEN 'no photo'
              WHEN NOT EXISTS (SELECT 1 FROM person p WHERE p.cpf = r.cpf AND p.branch = r.branch) THEN 'unknown employee'
              WHEN r.cpf IN (SELECT cpf FROM consented) THEN 'already registered' END AS reason
          FROM request r)
        WHERE reason IS NOT NULL GROUP BY ALL""", "request", "person", "consented"),
    "first_order": """
        SELECT o_custkey, o_orderstatus, o_totalprice, o_orderkey FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_totalprice, o_orderkey) = 1""",
    "last_order": """
        SELECT o_custkey, o_orderstatus, o_totalprice, o_orderkey FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_totalprice DESC, o_orderkey DESC) = 1""",
    "repeated_texts": """
        SELECT doc_id, source FROM documents WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)""",
    "append_orders": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders",
    "refresh_orders": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'",
    "publish_orders": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 2 = 1",
    "load_orders": """
        WITH checked AS (
          SELECT o_orderkey, year(o_orderdate) AS year, CASE WHEN o_orderkey % 10 = 0 THEN 'round key' WHEN o_totalprice < 20000 THEN 'too cheap'
            WHEN o_orderkey % 40 = 1 THEN 'no customer' ELSE '' END AS reason FROM orders),
        brought AS (
          SELECT *, 'until-1994' AS load, 1 AS times FROM checked WHERE year < 1995 UNION ALL
          SELECT *, 'until-1998', CASE WHEN year = 1997 THEN 2 ELSE 1 END FROM checked WHERE year <> 1993)
        SELECT o_orderkey, CAST(year AS INTEGER) AS year, load, CAST(1 AS BIGINT) AS copies,
          CASE WHEN reason = '' AND load = 'until-1998' AND year < 1995 THEN 'key exists' WHEN reason = '' AND n > 1 THEN 'key repeats' ELSE reason END AS reason
        FROM brought, range(1, 3) AS r(n) WHERE n <= times""",
    "numbered_parts": """
        SELECT p_partkey, (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY p_type, p_brand, p_partkey) AS recno FROM part""",
    "numbered_orders": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS recno FROM orders",
    "append_rejects": """
        SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderkey % 10 <> 0 THEN 'good' ELSE 'bad' END AS part FROM orders""",
    "export_report": sql(
        f"SELECT cost_centre, month_label, CAST(headcount AS VARCHAR) AS headcount FROM ({TURNOVER})", "emp", "months"),
    "export_by_payment_day": enriched(f"""
        SELECT branch, CAST(emp_no AS VARCHAR) AS emp_no, CAST(benefit_row AS VARCHAR) AS benefit_row, rule,
          coalesce(payment_day, 'none') AS payment_day
        FROM (SELECT *, 'food' AS rule FROM rich WHERE contains(benefit_desc, 'TK VA')
          UNION ALL SELECT *, 'basket' FROM rich WHERE contains(benefit_desc, 'TK CESTA'))
        LEFT JOIN (SELECT {cc('n_nationkey')} AS cost_centre,
            CASE n_nationkey % 4 WHEN 0 THEN '5' WHEN 1 THEN '1' ELSE '0' END AS payment_day
          FROM nation WHERE n_regionkey <> 3) USING (cost_centre)""", FOOD, JULY, JULY, "0"),
    "export_by_manager": sql("""
        SELECT branch, CAST(emp_no AS VARCHAR) AS emp_no, CAST(day AS VARCHAR) AS day, weekday, manager FROM grid""", "grid"),
    "export_duplicate_punches": sql("""
        SELECT tenant, value, CAST(date AS VARCHAR) AS date, CAST(minute AS INTEGER) AS minute, pis FROM afd
        WHERE date IS NOT NULL QUALIFY count(*) OVER (PARTITION BY date, minute, pis) > 1""", "afd"),
    "export_shift_gaps": sql("SELECT shift, shift_desc FROM catalogue WHERE shift_missing", "catalogue"),
    "dimension_sheet": f"""
        SELECT {cc('n_nationkey')} AS cost_centre, CASE n_nationkey % 4 WHEN 0 THEN '5' WHEN 1 THEN '1' ELSE '0' END AS payment_day,
          '' AS name FROM nation WHERE n_regionkey <> 3""",
    "receipt_pages": sql("""
        SELECT doc, page, CAST(length(text) AS INTEGER) AS chars FROM receipt_text WHERE page % 11 <> 0""", "receipt_text"),
    "target_columns": sql("""
        SELECT count(branch) AS branch, count(emp_no) AS emp_no, count(termination) AS termination FROM emp""", "emp"),
    "pay_cycle": """
        SELECT CAST(d AS VARCHAR) AS as_of, CAST(y AS VARCHAR) AS last_day,
          CAST(make_date(CAST(year(y) - CASE WHEN month(y) = 1 THEN 1 ELSE 0 END AS BIGINT),
            CASE WHEN month(y) = 1 THEN 12 ELSE month(y) - 1 END, 21) AS VARCHAR) AS first_day
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS DATE) - 1 AS y FROM orders)""",
    "employee_lookup": sql("SELECT branch, emp_no, name, cpf FROM emp WHERE cpf = '185' AND branch = '01'", "emp"),
    "first_punches": "SELECT event_id AS id, user_id AS pis, event_type AS device FROM events ORDER BY event_id LIMIT 10",
    "planned_by_day": sql("""
        SELECT shift, CAST(0 AS BIGINT) AS m1, """ + ", ".join(
        f"CAST(max(minutes) FILTER (day = {w}) AS BIGINT) AS m{w}" for w in range(2, 8)) + " FROM plan GROUP BY ALL", "plan"),
}
