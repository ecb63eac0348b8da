from __future__ import annotations

import datetime as dt
import json
import os
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators import consent, payroll, receipts
from rollcall.operators.relational import all_duplicates
from rollcall.plans import roles
from rollcall.sinks import tables
from rollcall.sources import erp, files
from rollcall.streaming import jobs
from rollcall.streaming.folders import run_folder

D = dt.date
TARGET = T.StructType(
    [
        T.StructField("cpf", T.StringType()),
        T.StructField("valor", T.DoubleType()),
        T.StructField("funcao", T.StringType()),
        T.StructField("data_referencia", T.DateType()),
    ]
)


def test_new_files(spark):
    names = ["2024-01-01.xlsx", "/share/2024-03-01.xlsx", "2024-13-01.xlsx", "jan.xlsx", "2024-02-01.csv", "2024-02-30.xlsx", "x2024-02-01.xlsx"]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    assert sorted(r.file_name for r in payroll.new_files(df, None).collect()) == ["/share/2024-03-01.xlsx", "2024-01-01.xlsx"]
    assert [r.file_name for r in payroll.new_files(df, D(2024, 1, 1)).collect()] == ["/share/2024-03-01.xlsx"]
    empty = payroll.high_water_mark(spark.createDataFrame([], "d date"), "d")
    assert payroll.new_files(df, empty.scalar()).count() == 2


def test_payroll(spark):
    rows = spark.createDataFrame(
        [
            ("1", "202402", "1.5", "x", "a"), (None, "202412", "2", "x", "a"), ("123456789012", "202413", "3", "x", "a"),
            ("9", None, "", "x", "a"), ("8", "202401", "1", "x", "b"), ("8", "202401", "one", "x", "b"),
        ],
        "CPF string, `PERIODO DA FOLHA` string, Valor string, extra string, file_name string",
    )
    good, bad = payroll.ingest_payroll(rows, TARGET)
    assert good.schema == TARGET
    assert sorted((tuple(r) for r in good.collect()), key=repr) == sorted(
        [
            ("00000000001", 1.5, None, D(2024, 2, 1)), (None, 2.0, None, D(2024, 12, 1)), ("123456789012", 3.0, None, None),
            ("00000000009", None, None, None),
        ], key=repr)
    assert [tuple(r) for r in bad.collect()] == [("b", 2, 1)]


PAGE = """COMPROVANTE
PAGADOR: EMPRESA S.A.
AGENCIA: 12 CONTA: 34-5
NR. DOCUMENTO: {doc}
BENEFICIARIO: FULANA {name}
CPF/CNPJ: 111.222-33
AGENCIA: 99 CONTA: 88-7
NR. DOCUMENTO: 55
DATA DO PAGAMENTO: 05/01/2024
VALOR: 1.234,56
NR. AUTENTICACAO: A.B1
"""


def test_receipts(spark):
    page = PAGE.format(doc="7", name="X ")
    rows = [
        ("LOTE", 1, page), ("LOTE", 2, page), ("LOTE", 3, PAGE.format(doc="", name="Y")), ("LOTE", 4, page.replace("VALOR", "TOTAL")), ("LOTE", 5, "EXTRATO"),
        ("LOTE", 6, PAGE.format(doc="1", name="Z")), ("SOLO", 1, page), ("a_b_c_d", 1, page), ("a_b_c_d", 2, page),
    ]
    pages = spark.createDataFrame(rows, "doc string, page int, text string")
    held = spark.createDataFrame([("FULANAZ_11122233_05012024_AB1",)], "receipt string")
    found, rejects = receipts.extract_receipts(pages, held)
    got = {r.page: r for r in found.collect()}
    assert set(got) == {1, 3} and got[1].receipt == "FULANAX_11122233_05012024_AB1"
    assert (got[1].payer, got[1].payee, got[1].payer_doc_no, got[3].payer_doc_no, got[1].amount) == ("EMPRESA SA", "FULANA X", "7", "", Decimal("1234.56"))
    assert (got[1].payer_account, got[1].payee_branch, got[1].payee_account, got[1].tax_id) == ("34-5", "99", "88-7", "11122233")
    assert [(r.doc, r.page) for r in rejects.collect()] == [("LOTE", 4)]


def test_consents(spark):
    emp = spark.createDataFrame(
        [("1", 1, "c1"), ("2", 2, "c1"), ("1", 3, "c2"), ("1", 4, "c3")], "branch string, emp_no long, cpf string"
    ).withColumns({c: F.lit("x") for c in ("name", "cost_centre", "cost_centre_desc", "dept", "dept_desc")}).withColumn("admission", F.to_date(F.lit("2024-01-01")))
    requests = spark.createDataFrame(
        [("c1", "1", True, "p1", 5), ("c1", "2", True, "p2", 3), ("c2", "1", True, "p", 1), ("c3", "1", True, None, 1), ("c3", "1", False, "p", 2), ("c9", "1", True, "p", 1), (" ", "1", True, "p", 1)],
        "cpf string, branch string, accepted boolean, photo string, requested int",
    )
    held = spark.createDataFrame([("c2",)], "cpf string")
    added = consent.register_consents(requests, emp, held)
    assert [(r.cpf, r.emp_no, r.photo) for r in added.collect()] == [("c1", 2, "p2")]
    assert consent.register_consents(requests, emp, held.union(added.select("cpf"))).count() == 0
    reasons = {(r.cpf.strip(), r.reason) for r in consent.rejected_requests(requests, emp, held).collect()}
    assert reasons == {("c2", "already registered"), ("c3", "no photo"), ("c3", "not accepted"), ("c9", "unknown employee"), ("", "no CPF")}
    assert consent.find_employee(emp, "c1", "2").first().emp_no == 2


def test_file_sources(spark, tmp_path):
    (tmp_path / "dim.csv").write_text("Code,Day\n A ,5\nB,\n", encoding="utf-8")
    rows = files.read_dim(spark, str(tmp_path / "dim.csv"), {"Day": "payment_day", "Code": "cost_centre"}).collect()
    assert {tuple(r) for r in rows} == {("5", "A"), (None, "B")}
    punch = {"id": 12, "personPIS": "0005", "clockingCollectorName": "d", "clockingDate": "01032024080000", "timezone": "x"}
    (tmp_path / "punch.json").write_text(json.dumps([punch, punch]))
    read = files.read_clockings(spark, str(tmp_path / "punch.json"))
    assert {t for _, t in read.dtypes} == {"string"} and [r.id for r in read.collect()] == ["12", "12"]
    (tmp_path / "afd.txt").write_bytes(b"a\r\nbb\r\n")
    assert [r.value for r in files.read_afd_lines(spark, str(tmp_path / "afd.txt")).collect()] == ["a", "bb"]
    pages = spark.createDataFrame([("d", 1, "t"), ("d", 2, ""), ("d", 3, None)], "doc string, page int, text string")
    tables.append(pages, str(tmp_path / "pages"))
    assert files.read_receipt_pages(spark, str(tmp_path / "pages")).count() == 1
    assert erp.read_as_strings(spark, str(tmp_path / "pages")).dtypes[1] == ("page", "string")
    pages.createOrReplaceTempView("target_view")
    assert erp.target_columns(spark, "target_view") == ["doc", "page", "text"]
    assert len(erp.target_schema(spark, "target_view")) == 3


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "5"), (2, "1"), (3, "none")], "id int, payment_day string")
    table = str(tmp_path / "t")
    tables.append(df, table)
    tables.append(df, table)
    assert spark.read.parquet(table).count() == 6
    tables.refresh(df, table)
    tables.refresh(df, table)
    assert spark.read.parquet(table).count() == 3
    checked = str(tmp_path / "checked")
    tables.append_with_rejects(df, F.when(F.col("id") > 1, F.lit(True)), checked)
    assert (tables.accepted(spark, checked).count(), tables.rejected(spark, checked).count()) == (2, 1)
    assert tables.rejected(spark, checked).columns == df.columns
    tables.export_by(df, "payment_day", str(tmp_path / "split"))
    assert sorted(p.name for p in (tmp_path / "split").glob("payment_day=*")) == ["payment_day=1", "payment_day=5", "payment_day=none"]
    tables.export_duplicates(df.union(df.filter("id = 1")), ["id"], str(tmp_path / "dq"))
    assert spark.read.option("header", True).csv(str(tmp_path / "dq")).count() == 2
    wide = spark.range(0, 4000, 1, 16).select((F.col("id") % 2).alias("part"), "id")
    tables.export_by(wide, "part", str(tmp_path / "wide"), files=3)
    assert all(0 < len(list((tmp_path / "wide" / f"part={i}").glob("part-*"))) <= 3 for i in (0, 1))
    gaps = df.withColumn("shift_missing", F.col("id") == 3)
    tables.export_gaps(gaps, str(tmp_path / "gaps"))
    assert spark.read.option("header", True).csv(str(tmp_path / "gaps")).count() == 1


def clocking(i, date, zone="x"):
    return {"id": str(i), "personPIS": "5", "clockingCollectorName": "d", "clockingDate": date, "timezone": zone}


def test_stream_clockings_by_id(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()

    def run():
        stream = jobs.read_clocking_stream(spark, str(source))
        jobs.stream_clockings(stream, f"{out}/table", f"{out}/rejects", f"{out}/checkpoint").awaitTermination()
        loaded = spark.read.parquet(f"{out}/table").collect()
        return sorted((int(r.nsr), r.date) for r in loaded), sorted(int(r.nsr) for r in spark.read.parquet(f"{out}/rejects").collect())

    (source / "a.json").write_text(json.dumps([clocking(i, f"0{i}032024080000") for i in (1, 2, 2, 3)] + [clocking(9, "99999999999999")]))
    first = [(1, "20240301"), (2, "20240302"), (3, "20240303")]
    assert run() == (first, [9])
    # The same ids with another date, another zone and no date; then the id without a date gets one.
    again = [clocking(3, "05032024080000"), clocking(2, "02032024230000", "ASIA/AQTOBE"), clocking(1, "bad"), clocking(9, "99999999999999"), clocking(4, "04032024080000")]
    (source / "b.json").write_text(json.dumps(again))
    assert run() == ([*first, (4, "20240304")], [1, 9])
    (source / "c.json").write_text(json.dumps([clocking(9, "09032024080000"), clocking(4, "01032024080000")]))
    assert run() == ([*first, (4, "20240304"), (9, "20240309")], [1, 9])
    assert run() == ([*first, (4, "20240304"), (9, "20240309")], [1, 9])


def test_stream_pending_counts_each_id_once(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    emp = spark.createDataFrame([("A", 5), ("D", 6)], "status string, pis long")
    loaded = spark.createDataFrame([("2.0",)], "id string")

    def run():
        stream = jobs.read_clocking_stream(spark, str(source))
        jobs.stream_pending_by_day(stream, emp, loaded, f"{out}/table", f"{out}/checkpoint").awaitTermination()
        return {r.date: r.punches for r in jobs.pending_days(spark, f"{out}/table").collect()}

    gone = clocking(7, "01032024080000") | {"personPIS": "6"}
    (source / "a.json").write_text(json.dumps([*(clocking(i, "01032024080000") for i in (1, 1, 2, 3)), gone, clocking(8, "none")]))
    assert run() == {"20240301": 2}
    (source / "b.json").write_text(json.dumps([clocking(3, "02032024080000"), clocking(4, "02032024080000")]))
    assert run() == {"20240301": 2, "20240302": 1}


def test_sheets_by_heading(spark, tmp_path):
    (tmp_path / "2024-01-01.csv").write_text("Filial,CPF,Valor,PERIODO DA FOLHA\n01,7,1.5,202401\n", encoding="utf-8")
    (tmp_path / "2024-02-01.csv").write_text("CPF,Extra,Filial,PERIODO DA FOLHA,Valor\r\n8,x,02,202402,2.5\r\n\r\n", encoding="utf-8")
    (tmp_path / "2024-03-01.csv").write_text('Valor,Filial,Descrição Verba\n3.5,03,"a, b"\n', encoding="utf-8")
    (tmp_path / "2024-04-01.csv").write_text("nothing,known\n1,2\n", encoding="utf-8")
    rows = files.read_payroll_files(spark, str(tmp_path))
    got = {r.file_name: (r.Filial, r.CPF, r.Valor, r["PERIODO DA FOLHA"], r["Descrição Verba"]) for r in rows.collect()}
    assert got == {
        "2024-01-01.csv": ("01", "7", "1.5", "202401", None),
        "2024-02-01.csv": ("02", "8", "2.5", "202402", None),
        "2024-03-01.csv": ("03", None, "3.5", None, "a, b"),
        "2024-04-01.csv": (None, None, None, None, None),
    }
    good, bad = payroll.ingest_payroll(payroll.new_files(rows, None, extension=".csv"), TARGET)
    assert [(r.file_name, r.rows, r.bad_rows) for r in bad.collect()] == [("2024-04-01.csv", 1, 1)]
    assert good.count() == 3


def test_stream_payroll(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    head = ",".join(payroll.PAYROLL_COLUMNS)

    def deliver(name, period, value="10.5"):
        line = ",".join({"CPF": "7", "Valor": value, "PERIODO DA FOLHA": period}.get(c, "") for c in payroll.PAYROLL_COLUMNS)
        (source / name).write_text(f"{head}\n{line}\n", encoding="utf-8")

    def run():
        stream = jobs.read_payroll_stream(spark, str(source))
        jobs.stream_payroll(stream, TARGET, f"{out}/table", f"{out}/rejects", f"{out}/checkpoint").awaitTermination()
        return sorted(str(r.data_referencia) for r in spark.read.schema(TARGET).parquet(f"{out}/table").collect())

    deliver("2024-01-01.csv", "202401")
    deliver("notes.csv", "202401")
    assert run() == ["2024-01-01"]
    deliver("2024-02-01.csv", "202402")
    deliver("2024-03-01.csv", "202403", "ten")
    assert run() == ["2024-01-01", "2024-02-01"]
    assert [r.file_name for r in spark.read.parquet(f"{out}/rejects").collect()] == ["2024-03-01.csv"]
    assert files.read_payroll_files(spark, str(source)).select("file_name").distinct().count() == 4


def test_run_folder_follows_the_cluster():
    conf = SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": "hdfs://shared/dir/"}.get(key, default))
    assert run_folder(SimpleNamespace(conf=conf), "x").startswith("hdfs://shared/dir/x-")


@pytest.mark.parametrize("where, master, fails", [("file:/tmp/w", "yarn", True), ("file:/tmp/w", "local[4]", False), ("hdfs://n/w", "yarn", False)])
def test_a_local_warehouse_is_no_shared_folder(where, master, fails):
    conf = SimpleNamespace(get=lambda key, default=None: {"spark.sql.warehouse.dir": where}.get(key, default))
    session = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))
    if fails:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            run_folder(session, "x")
    else:
        assert run_folder(session, "x").startswith(f"{where}/runs/x-")


def test_duplicates_of_whole_rows(spark):
    assert all_duplicates(spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "x string, y int"), ["x", "y"]).count() == 2


def test_only_new_sheets_are_opened(spark, tmp_path):
    for month in ("2024-01-01", "2024-02-01", "2024-03-01"):
        (tmp_path / f"{month}.csv").write_text(f"CPF,Valor\n{month},1\n")
    (tmp_path / "notes.csv").write_text("CPF\nx\n")
    # A sheet that Spark exported: a folder with the name of the sheet.
    spark.createDataFrame([("a", "2")], "CPF string, Valor string").coalesce(1).write.option("header", "true").csv(str(tmp_path / "file_name=2024-04-01.csv"))
    mark = F.lit("2024-01-15").cast("date")
    found = files.new_sheets(spark, str(tmp_path), mark, ".csv")
    assert sorted(r.file_name for r in found.collect()) == ["2024-02-01.csv", "2024-03-01.csv", "2024-04-01.csv"]
    rows = files.read_new_payroll_files(spark, str(tmp_path), mark, ".csv")
    opened = {f.split("/")[-1].split("-0")[0] + f.split("/")[-2] if "part-" in f else f.split("/")[-1] for f in rows.inputFiles()}
    assert {o for o in opened if not o.startswith("part")} == {"2024-02-01.csv", "2024-03-01.csv"} and len(opened) == 3
    assert sorted((r.file_name, r.CPF) for r in rows.collect()) == [("2024-02-01.csv", "2024-02-01"), ("2024-03-01.csv", "2024-03-01"), ("2024-04-01.csv", "a")]
    late = files.read_new_payroll_files(spark, str(tmp_path), F.lit("2030-01-01").cast("date"), ".csv")
    assert late.count() == 0 and "CPF" in late.columns


def test_quoted_line_ends(spark, tmp_path):
    (tmp_path / "2024-01-01.csv").write_text('CPF,"Descrição Verba",Valor\r\n7,"two\nlines, one value",1.5\r\n\r\n8,plain,2.5\r\n', encoding="utf-8")
    got = files.read_payroll_files(spark, str(tmp_path)).select("CPF", "Descrição Verba", "Valor").collect()
    assert sorted(tuple(r) for r in got) == [("7", "two\nlines, one value", "1.5"), ("8", "plain", "2.5")]


def test_names_of_sheets(spark):
    paths = ["file:/a/b=c/2024-01-01.csv", "/in/file_name=2024-04-01.csv/part-0-x.csv", "/in/2024-05-01.xlsx/part-1", "/in/plain/part-1", "part-1.csv", "2024.csv", "/in/a=b=2024-06-01.csv/part-2", "", None]
    got = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, path string").select("i", files.sheet_name(F.col("path")).alias("n")).collect()
    assert [r.n for r in sorted(got)] == ["2024-01-01.csv", "2024-04-01.csv", "2024-05-01.xlsx", "part-1", "part-1.csv", "2024.csv", "2024-06-01.csv", "", None]


def test_names_and_places_are_worked_out_once_a_file(spark, tmp_path):
    for month in ("2024-01-01", "2024-02-01"):
        (tmp_path / f"{month}.csv").write_text("CPF,Valor\n" + "7,1\n" * 50)
    rows = payroll.new_files(files.read_payroll_files(spark, str(tmp_path)), None, extension=".csv")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Aggregate") :]  # the side of the headings
    assert "substring_index" not in below.split("Aggregate", 1)[1].split("\n", 1)[1] and "regexp_extract(_metadata" not in plan
    above = plan[: plan.index("Join")]
    assert "array_position" not in above and "substring_index" not in above and "part-" not in above
    assert rows.count() == 100


def test_payroll_batches_survive_a_stop(spark, tmp_path, monkeypatch):
    """A file a batch; the job is stopped once after a batch wrote its rows and before it was committed."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    head = ",".join(payroll.PAYROLL_COLUMNS)
    for month in range(1, 7):
        value = "ten" if month == 4 else str(month)
        line = ",".join({"CPF": "7", "Valor": value, "PERIODO DA FOLHA": f"2024{month:02}"}.get(c, "") for c in payroll.PAYROLL_COLUMNS)
        (source / f"2024-{month:02}-01.csv").write_text(f"{head}\n{line}\n", encoding="utf-8")
    real, stops = jobs.write_batch, []

    def stopping(df, path, batch_id):
        real(df, path, batch_id)
        if path.endswith("quarantine") and batch_id == 2 and not stops:
            stops.append(batch_id)
            raise RuntimeError("stopped")

    monkeypatch.setattr(jobs, "write_batch", stopping)

    def run():
        stream = jobs.read_payroll_stream(spark, str(source), files=1)
        query = jobs.stream_payroll(stream, TARGET, f"{out}/table", f"{out}/rejects", f"{out}/checkpoint", quarantine=f"{out}/quarantine")
        query.awaitTermination()
        return len(query.recentProgress)

    with pytest.raises(Exception, match="stopped"):
        run()
    assert run() >= 4 and stops == [2]
    loaded = spark.read.schema(TARGET).parquet(f"{out}/table").collect()
    assert sorted(r.data_referencia.month for r in loaded) == [1, 2, 3, 5, 6]
    assert [r.file_name for r in spark.read.parquet(f"{out}/rejects").collect()] == ["2024-04-01.csv"]
    aside = spark.read.schema("value string, path string").parquet(f"{out}/quarantine").collect()
    assert len(aside) == 2 and all(r.path.endswith("2024-04-01.csv") for r in aside)


def deliver(source, name, clockings):
    """A delivery; deliveries are a second apart by their names, as the stream takes them by time."""
    (source / name).write_text(json.dumps(clockings))
    os.utime(source / name, (1_700_000_000 + ord(name[0]),) * 2)


def at(i, day, hour=8, month=3):
    return clocking(i, f"{day:02}{month:02}2024{hour:02}0000")


def test_late_punches_are_loaded_once(spark, tmp_path):
    """Four deliveries: on time, repeated, so late that the state has forgotten the day, and the late ones again."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    deliver(source, "a.json", [at(i, i) for i in range(1, 11)] + [clocking(90, "none")])
    query = None

    def run():
        stream = jobs.read_clocking_stream(spark, str(source), files=1)
        query = jobs.stream_clockings(stream, f"{out}/table", f"{out}/rejects", f"{out}/checkpoint", delay="2 days")
        query.awaitTermination()
        rows = spark.read.parquet(f"{out}/table").collect()
        assert len({r.id for r in rows}) == len(rows)
        return {int(r.nsr): r.late for r in rows}, jobs.state_rows(query)

    got, state = run()
    # All days count as on time in the first delivery; the state then keeps those of the last days only.
    assert got == {i: False for i in range(1, 11)} and min(state) < 10
    deliver(source, "b.json", [at(i, i) for i in (9, 10)] + [at(11, 11), clocking(90, "none"), clocking(91, "none")])
    got, _ = run()
    assert got == {i: False for i in range(1, 12)}
    # Day 2 is over for the state: one punch comes again, one for the first time.
    deliver(source, "c.json", [at(2, 2), at(40, 2, 9), at(40, 2, 9), at(20, 20), at(90, 20)])
    got, _ = run()
    assert got == {**{i: False for i in range(1, 12)}, 40: True, 20: False, 90: False}
    deliver(source, "d.json", [at(40, 2, 9), at(41, 1), at(20, 20), at(30, 30)])
    got, state = run()
    assert got == {**{i: False for i in range(1, 12)}, 40: True, 20: False, 90: False, 41: True, 30: False}
    assert state[-1] <= 2 and {int(r.nsr) for r in spark.read.parquet(f"{out}/rejects").collect()} == {90, 91}


def test_punch_batches_survive_a_stop(spark, tmp_path, monkeypatch):
    """The job is stopped after a batch wrote its punches and before it was committed; late punches and rejects are not lost or doubled."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for n, rows in enumerate(([at(1, 1), at(2, 20)], [at(3, 1), at(3, 1), clocking(9, "none"), at(2, 20)], [at(4, 21), at(3, 1), at(5, 2)])):
        deliver(source, f"{n}.json", rows)
    real, stops = jobs.write_batch, []

    def stopping(df, path, batch_id):
        real(df, path, batch_id)
        if len(stops) < 3 and batch_id == len(stops):
            stops.append(path)
            raise RuntimeError("stopped")

    monkeypatch.setattr(jobs, "write_batch", stopping)

    def run():
        stream = jobs.read_clocking_stream(spark, str(source), files=1)
        jobs.stream_clockings(stream, f"{out}/table", f"{out}/rejects", f"{out}/checkpoint", delay="2 days").awaitTermination()

    for _ in range(3):
        with pytest.raises(Exception, match="stopped"):
            run()
    run()
    rows = spark.read.parquet(f"{out}/table").collect()
    # The stream tells late from on time by the punches of the batch before the last one.
    assert sorted((int(r.nsr), r.late) for r in rows) == [(1, False), (2, False), (3, False), (4, False), (5, True)]
    assert [int(r.nsr) for r in spark.read.parquet(f"{out}/rejects").collect()] == [9]


def test_windows_of_days_over_batches(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    emp = spark.createDataFrame([("A", 5)], "status string, pis long")
    loaded = spark.createDataFrame([("3.0",)], "id string")

    def run():
        stream = jobs.read_clocking_stream(spark, str(source), files=1)
        query = jobs.stream_pending_by_day(stream, emp, loaded, f"{out}/table", f"{out}/checkpoint", delay="2 days")
        query.awaitTermination()
        return {int(r.date[6:]): r.punches for r in jobs.pending_days(spark, f"{out}/table").collect()}, jobs.state_rows(query)

    deliver(source, "a.json", [at(i, 1 + i % 2) for i in range(1, 7)])
    assert run()[0] == {1: 3, 2: 2}
    # The same day in a later batch adds to its window; a repeated id does not.
    deliver(source, "b.json", [at(7, 2), at(1, 2), at(8, 3)])
    assert run()[0] == {1: 3, 2: 3, 3: 1}
    deliver(source, "c.json", [at(9, 25), at(10, 25)])
    deliver(source, "d.json", [at(11, 1), at(12, 1), at(11, 1), at(13, 24)])
    got, state = run()
    assert got == {1: 5, 2: 3, 3: 1, 24: 1, 25: 2}
    assert state[-1] <= 2


def test_a_delivery_of_many_files_is_one_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(roles, "FILE_PUNCHES", 20)
    rows = [(i, dt.datetime(2024, 1, 1 + i % 28, 8, i % 60), i % 50, "click") for i in range(1, 2001)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    arriving = roles.deliver_punches(spark, str(tmp_path), str(tmp_path / "deliveries"))
    counts = [len(list((tmp_path / f"deliveries/delivery={n}").glob("part-*"))) for n in range(5)]
    assert len(set(counts)) == 1 and counts[0] > 1
    batches = []
    query = arriving.writeStream.foreachBatch(lambda df, _: batches.append(df.count())).option("checkpointLocation", str(tmp_path / "c"))
    query.trigger(availableNow=True).start().awaitTermination()
    wanted = [spark.createDataFrame(rows, "id long, at timestamp_ntz, pis long, device string").filter(p).count() for p in roles.DELIVERIES]
    assert batches == wanted


def test_jdbc_predicates_deal_each_row_once():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT CASE WHEN i % 10 = 0 THEN NULL WHEN i % 3 = 0 THEN 7 ELSE i * i END AS n, 'it''s ' || (i % 17) AS s, DATE '2024-01-01' + CAST(i // 9 AS INTEGER) AS d FROM range(500) r(i)")
    for column in ("n", "s", "d"):
        edges = [r[0] for r in con.sql(erp.edges_query("t", column, 8)).fetchall()]
        predicates = erp.range_predicates(column, edges)
        counts = [con.sql(f"SELECT count(*) FROM t WHERE {p}").fetchall()[0][0] for p in predicates]
        assert sum(counts) == 500 and 3 < len(predicates) <= 8
        assert con.sql(f"SELECT count(*) FROM t WHERE {' AND '.join(f'NOT coalesce({p}, false)' for p in predicates)}").fetchall()[0][0] == 0
        # Half of the values differ by far, one holds a third of the rows: no other share is much larger than an eighth.
        assert sorted(counts)[-2] <= 130
    assert erp.range_predicates("n", []) == erp.range_predicates("n", [5]) == ["1 = 1"]
    with pytest.raises(TypeError):
        erp.sql_literal(True)
