"""Queries on payroll files, receipts and consents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.text import count_char, joined
from rollcall.operators import consent, payroll, receipts
from rollcall.operators.relational import all_duplicates, as_strings, keep_first, keep_last
from rollcall.plans import roles
from rollcall.plans.report import report
from rollcall.sources.files import new_sheets as new_sheet_files
from rollcall.sources.files import read_new_payroll_files
from rollcall.streaming.folders import run_folder, staged
from rollcall.streaming.jobs import read_payroll_stream
from rollcall.streaming.jobs import stream_payroll as payroll_stream

WATERMARK = "1998-07-01"
TARGET = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("matricula", "filial", "cpf", "status", "descricao_verba", "funcao")]
    + [T.StructField("valor", T.DoubleType()), T.StructField("data_referencia", T.DateType())]
)


def sheets(spark: SparkSession, folder: str) -> DataFrame:
    return roles.payroll_rows(roles.table(spark, folder, "orders"))


def held(spark: SparkSession, folder: str) -> DataFrame:
    """Payroll rows loaded up to the watermark."""
    dated = sheets(spark, folder).withColumn("file_date", payroll.file_date(F.col("file_name")))
    return dated.filter(F.col("file_date") <= F.to_date(F.lit(WATERMARK)))


def high_water_mark(spark: SparkSession, folder: str) -> DataFrame:
    return report(payroll.high_water_mark(held(spark, folder), "file_date"))


def delivered(spark: SparkSession, folder: str) -> str:
    """The sheets as files: a folder of CSV for each name, as Spark exports them."""
    path = run_folder(spark, "sheets")
    sheets(spark, folder).repartition("file_name").write.partitionBy("file_name").option("header", "true").csv(path)
    return path


def mark(spark: SparkSession, folder: str):
    return payroll.high_water_mark(held(spark, folder), "file_date").scalar()


def fresh(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the sheets that are newer than the mark; the others are not opened."""
    return read_new_payroll_files(spark, delivered(spark, folder), mark(spark, folder))


def new_files(spark: SparkSession, folder: str) -> DataFrame:
    return report(fresh(spark, folder).groupBy("file_name", "file_date").agg(F.count(F.lit(1)).alias("rows")))


def new_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """The names of the new sheets, found without opening one."""
    found = new_sheet_files(spark, delivered(spark, folder), mark(spark, folder))
    return report(found.select("file_name", "file_date").distinct())


def payroll_ingest(spark: SparkSession, folder: str) -> DataFrame:
    good, _ = payroll.ingest_payroll(staged(fresh(spark, folder), "payroll"), TARGET)
    return report(good)


def payroll_rejects(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = payroll.ingest_payroll(staged(fresh(spark, folder), "payroll"), TARGET)
    return report(bad)


def stream_payroll(spark: SparkSession, folder: str) -> DataFrame:
    """The sheets as a stream of files, in batches of 32 files."""
    out = run_folder(spark, "payroll")
    arriving = read_payroll_stream(spark, delivered(spark, folder), files=32)
    query = payroll_stream(
        arriving, TARGET, f"{out}/table", f"{out}/rejects", f"{out}/checkpoint", ".xlsx", f"{out}/quarantine"
    )
    query.awaitTermination()
    loaded = spark.read.schema(TARGET).parquet(f"{out}/table")
    return report(
        loaded.groupBy("data_referencia").agg(F.count(F.lit(1)).alias("rows"), F.count("cpf").alias("with_cpf"))
    )


def all_text(spark: SparkSession, folder: str) -> DataFrame:
    return report(as_strings(roles.table(spark, folder, "part")))


def receipt_extract(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = receipts.extract_receipts(roles.receipt_texts(spark, folder), roles.known_receipts(spark, folder))
    return report(found)


def receipt_rejects(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = receipts.extract_receipts(roles.receipt_texts(spark, folder), roles.known_receipts(spark, folder))
    return report(bad)


def text_markers(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    rows = roles.table(spark, folder, "documents").filter(text.rlike("[0-9]{3}") & ~text.contains("|"))
    return report(
        rows.select(
            "doc_id",
            F.length(text).alias("length"),
            count_char(text, ".").alias("sentences"),
            joined(F.array("lang", "source")).alias("origin"),
        )
    )


def consent_frames(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    emp = (
        roles.employees(spark, folder)
        .join(roles.cost_centres(spark, folder), ["branch", "cost_centre"])
        .join(roles.departments(spark, folder).select("dept", "dept_desc").distinct(), "dept")
    )
    return roles.consent_requests(spark, folder), emp, roles.known_consents(spark, folder)


def consent_register(spark: SparkSession, folder: str) -> DataFrame:
    return report(consent.register_consents(*consent_frames(spark, folder)))


def consent_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return report(consent.rejected_requests(*consent_frames(spark, folder)))


def first_order(spark: SparkSession, folder: str) -> DataFrame:
    rows = roles.table(spark, folder, "orders").select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderkey")
    return report(keep_first(rows, ["o_custkey", "o_orderstatus"], ["o_totalprice", "o_orderkey"]))


def last_order(spark: SparkSession, folder: str) -> DataFrame:
    rows = roles.table(spark, folder, "orders").select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderkey")
    return report(keep_last(rows, ["o_custkey", "o_orderstatus"], ["o_totalprice", "o_orderkey"]))


def repeated_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose whole text occurs more than once; the texts meet as digests, so none is shuffled."""
    digest = F.sha2("text", 256).alias("digest")
    rows = roles.table(spark, folder, "documents").select("doc_id", digest, "source")
    return report(all_duplicates(rows, ["digest"]).drop("digest"))
