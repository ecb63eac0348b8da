"""File sources, each with an explicit schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators.payroll import PAYROLL_COLUMNS, new_files
from rollcall.operators.timeclock import CLOCKING_FIELDS

CLOCKING_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CLOCKING_FIELDS])
PAYROLL_HEADINGS = list(PAYROLL_COLUMNS)


def sheet_name(path: Column) -> Column:
    """The name of the sheet that a file belongs to: the folder's, where Spark exported the sheet as a folder, else the file's own."""
    # A pattern that looks for its start all along a path costs more than reading a line of the file.
    name, parent = F.substring_index(path, "/", -1), F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    folder = F.when(name.startswith("part-") & path.contains("/"), F.regexp_extract(parent, r"([^=]+\.\w+)$", 1)).otherwise("")
    return F.when(folder != "", folder).otherwise(name)


def sheet_files(files: DataFrame) -> DataFrame:
    """Files with the name of their sheet, from a listing (``path``) or a stream of one. No content is read."""
    return files.select("path", sheet_name(F.col("path")).alias("file_name"), "length", "modificationTime")


def list_sheets(spark: SparkSession, path: str) -> DataFrame:
    """The files below a folder, one row each. Spark reads their names, lengths and times only."""
    return sheet_files(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path))


def new_sheets(spark: SparkSession, path: str, watermark: Column | None = None, extension: str = ".xlsx") -> DataFrame:
    """The files below a folder that ``new_files`` takes: found by their names, before any of them is opened."""
    return new_files(list_sheets(spark, path), watermark, extension=extension)


def sheet_rows(spark: SparkSession, paths: list[str], headings: list[str], separator: str = ",") -> DataFrame:
    """Rows of sheets exported as CSV, each file read by its own heading line: the named columns as text, and ``file_name``.

    A heading that a file lacks is NULL in its rows, one that is not asked for is left out, and their order does not count. Quoted values may
    hold line ends. A file with none of the headings gives rows of NULL only, which ``ingest_payroll`` reports. Empty lines are no rows.
    """
    if not paths:
        return spark.createDataFrame([], ", ".join(f"`{h}` string" for h in [*headings, "file_name"]))
    reader = spark.read.option("recursiveFileLookup", "true")
    # As many columns as the widest heading has; quoted separators only make the count too high.
    lines = reader.text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start").filter("file_block_start = 0")
    firsts = lines.withColumn("_at", F.monotonically_increasing_id()).groupBy("file_path").agg(F.min(F.struct("_at", "value")).alias("_first"))
    width = firsts.agg(F.max(F.size(F.split("_first.value", f"[{separator}]")))).first()[0] or 1
    cells = reader.schema(", ".join(f"c{i} string" for i in range(width))).option("multiLine", "true").option("sep", separator).csv(paths)
    trimmed = F.array(*[F.trim(F.regexp_replace(f"c{i}", "\r$", "")) for i in range(width)])
    # A file is read by one task, its rows in order.
    placed = cells.select(F.col("_metadata.file_path").alias("_path"), trimmed.alias("_cells")).withColumn("_at", F.monotonically_increasing_id())
    # The path is taken from the first row, as a filter on the name would otherwise be worked out for each row below.
    first = placed.groupBy("_path").agg(F.min(F.struct("_at", "_cells", F.col("_path").alias("_of"))).alias("_first"))
    # What a file's name and headings say is worked out once a file: the place of each heading, -1 where it is missing.
    places = F.array(*[F.coalesce(F.array_position("_first._cells", h), F.lit(0)).cast("int") - 1 for h in headings])
    first = first.select("_path", F.col("_first._at").alias("_heading_at"), places.alias("_places"), sheet_name(F.col("_first._of")).alias("file_name"))
    rows = placed.join(first, "_path").filter("_at <> _heading_at")
    named = [F.get("_cells", F.get("_places", F.lit(i))).alias(h) for i, h in enumerate(headings)]
    return rows.select(*named, "file_name")


def read_dim(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A dimension sheet exported as CSV: ``columns`` names the column for each heading. All are text without outer blanks."""
    sheet = sheet_rows(spark, [path], list(columns))
    return sheet.select(*[F.col(f"`{heading}`").alias(name) for heading, name in columns.items()])


def read_clockings(spark: SparkSession, path: str) -> DataFrame:
    """Punches delivered as JSON arrays, one file per day and tenant; every field is text."""
    return spark.read.schema(CLOCKING_SCHEMA).option("multiLine", "true").json(path)


def parse_clockings(df: DataFrame, column: str = "payload") -> DataFrame:
    """Punches held as a JSON array in a text column, one row each."""
    rows = F.from_json(F.col(column), T.ArrayType(CLOCKING_SCHEMA))
    return df.select(F.explode(rows).alias("c")).select("c.*")


def read_afd_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of AFD files; they end with CR LF."""
    lines = spark.read.text(path)
    return lines.select(F.regexp_replace("value", "\r$", "").alias("value"))


def split_records(df: DataFrame, column: str = "value") -> DataFrame:
    """Records delivered as one CR LF separated text, one row each; the other columns stay."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(F.split(F.col(column), "\r\n")).alias(column))


def read_payroll_files(spark: SparkSession, path: str) -> DataFrame:
    """Payroll sheets exported as CSV, each read by its headings, with the name of their file."""
    return sheet_rows(spark, [path], PAYROLL_HEADINGS)


def read_new_payroll_files(spark: SparkSession, path: str, watermark: Column | None = None, extension: str = ".xlsx") -> DataFrame:
    """Rows of the payroll sheets that are new; older files and those with other names are not opened.

    The paths of the new files are read first, as the reader needs them: a text for each new file.
    """
    paths = [r["path"] for r in new_sheets(spark, path, watermark, extension).select("path").collect()]
    return new_files(sheet_rows(spark, paths, PAYROLL_HEADINGS), None, extension=extension)


def read_receipt_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page texts ``(doc, page, text)``, pages without text left out."""
    schema = "doc string, page int, text string"
    return spark.read.schema(schema).parquet(path).filter("text IS NOT NULL AND text <> ''")
