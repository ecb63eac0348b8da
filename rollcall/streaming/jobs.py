"""Incremental loads as streams: punches, payroll files and pending counts.

All run with ``availableNow``: they take what has arrived since the checkpoint, batch by batch, and stop. Every batch writes into a folder of
its own number and replaces it when it runs again, so a run after a failure adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rollcall.operators.payroll import ingest_payroll, new_files
from rollcall.operators.relational import anti_load, keep_first, known
from rollcall.operators.timeclock import active_pis, import_rows, loaded_ids
from rollcall.sinks.versions import read_or_none
from rollcall.sources.files import CLOCKING_SCHEMA, PAYROLL_HEADINGS, sheet_files, sheet_rows
from rollcall.streaming.folders import written_once

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How long after the latest punch an earlier one still counts as on time; ids are kept in the state that long.
DELAY = "3 days"
DATE = "yyyyMMdd"


def read_clocking_stream(spark: SparkSession, path: str, files: int = 1000) -> DataFrame:
    """New punch JSON files, at most ``files`` in a batch; every field is text."""
    return spark.readStream.schema(CLOCKING_SCHEMA).option("multiLine", "true").option("maxFilesPerTrigger", files).json(path)


def read_payroll_stream(spark: SparkSession, path: str, files: int = 100) -> DataFrame:
    """New payroll CSV files, at most ``files`` in a batch, by name; ``stream_payroll`` reads them by heading."""
    kind = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(kind).option("recursiveFileLookup", "true")
    return sheet_files(reader.option("maxFilesPerTrigger", files).load(path))


def started(rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Start a stream whose state, if it has any, is kept on disk."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.outputMode(mode).trigger(availableNow=True).start()


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write what a batch adds, in place of what an earlier run of the same batch wrote."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def other_batches(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """What the other batches wrote."""
    held = read_or_none(spark, path, f"{schema}, batch int")
    return spark.createDataFrame([], schema) if held is None else held.filter(F.col("batch") != batch_id).drop("batch")


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows in the state after each of the latest batches of a stream, all operators together."""
    return [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress]


ON_TIME, EVERY = "on time", "every"


def with_punch_time(rows: DataFrame) -> DataFrame:
    """Import rows with ``punched``, their local date and time; NULL where the date cannot be read."""
    day = F.try_to_timestamp("date", F.lit(DATE))
    return rows.withColumn("punched", day + F.make_dt_interval(secs=F.col("seconds").cast("decimal(18,6)")))


def stream_clockings(
    clockings: DataFrame, sink: str, rejects: str, checkpoint: str, keep_date: bool = False, delay: str = DELAY
) -> StreamingQuery:
    """Load each punch id once, whatever date a later delivery gives it.

    Ids that are on time, at most ``delay`` before the latest punch seen, are told apart in a state that forgets them after that time. Punches
    that the state lets pass, and those that come too late for it, are compared with the ids of the table, so none is lost and none loaded
    twice; ``late`` marks the second kind. A punch with an unreadable date goes to ``rejects``, once, and its id can still be loaded with a
    date that is readable. Of two deliveries of an id with different dates in the same batch, either may be the first.
    """
    rows = with_punch_time(import_rows(clockings, keep_date))
    dated = rows.filter("punched IS NOT NULL").withWatermark("punched", delay)
    once = dated.dropDuplicatesWithinWatermark(["id"]).withColumn("way", F.lit(ON_TIME))
    both = once.unionByName(rows.withColumn("way", F.lit(EVERY)))

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # The files of the two ways differ in size by far: read together, the large ones would all go to one task.
        with written_once(batch, by=["way"]) as batch:
            every = batch.filter(F.col("way") == EVERY).drop("way")
            passed = batch.filter(F.col("way") == ON_TIME).drop("way").withColumn("late", F.lit(False))
            rest = keep_first(every.filter("punched IS NOT NULL"), ["id"], ["punched"]).withColumn("late", F.lit(True))
            found = passed.unionByName(anti_load(rest, passed, ["id"]))
            write_batch(anti_load(found, other_batches(spark, sink, batch_id, "id string"), ["id"]), sink, batch_id)
            bad = keep_first(every.filter("punched IS NULL"), ["id"], ["nsr"])
            write_batch(anti_load(bad, other_batches(spark, rejects, batch_id, "id string"), ["id"]), rejects, batch_id)

    return started(both, load, checkpoint)


def stream_payroll(
    rows: DataFrame, target: T.StructType, sink: str, rejects: str, checkpoint: str, extension: str = ".csv", quarantine: str | None = None
) -> StreamingQuery:
    """Load payroll files once each; the checkpoint takes the place of a date watermark.

    ``rows`` are new files (``path``), which are read by the heading of each, or rows with a ``file_name``. A file that cannot be loaded is
    reported in ``rejects``, and with ``quarantine`` its lines are set aside there, to be mended and delivered again. Of a sheet that is a
    folder of files, those that come in one batch are judged together.
    """
    by_path = "path" in rows.columns

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if by_path:
            # As many paths as a batch has files.
            files = new_files(batch, None, extension=extension).select("path", "file_name").collect()
            batch = sheet_rows(spark, [r["path"] for r in files], PAYROLL_HEADINGS)
        # Sheets are parsed once, whatever reads their rows.
        with written_once(new_files(batch, None, extension=extension)) as rows:
            good, bad = ingest_payroll(rows, target)
            write_batch(good, sink, batch_id)
            write_batch(bad, rejects, batch_id)
        if quarantine and by_path:
            names = {r["file_name"] for r in spark.read.parquet(f"{rejects}/batch={batch_id}").select("file_name").collect()}
            aside = [r["path"] for r in files if r["file_name"] in names]
            lines = spark.read.text(aside) if aside else spark.createDataFrame([], "value string")
            where = F.col("_metadata.file_path") if aside else F.lit(None).cast("string")
            write_batch(lines.select("value", where.alias("path")), quarantine, batch_id)

    return started(rows, load, checkpoint)


def stream_pending_by_day(
    clockings: DataFrame, emp: DataFrame, loaded: DataFrame, sink: str, checkpoint: str, keep_date: bool = False, delay: str = DELAY
) -> StreamingQuery:
    """Number of pending punches per day: of active employees, not loaded yet, each id once.

    ``stream_clockings`` first loads each id once into ``punches`` below the sink. Punches that were on time are then counted in windows of a
    day, whose counts stay in the state until the day is ``delay`` behind; those that came late are counted beside them, batch by batch.
    ``pending_days`` puts both together.
    """
    spark = clockings.sparkSession
    punches = f"{sink}/punches"
    stream_clockings(clockings, punches, f"{sink}/rejects", f"{checkpoint}/punches", keep_date, delay).awaitTermination()
    kind = "id string, pis string, date string, punched timestamp, late boolean, batch int"
    arrived = spark.readStream.schema(kind).parquet(punches)
    rows = anti_load(known(arrived, active_pis(emp), ["pis"]), loaded_ids(loaded), ["id"])
    # The watermark here is never ahead of the one that told on time from late.
    window = rows.filter("NOT late").withWatermark("punched", delay).groupBy(F.window("punched", "1 day").alias("day"))
    counted = window.agg(F.count(F.lit(1)).alias("punches"))
    on_time = counted.select(F.date_format("day.start", DATE).alias("date"), "punches", F.lit(False).alias("late"))
    late = rows.filter("late").select("date", F.lit(1).cast("long").alias("punches"), F.lit(True).alias("late"))

    def count(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.groupBy("date", "late").agg(F.sum("punches").alias("punches")), f"{sink}/days", batch_id)

    return started(on_time.unionByName(late), count, f"{checkpoint}/days", "update")


def pending_days(spark: SparkSession, sink: str) -> DataFrame:
    """Pending punches per day over all batches: the latest count of its window, and all punches that came late."""
    days = spark.read.schema("date string, late boolean, punches long, batch int").parquet(f"{sink}/days")
    on_time = days.filter("NOT late").groupBy("date").agg(F.max_by("punches", "batch").alias("punches"))
    late = days.filter("late").groupBy("date").agg(F.sum("punches").alias("punches"))
    return on_time.unionByName(late).groupBy("date").agg(F.sum("punches").alias("punches"))
