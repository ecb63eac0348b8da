"""A seeded shuffle of records into shards: two passes, as a shuffle that does not fit in memory takes.

The first pass scatters records uniformly into buckets that fit in memory, by a seeded hash of the whole record. The second gathers each
bucket, shuffles it by Fisher and Yates (the method of Spark's ``shuffle``) and writes it to its place in the shards. All of it is
DataFrame operations. The place of a bucket is known before any record is moved, from the counts of the record hashes alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import new_folder, prepare, staged

#: Bytes of a bucket on average, buckets that a task takes, and the bytes that a row counts besides its text.
BUCKET_BYTES, BUCKETS_A_TASK, ROW_BYTES = 8 << 20, 2, 64
#: Buckets whose sizes are added up at once.
BLOCK = 4096
#: Copies of one record that are dealt one by one after their block was dealt.
COPIES = 4096


def whole(value: Column, by: int) -> Column:
    """A whole number divided by another, rounded down."""
    return F.call_function("div", value.cast("long"), F.lit(by).cast("long"))


def record_hashes(columns: list[str], seed: int) -> dict[str, Column]:
    """Two hashes of a record, 128 bits together; Spark's hash passes over nulls, so these are hashed as well."""
    nulls = [F.col(c).isNull() for c in columns]
    return {"__number": F.xxhash64(F.lit(seed), *columns, *nulls), "__other": F.xxhash64(F.lit(~seed), *nulls, *columns[::-1])}


def bucket_of(seed: int, number: Column, copy: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), number, copy), F.lit(buckets))


def unfolded(rows: DataFrame, times: Column, into: str) -> DataFrame:
    """Each row ``times`` times, numbered by ``into`` from 0. Blocks of copies are dealt out first, so that no task makes all copies of a
    record."""
    blocks = rows.withColumns({"__times": times, "__block": F.explode(F.sequence(F.lit(0).cast("long"), whole(times - 1, COPIES)))})
    dealt = blocks.repartition("__number", "__block")
    first = F.col("__block") * COPIES
    last = F.least(first + COPIES, F.col("__times")) - 1
    return dealt.withColumn(into, F.explode(F.sequence(first, last))).drop("__times", "__block")


def bucket_starts(sizes: DataFrame) -> DataFrame:
    """The number of records before each bucket; buckets are added up block by block, and blocks in turn."""
    blocks = sizes.withColumn("__block", whole(F.col("__bucket"), BLOCK))
    totals = blocks.groupBy("__block").agg(F.sum("__n").alias("__n"))
    earlier = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("__block", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__block").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("__inside", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    return starts.join(totals, "__block").select(F.col("__bucket").alias("__of"), (F.col("__base") + F.col("__inside")).alias("__before"))


def write_shards(
    docs: DataFrame, shards: int = 16, seed: int = 7, text_col: str = "text", bucket_bytes: int = BUCKET_BYTES, path: str | None = None
) -> str:
    """Write all rows of ``docs`` in random order to ``shards`` shards and return the folder, below ``spark.checkpoint.dir`` by default.

    The folder has one subfolder ``shard=N`` of Parquet files for each shard that has rows. ``slot`` numbers the rows of a shard from 0
    without gaps in the shuffled order, and each file is in that order. The numbers of rows of two shards differ by one at most. The same
    rows and seed give the same buckets; the order inside a bucket also depends on the number of tasks.

    Every row is one record: repeated rows stay apart and are spread like others, however many there are. Null ids, null, empty and very
    long texts are records like others; a text longer than a bucket makes its bucket as large as the text. Columns may have any type
    that Spark can group by; columns named ``shard`` or ``slot`` are replaced. An empty table makes a folder without rows.
    """
    spark = prepare(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    held = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    own, text = held.columns, f"c{names.index(text_col)}"
    record, both = record_hashes(own, seed), ["__number", "__other"]
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES

    narrow = held.select(*[c.alias(name) for name, c in record.items()], size.alias("__size"))
    counted = staged(narrow.groupBy(*both).agg(F.count(F.lit(1)).alias("__n"), F.max("__size").alias("__size")))
    rows, total = counted.agg(F.sum("__n"), F.sum(F.col("__n") * F.col("__size"))).first()
    buckets = int(-(-(total or 1) // bucket_bytes))
    tasks = -(-buckets // BUCKETS_A_TASK)

    # Records with so many copies that one bucket would be full of them are counted instead of moved, and dealt copy by copy.
    hot = (F.col("__n") > 1) & (F.col("__n") * F.col("__size") > bucket_bytes // 4)
    # A table of its own, usually empty: Spark sees its size before it plans the joins, and moves no record for them where it is small.
    common = staged(counted.where(hot))
    numbered = held.withColumns(record)
    single = numbered.join(common, both, "left_anti").withColumn("__copy", F.lit(0).cast("long"))
    copies = numbered.join(common, both, "left_semi").groupBy(*both, *own).agg(F.count(F.lit(1)).alias("__n"))
    copies = unfolded(copies, F.col("__n"), "__copy").drop("__n")
    bucket = bucket_of(seed, F.col("__number"), F.col("__copy"), buckets).alias("__bucket")
    scattered = single.unionByName(copies).select("*", bucket)

    alone = counted.where(~hot).select(F.col("__n"), bucket_of(seed, F.col("__number"), F.lit(0).cast("long"), buckets).alias("__bucket"))
    spread = unfolded(common, F.col("__n"), "__copy").select(F.lit(1).cast("long").alias("__n"), bucket)
    starts = staged(bucket_starts(alone.unionByName(spread).groupBy("__bucket").agg(F.sum("__n").alias("__n"))))

    # Rows of a bucket are put in one order before they are shuffled, and buckets of a task too: a task that runs again does the same.
    content = F.struct("__number", "__copy", *own)
    gathered = scattered.repartition(tasks, "__bucket").groupBy("__bucket").agg(F.array_sort(F.collect_list(content)).alias("__rows"))
    placed = gathered.join(starts, gathered["__bucket"] == starts["__of"]).sortWithinPartitions("__bucket")
    shuffled = placed.withColumn("__rows", F.shuffle("__rows", seed)).select("__before", F.posexplode("__rows").alias("__at", "__row"))
    n = rows or 1
    at = F.col("__before") + F.col("__at")
    # Shard s holds the places from s * n // shards on.
    shard = whole(at * shards + (shards - 1), n)
    out = shuffled.select(
        *[F.col(f"__row.{c}").alias(name) for c, name in zip(own, names)],
        (at - whole(shard * n, shards)).alias("slot"),
        shard.cast("int").alias("shard"),
    )
    path = path or new_folder(spark, "shards")
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path


def read_shards(docs: DataFrame, path: str) -> DataFrame:
    """The rows that ``write_shards`` wrote for ``docs``, with their ``shard`` and ``slot``."""
    fields = [f.simpleString().split(":", 1) for f in docs.schema if f.name not in ("shard", "slot")]
    schema = ", ".join(f"`{name}` {kind}" for name, kind in [*fields, ("slot", "bigint"), ("shard", "int")])
    return docs.sparkSession.read.schema(schema).parquet(path)
