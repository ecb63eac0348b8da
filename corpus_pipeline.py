"""A corpus from raw documents to packed training sequences.

Each stage is one operator of ``rollcall.llm`` whose decision takes effect on the documents that the stage before kept. Stages take and
return the columns of ``documents``; the last returns the places of the documents' pieces in the sequences. Stages decide about rows, which
are told by their id and text together: rows that share an id, or have none, do not share a decision. Nulls, empty texts, ties, repeated
rows and empty tables have the results that the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import prepare, staged, table
from rollcall.llm.decontamination import contaminated
from rollcall.llm.hyperminhash import near_duplicates
from rollcall.llm.labelled import remainder
from rollcall.llm.lines import drop_shared_lines
from rollcall.llm.packing import pack_documents
from rollcall.llm.rules import score_quality, train_quality
from rollcall.llm.tokens import word_tokenizer

#: Documents with a lower quality score go.
LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts; it learns from the labels of the documents at hand, less those held out."""
    prepare(spark)
    model = train_quality(docs, table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0))
    return score_quality(docs, model).where(F.col("score") >= LEAST_QUALITY).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share; ``n_chars`` is that of the new text."""
    prepare(spark)
    out = drop_shared_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; rows without an id all stay.

    Rows that share an id are one document: it stays with each of its different texts once, the one with the smallest other columns.
    """
    prepare(spark)
    kept = near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    rows = docs.join(kept, "doc_id", "left_semi").withColumn("__text", F.sha2(F.coalesce("text", F.lit("\0")), 256))
    first = F.min(F.struct(*[f"`{c}`" for c in docs.columns if c != "doc_id"])).alias("__row")
    one = rows.groupBy("doc_id", "__text").agg(first)
    one = one.select(*["doc_id" if c == "doc_id" else F.col(f"__row.`{c}`").alias(c) for c in docs.columns])
    return one.union(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item."""
    prepare(spark)
    text = F.coalesce("text", F.lit(""))
    row = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.sha2(text, 256))
    found = contaminated(docs.select(row.alias("row"), "text"), table(spark, sf_dir, "benchmark"), id_col="row").select("row").distinct()
    # The key is worked out again for the join only.
    return docs.join(found, row == found["row"], "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in training sequences."""
    prepare(spark)
    return pack_documents(docs, word_tokenizer())


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Training, near duplicates, edit distance and packing have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
