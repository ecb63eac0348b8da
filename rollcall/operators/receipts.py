"""Payment receipts: fields out of page text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import brazilian_money, capture, count_char, remove_chars
from rollcall.operators.relational import anti_load, keep_first, key_counts, keyed_join, split_by

MARKER = "COMPROVANTE"

# Characters removed from names and from numbers.
NAME_CHARS = '/\\:*?"<>.-'
FILE_CHARS = NAME_CHARS + " "

PAYEE_MARKER = "BENEFICIARIO:"

# Where each field stands on a page, and whether it may be empty. PAYEE_FIELDS stand after PAYEE_MARKER.
FIELDS = {
    "payer": (r"PAGADOR: (.+?)\n", False),
    "payer_branch": (r"AGENCIA: (\d+) +CONTA", False),
    "payer_account": (r"CONTA: ([\d.-]+)\nNR\. DOCUMENTO", False),
    "payer_doc_no": (r"NR\. DOCUMENTO:\s*(\d*)", True),
    "payee": (r"BENEFICIARIO: +(.+?)\n", False),
    "tax_id": (r"CPF/CNPJ: +([\d.-]+)", False),
    "payee_branch": (r"AGENCIA: (\d+)", False),
    "payee_account": (r"CONTA: ([\d.-]+)", False),
    "paid_on": (r"DATA DO PAGAMENTO: +([\d/]+)", False),
    "amount": (r"VALOR: +([\d.,]+)", False),
    "auth_no": (r"NR. AUTENTICACAO: +([\w.]+)", False),
    "payee_doc_no": (r"NR\. DOCUMENTO:\s*(\d*)", True),
}
PAYEE_FIELDS = ["payee_branch", "payee_account", "payee_doc_no"]
CLEANED = ["payer", "tax_id", "auth_no"]
NAME_PARTS = ["payee", "tax_id", "paid_on", "auth_no"]


def is_split_file(name: Column) -> Column:
    """Single receipts written by an earlier run have exactly three underscores in their name."""
    return count_char(name, "_") == 3


def receipt_name(parts: list[Column]) -> Column:
    """Name under which a receipt is known: its parts without blanks and punctuation."""
    return remove_chars(F.concat_ws("_", *parts), FILE_CHARS)


def receipt_pages(pages: DataFrame) -> DataFrame:
    """Pages that hold a receipt, of documents with more than one page."""
    whole = pages.filter(~is_split_file(F.col("doc")))
    several = key_counts(whole, ["doc"]).filter("rows_per_key > 1").select("doc")
    return keyed_join(whole.filter(F.col("text").contains(MARKER)), several, ["doc"], "left_semi")


def parse_receipts(pages: DataFrame) -> DataFrame:
    """All fields of each page; a field that is not there is NULL.

    The fields come out of a generator, which keeps later filters on them from running the patterns again.
    """
    at = F.locate(PAYEE_MARKER, F.col("text"))
    halves = pages.select("doc", "page", "text", F.when(at > 0, F.substring(F.col("text"), at, F.length("text"))).alias("after"))
    fields = [
        capture(F.col("after" if name in PAYEE_FIELDS else "text"), pattern, empty).alias(name)
        for name, (pattern, empty) in FIELDS.items()
    ]
    parsed = halves.select("doc", "page", F.inline(F.array(F.struct(*fields))))
    cleaned = parsed.withColumns({c: remove_chars(F.col(c), NAME_CHARS) for c in CLEANED} | {"payee": F.trim("payee")})
    return cleaned.withColumn("amount", brazilian_money(F.col("amount")))


def extract_receipts(pages: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New receipts, one per receipt name, and the pages on which a field is missing.

    ``existing`` holds the names of the receipts known already.
    """
    parsed = parse_receipts(receipt_pages(pages))
    rejects, complete = split_by(parsed, reduce(or_, [F.col(name).isNull() for name in FIELDS]))
    named = complete.withColumn("receipt", receipt_name([F.col(c) for c in NAME_PARTS]))
    receipts = anti_load(keep_first(named, ["receipt"], ["doc", "page"]), existing, ["receipt"])
    return receipts, rejects.select("doc", "page")
