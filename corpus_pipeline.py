"""From documents to packed sequences: quality rules, exact and near deduplication, secret redaction, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracefold.llm import exact_dedup, packing, quality, queries, secret_scan, simhash
from tracefold.llm.common import cut, documents, keep_rows


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that every quality rule accepts, as they are. Null and empty texts are rejected; repeated rows are kept or dropped alike."""
    return quality.filtered(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space: the longest, then the smallest doc_id (null last), then the first row.

    Null, empty and all-white texts are one group.
    """
    return keep_rows(docs, lambda rows, row: exact_dedup.exact_groups(rows, row=row))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id (null last), then the first row. Copies share 0.8 of their five-word shingles.

    A text of fewer than five words is one shingle; null and empty texts are one group.
    """
    return keep_rows(docs, lambda rows, row: simhash.near_groups(rows, width=5, row=row, similar=0.8))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret in their text replaced by a mark; texts without any, null ones too, as they are."""
    return secret_scan.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of sequences of 4096 tokens; a null or empty text is its end id alone."""
    return packing.pack(docs, queries.tokenizer(spark, queries.WORD_BPE), queries.END_ID)


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_copies), ("near dedup", near_copies), ("secret scans", secrets), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents, each on the written result of the one before. Empty tables and columns of any name pass through all of them."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not packed:
            docs = cut(docs, name.replace(" ", "-"))
    return docs


#: SimHash of XXH64 and the tokenizer have no SQL; the tests hold run() against brute force.
ORACLE_SQL = None
