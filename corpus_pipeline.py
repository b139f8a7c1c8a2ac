"""From raw documents to coded training text.

Quality rules drop what they reject, of near-duplicates one document stays, personal data is
masked, sources are mixed to their target weights, and what is left is coded in pieces. Each
stage works on all its predecessor kept and returns the columns of documents, the last one
the pieces.

Cases: every stage takes null ids, texts and sources, repeated rows, empty tables and extra
columns as its operator states; a missing table is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardlens.llm import decision_list, mixing, pieces, pii, simhash_trie
from wardlens.llm.common import stage
from wardlens.sources.tables import parquet_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the base rules and the learned decision list keep."""
    return decision_list.passing(docs, parquet_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts with near SimHash fingerprints."""
    return simhash_trie.one_of_each(docs, words=3, budget=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data masked."""
    return pii.mask(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document, decoded again as a check."""
    return pieces.encode_and_check(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("PII", personal_data),
    ("mixing sources to target weights", source_mix),
    ("SentencePiece encoding and decoding", piece_ids),
]

#: Fitted rules, fingerprints and pieces have no SQL; tests compare the stages otherwise.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet and read again."""
    keep = stage(spark).keep
    docs = parquet_table(spark, sf_dir, "documents")
    for place, (_, step) in enumerate(STAGES):
        docs = keep(step(spark, docs, sf_dir), f"stage-{place}")
    return docs
