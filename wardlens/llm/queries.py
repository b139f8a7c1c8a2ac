"""The queries of this folder's operators over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.llm import (
    decision_list,
    hard_negatives,
    lexicon_bpe,
    minhash,
    mixing,
    ordinal,
    pieces,
    pii,
    prefix_counts,
    sharding,
    simhash_trie,
    spelling,
    token_orc,
)
from wardlens.llm.common import stage
from wardlens.sources.tables import parquet_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "documents")


@query
def op2_token_orc(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids written as ORC files and read back: where each document starts."""
    path = f"{stage(spark).folder}/tokens"
    token_orc.write_token_files(documents(spark, folder), path)
    return token_orc.checked_tokens(spark, path)


@query
def op3_prefix_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, with the counts of all its prefixes."""
    return prefix_counts.count_tokens(documents(spark, folder))


@query
def op6_simhash_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and the components of near ones."""
    return simhash_trie.simhash_components(documents(spark, folder))


@query
def op7_entropy_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.mix_report(documents(spark, folder))


@query
def op8_interleaved_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place in shards that all have the table's mixture."""
    return sharding.shard(documents(spark, folder))


ORACLES["op8_interleaved_shards"] = sharding.SHARD_SQL


@query
def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of every document and what decoding them gives."""
    return pieces.encode_and_check(documents(spark, folder))


@query
def op9_one_permutation_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and their likeness."""
    return minhash.fingerprint_report(documents(spark, folder))


@query
def op4_bootstrapped_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: by form, and by learned context."""
    return pii.pii_report(documents(spark, folder))


@query
def op5_decision_list(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of every document, and whether the learned rules keep it."""
    labels = parquet_table(spark, folder, "labels")
    return decision_list.quality_report(documents(spark, folder), labels)


@query
def op1_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade of every document, and whether it is likely of the best grade."""
    labels = parquet_table(spark, folder, "labels")
    return ordinal.quality_report(documents(spark, folder), labels)


@query
def op11_kronecker_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, for each of its positives."""
    embeddings = hard_negatives.moved_labels(parquet_table(spark, folder, "embeddings"))
    return hard_negatives.hard_negatives(embeddings, anchor=F.col("vec_id") % 100 == 0)


ORACLES["op11_kronecker_negatives"] = hard_negatives.HARD_NEGATIVE_SQL


@query
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Frequent words, their near words, and the forms and roots of variants."""
    return spelling.variant_report(documents(spark, folder))


ORACLES["op12_spelling_variants"] = spelling.VARIANT_SQL


@query
def op13_lexicon_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document through a lexicon of frequent words, and decoded again."""
    return lexicon_bpe.code_report(documents(spark, folder))
