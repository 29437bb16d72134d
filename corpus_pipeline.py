"""From raw documents to encoded ones: five stages, each written as Parquet and read again by the next one.

What every stage makes of odd rows follows from its operator: a null text is an empty one (the first stage rejects both),
texts of any length are worked on whole, ids that several rows share are told apart by text where rows are chosen and
count as one document where documents are counted, null ids come last, rows repeated exactly are one group of near
duplicates, further columns of documents are not handed on, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import bpe, linededup, mixing, quality, simhash
from starload.llm.common import DOCUMENT_COLUMNS, table, written
from starload.llm.registry import VOCABULARY


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, the length told anew as a text may have lost lines."""
    return df.withColumn("n_chars", F.char_length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go (short, repeating or depleted ones; null and empty texts are short); kept ones lose the lines
    that ten or more documents of their host hold."""
    return _documents(quality.clean(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents hold go, from all of them; a text that loses all its lines stays as the empty one."""
    return _documents(linededup.deduped_text(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest doc_id; without one only if none has
    any, and then the first by its columns."""
    return simhash.one_of_each(docs).select(*DOCUMENT_COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that sources, languages and topics come near their target weights; rows of one id together."""
    return mixing.sample(docs).select(*DOCUMENT_COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids (little-endian unsigned 32-bit integers) of each document; none for an empty
    text."""
    found = bpe.encode_documents(docs, VOCABULARY, ["doc_id", "lang", "source"])
    return found.select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_duplicates),
    ("mixing to target weights", mixed),
    ("bpe encoding", encoded),
]

# Fingerprints (XXH64) and byte-pair encoding are not expressible in DuckDB SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents; the rows between them go through tables in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs, f"stage-{number}")
    return docs
