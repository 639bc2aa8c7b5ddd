"""The corpus pipeline: each stage works on all rows that the one before it kept.

An empty table gives empty results at every stage. Other columns are carried along up to the
last stage and may have any name.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, decontaminate, langid, secrets, simhash
from tidemark.llm.common import table
from tidemark.session import stored

# A document is kept when its best language has at least this pooled probability.
MIN_SCORE = 0.4


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose text has letters and a recognised language.

    Null and empty texts go. Repeated rows and rows without an id are judged like any other.
    """
    return langid.recognised(docs, langid.train(docs), MIN_SCORE)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies.

    The smallest id stays; rows without an id only where no copy has one. Null and empty
    texts are copies of each other, repeated rows leave one, different texts of one id are
    judged each for itself.
    """
    return simhash.one_of_each_group(docs, shingle=3, radius=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that hold no benchmark item.

    Null and empty texts hold none and stay; repeated rows and rows without an id are judged
    like any other.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep all documents, with secrets in their texts replaced.

    Null texts stay null; every repeated row and every row without an id is rewritten.
    """
    ledger = secrets.Ledger.create(spark)
    ledger.ingest(docs)
    return secrets.redact(docs, ledger)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_bytes): the token ids of every text and the bytes that they decode to.

    Null and empty texts have no ids and no bytes; each row gives one, with or without an id.
    """
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN)
    return bpe.decode(encoded, path).select("doc_id", "ids", F.length("decoded").cast("long").alias("n_bytes"))


STAGES = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("byte_bpe", encoding_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
