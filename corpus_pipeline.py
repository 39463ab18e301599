"""The training-data pipeline: five stages over ``documents``, each an operator of ``clipstat.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; the driver
writes its result as Parquet and reads it again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clipstat.llm import credentials, langid, mixing, packing, simhash
from clipstat.llm.common import stage, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go: null and empty texts, texts without a letter, and scores
    under the bound.  Texts of any length are judged whole, repeated rows alike; an empty table stays empty."""
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the smallest doc_id, null ids last, ties by fingerprint, then any
    one.  Rows that share an id without being near copies all stay; an empty table stays empty."""
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=3)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are masked; documents stay, null, empty and repeated ones too.  Texts of any
    length are scanned whole; an empty table stays empty."""
    return credentials.mask_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of its source ask for.  Equal rows and rows that share an id
    have copies of their own; null sources are one source; null and empty texts weigh nothing; ties go by id
    and size; an empty table stays empty."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences along the Hilbert curve, one row for each piece.  Null and empty texts have their end token;
    a text of any length is cut into pieces; repeated rows are packed each; an empty table gives no piece."""
    return packing.pack(docs)


STAGES = [("language ID", language_id), ("SimHash near-dedup", near_dedup), ("secret scans", secret_scan),
          ("mixing sources to target weights", mix), ("packing", pack)]

ORACLE_SQL = None  # XXH64 fingerprints, the language model and the tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{i}")
    return docs
