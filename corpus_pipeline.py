"""Corpus pipeline: toxicity, near duplicates, benchmark decontamination,
secret redaction and packing, each over all that its predecessor kept.

Stages take (spark, docs, sf_dir) and return a DataFrame that is written as
Parquet and reread as the next stage's docs; all but the last return the
columns of documents.  Nulls, empty texts, repeated rows, empty tables and
extra columns have the results that the operators' docstrings define.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.llm import decontam, neardup, packing, secrets, toxicity
from paneltide.llm.common import remainder_of_id, stored, table
from paneltide.llm.queries import RANKS, TOXIC
from paneltide.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), may_learn=remainder_of_id("id", 4) != 2)
    return toxicity.score(docs, model).filter(F.col("score") < TOXIC).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate class."""
    ship_package(spark)
    return neardup.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark windows."""
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets replaced by a mark."""
    ship_package(spark)
    return secrets.redact(docs, secrets.train(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048 ids."""
    ship_package(spark)
    pieces = packing.pack(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return pieces.select(F.col("row.doc_id").alias("doc_id"), "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: The classifier and the sampled signatures are beyond SQL; the tests hold each
#: stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
