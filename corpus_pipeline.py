"""The training corpus: filter, deduplicate, redact, mix and pack all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from odoscore.llm.common import read, stored
from odoscore.llm.mixing import mixed_documents
from odoscore.llm.packing import pack_documents
from odoscore.llm.secrets import redacted_documents
from odoscore.llm.simhash import keep_one_per_group
from odoscore.llm.toxicity import accepted_documents


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    return accepted_documents(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest doc_id."""
    return keep_one_per_group(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; a secret is replaced by its kind."""
    return redacted_documents(docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, the one at a source's budget cut."""
    return mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their texts, each in its bin.

    Texts go through the tasks here, so the shards are smaller.
    """
    return pack_documents(docs, with_text=True, shard_rows=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_to_weights),
    ("packing", pack_sequences),
]

#: Learned scores and fingerprints are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over all documents, each written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
