"""From raw documents to token ids: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns rows with the columns of documents, the
last one token ids. What a stage decides takes effect: rejected documents, duplicates and
documents with benchmark items go, secrets are replaced in the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyrisk.llm import decontaminate, neardup, pieces, quality, registry, secrets
from skyrisk.llm.shared import landed


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble takes for good ones."""
    registry.ship(spark)
    model = quality.fit(docs, registry.table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def first_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    registry.ship(spark)
    return neardup.one_of_each(docs)


def unseen_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    registry.ship(spark)
    return decontaminate.without_leaks(docs, registry.table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced and their lengths counted again."""
    registry.ship(spark)
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256."""
    registry.ship(spark)
    return pieces.token_rows(docs, registry.piece_model())


STAGES = [
    ("quality classifier", good_documents),
    ("minhash near-dedup", first_of_copies),
    ("benchmark decontamination", unseen_documents),
    ("secret scans", without_secrets),
    ("sentencepiece", token_ids),
]

ORACLE_SQL = None  # forests, fingerprints and merges are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; results between stages are written."""
    docs = registry.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = landed(docs, f"stage{i}")
    return docs
