"""From raw documents to a tokenised training mix, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last keep the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import jaccard, langid, mix, pieces, pii
from ledgerline.llm.shared import settle, table

#: No SQL for Feistel pseudonyms and piece ids; tested against brute force instead.
ORACLE_SQL = None

#: For test data; a real run brings its own secret.
PII_KEY = "key of the test pipeline"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; the others go.

    NULL text and text without a letter are rejected; repeated rows are judged alike; nothing to learn from
    rejects all; an empty table stays empty; columns stay as they are.
    """
    model = langid.train(docs.where(~langid.held_out()))
    return langid.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 on five-word shingles.

    The smallest doc_id stays, then text hash, then hash of the other columns; rows without words or doc_id link
    nothing and stay; columns stay as they are.
    """
    return jaccard.keep_one(docs, size=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms.

    Same rows and columns; NULL and empty texts stay as they are, repeated rows get the same pseudonyms.
    """
    return pii.pseudonymise(docs, PII_KEY).select(*(F.col(f"`{c}`") for c in docs.columns))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document occurs 0, 1 or 2 times.

    NULL source is a source of its own; documents without words have size 0; columns stay as they are.
    """
    return mix.emit(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids: NULL text has NULL ids and no tokens, empty text no ids."""
    import public_tokenizers

    model = pieces.load(spark, public_tokenizers.path("piece_bpe_32k.model"))
    ids = pieces.encode(docs.select("doc_id", "source", "text"), model)
    return ids.select("doc_id", "source", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("tokenised", tokenised),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
