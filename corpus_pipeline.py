"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and
read back as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import ngram_join, packing, quality, secrets, toxicity
from lakeops.llm.common import fold, small_batches, table
from lakeops.workspace import new_folder, stored

#: Documents below this quality go, and documents from this toxicity on.
QUALITY, TOXIC = 0.3, 0.3


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.

    It learns from labels outside the held-out fold. NULL and empty texts hold nothing to
    judge: they are kept, whatever the share of good labels. Rows with a NULL id are judged by
    their text. Without labels of both kinds every document is kept. A text is scored whole,
    in pieces.
    """
    small_batches(spark)
    model = quality.learn(docs, table(spark, sf_dir, "labels"), fold("id", 5) != 0)
    if not model.weights:
        return docs
    nothing = F.coalesce(F.col("text"), F.lit("")) == ""
    return docs.filter(nothing | (quality.quality_score(model, F.col("text")) >= QUALITY))


def civil_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic.

    NULL and empty texts match nothing and are kept; rows with a NULL id are judged by their
    text. Without labels of both kinds every document is kept. A text is scored whole, clause
    by clause.
    """
    small_batches(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), fold("id", 4) != 2)
    if not model.weights:
        return docs
    nothing = F.coalesce(F.col("text"), F.lit("")) == ""
    return docs.filter(nothing | (toxicity.toxicity_score(model, F.col("text")) < TOXIC))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, Jaccard 0.8 or more.

    The smallest id stays. Documents without words and with a NULL id are no copies.
    Long texts are hashed in slices.
    """
    small_batches(spark)
    return ngram_join.one_of_each(docs, ngram_join.Similarity(words=5, percent=80))


def masked_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and n_chars brought up to date.

    NULL and empty texts and NULL ids stay as they are.
    """
    ledger = secrets.BlobLedger(spark, new_folder(spark, "secrets"))
    return secrets.mask_documents(ledger, "documents", docs)


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 token ids.

    NULL and empty texts are the end id alone; NULL ids stay NULL. Long texts are cut at 2048
    ids before they are dealt to groups.
    """
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=1)


STAGES = [
    ("quality", good_documents),
    ("toxicity", civil_documents),
    ("near_copies", distinct_documents),
    ("secrets", masked_documents),
    ("packing", packed_documents),
]

#: SQL has no compression, trained grammar or tokenizer; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
