"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, folder of the tables) and returns a frame whose
decisions have taken effect; all but the last return the columns of documents.
Every stage's result is written as Parquet to the shared folder and read again
as the next one's documents, so a lost executor repeats part of one stage.

Defined cases of all stages: a null text is empty; a null id is a document like
any other; repeated rows are documents of their own until the copies go; an
empty table stays empty; extra columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesweft.llm import exact_dedup, mixing, ngram_join, packing, quality_model
from salesweft.llm.columns import fold, table
from salesweft.session import importable, written

# Weights after quality filtering and deduplication: clean text keeps its
# tokens, the rest is thinned in proportion to it.
TARGETS = {"clean": 0.95, "toxic": 0.03, "low": 0.02}
SCORE = "__pipeline_score"


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Empty texts get the score of the bias, a score of exactly 0.5 stays.
    """
    importable(spark)
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 3) != 1)
    scored = quality_model.scored(docs, quality_model.train(docs, labels), score_column=SCORE)
    return scored.where(F.col(SCORE) >= 0.5).drop(SCORE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts.

    The longest original stays, of equally long ones that of the smallest id,
    of repeated rows one; all empty texts are one group.
    """
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by similar word shingles.

    That of the smallest id stays, null ids last; empty texts link to nothing.
    """
    importable(spark)
    return ngram_join.deduplicated(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at the rates that bring the domains to their target weights.

    A rate below 1 keeps a document by a hash of its id and text, one above 1
    may repeat it; empty texts have no tokens and go by their rate as well.
    """
    return mixing.mixed(docs, mixing.label_domains(table(spark, sf_dir, "labels")), TARGETS, anchor="clean")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences; a text without tokens is its end token alone."""
    importable(spark)
    return packing.packed_documents(docs)


STAGES = [
    ("quality_filter", quality_filter),
    ("drop_copies", drop_copies),
    ("drop_near_copies", drop_near_copies),
    ("mix_domains", mix_domains),
    ("pack", pack),
]

# Trained models and tokenisation are beyond SQL; a test compares the pipeline
# with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
