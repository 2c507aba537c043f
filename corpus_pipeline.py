"""Training-corpus pipeline over ``documents``, one operator a stage.

Each stage takes all that its predecessor kept and returns a DataFrame that is written
and read again as the next stage's documents.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgersieve.llm import bpe, minhash, pii, toxicity, winnow
from ledgersieve.llm.queries import vocabulary
from ledgersieve.llm.store import ship, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    ship(spark)
    weights = toxicity.model(docs, table(spark, sf_dir, "labels"))
    return toxicity.kept(docs, weights)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest doc_id."""
    ship(spark)
    return minhash.kept(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten consecutive words of a benchmark item."""
    ship(spark)
    return winnow.kept(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    ship(spark)
    return pii.redacted(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token ids, and the text decoded from them."""
    ship(spark)
    coded = bpe.encode_decode(docs, vocabulary(), digests=False)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", redact),
    ("bpe", tokenize),
]

#: The stages learn a model and compare hashed signatures; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
