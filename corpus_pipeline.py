"""Documents to training sequences: five stages, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. `run` writes each result as Parquet to the
shared folder and reads it again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, neardup, packing, substrings, toxicity
from tidemark.llm.queries import remainder, tokenizer_path
from tidemark.session import materialise

REJECT_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below REJECT_FROM. Rows that share a doc_id go together."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = toxicity.toxicity(docs, labels.filter(F.coalesce(remainder(F.col("doc_id"), 3) != 1, F.lit(False))))
    bad = materialise(scores.filter(F.col("score") >= REJECT_FROM).select("doc_id").distinct(), "toxic")
    names = [F.col(f"`{c}`") for c in docs.columns]
    return docs.alias("d").join(bad.withColumnRenamed("doc_id", "bad"), F.col("d.doc_id").eqNullSafe(F.col("bad")), "left_anti").select(*names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    return neardup.without_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of words that stand elsewhere too; all rows stay."""
    return substrings.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens."""
    return packing.packed_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack),
]
# SQL can express neither the model nor the packing plan.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
