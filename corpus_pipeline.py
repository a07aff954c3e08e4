"""A corpus pipeline of five stages, each written as a table and read again by the next.

Every stage works on all documents that the one before kept. The first four return the columns of
`documents`; the last returns the tokens. Rows that a stage can't judge (null or empty texts) take the
result that its operator's docstring gives for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadpulse.llm import boilerplate, contamination, divergence, jaccard, pieces
from roadpulse.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject."""
    return divergence.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that many sites share, but for their first place; without documents left empty."""
    cut = boilerplate.remove_boilerplate(docs)
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(
        F.col("n_chars"))).drop("n_removed")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares at least 0.8 of its five-word shingles."""
    return jaccard.drop_near_duplicates(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have a passage of the benchmark."""
    return contamination.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of pieces, their ids, and the N best segmentations' scores, sizes and round trip."""
    return pieces.tokens(docs, ["doc_id"])


STAGES = [("quality rules", quality), ("line dedup", lines), ("near duplicates", near_duplicates),
          ("benchmark decontamination", decontamination), ("sentencepiece encoding", tokens)]

#: SQL has no SentencePiece; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
