"""A corpus pipeline of five operators, each stage a table that the next one reads.

Stages: quality rules, language identification, line dedup, MinHash near-dedup (five
words, similarity 0.8), best-fit packing. The first four return the columns of
documents; the last returns the packed sequences.

Rows with a null id or text: the quality rules reject null and empty texts (they have
fewer than ten words), so later stages see none; null ids pass unharmed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.llm.common import Scratch, scope
from veilframe.llm.langid import keep_known
from veilframe.llm.line_dedup import drop_recurring_lines
from veilframe.llm.minhash import keep_one
from veilframe.llm.packing import best_fit
from veilframe.llm.quality_rules import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands and the base rules keep."""
    return keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with a score of 0.5 or more."""
    return keep_known(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of recurring templates; one that has no line left goes, it is told elsewhere."""
    return drop_recurring_lines(docs).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left, packed into sequences."""
    return best_fit(docs)


STAGES = [
    ("quality", quality),
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder and read again.

    What a stage keeps for itself is dropped once its result is written.
    """
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scope():
            docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Compression ratios, the network and the packing cannot be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None
